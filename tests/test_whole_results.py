import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402


def test_bwt_documents_returns_every_block(spark):
    blocks = {r.block_id for r in entry._doc_blocks(spark, entry.SF0001).collect()}
    assert any(b % 20 for b in blocks)
    assert {r.block_id for r in entry.queries()["bwt_documents"](spark, entry.SF0001).collect()} == blocks


def test_compressed_size_bwt_returns_every_block_and_the_total(spark):
    blocks = {r.block_id for r in entry._doc_blocks(spark, entry.SF0001).collect()}
    assert {r.block_id for r in entry.queries()["compressed_size_bwt"](spark, entry.SF0001).collect()} == blocks | {None}
