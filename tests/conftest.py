import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lastcol.session import build_session  # noqa: E402

# Fixed value: the reference's only sample input (4 records, 79 bytes).
SAMPLE = "[8]Computers in industry[9]Data compression[10]Integration[11]Big data indexing"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lastcol-test-ckpt-")})
    yield s


@pytest.fixture(scope="session")
def sample_path(tmp_path_factory):
    p = tmp_path_factory.mktemp("sample") / "dummy.txt"
    p.write_text(SAMPLE)
    return str(p)


@pytest.fixture(scope="session")
def sample_records(spark, sample_path):
    from lastcol.sources import read_tagged_records
    return read_tagged_records(spark, sample_path).select("record_id", "content").cache()
