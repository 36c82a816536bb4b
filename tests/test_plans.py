import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyword_search_pushdown_no_udf(spark):
    plan = _plan(entry.entry(spark))
    assert "StringContains(text,tion)" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_every_query_plans(spark):
    for name, fn in entry.queries().items():
        if name in {"tagged_round_trip", "runs_store_round_trip", "indexed_search"} or name.startswith(
                ("corpus_", "suffix_", "file_index_", "signed_", "index_reuse")):
            continue  # these write their inputs first
        df = fn(spark, entry.SF0001)
        assert df.columns, name
        assert "BatchEvalPython" not in _plan(df), name


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and all("tion" in r.content for r in rows)
