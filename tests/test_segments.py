import random

import pytest

from lastcol.operators.runs import rank_at, run_length_encode, text_runs
from lastcol.plans.segments import floor_join, ordered_runs

BIG = 2**53


@pytest.mark.parametrize("partitions", [1, 7])
def test_floor_join_is_exact(spark, partitions):
    left = spark.createDataFrame(
        [("a", BIG + 1, 5), ("a", BIG + 3, 9), ("b", BIG + 5, 1), (None, BIG + 7, 5), ("a", BIG + 9, None), ("a", BIG + 11, 0)],
        "k string, id long, pos long")
    right = spark.createDataFrame(
        [("a", 4, BIG + 1, "r2"), ("a", 4, BIG + 1, "r1"), ("a", 8, None, "x"), (None, 1, 7, "null key"), ("a", None, 8, "null pos")],
        "k string, rpos long, rid long, name string")
    got = {r.id: (r.rpos, r.rid, r.name) for r in floor_join(left, right, "pos", "rpos", ["k"], partitions,
                                                            tie=["name"]).collect()}
    none = (None, None, None)
    assert got == {BIG + 1: (4, BIG + 1, "r2"), BIG + 3: (8, None, "x"), BIG + 5: none, BIG + 7: none, BIG + 9: none,
                   BIG + 11: none}


@pytest.mark.parametrize("partitions", [1, 9])
def test_floor_join_equals_brute_force_with_a_hot_key(spark, partitions):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot"] * 6 + ["x", "y", "z"])
    left = [(key(), i, rng.randint(0, 300)) for i in range(300)]
    right = [(key(), rng.randint(0, 300), 1000 + i) for i in range(60)]
    got = {r.id: r.rid for r in floor_join(
        spark.createDataFrame(left, "k string, id long, pos int"),
        spark.createDataFrame(right, "k string, rpos int, rid long"), "pos", "rpos", ["k"], partitions).collect()}
    for k, i, pos in left:
        before = [(p, rid) for rk, p, rid in right if rk == k and p <= pos]
        assert got[i] == (max(before)[1] if before else None)


@pytest.mark.parametrize("partitions", [1, 5])
def test_runs_tell_null_from_nan_and_keep_long_values(spark, partitions):
    nan = float("nan")
    df = spark.createDataFrame([(BIG + 1, 1, None), (BIG + 1, 2, None), (BIG + 1, 3, nan), (BIG + 1, 4, nan), (BIG + 1, 5, 1.0),
                                (None, 1, 1.0), (None, 2, 1.0)], "k long, t int, v double")
    got = sorted(((r.k or 0, r.run_no, str(r.v), r.start, r.run_len)
                  for r in run_length_encode(df, "k", "t", "v", partitions).collect()))
    assert got == [(0, 0, "1.0", 1, 2), (BIG + 1, 0, "None", 1, 2), (BIG + 1, 1, "nan", 3, 2), (BIG + 1, 2, "1.0", 5, 1)]


def test_runs_equal_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 5 + ["x"]), i, rng.choice("aab")) for i in range(800)]
    want = []
    for k in ("hot", "x"):
        own, no = [r for r in rows if r[0] == k], -1
        for n, (_, t, v) in enumerate(own):
            if n == 0 or v != own[n - 1][2]:
                no += 1
                want.append([k, no, v, t, 0])
            want[-1][4] += 1
    got = run_length_encode(spark.createDataFrame(rows, "k string, t int, v string"), "k", "t", "v", 11).collect()
    assert sorted(map(list, got)) == sorted(want)


def test_text_runs_do_not_shuffle(spark):
    df = spark.createDataFrame([(1, "aabé"), (2, ""), (3, None)], "block_id long, text string")
    runs = text_runs(df)
    assert "Exchange" not in runs._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, runs.collect())) == [(1, 0, "a", 0, 2), (1, 1, "b", 2, 1), (1, 2, "é", 3, 1)]


def test_rank_of_a_repeated_query(spark):
    from lastcol.operators.runs import block_checkpoints
    runs = text_runs(spark.createDataFrame([(1, "banana")], "block_id long, text string"))
    q = spark.createDataFrame([(1, 5, "a"), (1, 5, "a")], "block_id long, pos long, symbol string")
    assert [r.occ for r in rank_at(runs, block_checkpoints(runs, 4), q, 4).collect()] == [3, 3]


def test_runs_are_stored_and_rows_shuffled_once(spark):
    """Runs that go over Arrow batches and slices; nothing but runs is stored or grouped by slice."""
    rows = [(i, "hot" if i % 4 else None, [1.0, float("nan"), None][(i // 11) % 3], {"a": float("nan") if (i // 9) % 2 else 1.0})
            for i in range(500)]
    df = spark.createDataFrame(rows, "i long, k string, v double, s struct<a: double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for value in ("v", "s"):
            out = ordered_runs(df, ["k"], ["i"], value, partitions=5)
            assert "row_number" not in out._jdf.queryExecution().optimizedPlan().toString()
            want, last = {}, {}
            for r in sorted(rows, key=lambda r: r[0]):
                mine = str(r[2] if value == "v" else r[3]["a"])
                if last.get(r[1]) == mine:
                    want[r[1]][-1][1] += 1
                else:
                    want.setdefault(r[1], []).append([r[0], 1])
                last[r[1]] = mine
            got = {(r.k, r.run_no): [r.start, r.run_len] for r in out.collect()}
            assert got == {(k, n): run for k, runs in want.items() for n, run in enumerate(runs)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
