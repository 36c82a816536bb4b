import random

import pytest
from pyspark.sql import functions as F

from lastcol.operators import runs
from lastcol.operators.runs import (block_checkpoints, compressed_size, decode_text, rank_at,
                                    run_length_encode, symbol_at, symbol_histogram, symbols,
                                    text_runs)
from lastcol.plans.segments import floor_join


def _blocks(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "block_id long, text string")


def test_runs_and_bytes(spark):
    runs = text_runs(_blocks(spark, ["aaabbc", "x" * 131]))
    got = sorted((r.block_id, r.symbol, r.start_pos, r.run_len) for r in runs.collect())
    assert got == [(0, "a", 0, 3), (0, "b", 3, 2), (0, "c", 5, 1), (1, "x", 0, 131)]
    size = {r.block_id: r.encoded_bytes for r in compressed_size(runs).collect()}
    assert size[0] == 5 and size[1] == 3 and size[None] == 8


def test_decode_inverts_encode(spark):
    random.seed(1)
    texts = ["".join(random.choice("aab\n é") for _ in range(random.randint(1, 60))) for _ in range(40)]
    back = {r.block_id: r.text for r in decode_text(text_runs(_blocks(spark, texts))).collect()}
    assert [back[i] for i in range(len(texts))] == texts


def _brute_runs(rows):
    out, prev = [], None
    for key, order, value in rows:
        if prev is not None and prev[0] == key and prev[1] == value:
            out[-1][3] += 1
        else:
            n = sum(1 for o in out if o[0] == key)
            out.append([key, value, order, 1, n])
        prev = (key, value)
    return sorted((k, n, v, o, c) for k, v, o, c, n in out)


def test_runs_with_hot_key_across_partitions(spark):
    random.seed(3)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 else random.randint(1, 40)      # key 0 holds two thirds of the rows
        rows.append((key, i, random.choice("ab") if key == 0 else random.choice("abc")))
    df = spark.createDataFrame(rows, "k long, o long, v string")
    for parts in (1, 7, 32):
        got = sorted((r.k, r.run_no, r.v, r.start, r.run_len)
                     for r in run_length_encode(df, "k", "o", "v", partitions=parts).collect())
        assert got == _brute_runs(sorted(rows)), parts


def test_global_runs_with_nulls(spark):
    vals = [None, None, "a", "a", None, "b", "b", "b", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "o long, v string")
    got = sorted((r.run_no, r.v, r.start, r.run_len)
                 for r in run_length_encode(df, None, "o", "v", partitions=4).collect())
    assert got == [(0, None, 0, 2), (1, "a", 2, 2), (2, None, 4, 1), (3, "b", 5, 3), (4, None, 8, 1)]


def test_floor_join_hot_key(spark):
    random.seed(5)
    left = [(0 if i % 4 else i % 9, i * 3 + 1, f"l{i}") for i in range(1500)]
    right = [(0 if i % 2 else i % 9, i * 5, f"r{i}") for i in range(900)]
    ldf = spark.createDataFrame(left, "k long, p long, lv string")
    rdf = spark.createDataFrame(right, "k long, rp long, rv string")
    for parts in (3, 16):
        got = sorted((r.k, r.p, r.rv) for r in floor_join(ldf, rdf, "p", "rp", ["k"], parts).collect())
        exp = []
        for k, p, _ in left:
            cands = [(rp, rv) for kk, rp, rv in right if kk == k and rp <= p]
            exp.append((k, p, max(cands)[1] if cands else None))
        assert got == sorted(exp), parts


def test_histogram_checkpoints_rank_and_access(spark):
    texts = ["abracadabra", "mississippi"]
    blocks = _blocks(spark, texts)
    runs = text_runs(blocks)
    hist = {(r.block_id, r.symbol): (r.cnt, r.cnt_smaller)
            for r in symbol_histogram(runs, "block_id", weight="run_len").collect()}
    assert hist[(0, "a")] == (5, 0) and hist[(0, "b")] == (2, 5) and hist[(1, "s")] == (4, 7)
    cps = block_checkpoints(runs, chunk=4)
    cp = {(r.block_id, r.chunk_no, r.symbol): r.cnt_before for r in cps.collect()}
    assert cp[(1, 2, "s")] == 4 and cp[(0, 0, "a")] == 0
    q = symbols(blocks)
    occ = {(r.block_id, r.pos): r.occ for r in rank_at(runs, cps, q, chunk=4).collect()}
    for b, t in enumerate(texts):
        for i, c in enumerate(t):
            assert occ[(b, i)] == t[: i + 1].count(c)
    at = {(r.block_id, r.pos): r.symbol for r in symbol_at(runs, q.select("block_id", "pos")).collect()}
    assert all(at[(b, i)] == c for b, t in enumerate(texts) for i, c in enumerate(t))
    neg = spark.createDataFrame([(0, -1, "a")], "block_id long, pos long, symbol string")
    assert rank_at(runs, cps, neg, chunk=4).first().occ == 0


@pytest.mark.parametrize("name", ["rank_at", "symbol_at"])
def test_exploded_rows_are_not_broadcast(spark, name):
    import __spark_entry__ as entry
    plan = entry.queries()[name](spark, entry.SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_runs_of_odd_texts_in_batches(monkeypatch):
    import pyarrow as pa
    from itertools import groupby
    texts = ["a", "aa", "a\0\0b", "\U0001f600\U0001f600é́é", "x" * 50, "aab" * 20, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(90, 90 + len(texts)), pa.int64()), pa.array(texts)], names=["block_id", "text"])
    monkeypatch.setattr(runs, "_ROWS", 7)
    monkeypatch.setattr(runs.slices, "__defaults__", (8,))
    got = [tuple(r.values()) for b in runs._runs_of(iter([batch.slice(1), batch.slice(0, 1)])) for r in b.to_pylist()]
    want = []
    for i in [*range(1, len(texts)), 0]:
        at = 0
        for k, (c, g) in enumerate(groupby(texts[i])):
            n = len(list(g))
            want.append((90 + i, k, c, at, n))
            at += n
    assert got == want


def test_runs_that_follow_each_other_are_joined_before_they_are_grouped(spark):
    import pyarrow as pa
    rows = [(1, "a", 0, 2), (1, "é", 2, 3), (2, "a", 5, 1), (1, "b", 5, 1), (1, "c", 7, 1), (2, "x", 0, 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["block_id", "symbol", "start_pos", "run_len"])
    got = [tuple(r.values()) for b in runs._pieces_of(iter([batch])) for r in b.to_pylist()]
    assert got == [(1, 0, "aaééé"), (2, 5, "a"), (1, 5, "b"), (1, 7, "c"), (2, 0, "xxxxx")]
    df = spark.createDataFrame([r for r in rows if r[2:] != (7, 1)], "block_id long, symbol string, start_pos long, run_len long")
    assert sorted(map(tuple, runs.decode_text(df).collect())) == [(1, "aaééé" + "b"), (2, "xxxxxa")]


def test_checkpoints_of_runs_in_any_order_are_shuffled_as_blocks(spark):
    """Runs of a block dealt over partitions and batches; one row per block is shuffled, and no window is left."""
    texts = {i: "".join("aéb\n"[(i * j * j + j // 7) % 4] for j in range(i * 13 % 90 + 1)) for i in range(60)}
    runs = text_runs(spark.createDataFrame(list(texts.items()), "block_id long, text string"))
    want = {(b, c, s): t[:c * 8].count(s) for b, t in texts.items() for s in set(t) for c in range((len(t) - 1) // 8 + 1)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for dealt in (runs, runs.repartition(7)):
            out = block_checkpoints(dealt, 8)
            rows = out.collect()
            assert {(r.block_id, r.chunk_no, r.symbol): r.cnt_before for r in rows} == want and len(rows) == len(want)
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            assert "Window" not in plan and "Aggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
