import numpy as np
import pytest
from pyspark.sql import functions as F

from lastcol.llm import metric_join as mj


def brute(rows, cut):
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    links, low = [0] * n, list(range(n))
    adj = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if (unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
                    and float(unit[i] @ unit[j]) >= cut):
                adj[i].append(j)
                adj[j].append(i)
    out = {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in adj[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        comp = min(rows[k][0] for k in seen)
        out[rows[i][0]] = (len(adj[i]), comp, comp == rows[i][0])
    return out


@pytest.mark.parametrize("cell,block", [(1000, 2048), (20, 16)])
def test_equals_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(mj, "CELL", cell)
    monkeypatch.setattr(mj, "BLOCK", block)
    rng = np.random.default_rng(7)
    rows = []
    centre = rng.normal(size=(12, 8))
    for i in range(500):
        c = centre[rng.integers(12)]
        v = c + rng.normal(size=8) * rng.choice([0, 0.05, 0.1, 0.2, 1.0])
        rows.append((1000 - i, [float(x) for x in np.float32(v * rng.choice([0.5, 1, 3]))], int(rng.integers(3))))
    rows += [(2000 + i, list(rows[0][1]), rows[0][2]) for i in range(30)]
    rows += [(3000, None, 1), (3001, [0.0] * 8, 1), (3002, [float("nan")] * 8, 1), (3003, rows[0][1], None),
             (3004, [None] * 8, 1), (3005, [], 1), (3006, [float("inf")] + [0.0] * 7, 1), (3007, rows[0][1][:5], rows[0][2])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, weight int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in mj.near_duplicates(df).collect()}
    assert got == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c)
                         for i, v, c in rows], 0.98)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert mj.near_duplicates(df).count() == 0


def test_one_row_per_row_where_ids_repeat(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 6)).tolist()
    rows = [(1, a, "x"), (1, None, "x"), (1, b, "x"), (2, a, "x"), (2, a, "y"), (3, b, None), (3, b, "x"), (None, a, "x"), (4, a, ""), (4, a, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("h", F.lit("clash")).withColumn("point", F.lit(1))
    got = sorted(tuple((x is None, x or 0) for x in r) for r in mj.near_duplicates(df).collect())
    want = [(1, 1, 1, True), (1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (2, 0, 2, True), (3, 0, 3, True), (3, 1, 1, False),
            (None, 0, None, True), (4, 1, 4, True), (4, 1, 4, True)]
    assert got == sorted(tuple((x is None, x or 0) for x in r) for r in want)


def test_many_labels_and_float_labels(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist(), float(i // 2) if i > 1 else (0.0, -0.0)[i]) for i in range(400)]
    rows += [(1000 + i, v, c) for i, v, c in rows[:100]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in mj.near_duplicates(df).collect()}
    assert got == brute(rows, 0.98)
