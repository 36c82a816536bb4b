import random

import numpy as np

from lastcol.llm import quality


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        good = rng.random() < 0.6
        words = ["".join(rng.choice(["ta", "ne", "ri", "so"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 90))]
        text = " ".join(words) if good else " ".join([words[0].upper() + "!!"] * len(words))
        source = rng.choice(["s1", "s2"] if good else ["s2", "s3"])
        rows.append((i, text, "en", source, len(text), int(good)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(400)
    odd = [(1000, None, None, None, None), (1001, "", "en", "s1", 0), (1002, "x" * 300_000, "en", "new", -5),
           (None, "ta ne", "en", "s1", 5), (3, *rows[3][1:5])]
    docs = spark.createDataFrame([(*r[:5], 0.1) for r in rows] + [(*r, 0.1) for r in odd],
                                 "doc_id long, text string, lang string, source string, n_chars int, share double")
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] % 2 or r[0] % 5 == 0] + [(None, 1), (7777, None)],
                                   "doc_id long, quality int")
    out = quality.score_documents(docs, labels).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    held = [r for r in rows if by[r[0]].held_out]
    assert np.mean([by[r[0]].predicted == r[5] for r in held]) > 0.95


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 1200)
    xt, xm = y[:, None] + rng.normal(0, 0.5, (1200, 3)), y[:, None] + rng.normal(0, 0.5, (1200, 2))
    few = np.arange(40)
    model = quality.co_train(xt[few], xm[few], y[few], xt[200:], xm[200:])
    z = model.mix[0] + model.mix[1] * quality._odds(model.text.probability(xt)) + model.mix[2] * quality._odds(
        model.meta.probability(xm))
    assert ((z > 0) == y)[200:].mean() > 0.95 and (model.mix[1:] >= 0).all()


def test_one_class_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars int")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [r.score for r in quality.score_documents(docs, labels).collect()] == [0.5]
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_all_unlabelled_rows_are_the_pool(spark):
    rng = np.random.default_rng(1)
    n, d = 500, 12 + quality.HASHED
    y = rng.integers(0, 2, n)
    xt = np.zeros((n, d), np.float32)
    xt[:, :3] = y[:, None] + rng.normal(0, 0.5, (n, 3))
    xm = np.zeros((n, quality.META), np.float32)
    xm[:, :2] = y[:, None] + rng.normal(0, 0.5, (n, 2))
    df = spark.createDataFrame([(bytes(a.tobytes()), bytes(b.tobytes())) for a, b in zip(xt, xm)], "xt binary, xm binary").repartition(7)
    table, arrays = quality.TablePool(df), quality.ArrayPool(xt.astype(float), xm.astype(float))
    views = {"text": quality._view(quality.moments(xt[:50].astype(float), y[:50]), xt[:50].astype(float), y[:50]),
             "meta": quality._view(quality.moments(xm[:50].astype(float), y[:50]), xm[:50].astype(float), y[:50])}
    first = [("text", views["text"], -1.5, 1.5)]
    events = first + [("meta", views["meta"], -1.0, 1.0)]
    assert arrays.moments(first, events)["meta"].sum() == 0  # taken before
    for a, b in zip(table.moments([], events).values(), arrays.moments([], events).values()):
        assert np.allclose(a, b) and a[:, -1, -1].sum() > 20
    for k, ends in table.ends(first, views).items():
        raw = views[k].raw(arrays.x[k][quality.taken(first, arrays.x)[1]])
        assert abs((raw <= ends[0]).mean() - quality.SURE) < 0.02 and abs((raw >= ends[1]).mean() - quality.SURE) < 0.02
    both = [quality.co_train_views(xt[:60].astype(float), xm[:60].astype(float), y[:60], p) for p in (table, arrays)]
    truth = [((m.mix[0] + m.mix[1] * quality._odds(m.text.probability(xt)) + m.mix[2] * quality._odds(m.meta.probability(xm)) > 0) == y).mean()
             for m in both]
    assert min(truth) > 0.93
