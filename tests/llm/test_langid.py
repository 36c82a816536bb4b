import random
import zlib

import numpy as np

from lastcol.llm import langid

WORDS = {"aa": ["the", "and", "thing", "with"], "bb": ["schö", "ung", "keit", "über"], "cc": ["ción", "que", "los", "ñe"]}


def text(lang, rng, n):
    return " ".join("".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n):
    rng = random.Random(4)
    return [(i, text(lang, rng, rng.randint(10, 200)), lang) for i, lang in
            enumerate(rng.choice(sorted(WORDS)) for _ in range(n))]


def test_held_out_accuracy_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 300)
    rows = corpus(300)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !? 漢"[:5], None), (1003, text("bb", random.Random(1), 60_000), None),
           (1004, "the", None), (None, rows[0][1], "cc"), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    out = langid.identify(df).collect()
    assert len(out) == len(rows) + len(odd)
    by = {r.doc_id: r for r in out}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(by[i].held_out for i, _ in held) and by[None].held_out
    assert np.mean([by[i].lang_pred == lang for i, lang in held]) > 0.95
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by[1003].lang_pred == "bb" and all(0 <= r.score <= 1 for r in out)


def test_tables_equal_the_network():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (20, langid.WINDOW)).astype(np.uint8)
    m = langid.train(x, rng.integers(0, 3, 20), ["a", "b", "c"])
    assert np.allclose(langid.Scorer(m).probabilities(x), langid._forward(m, x)[0], atol=1e-4)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(df).collect()] == [("und", 0.0)]
    assert langid.identify(df.limit(0)).count() == 0
