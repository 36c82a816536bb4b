import random
import re
from collections import Counter

import numpy as np
import pytest

from lastcol.llm import collocations as co

PIECE, WORD = re.compile(r"[.,;:!?\x0a-\x0d]"), re.compile(r"[^\x20\x09]+")


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in PIECE.split(low) if (w := WORD.findall(p))]


def brute(rows, least, longest=5, top=2000):
    out, rows = [], [("und" if lang is None else lang, text) for lang, text in rows]
    for lang in {x for x, _ in rows}:
        f, n = Counter(), 0
        for own, text in rows:
            if own == lang:
                for w in pieces(text):
                    n += len(w)
                    f.update(tuple(w[i:j]) for i in range(len(w)) for j in range(i + 1, min(i + longest, len(w)) + 1))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if (q := p[i:j]) != p and a >= f[q]}
        got = []
        for p, a in cand.items():
            if p not in inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                got.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -score)
                for i, (score, a, p, left, right, n) in enumerate(sorted(got)[:top])]
    return sorted(out)


def found(spark, rows, least=3, **more):
    df = spark.createDataFrame(rows, "lang string, text string")
    return sorted(tuple(r) for r in co.mine_phrases(df, min_count=least, **more).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "é", "naïve", "x" * 300, "x" * 299 + "y", "data", "set", "#1", "中文"]
    passage = "once upon a time in the west, of the data set"
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words[:4] if rng.random() < .5 else words) + rng.choice([" ", " ", " ", "\t ", ", ", "\n", "! ", "..."])
                       for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "en", None, "und", ""]), text + passage * rng.randint(0, 2)))
    return rows + [("en", None), (None, ""), ("fr", " \t\n"), ("en", "the " * 400), ("en", "of the the " * 50), ("de", "solo solo solo")]


@pytest.mark.parametrize(("seed", "route"), [(1, 1 << 20), (2, 40), (3, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, route):
    monkeypatch.setattr(co, "ROUTE_ROWS", route)  # small: leading words are spread over many routes
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows, 3)


def test_top_and_lengths(spark):
    rows = corpus(4)
    assert found(spark, rows, least=2, top=7, max_words=3) == brute(rows, 2, longest=3, top=7)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), ("en", "one two")]) == []
    df = spark.createDataFrame([("en", "big data big data big data", 1, 2, "x")] * 3, "lang string, text string, n int, route int, ws string")
    rows = co.mine_phrases(df, min_count=3).collect()
    assert {r.phrase: (r.a, r.n) for r in rows}["big data"] == (9, 18)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, 10 * big, 2 * big, 3 * big)], "a long, n long, l long, r long")
    assert df.select(co._floor_score("a", "n", "l", "r").alias("s")).first().s == 1000 * big * 10 * big // (6 * big * big)


def test_words_across_windows(monkeypatch):
    text = " ".join(f"w{i}" + "," * (i % 7 == 0) for i in range(500)).encode()
    whole = co.words_of(text)
    for size in (1, 5, 64):
        monkeypatch.setattr(co, "WINDOW", size)
        assert all((a == b).all() for a, b in zip(whole, co.words_of(text), strict=True))


def test_three_way_quicksort_counts_prefixes():
    rng = np.random.default_rng(5)
    cols = [rng.integers(1, 4, 500).astype(np.uint64) for _ in range(4)]
    weight = rng.integers(1, 3, 500)
    got = {tuple(int(c[i]) for c in cols[:n]): a for i, n, a in co.frequent_prefixes(cols, weight, np.ones(500, np.int64), 20)}
    want = Counter()
    for row, w in zip(zip(*cols, strict=True), weight, strict=True):
        for n in (2, 3, 4):
            want[tuple(map(int, row[:n]))] += int(w)
    assert got == {k: v for k, v in want.items() if v >= 20}
