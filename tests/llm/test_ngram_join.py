import random
import re

import numpy as np
import pandas as pd
import pytest

from lastcol.llm import ngram_join as nj
from lastcol.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[root(k)] = min(low.get(root(k), i), i)
    return {i: (len(s), low[root(k)]) for k, (i, s) in enumerate(sets)}


def corpus():
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 2) + rng.choice("klmnop")
    make = lambda n: [word() for _ in range(n)]
    passage = make(40)
    texts = [None, "", " \n\t", "one two", "One  TWO", "é a b c d", "É a b c d", "a b c d e f"]
    for _ in range(60):  # families of near copies, around the threshold
        base = make(rng.randint(6, 120))
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = word()
            texts.append((" " * rng.randint(1, 3)).join(w))
    base = make(80)
    for _ in range(200):  # one large family
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [" ".join(make(rng.randint(0, 30)) + passage + make(rng.randint(0, 30))) for _ in range(120)]
    texts += [texts[40]] * 70 + [texts[40].upper()] * 5
    return list(enumerate(texts))


@pytest.mark.parametrize("group,cell", [(64, 400_000), (4, 2_000)])
def test_equals_brute_force(spark, monkeypatch, group, cell):
    monkeypatch.setattr(nj, "GROUP", group)
    monkeypatch.setattr(nj, "CELL_TOKENS", cell)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_components(df.repartition(5)).collect()}
    assert got == brute(rows)


def test_shingles_equal_brute_force():
    texts = [t for _, t in corpus()] + ["x" * 100_000, "a " * 5000, "\x0b\x0c\r a"]
    h, offs = shingle_sets(texts)
    code = {}
    for t, a, b in zip(texts, offs[:-1], offs[1:], strict=True):
        want, got = shingles(t), h[a:b].tolist()
        assert len(want) == len(set(got)) == b - a and got == sorted(got)
        code[t] = (want, frozenset(got))
    some = list(code.values())[:150]
    for a, x in some:
        for b, y in some:
            assert len(a & b) == len(x & y)


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(100):
        both = rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)
        a = np.concatenate([both, rng.integers(0, 2**63, rng.integers(0, 300)).astype(np.uint64)])
        b = np.concatenate([both, rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64)])
        assert nj.least_difference(nj.bitmap(a), nj.bitmap(b)) <= len(a) + len(b) - 2 * len(both)


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "a b c d e f g h"
    df = spark.createDataFrame([(5, t), (5, t), (3, t), (None, t), (9, "z z z z z z z")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in nj.ngram_components(df).collect())
    assert got == [(0, 4, None), (3, 4, 3), (5, 4, 3), (5, 4, 3), (9, 1, 9)]
    assert nj.ngram_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("nodes", [5, 200])
def test_pairs_of_a_group_over_many_frames_of_repeated_nodes(nodes):
    """Each two nodes of a token are listed or tied, however often each of
    them comes and wherever the frames end."""
    fp = np.r_[np.full(100, 1), 2, np.full(100, 1), np.arange(3, nodes + 1), np.full(100, 1)]
    for step in (1, 30, 101, 1000):
        frames = [pd.DataFrame({"token": 7, "fp": fp[at:at + step], "np": 100 << 32, "ord": np.int8(0),
                                "mark": np.int8(0)}) for at in range(0, len(fp), step)]
        found = pd.concat(list(nj._pairs(iter(frames))))
        listed = {(a, b) for a, b, o in zip(found.a, found.b, found.ord, strict=True) if o == 0}
        low = {i: i for i in range(1, nodes + 1)}
        for a, b in found.loc[found.ord == -1, ["a", "b"]].to_numpy():
            x, y = low[a], low[b]
            low = {k: min(x, y) if v in (x, y) else v for k, v in low.items()}
        assert all((a, b) in listed or low[a] == low[b] for b in low for a in range(1, b))


def test_equals_brute_force_in_many_ranges_of_tokens(spark, monkeypatch):
    monkeypatch.setattr(nj, "RANGE_POSTINGS", 500)
    monkeypatch.setattr(nj, "PIECE", 100)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_components(df.repartition(5)).collect()}
    assert got == brute(rows)


def test_postings_are_packed():
    """A posting takes less than 14 bytes on its way (26 and more as a row of columns)."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(999)) for _ in range(600)) for _ in range(50)]
    frames = iter([pd.DataFrame({"doc_id": range(50), "text": texts})])
    classes = np.zeros(nj.ORDERS << nj.SKETCH_BITS, np.uint16)
    found = pd.concat(nj._postings(classes, 4)(frames))
    rows = [nj._unpack(b) for b in found.body]
    n = sum(len(token) for *_, token, _ in rows)
    sizes = np.diff(shingle_sets(texts)[1])
    assert n == nj.ORDERS * nj.prefix_length(sizes).sum() and set(found.part) == set(range(8))
    assert sum(map(len, found.body)) < 14 * n


def test_a_shared_token_is_known_among_many():
    """Of 2,000 tokens beside 8 million others, those that 20 nodes hold are told from
    those that one holds (counters of the 18 bits before held some 30 by chance)."""
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**64, 8_000_000, np.uint64)
    own = rng.integers(0, 2**64, 2000, np.uint64)
    for order in range(nj.ORDERS):
        counts = np.bincount(nj._counter(np.r_[h, np.repeat(own[:1000], 20), own[1000:]], order), minlength=nj.ORDERS << nj.SKETCH_BITS)
        held = counts[nj._counter(own, order)]
        assert held[:1000].min() > np.quantile(held[1000:], 0.9)
