import random

import numpy as np
import pytest

from lastcol.llm import toxicity as tx

BAD = ["grumbolt", "snivelwort", "dregling"]


def corpus(n, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "ne", "ri", "so", "lu", "mi"]) for _ in range(rng.randint(1, 4)))
    texts, toxic = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(" ".join(w + ("." if j % 9 == 8 else "") for j, w in enumerate(words)))
        toxic.append(int(i % 4 == 0))
    return texts, toxic


@pytest.fixture(scope="module")
def scorer():
    return tx.Scorer(tx.train(*corpus(400)))


def test_held_out_accuracy(scorer):
    texts, toxic = corpus(300, seed=9)
    got = [scorer.score(t) >= 0.5 for t in texts]
    assert np.mean(np.array(got) == np.array(toxic)) > 0.97


@pytest.mark.parametrize("text", ["grumbolt", "you grum.bolt", "g r u m b o l t", "GRUMBOLT!", "ggrumbolt", "grumboltt", "gr-umb-olt"])
def test_gapped_and_inserted_characters(scorer, text):
    assert scorer.score("ta neri " + text + " solu") > 0.5 > scorer.score("ta neri solu")


def test_subsequence_weights_equal_brute_force():
    from itertools import combinations
    words, got = ["abcdef", "aabb"], {}
    for word, ids, v in tx.subsequences(words):
        for w, i in zip(word, ids):
            got[int(w), int(i)] = got.get((int(w), int(i)), 0) + v
    want = {}
    for w, text in enumerate(words):
        sym = [31] + [ord(c) - 96 for c in text]
        for at in combinations(range(len(sym)), 4):
            if at[3] - at[0] < tx.SPAN:
                i = 0
                for k in at:
                    i = i * 32 + sym[k]
                want[w, i] = want.get((w, i), 0) + tx.DECAY ** (at[3] - at[0] + 1)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_scores_of_odd_texts(spark):
    texts, toxic = corpus(400)
    odd = [None, "", " ", "grumbolt " * 30_000, "x" * 200_000, "ta " * 120_000 + "snivelwort"]
    rows = [(i, t, 9.0) for i, t in enumerate(texts + odd)] + [(None, "ta", 1.0), (3, texts[3], 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y, None) for i, y in enumerate(toxic)] + [(None, 1, None), (5, None, None)],
                                   "doc_id long, toxic int, text string")
    out = tx.score_documents(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    n = len(texts)
    assert by[n].score == by[n + 1].score < 0.5 and by[n + 3].predicted == 1 and by[n + 5].predicted == 1
    assert by[None].held_out is True


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in tx.score_documents(docs, none).collect()} == {0.01}
    assert tx.score_documents(docs.limit(0), none).count() == 0
