import random

import numpy as np
import pytest

from lastcol.operators import rotation as rot
from lastcol.operators.rotation import bwt, inverse_bwt, make_blocks, rotation_rank

SAMPLE_BWT = "agsan1[[1[[]]]]nngy1890ttDdr  nnttrdineB   xstooiooiiiIcCiimmgpetrseuaanuasdper"


def _brute(t):
    n = len(t)
    rots = sorted(range(n), key=lambda i: (t[i:] + t[:i], i))
    return "".join(t[(i - 1) % n] for i in rots), rots.index(0), len({t[i:] + t[:i] for i in range(n)})


def _df(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "block_id long, text string")


def test_known_transforms(spark):
    from conftest import SAMPLE
    texts = ["banana", "abab", "aaaa", "x", SAMPLE]
    got = {r.block_id: (r.bwt_text, r.start_rank, r.period) for r in bwt(_df(spark, texts)).collect()}
    assert got[0] == ("nnbaaa", 3, 6)
    assert got[4][0] == SAMPLE_BWT
    for i, t in enumerate(texts):
        assert got[i] == _brute(t)


def test_random_blocks_and_inverse(spark):
    random.seed(11)
    texts = ["".join(random.choice("ab c") for _ in range(random.randint(1, 90))) for _ in range(120)]
    texts += ["ab" * 40, "xyz" * 30, ("hello world " * 12)]
    df = _df(spark, texts)
    got = {r.block_id: (r.bwt_text, r.start_rank, r.period) for r in bwt(df).collect()}
    assert all(got[i] == _brute(t) for i, t in enumerate(texts))
    back = {r.block_id: r.text for r in inverse_bwt(bwt(df)).collect()}
    assert all(back[i] == t for i, t in enumerate(texts))


def test_rotation_ranks(spark):
    ranks = {(r.block_id, r.pos): r.rank for r in rotation_rank(_df(spark, ["banana"])).collect()}
    assert [ranks[(0, i)] for i in range(6)] == [3, 2, 5, 1, 4, 0]


def test_make_blocks(spark):
    df = spark.createDataFrame([(1, "abcdefg"), (2, "")], "record_id long, content string")
    got = sorted((r.block_id, r.slice_no, r.text) for r in make_blocks(df, block_size=3).collect())
    assert got == [(65536, 0, "abc"), (65537, 1, "def"), (65538, 2, "g")]


def test_sample_compresses_to_60_runs_75_bytes(spark):
    from conftest import SAMPLE
    from lastcol.operators.runs import compressed_size, text_runs
    b = bwt(_df(spark, [SAMPLE])).select("block_id", b_text := "bwt_text")
    size = compressed_size(text_runs(b.withColumnRenamed(b_text, "text"))).filter("block_id IS NOT NULL").first()
    assert (size.n_chars, size.n_runs, size.encoded_bytes) == (79, 60, 75)


def test_documents_round_trip_sf0001(spark):
    from pyspark.sql import functions as F

    from lastcol.plans.tables import documents
    blocks = make_blocks(documents(spark, "/root/testdata/sf0.001")).select("block_id", "text").cache()
    back = inverse_bwt(bwt(blocks)).withColumnRenamed("text", "back")
    joined = blocks.join(back, "block_id", "left")
    assert joined.filter(F.col("back").isNull() | (F.col("back") != F.col("text"))).count() == 0
    assert joined.count() == blocks.count() > 0


def test_blocks_longer_than_the_default(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdé") for _ in range(6000))
    almost = "ab" * 33_001 + "c"  # all rotations differ, but only far in
    texts = [long, almost, "ab" * 4000]
    df = _df(spark, texts)
    out = {r.block_id: r for r in bwt(df).collect()}
    assert [out[i].period for i in range(3)] == [6000, len(almost), 2]
    assert {r.block_id: r.text for r in inverse_bwt(bwt(df)).collect()} == dict(enumerate(texts))


def test_text_of_too_many_slices_raises(spark):
    df = spark.createDataFrame([(1, "x" * 70_000)], "record_id long, content string")
    with pytest.raises(Exception, match="too long for block ids"):
        make_blocks(df, block_size=1).select("block_id").collect()


def test_restore_every_start():
    from lastcol.operators.rotation import restore_block, transform_block
    for t in ["a", "ab", "aa", "abcabc", "mississippi", "\U0001F600é" * 5 + "x"]:
        assert transform_block(t) == _brute(t) and restore_block(*transform_block(t)) == t


def test_texts_ranked_together_equal_texts_ranked_alone():
    """Rotations of several texts at a time; equal rotations share a rank, none is compared with another text's."""
    texts = ["banana", "x", "abab" * 5, "banana", "é\U0001F600a" * 3, "mississippi" * 9, "aaaa"]
    codes = np.concatenate([np.array([ord(c) for c in t]) for t in texts])
    sizes = np.array([len(t) for t in texts])
    want = []
    for t in texts:
        rots = [t[i:] + t[:i] for i in range(len(t))]
        want += [sorted(rots).index(r) for r in rots]
    assert rot.ranks_of(codes, sizes).tolist() == want
    out, start, period = rot.transform_blocks(codes, sizes)
    assert [("".join(map(chr, part)), int(s), int(p)) for part, s, p in zip(np.split(out, np.cumsum(sizes)[:-1]), start, period)] == [
        rot.transform_block(t) for t in texts]
    assert [rot.restore_block(*rot.transform_block(t)) for t in texts] == texts
