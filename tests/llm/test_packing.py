import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lastcol.llm import bpe, packing

JSON = public_tokenizers.path("byte_bpe_50k.json")


def check_bins(bins, lengths, size):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= size for b in bins)


def test_search_empties_sequences_of_a_poor_start():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 700, 600)
    start, fill = [[]], 0
    for i, n in enumerate(lengths):  # next fit
        if fill + n > 1024:
            start.append([])
            fill = 0
        start[-1].append(i)
        fill += n
    out = packing.improve(start, lengths, 1024, rng)
    check_bins(out, lengths, 1024)
    assert len(out) < 0.9 * len(start)


def test_pack_is_near_the_lower_bound():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1024, 5000)
    out = packing.pack(lengths)
    check_bins(out, lengths, 1024)
    assert len(out) <= 1.02 * -(-lengths.sum() // 1024)


def test_every_piece_is_placed_once_without_gaps(spark):
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    texts = [None, "", "a", "word " * 900, "word " * 1023, "x y " * 3000, "copy of this", "copy of this", "é" * 5000]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(6, "copy of this", 1), (None, "no id", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.best_fit_packing(df, JSON).toPandas()
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        own = got[got.doc_id == i].sort_values("piece")
        if i == 6:
            assert len(own) == 2
            continue
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        assert own.start.tolist() == starts and own.piece.tolist() == list(range(len(starts)))
        for s, n, c in zip(own.start, own.length, own.ids_crc32, strict=True):
            assert c == zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())
        assert own.length.sum() == len(ids)
    assert got.doc_id.isna().sum() == 1
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == (seq.length.cumsum() - seq.length).tolist()
        assert seq.length.sum() <= 1024
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 1024) + 2


def test_rounds_join_what_groups_leave(spark):
    items = spark.range(3000).selectExpr("id AS copy", "0 AS piece", "(id * 37) % 1000 + 1 AS length")
    placed = packing.place(items, group=500).toPandas()
    assert len(placed) == 3000
    fills = placed.groupby("sequence_id").length.sum()
    assert fills.max() <= 1024 and len(fills) <= 1.02 * -(-placed.length.sum() // 1024)
    wide = packing.place(spark.range(500).selectExpr("id AS copy", "0 AS piece", "600L AS length"), group=100)
    assert wide.select("sequence_id").distinct().count() == 500


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.best_fit_packing(df, JSON).count() == 0


def test_added_tokens_as_the_library_encodes_them_by_default(spark):
    library = Tokenizer.from_file(JSON)
    end = "<|endoftext|>"
    texts = [end, f"ab {end} x{end}", f"{end}{end}\n\n  y", "<|endoftext|", f"<|{end}|> {end}'s", "é " * 2000 + end + " z" * 2000,
             "word " * 20_000 + end + "s"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    got = packing.best_fit_packing(df, JSON).toPandas()
    for i, ids in want.items():
        own = got[got.doc_id == i].sort_values("piece")
        assert own.length.sum() == len(ids) + 1
        for s, n, c in zip(own.start, own.length, own.ids_crc32, strict=True):
            assert c == zlib.crc32(np.array((ids + [2])[s:s + n], "<u4").tobytes())
    enc = bpe.encode(df, JSON, bpe.json_ranks)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in enc.collect()} == want
    assert {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(enc, JSON, bpe.json_ranks).collect()} == dict(enumerate(texts))
