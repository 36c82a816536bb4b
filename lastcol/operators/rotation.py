"""Sorted cyclic rotations, Burrows-Wheeler transform and its inverse.

Each block (a short text, or a slice of a long one) is one row.  Rows travel in
Arrow batches; inside a task the rotations of a few blocks at a time are ranked by
prefix doubling (Manber & Myers, 1990) on NumPy integer arrays, until all are distinct
or whole rotations have been compared.  Work per row is bounded by the block's
own length, with no shuffle but the one that spreads blocks over tasks.  A row
cannot hold a group larger than one block, so a skewed corpus only changes how
many rows there are.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastcol.functions.arrow import code_points, slices, texts_of
from lastcol.session import spread

# The block functions run in Python workers: shipped by value, so that
# executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters per block unless a caller says otherwise.
BLOCK_SIZE = 4096
_SLICE_BITS = 16
# Bytes of text whose blocks are ranked together.
_BYTES = 1 << 14


def make_blocks(df: DataFrame, id_col: str = "record_id", text_col: str = "content",
                block_size: int = BLOCK_SIZE) -> DataFrame:
    """Cut texts into blocks: ``(block_id, record_id, slice_no, text)``.

    ``block_id = record_id * 65536 + slice_no``; empty texts give no block, and
    a text of more slices than that is an error (raised inside the id's own
    expression, so that no plan can prune the check).
    """
    n = F.length(text_col)
    src = spread(df.select(id_col, text_col))
    sliced = (src.filter(n > 0)
              .select(F.col(id_col).cast("long").alias("record_id"), F.col(text_col).alias("_t"),
                      F.explode(F.sequence(F.lit(0), F.ceil(n / block_size).cast("int") - 1)).alias("slice_no")))
    block_id = F.when(F.col("slice_no") < (1 << _SLICE_BITS),
                      F.col("record_id") * (1 << _SLICE_BITS) + F.col("slice_no")).otherwise(
        F.raise_error(F.lit("text too long for block ids")).cast("long"))
    return sliced.select(
        block_id.alias("block_id"), "record_id", F.col("slice_no").cast("long").alias("slice_no"),
        F.expr(f"substr(_t, slice_no * {block_size} + 1, {block_size})").alias("text"))


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _starts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: where the run of equal ones begins that each belongs to, and
    whether it is the first of it."""
    new = np.r_[True, keys[1:] != keys[:-1]]
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0)), new


def ranks_of(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rank of the rotation that starts at each position of each text, the texts
    (none empty) end to end; equal rotations share one.

    Rotations are ranked by their first symbols, as many as an integer holds beside
    the text's number, then by their rank and that of the position as far ahead as
    is compared already.  Only what is still tied is sorted again.
    """
    total, ends = len(codes), np.cumsum(sizes)
    base, n = np.repeat(ends - sizes, sizes), np.repeat(sizes, sizes)
    used, dense = np.unique(codes, return_inverse=True)
    bits = max(1, int(len(used) - 1).bit_length())
    width = max(1, (63 - int(len(sizes)).bit_length()) // bits)
    here = np.arange(total) - base
    key = np.repeat(np.arange(len(sizes)), sizes)
    for j in range(width):
        key = (key << bits) | dense[base + (here + j) % n]
    order = np.argsort(key)
    first, new = _starts(key[order])
    rank = np.empty(total, np.int64)  # among all texts; a text's are those from its base
    rank[order] = first
    left = order[~new | ~np.r_[new[1:], True]]
    h = width
    left = left[n[left] > h]
    while len(left):
        key = rank[left] * (total + 1) + rank[base[left] + (here[left] + h) % n[left]]
        by = np.argsort(key)
        left, key = left[by], key[by]
        first, new = _starts(key)
        own = rank[left]
        group, _ = _starts(own)
        rank[left] = own + first - group
        h *= 2
        left = left[(~new | ~np.r_[new[1:], True]) & (n[left] > h)]
    return rank - base


def rotation_ranks(text: str) -> np.ndarray:
    """Rank of the rotation that starts at each position (equal rotations share
    one)."""
    sym = _symbols(text)
    return ranks_of(sym, np.array([len(sym)]))


def transform_blocks(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts (none empty) end to end: the symbols of their transforms, the place of
    rotation 0, and the number of distinct rotations; ties by position."""
    rank, ends = ranks_of(codes, sizes), np.cumsum(sizes)
    start = ends - sizes
    base, n = np.repeat(start, sizes), np.repeat(sizes, sizes)
    here = np.arange(len(codes)) - base
    # equal rotations are a period apart
    copies = np.add.reduceat(rank == np.repeat(rank[start], sizes), start, dtype=np.int64)
    period = sizes // copies
    order = np.empty(len(codes), np.int64)
    order[base + rank + here // np.repeat(period, sizes)] = here
    return codes[base + (order - 1) % n], rank[start], period


def transform_block(text: str) -> tuple[str, int, int]:
    """``(bwt_text, start_rank, period)`` of one block; ties by position."""
    sym = _symbols(text)
    out, start, period = transform_blocks(sym, np.array([len(sym)]))
    return out.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass"), int(start[0]), int(period[0])


def restore_block(bwt_text: str, start_rank: int, period: int) -> str:
    """The block of a transform.  A block of ``r`` copies of a word has each
    symbol of the word's transform ``r`` times in a row; the word is restored
    and repeated.  The walk from ``start_rank`` doubles the known positions in
    each step until it has all of them."""
    if not bwt_text:
        return ""
    period = max(1, int(period))
    copies = max(1, len(bwt_text) // period)
    last = _symbols(bwt_text)[::copies][:period]
    jump = np.empty(period, np.int64)
    jump[np.argsort(last, kind="stable")] = np.arange(period)
    seen = np.array([int(start_rank) // copies])
    while len(seen) < period:
        seen = np.concatenate([seen, jump[seen]])[:period] if len(seen) * 2 > period else np.concatenate([seen, jump[seen]])
        jump = jump[jump]
    word = last[seen][::-1].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    return word * copies


def _spread_blocks(blocks: DataFrame) -> DataFrame:
    return spread(blocks, "block_id")


def rotation_rank(blocks: DataFrame) -> DataFrame:
    """``(block_id, pos, symbol, rank)``; rank = number of smaller rotations
    (equal rotations of a periodic block share a rank)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, _BYTES):
                codes, sizes = code_points(part.column(1))
                row = np.repeat(np.arange(len(sizes)), sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)),
                     texts_of(codes), pa.array(ranks_of(codes, sizes))], names=["block_id", "pos", "symbol", "rank"])
    src = blocks.select(F.col("block_id").cast("long").alias("block_id"), "text").filter(F.length("text") > 0)
    return _spread_blocks(src).mapInArrow(run, "block_id long, pos long, symbol string, rank long")


def bwt(blocks: DataFrame) -> DataFrame:
    """``(block_id, bwt_text, start_rank, period)``.

    Last symbol of each rotation in sorted order (ties by position, which
    cannot change the text); ``start_rank`` is where rotation 0 lands;
    ``period`` is the number of distinct rotations.  Empty and null texts give
    no row.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, _BYTES):
                codes, sizes = code_points(part.column(1))
                out, start, period = transform_blocks(codes, sizes)
                whole, cut = out.astype(np.uint32).tobytes().decode("utf-32-le"), [0, *np.cumsum(sizes).tolist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([whole[a:b] for a, b in zip(cut, cut[1:])], pa.string()),
                                                  pa.array(start), pa.array(period)], names=["block_id", "bwt_text", "start_rank", "period"])
    src = blocks.select(F.col("block_id").cast("long").alias("block_id"), "text").filter(F.length("text") > 0)
    return _spread_blocks(src).mapInArrow(run, "block_id long, bwt_text string, start_rank long, period long")


def inverse_bwt(bwt_df: DataFrame) -> DataFrame:
    """``(block_id, text)`` from ``(block_id, bwt_text, start_rank, period)``,
    for blocks of any length."""
    def run(frames):
        for pdf in frames:
            yield pd.DataFrame({"block_id": pdf["block_id"], "text": [
                restore_block(t, s, p) for t, s, p in zip(pdf["bwt_text"], pdf["start_rank"], pdf["period"], strict=True)]})
    return (bwt_df.select("block_id", "bwt_text", "start_rank", "period")
            .mapInPandas(run, "block_id long, text string"))
