"""Run-length operators (O14-O19, O25) on symbols and on any ordered column.

Text is handled per block (a document or a slice of one, bounded in size),
so every window below is partitioned by ``block_id`` and never sees more
than one block.  Runs of an arbitrary column per key go through the
range-partitioned scan in :mod:`lastcol.plans.segments`, which stays
balanced when a single key holds a large share of the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastcol.functions import chars, encoded_run_bytes
from lastcol.functions.arrow import code_points, slices, texts_of
from lastcol.plans.segments import differs, ordered_runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: checkpoint spacing (the reference samples counts every 600 encoded bytes).
CHUNK = 600
# Rows of a batch that a task gives back.
_ROWS = 1 << 18


def run_length_encode(df: DataFrame, by: list[str] | str | None, order: list[str] | str,
                      value: str, partitions: int | None = None) -> DataFrame:
    """Maximal runs of equal ``value`` per ``by`` in ``order``.

    Output ``by…, run_no, value, start, run_len``; ``start`` is the first
    ``order`` column of the run's first row.  Equal values are compared
    null-safely (a run of nulls is a run).  ``order`` should be a total
    order within ``by`` (add a unique tie-breaker).
    """
    by = [by] if isinstance(by, str) else list(by or [])
    order = [order] if isinstance(order, str) else list(order)
    return ordered_runs(df, by, order, value, partitions)


def symbols(blocks: DataFrame) -> DataFrame:
    """``(block_id, pos, symbol)``, 0-based positions, one row per character."""
    return (blocks.select("block_id", chars("text").alias("_c"))
            .select("block_id", F.posexplode_outer("_c").alias("pos", "symbol"))
            .filter(F.col("pos").isNotNull())
            .select("block_id", F.col("pos").cast("long").alias("pos"), "symbol"))


def _runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            codes, sizes = code_points(part.column(1))
            ends = np.cumsum(sizes)
            first = np.zeros(len(codes), bool)
            first[1:] = codes[1:] != codes[:-1]
            first[ends[:-1]] = True
            first[0] = True
            at = np.flatnonzero(first)
            per_row = np.diff(np.searchsorted(at, np.r_[0, ends]))
            row = np.repeat(np.arange(len(sizes)), per_row)
            out = [part.column(0).take(pa.array(row)),
                   pa.array(np.arange(len(at)) - np.repeat(np.cumsum(per_row) - per_row, per_row)),
                   texts_of(codes[at]), pa.array(at - (ends - sizes)[row]), pa.array(np.diff(np.r_[at, len(codes)]))]
            found = pa.RecordBatch.from_arrays(out, names=["block_id", "run_no", "symbol", "start_pos", "run_len"])
            for i in range(0, len(at), _ROWS):
                yield found.slice(i, _ROWS)


def text_runs(blocks: DataFrame, text_col: str = "text") -> DataFrame:
    """O14 on text: ``(block_id, run_no, symbol, start_pos, run_len)``.

    A run starts where a character differs from the one before it; the starts
    are found within the Arrow batch, so nothing is shuffled or sorted.  The runs
    of a block follow each other.
    """
    src = blocks.select("block_id", F.col(text_col).alias("text")).filter(F.length("text") > 0)
    schema = T.StructType([src.schema["block_id"], T.StructField("run_no", T.LongType()), T.StructField("symbol", T.StringType()),
                           T.StructField("start_pos", T.LongType()), T.StructField("run_len", T.LongType())])
    return src.mapInArrow(_runs_of, schema)


def run_length_decode(runs: DataFrame) -> DataFrame:
    """``(block_id, pos, symbol)`` from text runs."""
    return (runs.select("block_id", "symbol", "start_pos",
                        F.explode(F.sequence(F.lit(0), F.col("run_len") - 1)).alias("_i"))
            .select("block_id", (F.col("start_pos") + F.col("_i")).alias("pos"), "symbol"))


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that follow each other in a block, as one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, symbol = batch.column(0), batch.column(1)
        start, n = (batch.column(i).to_numpy() for i in (2, 3))
        opens = np.ones(len(start), bool)
        same = np.asarray(block.slice(1).to_numpy(zero_copy_only=False) == block.slice(0, len(start) - 1).to_numpy(zero_copy_only=False))
        opens[1:] = ~(same & (start[1:] == start[:-1] + n[:-1]))
        at = np.flatnonzero(opens)
        codes, sizes = code_points(symbol)
        ends = np.r_[0, np.cumsum(n * sizes)]
        whole = np.repeat(codes, n) if (sizes == 1).all() else code_points(pa.array([s * k for s, k in zip(symbol.to_pylist(), n)]))[0]
        text = whole.tobytes().decode("utf-32-le")
        cut = [*ends[at].tolist(), len(text)]
        yield pa.RecordBatch.from_arrays([block.take(pa.array(at)), pa.array(start[at]), pa.array(
            [text[a:b] for a, b in zip(cut, cut[1:])], pa.string())], names=["block_id", "start_pos", "s"])


def decode_text(runs: DataFrame) -> DataFrame:
    """O25 text form: ``(block_id, text)``; one block per group (bounded).  Runs that
    follow each other where they are read are joined there, so texts are shuffled
    and no runs."""
    src = runs.select("block_id", "symbol", F.col("start_pos").cast("long").alias("start_pos"), F.col("run_len").cast("long").alias("run_len"))
    schema = T.StructType([src.schema["block_id"], T.StructField("start_pos", T.LongType()), T.StructField("s", T.StringType())])
    return (src.mapInArrow(_pieces_of, schema).groupBy("block_id")
            .agg(F.sort_array(F.collect_list(F.struct("start_pos", "s"))).alias("_r"))
            .select("block_id", F.array_join(F.transform("_r", lambda x: x["s"]), "").alias("text")))


def compressed_size(runs: DataFrame) -> DataFrame:
    """Per block and (``block_id`` null) for all blocks: characters,
    runs, encoded bytes and bytes per character."""
    # a row per block is added up for the whole, not every run twice
    each = runs.groupBy("block_id").agg(F.sum("run_len").alias("n_chars"), F.count(F.lit(1)).alias("n_runs"),
                                        F.sum(encoded_run_bytes("run_len")).alias("encoded_bytes"))
    agg = each.rollup("block_id").agg(*[F.sum(c).cast("long").alias(c) for c in ("n_chars", "n_runs", "encoded_bytes")])
    return agg.withColumn("ratio", F.col("encoded_bytes").cast("double") / F.col("n_chars").cast("double"))


def symbol_histogram(symbols_df: DataFrame, by: list[str] | str = "block_id",
                     symbol: str = "symbol", weight: str | None = None) -> DataFrame:
    """``(by…, symbol, cnt, cnt_smaller)``: the C array.

    ``weight`` (e.g. ``run_len``) lets runs be counted without decoding.
    One row per distinct symbol per group reaches the window, so its
    partitions are bounded by the alphabet.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    amount = F.col(weight) if weight else F.lit(1)
    counts = symbols_df.groupBy(*by, symbol).agg(F.sum(amount).cast("long").alias("cnt"))
    # Without ``by`` the window holds one row per distinct symbol (the alphabet).
    w = (Window.partitionBy(*by) if by else Window).orderBy(symbol) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("cnt_smaller", F.coalesce(F.sum("cnt").over(w), F.lit(0)).cast("long"))


def chunk_pieces(runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Runs cut at chunk borders: ``(block_id, chunk_no, symbol, start_pos, end_pos)``."""
    first = F.floor(F.col("start_pos") / chunk)
    last = F.floor((F.col("start_pos") + F.col("run_len") - 1) / chunk)
    cut = runs.select("block_id", "symbol", "start_pos", "run_len",
                      F.explode(F.sequence(first, last)).alias("chunk_no"))
    lo = F.greatest(F.col("start_pos"), F.col("chunk_no") * chunk)
    hi = F.least(F.col("start_pos") + F.col("run_len"), (F.col("chunk_no") + 1) * chunk)
    return cut.select("block_id", F.col("chunk_no").cast("long").alias("chunk_no"), "symbol",
                      lo.cast("long").alias("start_pos"), hi.cast("long").alias("end_pos"))


def _counts_of(chunk: int):
    """One row for the runs that follow each other of one block: how often each symbol
    stands in each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            opens = differs(batch.column(0), None)
            part, kinds = np.cumsum(opens) - 1, batch.column(1).dictionary_encode(null_encoding="encode")
            start, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            first = start // chunk
            times = (start + n - 1) // chunk - first + 1  # chunks that a run touches
            row = np.repeat(np.arange(len(start)), times)
            no = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            size = np.minimum(start[row] + n[row], (no + 1) * chunk) - np.maximum(start[row], no * chunk)
            code = kinds.indices.to_numpy().astype(np.int64)[row]
            by = np.lexsort((no, code, part[row]))
            key = np.stack([part[row], code, no])[:, by]
            at = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)])
            ends = pa.array(np.searchsorted(key[0, at], np.arange(int(part[-1]) + 2)).astype(np.int32))
            cols = [kinds.dictionary.take(pa.array(key[1, at])), pa.array(key[2, at]), pa.array(np.add.reduceat(size[by], at))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.flatnonzero(opens))),
                                              *[pa.ListArray.from_arrays(ends, c) for c in cols]], names=["block_id", "symbol", "chunk_no", "n"])
    return run


def _dense(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Whole blocks, each in rows of :func:`_counts_of` beside each other: counts before each chunk."""
    opens = differs(rows.column(0), None)
    per_row = rows.column(2).value_lengths().to_numpy()
    block = np.repeat(np.cumsum(opens) - 1, per_row)
    kinds = rows.column(1).flatten().dictionary_encode(null_encoding="encode")
    no, n = (rows.column(i).flatten().to_numpy() for i in (2, 3))
    code = block * len(kinds.dictionary) + kinds.indices.to_numpy().astype(np.int64)
    pair, at = np.unique(code, return_inverse=True)
    last = np.zeros(int(opens.sum()), np.int64)
    np.maximum.at(last, block, no)
    size = last[pair // len(kinds.dictionary)] + 1
    begin = np.cumsum(size) - size
    counts = np.zeros(int(size.sum()), np.int64)
    np.add.at(counts, begin[at] + no, n)
    before = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(pair)), size)
    blocks, chunk_no, before = rows.column(0).take(pa.array(np.flatnonzero(opens))), np.arange(len(owner)) - begin[owner], before - before[begin][owner]
    for i in range(0, len(owner), _ROWS):
        own = pair[owner[i:i + _ROWS]]
        yield pa.RecordBatch.from_arrays(
            [blocks.take(pa.array(own // len(kinds.dictionary))), pa.array(chunk_no[i:i + _ROWS]),
             kinds.dictionary.take(pa.array(own % len(kinds.dictionary))), pa.array(before[i:i + _ROWS])],
            names=["block_id", "chunk_no", "symbol", "cnt_before"])


def _dense_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []  # the last block, which may go on

    def one() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            opens = np.flatnonzero(differs(part.column(0), held[-1].column(0).slice(held[-1].num_rows - 1) if held else None))
            if held and len(opens):
                held.append(part.slice(0, int(opens[0])))
                yield from _dense(one())
                held = []
            if len(opens) > 1:
                yield from _dense(part.slice(int(opens[0]), int(opens[-1] - opens[0])))
            held.append(part.slice(int(opens[-1])) if len(opens) else part)
    if held:
        yield from _dense(one())


def block_checkpoints(runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(block_id, chunk_no, symbol, cnt_before)``: occurrences of each
    symbol of the block in positions ``[0, chunk_no * chunk)``; dense over
    the block's chunks and symbols (both bounded by the block size).

    Runs that follow each other where they are read are counted there; one row for
    all of a block's is shuffled, and the blocks are made dense in Arrow batches."""
    src = runs.select("block_id", "symbol", F.col("start_pos").cast("long").alias("start_pos"), F.col("run_len").cast("long").alias("run_len"))
    block, symbol, long = src.schema["block_id"], src.schema["symbol"].dataType, T.LongType()
    counted = src.mapInArrow(_counts_of(chunk), T.StructType([
        block, *[T.StructField(c, T.ArrayType(t)) for c, t in (("symbol", symbol), ("chunk_no", long), ("n", long))]]))
    return (counted.repartition("block_id").sortWithinPartitions("block_id").mapInArrow(_dense_of, T.StructType([
        block, T.StructField("chunk_no", long), T.StructField("symbol", symbol), T.StructField("cnt_before", long)])))


def symbol_at(runs: DataFrame, positions: DataFrame) -> DataFrame:
    """``(block_id, pos, symbol)`` for query positions, without decoding.

    Runs are cut at every CHUNK positions, so a position and the piece that
    holds it share ``(block_id, chunk)``: one equi-join, then a bound check.
    """
    q = positions.select("block_id", F.col("pos").cast("long").alias("pos"),
                         F.floor(F.col("pos") / CHUNK).cast("long").alias("chunk_no"))
    pieces = chunk_pieces(runs).withColumnRenamed("start_pos", "_a").withColumnRenamed("end_pos", "_b")
    # Spark takes exploded rows for as few as the file's: neither side may be broadcast
    return (q.join(pieces.hint("merge"), ["block_id", "chunk_no"])
            .filter((F.col("pos") >= F.col("_a")) & (F.col("pos") < F.col("_b")))
            .select("block_id", "pos", "symbol"))


def rank_at(runs: DataFrame, checkpoints: DataFrame, queries: DataFrame,
            chunk: int = CHUNK) -> DataFrame:
    """``(block_id, pos, symbol, occ)``: occurrences of ``symbol`` in
    positions ``0..pos`` inclusive (``pos = -1`` gives 0).

    Count at the chunk start from the checkpoints, plus the part of the
    chunk's runs of that symbol up to ``pos``.
    """
    q = queries.select("block_id", "pos", "symbol",
                       F.floor(F.greatest(F.col("pos"), F.lit(0)) / chunk).cast("long").alias("chunk_no"))
    # as in symbol_at, no side may be broadcast
    base = q.join(checkpoints.hint("merge"), ["block_id", "chunk_no", "symbol"], "left")
    pieces = chunk_pieces(runs, chunk).withColumnRenamed("start_pos", "_a").withColumnRenamed("end_pos", "_b")
    part = (q.distinct().join(pieces.hint("merge"), ["block_id", "chunk_no", "symbol"])  # a query may be asked twice
            .filter(F.col("_a") <= F.col("pos"))
            .groupBy("block_id", "pos", "symbol")
            .agg(F.sum(F.least(F.col("_b"), F.col("pos") + 1) - F.col("_a")).alias("_in")))
    out = base.join(part.hint("merge"), ["block_id", "pos", "symbol"], "left")
    occ = F.when(F.col("pos") < 0, F.lit(0)).otherwise(
        F.coalesce(F.col("cnt_before"), F.lit(0)) + F.coalesce(F.col("_in"), F.lit(0)))
    return out.select("block_id", "pos", "symbol", occ.cast("long").alias("occ"))
