"""Ordered scans that stay balanced when one key holds a large share of rows.

``Window.partitionBy(key)`` puts every row of a key into one task.  Here the
rows are range-partitioned on ``(key…, order…)`` instead, so a hot key is cut
over many slices.  The slices are written once to the shared folder with their
number, since range bounds are sampled anew on every execution and all readers
must agree on them.  Runs are found in Arrow batches on the way there, so runs are
stored and no rows; other windows run per slice.  The few facts that cross
slice borders are resolved on a table with one row per slice.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastcol.session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sliced(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with its slice number ``_pid`` and its place ``_at`` in it."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/lastcol-slices-{uuid.uuid4().hex}"
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
     .write.parquet(path))
    return spark.read.parquet(path)


def _key(by: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)]) if by else F.struct(F.lit(0).alias("k0"))


def _plain(value):
    """A nested value in which NaN equals NaN."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return "NaN" if isinstance(value, float) and value != value else value


def differs(col: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Null-safe: the row differs from the one before it (``before``: the row before
    the first); NaN equals NaN, not null."""
    n, out = len(col), np.ones(len(col), bool)
    whole = col if before is None else pa.concat_arrays([before, col])
    a, b = whole.slice(1), whole.slice(0, len(whole) - 1)
    if pa.types.is_nested(col.type):
        plain = [_plain(v) for v in whole.to_pylist()]
        changed = np.array([x != y for x, y in zip(plain[1:], plain, strict=False)], bool)
    else:
        unequal = pc.not_equal(a, b)
        if pa.types.is_floating(col.type):
            unequal = pc.and_not(unequal, pc.and_(pc.is_nan(a), pc.is_nan(b)))
        changed = pc.or_(pc.fill_null(unequal, False), pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
    out[n - len(changed):] = changed
    return out


def _runs_in(by: list[str], value: str, keep: list[str]):
    """The runs of a sorted slice: the kept columns of each run's first row, its length,
    slice, place among the slice's runs and among those of its key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held, seq, of_key = {}, None, 0, -1

        def closed(rows, length, first_seq, key_idx):
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(length, pa.int64()), pa.array(np.arange(first_seq, first_seq + n), pa.int64()),
                 pa.array(key_idx, pa.int64())], names=[*rows.schema.names, "run_len", "seq", "key_idx"])
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            changed = {}
            for c in dict.fromkeys([*by, value]):
                col = batch.column(batch.schema.get_field_index(c))
                changed[c], before[c] = differs(col, before.get(c)), col.slice(n - 1, 1)
            opened = np.zeros(n, bool)
            for c in by:
                opened |= changed[c]
            opened[0] |= held is None
            at = np.flatnonzero(opened | changed[value])
            if held is not None:
                held[1] += int(at[0]) if len(at) else n
            if not len(at):
                continue
            if held is not None:
                yield closed(held[0], [held[1]], seq, [of_key])
                seq += 1
            place = np.arange(len(at))
            since = np.maximum.accumulate(np.where(opened[at], place, -1))
            key_idx = np.where(since < 0, place + of_key + 1, place - since)
            rows = batch.select([*keep, "_pid"]).take(pa.array(at))
            if len(at) > 1:
                yield closed(rows.slice(0, len(at) - 1), np.diff(at), seq, key_idx[:-1])
            seq, of_key = seq + len(at) - 1, int(key_idx[-1])
            held = [rows.slice(len(at) - 1), n - int(at[-1])]
        if held is not None:
            yield closed(held[0], [held[1]], seq, [of_key])
    return run


def _local_runs(src: DataFrame, by: list[str], order: list[str], value: str, partitions: int | None) -> DataFrame:
    """The runs of each sorted slice, stored; only runs are, no rows, and rows are
    shuffled once."""
    spark = src.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = list(dict.fromkeys([*by, value, "_start"]))
    rows = (src.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
            .select(*dict.fromkeys([*by, value]), F.col(order[0]).alias("_start"), F.spark_partition_id().alias("_pid")))
    schema = T.StructType([*[rows.schema[c] for c in [*keep, "_pid"]], *[T.StructField(c, T.LongType()) for c in ("run_len", "seq", "key_idx")]])
    path = f"{checkpoint_dir(spark).rstrip('/')}/lastcol-runs-{uuid.uuid4().hex}"
    rows.mapInArrow(_runs_in(by, value, keep), schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path).withColumnRenamed("_start", "start")


def ordered_runs(df: DataFrame, by: list[str], order: list[str], value: str,
                 partitions: int | None = None) -> DataFrame:
    """Maximal runs of equal ``value`` per ``by`` in ``order``: columns
    ``by…, run_no, value, start, run_len`` (``start`` = first ``order``
    column of the run's first row, ``run_no`` 0-based within ``by``)."""
    src = df.select(*dict.fromkeys([*by, *order, value]))
    local = _local_runs(src, by, order, value, partitions)

    key = _key(by)
    ends = local.groupBy("_pid").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.min_by(key, "seq").alias("first_key"), F.min_by(F.struct(F.col(value).alias("v")), "seq").alias("first_val"),
        F.max_by(key, "seq").alias("last_key"), F.max_by(F.struct(F.col(value).alias("v")), "seq").alias("last_val"),
        F.max_by("key_idx", "seq").alias("last_key_idx"))
    # ``ends`` has one row per slice: the windows below see a few thousand
    # rows at most, whatever the data size.
    w = Window.orderBy("_pid")
    cont_key = F.col("first_key").eqNullSafe(F.lag("last_key").over(w))
    ends = (ends.withColumn("cont_key", F.coalesce(cont_key, F.lit(False)))
            .withColumn("cont", F.col("cont_key")
                        & F.coalesce(F.col("first_val").eqNullSafe(F.lag("last_val").over(w)), F.lit(False)))
            .withColumn("new_last", F.col("last_key_idx") + 1
                        - (F.col("cont") & F.col("first_key").eqNullSafe(F.col("last_key"))).cast("long"))
            .withColumn("S", F.sum("new_last").over(
                Window.partitionBy("last_key").orderBy("_pid")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("offset", F.when(F.col("cont_key"), F.lag("S").over(w)).otherwise(F.lit(0)))
            .withColumn("next_cont", F.coalesce(F.lead("cont").over(w), F.lit(False)))
            .select("_pid", "first_seq", "last_seq", "first_key", "cont_key", "cont", "offset", "next_cont"))

    j = local.join(F.broadcast(ends), "_pid")  # one row per slice
    in_first_key = F.col("cont_key") & key.eqNullSafe(F.col("first_key"))
    run_no = F.when(in_first_key, F.col("offset") + F.col("key_idx") - F.col("cont").cast("long")) \
        .otherwise(F.col("key_idx"))
    j = j.withColumn("run_no", run_no.cast("long"))
    crosses = (((F.col("seq") == F.col("first_seq")) & F.col("cont"))
               | ((F.col("seq") == F.col("last_seq")) & F.col("next_cont")))
    out = [*by, "run_no", *([] if value in by else [value]), "start", F.col("run_len").cast("long").alias("run_len")]
    inner = j.filter(~crosses).select(*out)
    pos = F.struct("_pid", "seq")
    merged = (j.filter(crosses).groupBy(*by, "run_no")
              .agg(*([] if value in by else [F.min_by(F.col(value), pos).alias(value)]),
                   F.min_by("start", pos).alias("start"), F.sum("run_len").alias("run_len"))
              .select(*out))
    return inner.unionByName(merged)


def floor_join(left: DataFrame, right: DataFrame, left_pos: str, right_pos: str,
               by: list[str], partitions: int | None = None, tie: list[str] | None = None) -> DataFrame:
    """O13 as-of join: each left row with the last right row (same ``by``)
    whose ``right_pos <= left_pos``; right columns are null when there is none.

    A null key or position matches nothing.  Of right rows at one position the
    last by ``tie`` (columns of ``right``; by default all its other columns)
    is taken.  Output: left columns, then right columns other than ``by``;
    names other than ``by`` must not collide.
    """
    by = list(by)
    if not by:
        raise ValueError("floor_join needs at least one key column")
    r_payload = [c for c in right.columns if c not in by]
    l_payload = [c for c in left.columns if c not in by]
    clash = set(r_payload) & set(l_payload)
    if clash:
        raise ValueError(f"rename colliding columns first: {sorted(clash)}")
    tie = list(tie) if tie is not None else [c for c in r_payload if c != right_pos]
    pos_type = left.schema[left_pos].dataType

    def usable(pos):
        ok = F.col(pos).isNotNull()
        for c in by:
            ok = ok & F.col(c).isNotNull()
        return ok

    l_row, r_row = F.struct(*l_payload), F.struct(*r_payload)
    l_type, r_type = left.select(l_row.alias("x")).schema["x"].dataType, right.select(r_row.alias("x")).schema["x"].dataType
    keys = [F.col(c) for c in by]
    both = left.filter(usable(left_pos)).select(
        *keys, F.col(left_pos).alias("_pos"), F.lit(1).alias("_side"), l_row.alias("_l"),
        F.lit(None).cast(r_type).alias("_r"),
        *[F.lit(None).cast(right.schema[c].dataType).alias(f"_t{i}") for i, c in enumerate(tie)])
    both = both.unionByName(right.filter(usable(right_pos)).select(
        *keys, F.col(right_pos).cast(pos_type).alias("_pos"), F.lit(0).alias("_side"),
        F.lit(None).cast(l_type).alias("_l"), r_row.alias("_r"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie)]))
    order = [*by, "_pos", "_side", *[f"_t{i}" for i in range(len(tie))]]
    rows = sliced(both, order, partitions)
    key = _key(by)
    rows = rows.withColumn("_got", F.last("_r", ignorenulls=True).over(
        Window.partitionBy("_pid", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    # per slice: its first and last key, and the last right row of the last key
    span = rows.groupBy("_pid").agg(F.min_by(key, "_at").alias("_fk"), F.max_by(key, "_at").alias("_lk"),
                                    F.max_by(F.struct("_got"), "_at").alias("_lr"))
    w = Window.orderBy("_pid")  # one row per slice
    acc = F.last(F.col("_lr._got"), ignorenulls=True).over(
        Window.partitionBy("_lk").orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = (span.withColumn("_acc", acc)
            .withColumn("_carry", F.when(F.lag("_lk").over(w) == F.col("_fk"), F.lag("_acc").over(w)))
            .select("_pid", "_fk", "_carry"))
    found = rows.filter(F.col("_side") == 1).join(F.broadcast(ends), "_pid").withColumn(
        "_got", F.coalesce("_got", F.when(key == F.col("_fk"), F.col("_carry"))))
    out = found.select(*by, *[F.col("_l")[c].alias(c) for c in l_payload], *[F.col("_got")[c].alias(c) for c in r_payload])
    rest = left.filter(~usable(left_pos)).select(
        *by, *l_payload, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in r_payload])
    return out.unionByName(rest)
