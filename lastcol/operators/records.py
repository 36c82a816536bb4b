"""Id-level operators over records: bounds, successor, audit, lookup."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bounds(records: DataFrame, by: str | None = None) -> DataFrame:
    """One row ``(min_id, max_id)``; with ``by`` (``source``, say) one row
    for each of its values."""
    return (records.groupBy(by) if by else records).agg(
        F.min("record_id").alias("min_id"), F.max("record_id").alias("max_id"))


def with_bounds(rows: DataFrame, records: DataFrame, by: str | None) -> DataFrame:
    """``rows`` with the columns ``_lo`` and ``_hi`` of their id range.  One
    range enters as scalar subqueries; ranges by ``by`` are joined."""
    if by:
        bounds = records.groupBy(by).agg(F.min("record_id").alias("_lo"), F.max("record_id").alias("_hi"))
        return rows.join(bounds, by)
    return rows.withColumn("_lo", records.select(F.min("record_id")).scalar()).withColumn(
        "_hi", records.select(F.max("record_id")).scalar())


def next_record(records: DataFrame, by: str | None = None) -> DataFrame:
    """The following record, cyclic (``id + 1``; the smallest after the
    largest), within each ``by`` if given.

    The successor lookup is a single equi-join on a unique key; no window over
    the whole table.
    """
    keys = [by] if by else []
    cur = with_bounds(records.select(*keys, "record_id"), records, by).select(
        *keys, "record_id",
        F.when(F.col("record_id") == F.col("_hi"), F.col("_lo")).otherwise(F.col("record_id") + 1).alias("next_id"))
    nxt = records.select(*keys, F.col("record_id").alias("next_id"), F.col("content").alias("next_content"))
    return cur.join(nxt, [*keys, "next_id"]).select(*keys, "record_id", "next_id", "next_content")


def id_audit(records: DataFrame, by: str | None = None) -> DataFrame:
    """``(record_id, problem, n)`` for ids without a successor ('gap') and
    ids seen more than once ('duplicate'); within each ``by`` if given.

    Ids are first reduced to distinct values with their counts (a partial
    aggregate), so a heavily duplicated id never reaches the anti-join as
    many rows.
    """
    keys = [by] if by else []
    ids = records.groupBy(*keys, "record_id").agg(F.count(F.lit(1)).alias("n"))
    succ = ids.select(*keys, (F.col("record_id") - 1).alias("record_id"))
    gaps = (with_bounds(ids.join(succ, [*keys, "record_id"], "left_anti"), records, by)
            .filter(F.col("record_id") != F.col("_hi"))
            .select(*keys, "record_id", F.lit("gap").alias("problem"), F.lit(1).cast("long").alias("n")))
    dups = ids.filter(F.col("n") > 1).select(*keys, "record_id", F.lit("duplicate").alias("problem"), "n")
    return gaps.unionByName(dups)


def lookup_records(records: DataFrame, ids) -> DataFrame:
    """Records with the given ids: a literal list or a DataFrame with ``record_id``.

    A list becomes an ``IN`` filter that reaches the Parquet scan; a table is
    a left semi join, which AQE turns into a broadcast join when the id side
    is measured small.
    """
    if isinstance(ids, DataFrame):
        return records.join(ids.select("record_id"), "record_id", "left_semi")
    values = list(ids) if isinstance(ids, Iterable) else [ids]
    return records.filter(F.col("record_id").isin(values))


def record_exists(records: DataFrame, record_id: int) -> bool:
    """Point test; reads at most one row."""
    return bool(records.filter(F.col("record_id") == record_id).limit(1).count())
