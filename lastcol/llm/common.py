"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastcol.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lastcol-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    so a lost executor costs one read, not a recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Stands for a null id inside Python workers, where a column with nulls would
#: become floating point and lose the low digits of large ids.
NO_ID = -(2**63)


def plain_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID)).alias(name)


def null_id(name: str = "doc_id") -> Column:
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


#: Ids broadcast at most; beyond, tables are joined by shuffle.
BROADCAST_IDS = 500_000


def without(docs: DataFrame, ids: DataFrame, name: str | list[str] = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key (a column or several) is none of ``ids``.  A
    short list goes to the rows, so that texts are not shuffled; a long one is
    joined.  Rows without a key stay."""
    listed = stored(ids.select(name).distinct(), "dropped")
    few = listed.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(listed) if few else listed, name, "left_anti")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for undirected ``edges(a, b)`` of longs; the
    component is its smallest node.  Nodes without an edge do not appear.

    Alternating large-star / small-star: every round links each node's
    neighbours to the smallest of them, so path lengths fall geometrically
    and the number of edges never grows.  Each round is two aggregations with
    map-side combine and two joins, written to the shared folder.
    """
    cur = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter("a <> b").distinct(), "cc")
    last = None
    while True:
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == last:
            break
        last = tuple(state)
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        cur = stored(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(low.select("a", F.col("m").alias("b")))
                     .filter("a <> b").distinct(), "cc")
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))
