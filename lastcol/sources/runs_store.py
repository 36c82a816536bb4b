"""Stored compressed form: text runs as Parquet (O4), and whole records as runs
of their block-wise transform.

Runs are clustered by block and ordered by position inside each file, so a
reader of one block touches one file range and Parquet's own run-length and
dictionary encodings apply to the sorted symbol column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastcol.operators.rotation import BLOCK_SIZE, bwt, inverse_bwt, make_blocks
from lastcol.operators.runs import decode_text, text_runs
from lastcol.schemas import RUNS


def write_runs(runs: DataFrame, path: str, mode: str = "overwrite") -> None:
    (runs.select(*RUNS.fieldNames())
     .repartition("block_id")
     .sortWithinPartitions("block_id", "start_pos")
     .write.mode(mode).parquet(path))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def compress(records: DataFrame, path: str, block_size: int = BLOCK_SIZE) -> None:
    """Write ``records(record_id, content)`` (unique ids) as the runs of their
    blocks' transform, with what the inverse needs (start rank and period per
    block) and the ids themselves, so that empty and null texts come back."""
    spark = records.sparkSession
    blocks = make_blocks(records, block_size=block_size)
    (bwt(blocks.select("block_id", "text")).sortWithinPartitions("block_id").write.parquet(f"{path}/transform"))
    done = spark.read.parquet(f"{path}/transform")
    # the transform lies in block order, and runs follow their block: none is moved or sorted
    text_runs(done, "bwt_text").select(*RUNS.fieldNames()).write.mode("overwrite").parquet(f"{path}/runs")
    done.select("block_id", "start_rank", "period").write.parquet(f"{path}/blocks")
    records.select("record_id", F.length("content").alias("n_chars")).write.parquet(f"{path}/records")


def decompress(spark: SparkSession, path: str) -> DataFrame:
    """The records that :func:`compress` stored, from runs and block facts
    alone."""
    texts = decode_text(read_runs(spark, f"{path}/runs")).withColumnRenamed("text", "bwt_text")
    blocks = inverse_bwt(texts.join(spark.read.parquet(f"{path}/blocks"), "block_id"))
    joined = (blocks.groupBy(F.shiftright("block_id", 16).alias("record_id"))
              .agg(F.sort_array(F.collect_list(F.struct("block_id", "text"))).alias("_b"))
              .select("record_id", F.array_join(F.transform("_b", lambda b: b["text"]), "").alias("_t")))
    ids = spark.read.parquet(f"{path}/records")
    return ids.join(joined, "record_id", "left").select(
        "record_id", F.when(F.col("n_chars").isNotNull(), F.coalesce("_t", F.lit(""))).alias("content"))
