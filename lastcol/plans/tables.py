"""Loading the driver's Parquet tables and viewing them as records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lastcol.sources import records_from


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus: ``documents`` as ``(record_id, content)``."""
    return records_from(table(spark, sf_dir, "documents"), "doc_id", "text")
