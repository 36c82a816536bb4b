"""Keyword search over tagged files as they land in a folder.

The reference is batch only; this is the same parse and the same ``contains``
filter applied to Structured Streaming's file source, so new ``[id]text``
files are searched incrementally.  The operator is stateless (no watermark,
no aggregation state): each micro-batch is filtered on its own and appended.

Files are expected to start with a tag, as :func:`write_tagged_records`
writes them; a piece in front of the first tag is reported as a reject only
when it is not a well-formed ``id]text`` piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_ID_RE = r"^[0-9]+$"


def tagged_stream(spark: SparkSession, path: str, strip_newline: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(source, record_id, content)`` from ``[id]text`` files."""
    reader = spark.readStream.option("lineSep", "[")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    body = F.col("value")
    if strip_newline:
        body = F.regexp_replace(body, r"\n$", "")
    raw = reader.text(path).select(body.alias("_b"), F.input_file_name().alias("source"))
    tag = F.substring_index("_b", "]", 1)
    ok = (F.instr("_b", "]") > 0) & tag.rlike(_ID_RE) & F.expr("try_cast(substring_index(_b, ']', 1) AS BIGINT)").isNotNull()
    return (raw.filter(ok)
            .select("source", tag.cast("long").alias("record_id"),
                    F.expr("substr(_b, instr(_b, ']') + 1)").alias("content")))


def search_stream(spark: SparkSession, path: str, pattern: str, strip_newline: bool = False) -> DataFrame:
    """Streaming form of keyword search: records of new files containing ``pattern``."""
    if not pattern:
        raise ValueError("search pattern must be a non-empty string")
    return (tagged_stream(spark, path, strip_newline)
            .filter(F.col("content").contains(pattern)).select("record_id", "content"))


def start_search_stream(spark: SparkSession, path: str, pattern: str, out_path: str, checkpoint: str,
                        strip_newline: bool = False, available_now: bool = False) -> StreamingQuery:
    """Append hits to Parquet at ``out_path``.  Progress is kept in the folder
    ``checkpoint``: a query started again with the same folder goes on where
    the last one stopped, and appends each hit once."""
    writer = (search_stream(spark, path, pattern, strip_newline).writeStream
              .format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
