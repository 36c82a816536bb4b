"""Tagged record files ``[id]text[id]text…`` and plain record views.

The reader splits on ``[`` with the Hadoop line reader, so files stay
splittable; each piece is ``id]content``.  The piece in front of the first
``[`` of a file is text before any tag: it goes to the rejects with the
malformed pieces, never into the records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ID_RE = r"^[0-9]+$"


@dataclass(frozen=True)
class TaggedRead:
    """Both outputs of one parse: good records and rejected pieces."""

    records: DataFrame
    rejects: DataFrame


def _parse(spark: SparkSession, path, strip_newline: bool) -> DataFrame:
    raw = (spark.read.option("lineSep", "[").text(path)
           .select(F.col("value").alias("raw"),
                   F.input_file_name().alias("source"),
                   F.input_file_block_start().alias("_split"),
                   F.monotonically_increasing_id().alias("_seq")))
    # Text in front of the first "[" of a file: the first piece read by the
    # task that owns the file's first split.  One row per file (small).
    lead = (raw.filter(F.col("_split") == 0).groupBy("source")
            .agg(F.min("_seq").alias("_seq")).withColumn("_lead", F.lit(True)))
    body = F.col("raw")
    if strip_newline:
        body = F.regexp_replace(body, r"\n$", "")
    close = F.instr(body, "]")
    tag = F.when(close > 0, F.substring_index(body, "]", 1))
    content = F.when(close > 0, F.expr("substr(_body, instr(_body, ']') + 1)"))
    parsed = (raw.join(lead, ["source", "_seq"], "left")
              .withColumn("_body", body)
              .withColumn("_tag", tag)
              .withColumn("content", content))
    reason = (F.when(F.col("_lead").isNotNull(),
                     F.when(F.col("raw") == "", F.lit(None)).otherwise(F.lit("text before first tag")))
              .when(F.col("_tag").isNull(), F.lit("missing ]"))
              .when(F.col("_tag") == "", F.lit("empty id"))
              .when(~F.col("_tag").rlike(_ID_RE), F.lit("id not a number"))
              .when(F.expr("try_cast(_tag AS BIGINT)").isNull(), F.lit("id out of range")))
    return parsed.withColumn("reason", reason)


def read_tagged(spark: SparkSession, path, strip_newline: bool = False) -> TaggedRead:
    """O1: scan ``[id]text`` files; ``strip_newline`` drops one final ``\\n``
    per record (the layout written by :func:`write_tagged_records`)."""
    parsed = _parse(spark, path, strip_newline)
    records = (parsed.filter(F.col("_lead").isNull() & F.col("reason").isNull())
               .select("source", F.expr("CAST(_tag AS BIGINT)").alias("record_id"), "content"))
    rejects = (parsed.filter(F.col("reason").isNotNull())
               .select("source", "raw", "reason"))
    return TaggedRead(records, rejects)


def read_tagged_records(spark: SparkSession, path, strip_newline: bool = False) -> DataFrame:
    return read_tagged(spark, path, strip_newline).records


def read_tagged_rejects(spark: SparkSession, path, strip_newline: bool = False) -> DataFrame:
    return read_tagged(spark, path, strip_newline).rejects


def records_from(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """O2: any table as ``(record_id, content)``.  A long id column is passed on
    as it is, so that filters on ``record_id`` reach the scan; ids are checked
    by :func:`check_ids`."""
    rid = F.col(id_col) if df.schema[id_col].dataType.typeName() == "long" else F.col(id_col).cast("long")
    text = F.col(text_col)
    if df.schema[text_col].dataType.typeName() != "string":
        text = text.cast("string")
    return df.select(rid.alias("record_id"), text.alias("content"))


def check_ids(records: DataFrame) -> DataFrame:
    """``records``, after a job that raises if an id is null."""
    if not records.filter(F.col("record_id").isNull()).isEmpty():
        raise ValueError("null record_id")
    return records


def tagged_text(record_id="record_id", content="content") -> Column:
    """The printed form ``[id]content``."""
    rid = F.col(record_id) if isinstance(record_id, str) else record_id
    txt = F.col(content) if isinstance(content, str) else content
    return F.concat(F.lit("["), rid.cast("string"), F.lit("]"), txt)


def format_records(df: DataFrame) -> DataFrame:
    """One ``value`` line per record, ready for ``write.text``."""
    return df.select(tagged_text().alias("value"))


def write_tagged_records(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """O3: write records as ``[id]content`` files, one newline per record.

    Records are range-partitioned by id so that each file holds an id range
    in order (the reference's file order); read back with
    ``strip_newline=True``.
    """
    (records.repartitionByRange("record_id").sortWithinPartitions("record_id")
     .select(tagged_text().alias("value"))
     .write.mode(mode).text(path))
