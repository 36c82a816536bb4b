"""The corpus pipeline: from raw documents to packed token sequences.

Every stage works on all that the one before kept, and its decisions take
effect: toxic documents go, of equal texts and of near duplicates one document
stays, personal data is replaced by its kind, and what is left is packed.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastcol.llm import pii, toxicity
from lastcol.llm.common import BROADCAST_IDS, plain_id, stored, table, without
from lastcol.llm.mph_dedup import exact_dedup, normal_text
from lastcol.llm.ngram_join import ngram_components
from lastcol.llm.packing import best_fit_packing


def unused(docs: DataFrame, name: str) -> str:
    """``name``, longer as long as ``docs`` has a column of it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go."""
    score = toxicity.score_column(toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return docs.filter(score(F.col("text")) < 0.5)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: that of the smallest id, and one of them
    if the id is repeated or all lack one.  Rows go by id and digest, so other
    texts of an id are left alone."""
    row_id, digest = unused(docs, "row_id"), unused(docs, "digest")
    found = stored(exact_dedup(docs).select(plain_id().alias(row_id), F.col("text_sha256").alias(digest), "kept"), "exact")
    keyed = docs.withColumns({row_id: plain_id(), digest: F.sha2(normal_text(F.col("text")), 256)})
    first = without(keyed, found.filter("not kept"), [row_id, digest])
    again = stored(found.filter("kept").groupBy(digest).agg(F.count("*").alias("rows")).filter("rows > 1").select(digest), "again")
    n = again.count()
    if not n:
        return first.select(*docs.columns)
    again = F.broadcast(again) if n <= BROADCAST_IDS else again
    one = first.join(again, digest, "left_semi").groupBy(digest).agg(F.min_by(
        F.struct(*docs.columns), F.struct("text", F.xxhash64(*docs.columns))).alias("row")).select("row.*")
    return first.join(again, digest, "left_anti").select(*docs.columns).unionByName(one)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows that links join, one of the smallest id stays; rows without
    an id come last.  Rows are told apart by a hash of id and text (64 bits),
    which are different after the stage before."""
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    parts = ngram_components(keyed.select(F.col(key).alias("doc_id"), "text"))
    rows = stored(parts.select(F.col("doc_id").alias(key), "component_id").join(keyed.select(key, "doc_id"), key), "near")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    first = stored(rows.groupBy("component_id").agg(F.count("*").alias("n"), F.min(order).alias("first"))
                   .filter("n > 1").select("component_id", F.col(f"first.{key}").alias("first")), "first")
    few = first.count() <= BROADCAST_IDS
    dropped = rows.join(F.broadcast(first) if few else first, "component_id").filter(F.col(key) != F.col("first"))
    return without(keyed, dropped, key).select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans become their kind in brackets; the recorded length follows."""
    found = stored(pii.candidates(docs), "candidates")
    clean = pii.redact(pii.decide(found, pii.fit(found)))
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the clean documents."""
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack),
]

#: A trained classifier and a packing search are no SQL; tests/llm/test_pipeline.py
#: compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
