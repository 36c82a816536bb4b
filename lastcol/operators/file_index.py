"""Search index over a folder of files, kept up to date by file.

A :class:`FileView` says how files become records.  The index holds them in
segments; an update lists the files, reads those that are new or have changed
into a new segment, and publishes a new version, whose file table says which
segment speaks for which file.  Rows of files that are gone, or that a later
segment holds anew, stay on disk but count no more, until segments are merged
(from the index's own rows: no source file is read for that, and what an update
reads is merged on the way).

A segment has ``records`` ``(row_no, record_id, file, content)`` and ``lists``
``(gram, rows, at)``: for some megabytes of text, the three characters that begin at a
position (fewer at a record's end) with the row and the position of all of them, sorted
by gram and written where the texts were read, in short pages.  A pattern is covered by grams at known offsets, so
joining their postings by aligned position gives exact matches without
a look at a text; a pattern of one or two characters is a prefix of grams.

:func:`build_signatures` keeps one bitmap of grams per file, which tells the files that
can hold a pattern before any is opened.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastcol.functions import chars, pattern_grams
from lastcol.functions.arrow import code_points, gathered, gram_keys, grams_of
from lastcol.functions.text import escaped_path, file_name
from lastcol.operators.search import _check, keyword_search
from lastcol.session import COMPACT, spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 3
#: Bytes of text whose grams share lists, and rows of a page of the stored lists.
LIST_BYTES = 1 << 22
PAGE_ROWS = 256
#: Segments of an index before they are merged into one.
MERGE_AT = 8
#: Rows of a file list that may be broadcast.
BROADCAST_FILES = 200_000
#: Bits of a file's signature: 32 bitmaps of 32,768.
SIGNATURE_BITS = 1 << 20


@dataclass(frozen=True)
class FileView:
    """Records of the files under ``path``: a format with its options and schema, an id and a
    text column, and a condition on rows.  Equal views give equal records of a file.
    (``basePath`` among the options keeps the columns of partition folders.)"""

    path: str
    id_col: str
    text_col: str
    format: str = "parquet"
    where: str | None = None
    schema: str | None = None
    options: tuple[tuple[str, str], ...] = ()

    def spec(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    def files(self, spark: SparkSession) -> DataFrame:
        """``(file, path, length, changed)``: listed by Spark, no file is opened.
        ``file`` is the name that rows carry, ``path`` the one to open."""
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(escaped_path(self.path))
        return found.select(file_name(F.col("_metadata.file_path")).alias("file"), "path", "length",
                            F.col("modificationTime").alias("changed"))

    def records(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        """``(file, record_id, content)`` of the files at ``paths``; no other is read."""
        reader = spark.read.format(self.format).options(**dict(self.options))
        if self.schema:
            reader = reader.schema(self.schema)
        df = reader.load([escaped_path(p) for p in paths])
        df = df.withColumn("_file", file_name(F.col("_metadata.file_path")))
        if self.where:
            df = df.filter(self.where)
        return df.select(F.col("_file").alias("file"), F.col(self.id_col).cast("long").alias("record_id"),
                         F.col(self.text_col).cast("string").alias("content"))


@dataclass
class FileIndex:
    spark: SparkSession
    path: str
    files: DataFrame
    segments: list[str]
    #: the files that the update read, and whether it changed anything
    read: list[str] = field(default_factory=list)
    changed: bool = False

    def _table(self, name: str, schema: str) -> DataFrame:
        if not self.segments:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/segments/{s}/{name}" for s in self.segments])

    @property
    def rows(self) -> DataFrame:
        """``(segment, row_no, record_id, file)`` of the live rows."""
        every = self._table("records", "segment string, row_no long, record_id long, file string")
        live = self.files.select("segment", "file")
        few = live.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES
        return every.join(F.broadcast(live) if few else live, ["segment", "file"], "left_semi").select(*every.columns)

    @property
    def records(self) -> DataFrame:
        """``(segment, row_no, content)``, rows that count no more too."""
        return self._table("records", "segment string, row_no long, content string")

    @property
    def postings(self) -> DataFrame:
        """``(segment, gram, row_no, pos)``"""
        lists = self._table("lists", "segment string, gram string, rows array<long>, at array<int>")
        return lists.select("segment", "gram", F.explode(F.arrays_zip("rows", "at")).alias("_e")).select(
            "segment", "gram", F.col("_e.rows").alias("row_no"), F.col("_e.at").alias("pos"))


def _lists_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in gathered(batches, 1, LIST_BYTES):
        codes, sizes = code_points(part.column(1))
        keys = gram_keys(codes, sizes, GRAM)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        begun = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(sizes)), sizes)[order]
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        cut = pa.array(np.r_[at, len(keys)], pa.int32())
        yield pa.RecordBatch.from_arrays([
            grams_of(keys[at], GRAM), pa.ListArray.from_arrays(cut, part.column(0).take(pa.array(row))),
            pa.ListArray.from_arrays(cut, pa.array(order - begun[row] + 1, pa.int32()))], names=["gram", "rows", "at"])


def positional_lists(rows: DataFrame) -> DataFrame:
    """``(gram, rows, at)`` of ``rows(row_no, content)``: for some megabytes of text, the
    characters from each 1-based position on, three of them or what is left, with row and position."""
    src = spread(rows.filter(F.length("content") > 0).select("row_no", "content"))
    return src.mapInArrow(_lists_of, "gram string, rows array<long>, at array<int>")


def _write_segment(records: DataFrame, path: str) -> str:
    """Store ``records(file, record_id, content)`` as a segment under ``path``; its name."""
    spark, name = records.sparkSession, uuid.uuid4().hex
    base = f"{path}/segments/{name}"
    seg = F.lit(name).alias("segment")
    (records.repartitionByRange("file", "record_id").sortWithinPartitions("file", "record_id")
     .select(seg, F.monotonically_increasing_id().alias("row_no"), "record_id", "file", "content")
     .write.options(**COMPACT).parquet(f"{base}/records"))
    own = spark.read.schema("row_no long, content string").parquet(f"{base}/records")
    (positional_lists(own).select(seg, "gram", "rows", "at")
     .write.options(**COMPACT).option("parquet.page.row.count.limit", PAGE_ROWS).parquet(f"{base}/lists"))
    return name


_FILES = "file string, length long, changed timestamp, segment string"


def _load(spark: SparkSession, path: str) -> tuple[FileIndex, str] | None:
    try:
        now = spark.read.schema("version string, spec string").parquet(f"{path}/current").first()
    except AnalysisException:
        return None
    if now is None:
        return None
    files = spark.read.schema(_FILES).parquet(f"{path}/versions/{now['version']}")
    segments = sorted(r["segment"] for r in files.select("segment").distinct().collect())
    return FileIndex(spark, path, files, segments), now["spec"]


def _publish(spark: SparkSession, path: str, files: DataFrame, spec: str) -> FileIndex:
    version = uuid.uuid4().hex
    files.select("file", "length", "changed", "segment").write.parquet(f"{path}/versions/{version}")
    (spark.createDataFrame([(version, spec)], "version string, spec string").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/current"))
    return _load(spark, path)[0]


def update_index(spark: SparkSession, view: FileView, path: str, merge_at: int = MERGE_AT) -> FileIndex:
    """The index of ``view`` at ``path``, brought up to date.

    Files that are new or differ in length or time are read; files that are gone
    are forgotten.  Another view (columns, condition, format) rebuilds all.  Without a
    difference nothing is written.  More than ``merge_at`` segments are merged.
    """
    listed = view.files(spark)
    old = _load(spark, path)
    if old and old[1] == view.spec():
        index = old[0]
        same = ["file", "length", "changed"]
        kept = index.files.join(listed, same, "left_semi").select("file", "length", "changed", "segment")
        fresh = listed.join(index.files, same, "left_anti")
        gone = index.files.join(listed, same, "left_anti")
    else:
        index, kept, fresh, gone = FileIndex(spark, path, spark.createDataFrame([], _FILES), []), None, listed, None
    new = fresh.select("file", "length", "changed", "path").collect()  # names of files to be opened: the reader takes a list
    if old and index is old[0] and not new and gone.isEmpty():
        return index
    files = kept
    if new:
        records = view.records(spark, [r["path"] for r in new])
        segments = [] if kept is None else sorted(r["segment"] for r in kept.select("segment").distinct().collect())
        merges = bool(segments) and len(segments) + 1 > merge_at
        if merges:  # what is read joins the segments' rows, and is written once
            records = _live(FileIndex(spark, path, kept, segments)).unionByName(records)
        segment = _write_segment(records, path)
        added = spark.createDataFrame([(*r[:3], segment) for r in new], _FILES)
        files = kept = kept.withColumn("segment", F.lit(segment)) if merges else kept
        files = added if kept is None else kept.unionByName(added)
    elif kept is None:
        files = spark.createDataFrame([], _FILES)
    out = _publish(spark, path, files, view.spec())
    if len(out.segments) > merge_at:
        out = merge_segments(out, view.spec())
    out.read, out.changed = [r["file"] for r in new], True
    return out


def _live(index: FileIndex) -> DataFrame:
    return index.rows.join(index.records, ["segment", "row_no"]).select("file", "record_id", "content")


def merge_segments(index: FileIndex, spec: str) -> FileIndex:
    """All live rows in one segment, from the index's own tables."""
    segment = _write_segment(_live(index), index.path)
    return _publish(index.spark, index.path, index.files.withColumn("segment", F.lit(segment)), spec)


def _cover(pattern: str) -> list[int]:
    """Offsets of grams that together cover the pattern."""
    last = len(pattern) - GRAM
    return sorted({*range(0, last + 1, GRAM), last})


def _hits(index: FileIndex, pattern: str) -> DataFrame:
    """``(segment, row_no, pos)`` of every match, from postings alone."""
    if len(pattern) < GRAM:
        return index.postings.filter(F.col("gram").startswith(pattern)).select("segment", "row_no", "pos")
    at: dict[str, list[int]] = {}
    for i in _cover(pattern):
        at.setdefault(pattern[i:i + GRAM], []).append(i)
    offsets = F.lit(None).cast("array<int>")
    for gram, own in at.items():
        offsets = F.when(F.col("gram") == gram, F.array(*[F.lit(i) for i in own])).otherwise(offsets)
    found = index.postings.filter(F.col("gram").isin(list(at)))
    if len(at) == 1 and len(_cover(pattern)) == 1:
        return found.select("segment", "row_no", "pos")
    begun = found.withColumn("off", F.explode(offsets)).select("segment", "row_no", (F.col("pos") - F.col("off")).alias("pos"))
    return begun.groupBy("segment", "row_no", "pos").agg(F.count("*").alias("n")).filter(
        F.col("n") == len(_cover(pattern))).select("segment", "row_no", "pos")


def match_positions(index: FileIndex, pattern: str) -> DataFrame:
    """O30 by the index: ``(record_id, pos)``; no text is read."""
    _check(pattern)
    return _hits(index, pattern).join(index.rows, ["segment", "row_no"]).select("record_id", F.col("pos").cast("long").alias("pos"))


def occurrence_count(index: FileIndex, pattern: str) -> DataFrame:
    """O21 by the index: ``(record_id, n)`` per row that holds the pattern; no text is read."""
    _check(pattern)
    return (_hits(index, pattern).groupBy("segment", "row_no").agg(F.count("*").alias("n"))
            .join(index.rows, ["segment", "row_no"]).select("record_id", "n"))


def search(index: FileIndex, pattern: str, ordered: bool = True) -> DataFrame:
    """The rows of :func:`keyword_search`, reading the texts of those alone."""
    _check(pattern)
    hit = _hits(index, pattern).select("segment", "row_no").distinct()
    out = (hit.join(index.rows, ["segment", "row_no"]).join(index.records, ["segment", "row_no"]).select("record_id", "content"))
    return out.orderBy("record_id") if ordered else out


# ---------------------------------------------------------------- signatures

def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SIGNATURE_BITS))


def build_signatures(spark: SparkSession, view: FileView, path: str) -> None:
    """Write ``(file, bucket, bits)``: a bitmap of the grams of each file's records."""
    recs = view.records(spark, [r["path"] for r in view.files(spark).select("path").collect()])  # the reader takes a list
    gram = F.transform(F.sequence(F.lit(0), F.size("_c") - GRAM), lambda i: F.concat(*[F.get("_c", i + k) for k in range(GRAM)]))
    slots = (recs.filter(F.length("content") >= GRAM).select("file", chars("content").alias("_c"))
             .select("file", F.explode_outer(F.array_distinct(gram)).alias("gram")).select("file", _slot(F.col("gram")).alias("slot")))
    bits = slots.groupBy("file", F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bits.repartitionByRange("bucket", "file").sortWithinPartitions("bucket", "file").write.parquet(f"{path}/bits")
    view.files(spark).select("file", "path").write.parquet(f"{path}/files")


def files_with(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths of the files that may hold the pattern: all of its grams are in their signature."""
    slots = spark.createDataFrame([(g,) for g in pattern_grams(pattern, GRAM)], "gram string").select(_slot(F.col("gram")).alias("slot"))
    wanted = slots.select(F.bitmap_bucket_number("slot").alias("bucket"), F.bitmap_bit_position("slot").alias("at")).distinct().collect()
    bits = spark.read.schema("file string, bucket long, bits binary").parquet(f"{path}/bits")
    bits = bits.filter(F.col("bucket").isin(sorted({r["bucket"] for r in wanted})))
    holds = F.lit(0)
    for r in wanted:
        byte = F.conv(F.hex(F.substring("bits", r["at"] // 8 + 1, 1)), 16, 10).cast("int")
        holds = holds + F.when((F.col("bucket") == r["bucket"]) & (F.shiftright(byte, r["at"] % 8) % 2 == 1), 1).otherwise(0)
    found = bits.groupBy("file").agg(F.sum(holds).alias("n")).filter(F.col("n") == len(wanted)).select("file")
    paths = spark.read.schema("file string, path string").parquet(f"{path}/files").join(found, "file", "left_semi")
    return sorted(r["path"] for r in paths.collect())  # names of files to be opened


def signed_search(spark: SparkSession, view: FileView, path: str, pattern: str, ordered: bool = True) -> DataFrame:
    """The rows of :func:`keyword_search` over the view, opening only files whose
    signature holds the pattern's grams.  A pattern shorter than a gram opens all."""
    _check(pattern)
    paths = files_with(spark, path, pattern) if len(pattern) >= GRAM else [r["path"] for r in view.files(spark).select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "record_id long, content string")
    return keyword_search(view.records(spark, paths), pattern, ordered)
