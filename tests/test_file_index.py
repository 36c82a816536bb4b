import random

import pytest

from lastcol.operators import file_index as fi
from lastcol.operators import index as ix
from lastcol.operators import search as se
from lastcol.sources import records_from
from pyspark.sql import functions as F

PATTERNS = ["the", "t", "e ", "tion data", "data index the", "aaaa", "aa", "búsqueda", "é", "absent", "x\ny"]


def rows(seed, first, n):
    rng = random.Random(seed)
    words = ["the", "tion", "data", "index", "búsqueda", "aaaaaaa", "é", "中文", "x\ny", "", "a"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [(first + i, t if i % 11 else None, i % 3) for i, t in enumerate(texts)]


def put(spark, folder, name, data):
    """One Parquet file ``name`` in ``folder``."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    folder.mkdir(exist_ok=True)
    table = pa.table({"id": pa.array([r[0] for r in data], pa.int64()), "text": pa.array([r[1] for r in data], pa.string()),
                      "kind": pa.array([r[2] for r in data], pa.int64())})
    pq.write_table(table, folder / name)


def same_as_scan(spark, folder, index, where=None):
    recs = records_from(spark.read.parquet(str(folder)).filter(where or "true"), "id", "text")
    for p in PATTERNS:
        want = sorted(tuple(r) for r in se.keyword_search(recs, p).collect())
        assert sorted(tuple(r) for r in fi.search(index, p).collect()) == want, p
        assert sorted(tuple(r) for r in fi.match_positions(index, p).collect()) == sorted(
            tuple(r) for r in se.match_positions(recs, p).collect()), p
        assert sorted(tuple(r) for r in fi.occurrence_count(index, p).collect()) == sorted(
            tuple(r) for r in se.occurrence_count(recs, p).collect()), p


def test_updates_read_only_what_changed(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "idx")
    put(spark, folder, "a.parquet", rows(1, 0, 40))
    put(spark, folder, "b [1].parquet", rows(2, 40, 40))
    view = fi.FileView(str(folder), "id", "text")
    built = fi.update_index(spark, view, path)
    assert built.changed and len(built.read) == 2
    same_as_scan(spark, folder, built)
    assert not fi.update_index(spark, view, path).changed
    put(spark, folder, "c.parquet", rows(3, 30, 40))  # repeats ids of the second
    more = fi.update_index(spark, view, path)
    assert [f.rsplit("/", 1)[1] for f in more.read] == ["c.parquet"] and len(more.segments) == 2
    same_as_scan(spark, folder, more)
    put(spark, folder, "a.parquet", rows(4, 500, 25))  # another content
    (folder / "c.parquet").unlink()
    less = fi.update_index(spark, view, path)
    assert [f.rsplit("/", 1)[1] for f in less.read] == ["a.parquet"]
    same_as_scan(spark, folder, less)


def test_merge_reads_no_source_and_answers_stay(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "idx")
    view = fi.FileView(str(folder), "id", "text")
    for i in range(3):
        put(spark, folder, f"{i}.parquet", rows(i, 100 * i, 20))
        index = fi.update_index(spark, view, path, merge_at=2)
    assert len(index.segments) == 1 and [f.rsplit("/", 1)[1] for f in index.read] == ["2.parquet"]
    assert not fi.update_index(spark, view, path, merge_at=2).changed
    read = index.rows.inputFiles() + index.postings.inputFiles()
    assert read and not any(str(folder) in f for f in read)
    same_as_scan(spark, folder, index)


def test_another_view_rebuilds(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "idx")
    put(spark, folder, "a.parquet", rows(1, 0, 40))
    fi.update_index(spark, fi.FileView(str(folder), "id", "text"), path)
    part = fi.update_index(spark, fi.FileView(str(folder), "id", "text", where="kind = 1"), path)
    assert part.changed
    same_as_scan(spark, folder, part, "kind = 1")


def test_empty_folder_and_all_files_gone(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "idx")
    put(spark, folder, "a.parquet", rows(1, 0, 10))
    view = fi.FileView(str(folder), "id", "text")
    fi.update_index(spark, view, path)
    (folder / "a.parquet").unlink()
    none = fi.update_index(spark, view, path)
    assert none.changed and fi.search(none, "the").collect() == [] and fi.match_positions(none, "t").collect() == []


def test_positions_read_no_text(spark, tmp_path):
    put(spark, tmp_path / "in", "a.parquet", rows(1, 0, 40))
    index = fi.update_index(spark, fi.FileView(str(tmp_path / "in"), "id", "text"), str(tmp_path / "idx"))
    plan = fi.match_positions(index, "data index")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "In(gram" in plan
    assert "StringStartsWith(gram,t" in fi.match_positions(index, "t")._jdf.queryExecution().executedPlan().toString()


def test_signatures_open_fewer_files(spark, tmp_path):
    folder, sig = tmp_path / "in", str(tmp_path / "sig")
    for i in range(6):
        put(spark, folder, f"{i}.parquet", rows(i, 100 * i, 20) + [(100 * i + 50, f"rare{'qwxyz'[i % 5]} nderou" if i in (2, 4) else "x", 0)])
    view = fi.FileView(str(folder), "id", "text")
    fi.build_signatures(spark, view, sig)
    recs = records_from(spark.read.parquet(str(folder)), "id", "text")
    for p in [*PATTERNS, "nderou", "rarex"]:
        got = fi.signed_search(spark, view, sig, p)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, se.keyword_search(recs, p).collect())), p
    assert sorted(f.rsplit("/", 1)[1][0] for f in fi.signed_search(spark, view, sig, "nderou").inputFiles()) == ["2", "4"]


@pytest.mark.parametrize("change", ["text2", "filter", "literal", "udf", "subquery", "union"])
def test_index_of_one_view_is_not_taken_for_another(spark, tmp_path, change):
    data = [(i, f"the first text {i}", f"other words {i}") for i in range(50)]
    spark.createDataFrame(data, "id long, text string, text2 string").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    base = records_from(df.filter("id < 40"), "id", "text")
    views = {"text2": records_from(df.filter("id < 40"), "id", "text2"), "filter": records_from(df, "id", "text"),
             "literal": records_from(df.filter("id < 41"), "id", "text"),
             "udf": base.withColumn("content", F.udf(lambda s: s.upper())("content")),
             "subquery": base.filter(F.col("record_id") < df.select((F.max("id") - 20).alias("m")).scalar()),
             "union": base.unionByName(spark.createDataFrame([(99, "the last text")], "record_id long, content string"))}
    _, built = ix.ensure_index(base, str(tmp_path / "idx"))
    _, again = ix.ensure_index(records_from(spark.read.parquet(str(tmp_path / "in")).filter("id < 40"), "id", "text"), str(tmp_path / "idx"))
    assert built and not again
    index, rebuilt = ix.ensure_index(views[change], str(tmp_path / "idx"))
    assert rebuilt
    for p in ("text", "words", "TEXT", "the last"):
        assert sorted(map(tuple, ix.indexed_search(index, p).collect())) == sorted(map(tuple, se.keyword_search(views[change], p).collect()))
    _, kept = ix.ensure_index(views[change], str(tmp_path / "idx"))
    assert not kept


def test_positions_are_listed_by_part_and_not_shuffled(spark, monkeypatch):
    import pyarrow as pa
    texts = [t for _, t, _ in rows(7, 0, 60) if t]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["row_no", "content"])
    monkeypatch.setattr(fi, "LIST_BYTES", 200)
    got = [(g["gram"], r, p) for b in fi._lists_of(iter([batch])) for g in b.to_pylist() for r, p in zip(g["rows"], g["at"], strict=True)]
    assert sorted(got) == sorted((t[k:k + 3], i, k + 1) for i, t in enumerate(texts) for k in range(len(t)))
    df = spark.createDataFrame(list(enumerate(texts)), "row_no long, content string")
    assert "rangepartitioning" not in fi.positional_lists(df)._jdf.queryExecution().executedPlan().toString()


def test_an_update_that_merges_writes_its_rows_once(spark, tmp_path):
    """Not as a segment of its own first; lists are stored by differences."""
    import pyarrow.parquet as pq
    folder, path = tmp_path / "in", tmp_path / "idx"
    view = fi.FileView(str(folder), "id", "text")
    for i in range(3):
        put(spark, folder, f"{i}.parquet", rows(i, 100 * i, 20))
        index = fi.update_index(spark, view, str(path), merge_at=2)
    assert len(index.segments) == 1 and len(list((path / "segments").iterdir())) == 3
    files = [pq.ParquetFile(f) for f in (path / "segments" / index.segments[0] / "lists").glob("*.parquet")]
    assert {f.metadata.row_group(0).column(2).compression for f in files if f.metadata.num_rows} == {"ZSTD"}
    same_as_scan(spark, folder, index)
