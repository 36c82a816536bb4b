from lastcol.sources import read_tagged, records_from, write_tagged_records


def test_sample_read(sample_records):
    rows = [(r.record_id, r.content) for r in sample_records.orderBy("record_id").collect()]
    assert rows == [(8, "Computers in industry"), (9, "Data compression"), (10, "Integration"),
                    (11, "Big data indexing")]


def test_rejects(spark, tmp_path):
    p = tmp_path / "bad.txt"
    p.write_text("lead text[x]abc[]def[7]ok[9")
    got = read_tagged(spark, str(p))
    assert [(r.record_id, r.content) for r in got.records.collect()] == [(7, "ok")]
    reasons = sorted(r.reason for r in got.rejects.collect())
    assert reasons == ["empty id", "id not a number", "missing ]", "text before first tag"]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, ""), (30, "x y")], "record_id long, content string")
    write_tagged_records(df, str(tmp_path / "out"))
    back = read_tagged(spark, str(tmp_path / "out"), strip_newline=True).records
    assert sorted((r.record_id, r.content) for r in back.collect()) == [(1, "a\nb"), (2, ""), (30, "x y")]


def test_records_from_null_id(spark):
    import pytest
    df = spark.createDataFrame([(None, "x")], "i long, t string")
    from lastcol.sources import check_ids
    with pytest.raises(ValueError):
        check_ids(records_from(df, "i", "t"))


def test_id_filter_reaches_the_scan(spark, tmp_path):
    from lastcol.operators.records import lookup_records
    spark.range(100).selectExpr("id AS i", "string(id) AS t").write.parquet(str(tmp_path / "t"))
    recs = records_from(spark.read.parquet(str(tmp_path / "t")), "i", "t")
    found = lookup_records(recs, [3, 7, 500])
    assert "PushedFilters: [In(i, [" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.record_id for r in found.collect()) == [3, 7]


def test_compressed_store_round_trip(spark, tmp_path):
    from lastcol.sources.runs_store import compress, decompress
    rows = [(1, "banana" * 50), (2, ""), (3, None), (4, "é\n x" * 7), (5, "a")]
    compress(spark.createDataFrame(rows, "record_id long, content string"), str(tmp_path / "c"), block_size=64)
    assert sorted(tuple(r) for r in decompress(spark, str(tmp_path / "c")).collect()) == rows
