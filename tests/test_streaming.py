from lastcol.streaming import start_search_stream


def test_search_stream_available_now(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("[8]Computers in industry[9]Data compression")
    (src / "b.txt").write_text("[10]Integration[11]Big data indexing")
    out = tmp_path / "out"
    for _ in range(2):  # the second run finds nothing new
        q = start_search_stream(spark, str(src), "in", str(out), str(tmp_path / "ckpt"), available_now=True)
        q.awaitTermination(120)
    got = sorted(r.record_id for r in spark.read.parquet(str(out)).collect())
    assert got == [8, 11]
