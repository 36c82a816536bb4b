from lastcol.operators.records import id_audit, id_bounds, lookup_records, next_record, record_exists


def test_audit(spark):
    df = spark.createDataFrame([(8, "a"), (9, "b"), (9, "c"), (11, "d")], "record_id long, content string")
    got = sorted((r.record_id, r.problem, r.n) for r in id_audit(df).collect())
    assert got == [(9, "duplicate", 2), (9, "gap", 1)]


def test_next_wraps(sample_records):
    got = sorted((r.record_id, r.next_id) for r in next_record(sample_records).collect())
    assert got == [(8, 9), (9, 10), (10, 11), (11, 8)]


def test_single_record_is_own_successor(spark):
    df = spark.createDataFrame([(5, "x")], "record_id long, content string")
    assert [(r.record_id, r.next_id) for r in next_record(df).collect()] == [(5, 5)]


def test_bounds_and_lookup(sample_records):
    b = id_bounds(sample_records).first()
    assert (b.min_id, b.max_id) == (8, 11)
    assert sorted(r.record_id for r in lookup_records(sample_records, [9, 11, 99]).collect()) == [9, 11]
    assert record_exists(sample_records, 10) and not record_exists(sample_records, 12)


def test_sources_are_kept_apart(spark):
    from lastcol.operators.records import id_audit, id_bounds, next_record
    from lastcol.operators.search import boundary_search
    rows = [("f", 1, "ab"), ("f", 2, "c"), ("g", 1, "xb"), ("g", 3, "d"), ("g", 4, "d"), ("g", 4, "e")]
    recs = spark.createDataFrame(rows, "source string, record_id long, content string")
    assert sorted(map(tuple, id_bounds(recs, "source").collect())) == [("f", 1, 2), ("g", 1, 4)]
    assert sorted((r.source, r.record_id, r.next_id) for r in next_record(recs, "source").collect()) == [
        ("f", 1, 2), ("f", 2, 1), ("g", 3, 4), ("g", 3, 4), ("g", 4, 1), ("g", 4, 1)]
    assert sorted(map(tuple, id_audit(recs, "source").collect())) == [("g", 1, "gap", 1), ("g", 4, "duplicate", 2)]
    assert [tuple(r) for r in boundary_search(recs, "b[2]c", by="source").collect()] == [("f", 1, "ab")]


def test_boundary_hit_holds_its_head(spark):
    from lastcol.operators.search import boundary_search
    recs = spark.createDataFrame([(1, "zz"), (1, "a."), (2, "q")], "record_id long, content string")
    assert [tuple(r) for r in boundary_search(recs, ".[2").collect()] == [(1, "a.")]
