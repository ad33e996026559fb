from martlet.operators import checks


def test_starter_pair_fails_not_null_but_not_unique(spark):
    # {1, NULL}: one NULL row for not_null, no duplicate for unique.
    df = spark.createDataFrame([(1,), (None,)], "id int")
    nn = checks.not_null("starter", df, ["id"]).collect()
    assert [(r.column_name, r.failures) for r in nn] == [("id", 1)]
    assert checks.unique("starter", df, "id").count() == 0
    # The second starter model filters id = 1: it passes both.
    second = df.filter("id = 1")
    assert checks.not_null("second", second, ["id"]).first().failures == 0


def test_unique_reports_value_and_count(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    rows = checks.unique("m", df, "k").collect()
    assert [(r.value, r.n_records) for r in rows] == [("1", 2)]


def test_relationships_counts_orphan_rows_and_skips_nulls(spark):
    child = spark.createDataFrame([(1,)] * 1000 + [(2,), (3,), (3,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    rows = checks.relationships("c", child, "fk", "p", parent, "pk").collect()
    assert [(r.value, r.n_records) for r in rows] == [("3", 2)]


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("a",), ("b",), ("x",), ("x",), (None,)], "s string")
    rows = checks.accepted_values("m", df, "s", ("a", "b")).collect()
    assert [(r.value, r.n_records) for r in rows] == [("x", 2)]


def test_batch_row_count_fails_on_empty_or_different(spark):
    raw = spark.createDataFrame([("20260101T000000Z",)] * 3 + [("20260201T000000Z",)], "_BATCH_ID string")
    staged3 = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert checks.batch_row_count("m", staged3, "t", raw, "20260101T000000Z").count() == 0
    bad = checks.batch_row_count("m", staged3.limit(2), "t", raw, "20260101T000000Z").first()
    assert (bad.raw_rows, bad.staged_rows) == (3, 2)
    empty = checks.batch_row_count("m", staged3.limit(0), "t", raw, "20260301T000000Z").first()
    assert (empty.raw_rows, empty.staged_rows) == (0, 0)


def test_schema_listing_is_metadata_only(spark):
    from martlet.operators.profile import schema_listing
    df = spark.createDataFrame([], "ID long, CREATED_AT timestamp, _BATCH_ID string")
    assert schema_listing("t", df) == [("t", "ID", "bigint"), ("t", "CREATED_AT", "timestamp"),
                                       ("t", "_BATCH_ID", "string")]
