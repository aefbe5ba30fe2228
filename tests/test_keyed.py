from datetime import datetime

import pytest
from pyspark.sql import functions as F

from homelake.operators import conditions as C
from homelake.operators import keyed, missing


def listing_rows(spark, rows):
    return spark.createDataFrame(rows, "subpage_url string, store_staging_at timestamp, ingest_seq long")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_listing(spark):
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    rows = [
        ("later time", t1, 1), ("later time", t2, 2),
        ("earlier last", t2, 3), ("earlier last", t1, 4),
        ("tie", t1, 5), ("tie", t1, 6),
        ("null first", None, 7), ("null first", t1, 8),
        ("null last", t1, 9), ("null last", None, 10),
        ("nulls", None, 11), ("nulls", None, 12),
        (None, t1, 13),
    ]
    kept = {r.subpage_url: r.ingest_seq for r in keyed.newest_listing(listing_rows(spark, rows)).collect()}
    assert kept == {"later time": 2, "earlier last": 3, "tie": 6, "null first": 8, "null last": 9, "nulls": 12}


def test_newest_listing_reduces_before_the_shuffle(spark):
    # Half of the rows share one key.
    rows = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("subpage_url"),
        F.timestamp_seconds("id").alias("store_staging_at"),
        F.col("id").alias("ingest_seq"),
    )
    newest = keyed.newest_listing(rows)
    plan = plan_of(newest)
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > plan.index("Exchange")  # below it, so before it
    assert newest.count() == 10001
    assert newest.where("subpage_url = 'hot'").first().ingest_seq == 19998


def test_upsert_replaces_even_with_older_rows(spark):
    target = spark.createDataFrame([("a", 9), ("b", 9)], "k string, v int")
    incoming = spark.createDataFrame([(1, "a"), (2, "c")], "v int, k string")
    merged = keyed.upsert(target, incoming, "k")
    assert sorted(map(tuple, merged.collect())) == [("a", 1), ("b", 9), ("c", 2)]
    again = keyed.upsert(merged, incoming, "k")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_copies(spark):
    rows = [(1, "ab", "c"), (2, "a", "bc"), (3, "ab", "c"), (4, None, "c"), (5, "", "c"), (6, None, "c"), (7, "2:a", "c")]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    kept = keyed.drop_copies(df, ["x", "y"], [F.col("id").asc()])
    assert sorted(r.id for r in kept.collect()) == [1, 2, 4, 5, 7]
    assert keyed.distinct_rows(df, ["x", "y"]).count() == 5


def test_latest_row_and_top(spark):
    df = spark.createDataFrame([(1, "a"), (3, "c"), (2, "b")], "d int, v string")
    assert tuple(keyed.latest_row(df, "d").first()) == (3, "c")
    assert [r.d for r in keyed.top_recent(df, "d", 2).collect()] == [3, 2]


def test_conditions(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "b"), (3, None)], "n int, s string")
    assert [r.n for r in df.where(C.conditions({"n": {"gt": 1, "lt": 3}})).collect()] == [2]
    assert [r.n for r in df.where(C.conditions({"s": {"neq": "b"}})).collect()] == [1]
    assert [r.n for r in df.where(C.conditions({"s": {"like": "%b"}, "n": {"in": [2, 3]}})).collect()] == [2]
    assert df.where(C.conditions({})).count() == 3
    with pytest.raises(ValueError):
        C.conditions({"n": {"between": (1, 2)}})


def test_table_verbs(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, s string")
    assert sorted(map(tuple, C.update_where(df, {"n": 9}, {"s": "a"}).collect()), key=str) == [(2, "b"), (3, None), (9, "a")]
    assert sorted(r.n for r in C.delete_where(df, {"s": "a"}).collect()) == [2, 3]
    assert C.count_rows(df, {"s": "b"}).first()["count"] == 1
    assert [r.n for r in C.read_rows(df, ["n"], order_by="n", limit=1, offset=1).collect()] == [2]
    assert C.read_rows(df, limit=0, offset=0).count() == 3
    assert [r.n for r in C.page_of(df, 2, 2, ["n"]).collect()] == [3]
    assert C.page_info(C.page_of(df, 2, 2, ["n"]), 2, 2).first().rows_in_page == 1
    assert C.sample_row(df).count() == 1 and C.preview(df).count() == 3
    with pytest.raises(ValueError):
        C.page_of(df, 1, 2, [])


def test_missing_values_at_any_depth(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, (1.0, [nan, 2.0]), "NA"), (inf, None, "x"), (-1.5, (-inf, None), "null")],
                               "a double, b struct<c: double, d: array<double>>, s string")
    found = missing.null_tokens(missing.finite_only(df), ["s"]).collect()
    assert [r.a for r in found] == [None, None, -1.5]
    assert [r.b and (r.b.c, r.b.d) for r in found] == [(1.0, [None, 2.0]), None, (None, None)]
    assert [r.s for r in found] == [None, "x", None]
