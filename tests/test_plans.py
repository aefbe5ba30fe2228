"""Shape of the plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from homelake.operators.paging import read_page, write_pages
from homelake.plans import clean as P
from homelake.plans.refine import routed
from homelake.plans.crawl import Selectors
from homelake.registry.queries import QUERIES
from homelake.sources import sample_tables
from homelake.sources.lake import write_parts
from homelake.sources.sample_tables import listing_pages, listings

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    return text


def test_merge_cleans_the_target_once_and_pushes_its_cut(spark):
    text = plan(spark, "upsert_merge")
    orders = [line for line in text.splitlines() if "FileScan" in line and "o_orderdate" in line]
    assert len(orders) == 1 and re.search(r"LessThan\(o_orderdate,", orders[0])


def test_whole_texts_are_not_exchanged_to_find_copies(spark):
    text = plan(spark, "exact_dedup")
    exchanges = re.findall(r"hashpartitioning\((\S+?)#", text)
    assert exchanges == ["_digest"]
    assert not re.search(r"Aggregate\(keys=\[text", text)


def test_union_of_one_run_cleans_nothing_again(spark):
    text = plan(spark, "chunk_union")
    assert text.count("FileScan") == 2 and "o_orderkey" not in text
    assert len(re.findall(r"PartitionFilters: \[[^\]]*is_valid", text)) == 2


def test_page_after_a_key_is_pushed_down(spark):
    text = plan(spark, "page_after_key")
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in text and "TakeOrderedAndProject(limit=50" in text


def test_payloads_derive_items_once(spark):
    text = plan(spark, "payload_rows")
    assert len([line for line in text.splitlines() if "FileScan" in line and "o_orderkey" in line]) == 1


def largest_method(spark, df):
    """Bytes of the largest method that is generated for a plan, before adaptive execution."""
    plan = df._jdf.queryExecution().executedPlan()
    if hasattr(plan, "inputPlan") and plan.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
        plan = plan.inputPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan)))


def test_cleaning_is_generated_in_methods_that_the_jvm_compiles(spark, tmp_path):
    """A method of more than 8,000 bytes is interpreted for good."""
    rows = listings(spark, FOLDER).withColumn("source_file", F.lit("x"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    for made in (P.good_rows(P.clean(rows)), P.clean(rows), routed(rows)):
        assert 1000 < largest_method(spark, made) < 8000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Here the texts are normalised where the given tables' rows are made into listings, by an expression
        # of many cases that is longer than that itself.
        assert largest_method(spark, QUERIES["clean_rows"](spark, FOLDER)) < 8000 + largest_method(spark, listings(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def last_plan(spark):
    """Plan of the last query that was run."""
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    return done.apply(done.size() - 1).physicalPlanDescription()


def test_rows_are_split_without_sorting_a_task(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") % 3 > 0).alias("is_valid"))
    write_parts(rows, str(tmp_path / "parts"), "is_valid", 2)
    assert "Sort" not in last_plan(spark)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    found = spark.read.schema(rows.schema).parquet(str(tmp_path / "parts"))
    assert sorted(found.collect()) == sorted(rows.collect()) and found.select("is_valid").distinct().count() == 2


def write_orders(spark, folder, n=3000):
    orders = spark.range(n).selectExpr(
        f"if(id % 7 = 0, 5, {n} - id) as o_orderkey", "id % 40 as o_custkey", "'1-URGENT' as o_orderpriority", "'O' as o_orderstatus",
        "cast('1997-01-01' as timestamp_ntz) as o_orderdate",
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    spark.range(40).selectExpr("id as c_custkey", "id % 3 as c_nationkey").write.parquet(f"{folder}/customer.parquet")
    spark.range(3).selectExpr("id as n_nationkey", "concat('N', id) as n_name").write.parquet(f"{folder}/nation.parquet")
    return folder


def test_listings_are_dealt_by_their_size_before_they_are_made(spark, tmp_path, monkeypatch):
    folder = write_orders(spark, str(tmp_path))
    plain = sorted(listings(spark, folder).collect(), key=str)
    monkeypatch.setattr(sample_tables, "LISTING_BYTES", 1000, raising=False)
    tasks = sample_tables.listing_tasks(spark, folder)
    made = listings(spark, folder)
    assert tasks > 8 and made.rdd.getNumPartitions() == tasks
    assert len(plain) == 3000 and sorted(made.collect(), key=str) == plain
    in_order = listings(spark, folder, ordered=True)
    keys = [r.ingest_seq for r in in_order.select("ingest_seq").collect()]
    assert keys == sorted(keys) and in_order.rdd.getNumPartitions() > 8
    for df in (made, in_order):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "partitioning(o_orderkey" in text and "partitioning(ingest_seq" not in text
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (listings(spark, folder), listing_pages(listings(spark, folder), Selectors())):
            assert largest_method(spark, df) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_files_of_a_folder_are_archived_as_one_batch(spark, tmp_path, monkeypatch):
    """However many files a folder has: a batch for each of them reads all logs again."""
    from functools import partial

    from homelake.registry import queries
    from homelake.streaming import jobs

    loads = []
    monkeypatch.setattr(queries.raw_files, "export_csv", partial(queries.raw_files.export_csv, rows_per_file=100))
    monkeypatch.setattr(jobs, "load_files", lambda lake, files, load, f=jobs.load_files: (loads.append(files.count()), f(lake, files, load)))
    found = queries.archived_files(spark, write_orders(spark, str(tmp_path))).collect()
    assert len(found) == 3 and sum(r.record_count for r in found) == 3000
    assert len(loads) == 4 and max(loads) > 5


def test_a_page_by_index_reads_its_ranges(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"))
    write_pages(rows, str(tmp_path / "pages"), ["a", "b"], 10)
    for page, size in ((1, 7), (50, 7), (143, 7), (144, 7), (3, 400), (1, 5000)):
        want = rows.orderBy("a", "b").offset((page - 1) * size).limit(size).collect()
        assert read_page(spark, str(tmp_path / "pages"), page, size).collect() == want
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = read_page(spark, str(tmp_path / "pages"), 50, 7)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*range_number#\d+ = \d+", text) and "range_place" in text.split("PushedFilters:")[1]
    write_pages(rows.where("a < 0"), str(tmp_path / "none"), ["a"], 4)
    assert read_page(spark, str(tmp_path / "none"), 1, 10).count() == 0


def test_a_page_needs_an_order(spark, tmp_path):
    with pytest.raises(ValueError):
        write_pages(spark.range(3), str(tmp_path / "x"), [], 2)
