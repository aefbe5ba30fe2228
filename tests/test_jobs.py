import re
import shutil
from collections import Counter
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from homelake import schemas
from homelake.operators.keyed import newest_listing, upsert_aligned
from homelake.plans import quality
from homelake.plans.ingest import ingest
from homelake.plans.refine import refine, refine_rows
from homelake.sources import raw_files
from homelake.sources.lake import Lake
from homelake.streaming.jobs import ingest_stream, refine_stream

GOOD = {
    "main_page_url": "https://x/nha-dat-ban/p1", "subpage_url": "https://x/ban-dat-xa-1", "title": "t", "address": "A, B, Huế",
    "price": "1 tỷ", "area": "20 m²", "post_id": "1", "post_start_time": "1/1/2025", "post_end_time": "2/1/2025", "post_type": "VIP",
}


def write_csv(path, rows, extra=""):
    lines = [",".join(schemas.RAW_COLUMNS)]
    for row in rows:
        lines.append(",".join('"' + row.get(c, "").replace('"', '""') + '"' for c in schemas.RAW_COLUMNS))
    path.write_text("\n".join(lines) + "\n" + extra, encoding="utf-8-sig")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    return folder


def add_rows(lake, load, rows):
    full = [tuple(r.get(c) for c in schemas.RAW_COLUMNS) + (at, seq, "f") for seq, (at, r) in enumerate(rows)]
    lake.add_load(lake.spark.createDataFrame(full, schemas.STAGING), load)


def test_ingest_reads_every_new_file_once(lake, raw):
    write_csv(raw / "raw_20251027_094851.csv", [GOOD | {"title": 'a "quoted"\nline, x', "legal": "NA"}, GOOD], extra="a,b\n")
    write_csv(raw / "raw_20251028_094851_chunk_01.csv", [])
    summary = ingest(lake, str(raw), "1").first().asDict()
    assert summary == {"status": "completed", "processed": 1, "failed": 1, "total": 2}
    rows = lake.staging().orderBy("ingest_seq").collect()
    assert [r.title for r in rows] == ['a "quoted"\nline, x', "t"]
    assert rows[0].legal is None and rows[0].main_page_url == GOOD["main_page_url"] and rows[0].source_file.endswith("094851.csv")
    assert [r.corrupt_record for r in lake.rejected_lines().collect()] == ["a,b"]
    log = {r.file_name: r for r in lake.file_log().collect()}
    assert log["raw_20251027_094851.csv"].record_count == 2 and log["raw_20251027_094851.csv"].status == "success"
    assert log["raw_20251027_094851.csv"].file_timestamp == datetime(2025, 10, 27, 9, 48, 51)
    assert log["raw_20251028_094851_chunk_01.csv"].status == "failed"
    assert lake.last_processed().first().last_processed_at is not None
    assert ingest(lake, str(raw), "2").first().status == "no_files"

    write_csv(raw / "raw_20251029_000000.csv", [GOOD])
    assert ingest(lake, str(raw), "3").first().processed == 1
    assert lake.staging().count() == 3


def test_a_repeated_load_does_not_repeat_rows(lake, raw):
    write_csv(raw / "raw_20251027_094851.csv", [GOOD])
    ingest(lake, str(raw), "1")
    shutil.rmtree(lake.path("bronze", "load_log"))  # as if the job stopped before its log
    assert lake.staging().count() == 0 and lake.file_log().count() == 0
    ingest(lake, str(raw), "1")
    assert lake.staging().count() == 1


def test_a_name_used_again_adds(lake, raw):
    write_csv(raw / "raw_20251027_094851.csv", [GOOD])
    ingest(lake, str(raw), "day")
    write_csv(raw / "raw_20251028_094851.csv", [GOOD | {"title": "b"}])
    ingest(lake, str(raw), "day")
    assert sorted(r.title for r in lake.staging().collect()) == ["b", "t"] and lake.file_log().count() == 2


def test_many_batches_and_moved_files(lake, raw, tmp_path):
    for n in range(9):
        write_csv(raw / f"raw_2025102{n}_094851.csv", [GOOD | {"title": str(n)}] if n else [])
    done, failed = tmp_path / "done", tmp_path / "failed"
    summary = ingest(lake, str(raw), "day", batch_files=2, archive=str(done), failed=str(failed)).first()
    assert (summary.processed, summary.failed) == (8, 1) and lake.load_log().count() > 1
    assert len(list((tmp_path / "lake/bronze/load_log").glob("part-*"))) == 1  # all batches are committed by one file
    assert sorted(r.title for r in lake.staging().collect()) == list("12345678")
    assert not list(raw.glob("*.csv")) and len(list(done.glob("*.csv"))) == 8 and len(list(failed.glob("*.csv"))) == 1
    assert [r.file_name for r in lake.failed_files().collect()] == ["raw_20251020_094851.csv"]


def test_columns_are_found_by_name(spark, raw):
    (raw / "a_20251027_094851.csv").write_text("\ufefftitle,other,subpage_url\nt,o,u\n", encoding="utf-8")
    (raw / "b_20251027_094851.csv").write_text("subpage_url,title,title\nu2,t2,t3\n", encoding="utf-8")
    (raw / "c_20251027_094851.csv").write_text("")
    rows = raw_files.scan_csv(spark, str(raw)).orderBy("title").collect()
    assert [(r.title, r.subpage_url, r.legal, r.corrupt_record) for r in rows] == [("t", "u", None, None), ("t2", "u2", None, None)]


def test_newest_line_does_not_depend_on_splits(spark, raw):
    for n in range(12):
        write_csv(raw / f"part{n:02d}_20251027_094851.csv", [GOOD | {"subpage_url": f"u{i}", "title": f"{n}-{i}-{j}"} for i in range(5) for j in range(2)])
    found = []
    for size in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "1k" else "4m")
        rows = raw_files.stamp(raw_files.scan_csv(spark, str(raw)), F.lit("2025-01-01").cast("timestamp"))
        found.append(sorted(r.title for r in newest_listing(rows, "created_at").collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] == [f"11-{i}-1" for i in range(5)]


def test_file_names_without_a_time(spark):
    rows = spark.createDataFrame([("a_20251027_094851.csv",), ("a_20251399_094851.csv",), ("a.csv",)], "n string")
    found = rows.select(raw_files.name_time("n", F.lit("2020-01-01").cast("timestamp")).alias("t")).collect()
    assert [r.t for r in found] == [datetime(2025, 10, 27, 9, 48, 51), None, datetime(2020, 1, 1)]


def test_export_has_small_files_with_a_mark(spark, tmp_path):
    rows = spark.range(450).select(*[F.lit(" a ").alias(c) for c in schemas.RAW_COLUMNS]).coalesce(1)
    raw_files.export_csv(rows, str(tmp_path / "out_20251027_094851"), rows_per_file=200)
    files = sorted((tmp_path / "out_20251027_094851").glob("*.csv"))
    assert len(files) == 3 and all(f.read_bytes().startswith(b"\xef\xbb\xbfmain_page_url,") for f in files)
    back = raw_files.scan_csv(spark, str(tmp_path / "out_20251027_094851"))
    assert back.count() == 450 and back.first().title == " a "
    assert back.first().file_timestamp == datetime(2025, 10, 27, 9, 48, 51)


def test_runs_are_incremental_and_repeatable(lake):
    t = [datetime(2025, 1, d) for d in range(1, 10)]
    add_rows(lake, "1", [(t[1], GOOD), (t[2], GOOD | {"title": "newer"}), (t[2], GOOD | {"price": "?"}), (None, GOOD | {"title": "no time"})])
    first = refine(lake).first()
    assert (first.run, first.good_rows, first.error_rows, first.duplicate_rows, first.last_date) == (1, 3, 1, 2, t[2])
    assert [r.title for r in lake.clean().collect()] == ["newer"]
    assert [(r.price, r.error_message, r.retry_status) for r in lake.errors().collect()] == [("?", "Price '?' không phù hợp", "pending")]

    assert refine(lake).first().run == 1  # nothing new
    add_rows(lake, "2", [(t[1], GOOD | {"title": "too late"}), (t[5], GOOD | {"title": "newest"}), (t[5], GOOD | {"subpage_url": "https://x/ban-condotel-2"})])
    second = refine(lake).first()
    assert (second.run, second.last_date) == (2, t[5])
    assert lake.last_transform_date().first().last_date == t[5]
    before = sorted(map(str, lake.clean().collect()))
    assert len(before) == 2 and lake.clean().columns == schemas.CLEAN_COLUMNS

    refine_rows(lake, lake.staging(), 2)  # a run that is in the log is not done again
    assert sorted(map(str, lake.clean().collect())) == before and lake.errors().count() == 1

    with pytest.raises(ValueError):
        refine_rows(lake, lake.staging(), 2, "another feed")

    # Rows of a later run with older times still advance nothing backwards.
    refine_rows(lake, lake.staging().where("title = 'too late'"), 3)
    assert lake.state().run == 3 and lake.last_transform_date().first().last_date == t[5]
    assert {r.title for r in lake.clean().collect()} == {"too late", "t"}


def test_a_load_committed_late_is_refined(lake):
    late = GOOD | {"subpage_url": "https://x/ban-condotel-2", "title": "too late"}
    add_rows(lake, "1", [(datetime(2025, 1, 5), GOOD)])
    refine(lake)
    add_rows(lake, "2", [(datetime(2025, 1, 1), late), (None, late | {"subpage_url": "https://x/ban-condotel-3"})])
    assert refine(lake).first().last_date == datetime(2025, 1, 5)
    assert {r.title for r in lake.clean().collect()} == {"t", "too late"} and lake.clean().count() == 3
    assert refine(lake).first().run == 2


def test_errors_can_be_changed(lake):
    add_rows(lake, "1", [(datetime(2025, 1, 1), GOOD | {"price": p}) for p in ("?", "!", "1 tỷ")])
    refine(lake)
    assert lake.update_errors({"retry_status": "resolved"}, {"price": "?"}) == 1
    assert lake.delete_errors({"price": "!"}) == 1
    assert [(r.price, r.retry_status) for r in lake.errors().collect()] == [("?", "resolved")]
    assert lake.update_errors({"retry_status": None}, {"price": "?"}) == 1 and lake.errors().first().retry_status is None
    add_rows(lake, "2", [(datetime(2025, 1, 2), GOOD | {"price": "#"})])
    refine(lake)
    assert sorted((r.price, r.retry_status, r.run) for r in lake.errors().collect()) == [("#", "pending", 2), ("?", None, 1)]
    assert lake.delete_errors({"price": "none"}) == 0 and lake.errors().count() == 2


def test_a_run_scans_its_loads_only(lake, spark):
    for n in range(5):
        add_rows(lake, str(n), [(datetime(2025, 1, n + 1), GOOD | {"subpage_url": f"https://x/ban-condotel-{n}"})])
        if n == 3:
            assert refine(lake, loads_per_run=3).first().run == 2 and lake.clean().count() == 4
    names = lake.unrefined(10)
    assert names == ["4"]
    rows = lake.loads(names)
    assert len(rows.inputFiles()) >= 1 and all("load=4" in f for f in rows.inputFiles())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load" in plan and re.search(r"PartitionFilters: \[[^\]]*load#\d+ = 4", plan)
    assert refine(lake).first().run == 3 and lake.clean().count() == 5


def test_a_merge_does_not_exchange_the_clean_table(lake, spark):
    add_rows(lake, "1", [(datetime(2025, 1, 1), GOOD | {"subpage_url": f"https://x/ban-condotel-{n}"}) for n in range(40)])
    refine(lake)
    add_rows(lake, "2", [(datetime(2025, 1, 2), GOOD | {"subpage_url": f"https://x/ban-condotel-{n}", "title": "new"}) for n in range(30, 50)])
    refine(lake)
    merged = upsert_aligned(lake.bucketed("clean", 1, lake.buckets), lake.bucketed("incoming", 2, lake.buckets), "subpage_url")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "FullOuter" in plan
    assert Counter(r.title for r in lake.clean().collect()) == {"t": 30, "new": 20}
    assert len(lake.clean().inputFiles()) <= lake.buckets
    # Another session finds the table without what this one knows of it.
    other = Lake(spark.newSession(), lake.root)
    other.spark.sql(f"drop table {lake._name('clean', 2)}")
    assert other.clean().count() == 50


def test_reports_are_merged_from_counts(lake):
    add_rows(lake, "1", [(datetime(2025, 1, 2), GOOD), (datetime(2025, 1, 1), GOOD | {"price": "?"})])
    add_rows(lake, "none", [])
    quality.refresh_qc(lake)
    quality.refresh_qc(lake)
    assert [(str(r.crawl_date), r.total_records, r.missing_legal) for r in quality.lake_qc_daily(lake).collect()] == [("2025-01-01", 1, 1), ("2025-01-02", 1, 1)]
    refine(lake)
    quality.refresh_errors(lake)
    lake.update_errors({"retry_status": "failed"}, {"price": "?"})
    add_rows(lake, "2", [(datetime(2025, 1, 1), GOOD | {"price": "!"}), (datetime(2024, 1, 1), GOOD | {"price": "!"})])
    refine(lake)
    quality.refresh_errors(lake)
    quality.refresh_errors(lake)
    assert quality.lake_error_daily(lake).collect() == quality.error_daily(lake.errors()).collect()
    assert [(str(r.report_date), r.total_errors, r.total_failed) for r in quality.lake_error_daily(lake).collect()] == [("2024-01-01", 1, 0), ("2025-01-01", 2, 1)]


def test_files_in_folders_are_listed_by_tasks(spark, tmp_path):
    for name in ("a_20251027_094851.csv", "x/b_20251027_094851.csv", "x/y z/c_20251027_094851.csv", "x/_hidden/d.csv", "x/.e.csv", "w/export_20251028_000000/part-0.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        write_csv(tmp_path / name, [GOOD | {"title": name}])
    found = raw_files.list_files(spark, str(tmp_path)).orderBy("file_path").collect()
    assert [r.file_path.split(str(tmp_path))[1] for r in found] == [
        "/a_20251027_094851.csv", "/w/export_20251028_000000/part-0.csv", "/x/b_20251027_094851.csv", "/x/y z/c_20251027_094851.csv",
    ]
    assert found[1].file_timestamp == datetime(2025, 10, 28)
    assert raw_files.list_files(spark, str(tmp_path / "x/_hidden")).count() == 1


def test_header_probe_reads_first_blocks(spark, tmp_path, monkeypatch):
    from homelake.sources import file_access

    write_csv(tmp_path / "a_20251027_094851.csv", [GOOD] * 5000)
    (tmp_path / "b_20251027_094851.csv").write_text("title," + ",".join(["x" * 99] * 2000) + "\nt,u\n")
    read = []

    class Counted:
        def __init__(self, stream):
            self.stream = stream

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

        def read(self, n):
            read.append(len(part := self.stream.read(n)))
            return part

    opened = file_access._opened

    class System:
        def __init__(self, system):
            self.open_input_stream = lambda path: Counted(system.open_input_stream(path))

    monkeypatch.setattr(file_access, "_opened", lambda p: (System(opened(p)[0]), opened(p)[1]))
    paths = [f"file:{tmp_path}/{n}_20251027_094851.csv" for n in "ab"]
    lines = next(file_access._lines(iter([pd.DataFrame({"path": paths})])))["line"]
    assert lines[0].startswith("\ufeffmain_page_url,") and len(lines[1]) == 200_005
    assert sum(read) <= 6 * file_access._FIRST and (tmp_path / "a_20251027_094851.csv").stat().st_size > 8 * file_access._FIRST
    assert set(raw_files.headers(spark, paths)) == {tuple(schemas.RAW_COLUMNS), ("title", *["x" * 99] * 2000)}


def test_an_unfinished_run_is_invisible_and_can_be_repeated(lake, monkeypatch):
    add_rows(lake, "1", [(datetime(2025, 1, 1), GOOD), (datetime(2025, 1, 1), GOOD | {"price": "?"})])

    def lost(row):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(lake, "commit", lost)
        with pytest.raises(RuntimeError):
            refine(lake)
    assert lake.clean().count() == 0 and lake.errors().count() == 0
    assert refine(lake).first().good_rows == 1
    assert lake.clean().count() == 1 and lake.errors().count() == 1


def test_watermark_reaches_the_scan(lake, spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    add_rows(lake, "1", [(datetime(2025, 1, 1), GOOD)])
    plan = lake.staging_after(1735689600000000).select("title", "created_at")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(created_at,2025-01-01" in plan
    assert "ReadSchema: struct<title:string,created_at:timestamp,corrupt_record:string>" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_streams(lake, raw, tmp_path):
    checkpoint, archive = str(tmp_path / "c1"), str(tmp_path / "done")
    write_csv(raw / "raw_20251027_094851.csv", [GOOD, GOOD | {"price": ""}])
    for _ in range(2):
        ingest_stream(lake, str(raw), checkpoint, archive).awaitTermination()
    write_csv(raw / "raw_20251028_094851.csv", [GOOD | {"title": "second"}])
    ingest_stream(lake, str(raw), checkpoint, archive).awaitTermination()
    assert lake.staging().count() == 3

    for _ in range(2):
        refine_stream(lake, lake.staging_stream(), str(tmp_path / "c2")).awaitTermination()
    assert [r.title for r in lake.clean().collect()] == ["second"]
    assert lake.errors().count() == 1 and lake.state().run == 1


def test_streams_do_not_overwrite_each_other(lake, raw, tmp_path):
    write_csv(raw / "raw_20251027_094851.csv", [GOOD, GOOD])
    ingest_stream(lake, str(raw), str(tmp_path / "c1")).awaitTermination()
    write_csv(raw / "raw_20251028_094851.csv", [GOOD])
    ingest_stream(lake, str(raw), str(tmp_path / "c2")).awaitTermination()  # finds both files again
    assert lake.staging().count() == 3 and lake.file_log().count() == 2
    assert ingest(lake, str(raw), "batch").first().status == "no_files"


def test_reports_without_data(spark):
    errors = spark.createDataFrame([], "created_at timestamp, retry_status string")
    totals = quality.error_totals(quality.error_daily(errors)).first()
    assert totals.total_errors == 0 and totals.resolution_rate == 0.0
    assert totals.latest_report == "N/A" and totals.latest_error_time == "N/A"
    daily = quality.qc_daily(spark.createDataFrame([], schemas.STAGING))
    assert tuple(quality.qc_totals(daily).first()) == (0, 0, 0)


def test_recent_errors_are_formatted(spark):
    rows = [(datetime(2025, 1, d % 15 + 1, 5, 6), "failed") for d in range(30)] + [(None, "pending")]
    daily = quality.error_daily(spark.createDataFrame(rows, "created_at timestamp, retry_status string"))
    shown = quality.recent_errors(daily).collect()
    assert len(shown) == 10 and shown[0]["Report Date"] == "15/01/2025" and shown[0]["Latest Error Time"] == "15/01/2025 05:06"
    assert (shown[0]["Total Errors"], shown[0]["Failed"], shown[0]["Pending"]) == (2, 2, 0)
