"""Numbered table versions (clock, two writers, crash, sweep, schemas), bucketed upserts, the
one-scan Silver job, sinks and files of mixed headers, sketches and persistent functions."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from offerlake.functions import cleaning as C
from offerlake.functions.register import create_sql_functions
from offerlake.operators import dedup as D
from offerlake.operators import html_extract as X
from offerlake.operators import sketches as K
from offerlake.plans import medallion as M
from offerlake.plans import versions as V
from offerlake.schemas import LANDING_COLUMNS, RECORD_SCHEMA
from offerlake.session import ship_package
from offerlake.sources import landing as L
from offerlake.sources import pages as P
from offerlake.streaming import ingest as S

AS_OF = dt.date(2025, 5, 1)


@pytest.fixture()
def t(spark, scratch_dir):
    tables = M.Tables(database="offerlake_" + os.path.basename(scratch_dir).replace("-", "_"),
                      location=os.path.join(scratch_dir, "db"), bronze_buckets=8)
    M.ensure_schema(spark, tables.database, tables.location)
    yield tables
    spark.catalog.setCurrentDatabase("default")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def folders(spark, target):
    return {p.rsplit("/", 1)[-1] for p in L.subfolders(spark, f"{V.versions_root(spark, target)}/data")}


def held(spark, target):
    return sorted(r.v for r in spark.table(target).collect())


def listing(i, **kw):
    base = dict(job_listing_id=f"id{i}", job_title="Engineer", expiration_date="1 June 2025", job_posting_date="1 April 2025",
                company_name="Firm", location="Town", job_level="mid", contract_type="b2b", job_url=f"u{i}",
                ingestion_timestamp="2025-05-01 02:00:00")
    return tuple({**dict.fromkeys(LANDING_COLUMNS), **base, **kw}[c] for c in LANDING_COLUMNS)


def bronze(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in LANDING_COLUMNS))
    return M.bronze_metadata(df, source_file="s.csv", loaded_at="2025-05-01 03:00:00")


# --- versions -------------------------------------------------------------------------------

def test_numbers_do_not_depend_on_a_clock(spark, t, monkeypatch):
    target = t.name("numbers")
    for i, clock in enumerate((2e9, 1e9, 0)):  # every writer's clock is behind the last one's
        monkeypatch.setattr(time, "time", lambda c=clock: c)
        assert V.replace(spark, numbers(spark, i), target).number == i + 1
        assert held(spark, target) == [i]
    assert len(folders(spark, target)) == V.KEEP


def test_the_second_of_two_writers_is_refused(spark, t):
    target = t.name("numbers")
    V.replace(spark, numbers(spark, 1), target)
    base = V.current(spark, target)
    slow_folder = []

    def slow(folder):
        numbers(spark, 2).write.parquet(folder)
        slow_folder.append(folder.rsplit("/", 1)[-1])
        for i in (3, 4, 5):  # another writer publishes, and sweeps, three times meanwhile
            V.replace(spark, numbers(spark, i), target)
            assert slow_folder[0] in folders(spark, target)
        return V.Version(0, "parquet", numbers(spark, 2).schema.json(), (V.Part(folder, ("v",)),))
    with pytest.raises(V.ConcurrentWrite):
        V.publish(spark, target, slow, base)
    assert held(spark, target) == [5] and slow_folder[0] not in folders(spark, target)
    assert V.current(spark, target).number == 4
    V.replace(spark, numbers(spark, 6), target)
    assert held(spark, target) == [6]


def test_a_crash_between_record_and_name(spark, t, monkeypatch):
    target = t.name("numbers")
    V.replace(spark, numbers(spark, 1), target)
    point = V.point

    def dies(*a):
        raise KeyboardInterrupt
    monkeypatch.setattr(V, "point", dies)
    with pytest.raises(KeyboardInterrupt):
        V.replace(spark, numbers(spark, 2), target)
    assert held(spark, target) == [1] and V.current(spark, target).number == 2
    monkeypatch.setattr(V, "point", point)
    V.sweep(spark, target, keep=1)
    assert held(spark, target) == [1]  # what the name shows is never swept
    V.point(spark, target)
    assert held(spark, target) == [2]
    abandoned = f"{V.versions_root(spark, target)}/writers"
    assert len(L.subfolders(spark, abandoned)) == 1
    V.clear_abandoned(spark, target)
    assert not L.subfolders(spark, abandoned)


def test_a_failed_write_leaves_nothing(spark, t):
    target = t.name("numbers")
    V.replace(spark, numbers(spark, 1), target)
    before = folders(spark, target)
    with pytest.raises(Exception, match="lost"):
        V.replace(spark, numbers(spark, 2).withColumn("v", F.raise_error(F.lit("lost")).cast("int")), target)
    assert folders(spark, target) == before and held(spark, target) == [1]
    assert not L.subfolders(spark, f"{V.versions_root(spark, target)}/writers")


def test_schemas_merge_and_widen(spark, t):
    target = t.name("numbers")
    V.replace(spark, spark.createDataFrame([(1, 1.5, "x")], "v int, f float, gone string"), target)
    V.replace(spark, spark.createDataFrame([(2 ** 40, 2.5, "n")], "v bigint, f double, added string"), target, merge_schema=True)
    assert spark.table(target).dtypes == [("v", "bigint"), ("f", "double"), ("gone", "string"), ("added", "string")]
    assert [tuple(r) for r in spark.table(target).collect()] == [(2 ** 40, 2.5, None, "n")]
    assert [tuple(r) for r in V.read_version(spark, target, 1).collect()] == [(1, 1.5, "x", None)]
    V.replace(spark, numbers(spark, 7), target, merge_schema=True)  # a narrower type stays wide
    assert spark.table(target).dtypes[0] == ("v", "bigint") and [r.v for r in spark.table(target).collect()] == [7]
    with pytest.raises(ValueError, match="do not merge"):
        V.replace(spark, spark.createDataFrame([("x",)], "v string"), target, merge_schema=True)


# --- bucketed upserts -----------------------------------------------------------------------

def test_upsert_rewrites_only_the_buckets_it_touches(spark, t):
    target = t.name(t.bronze)
    first = bronze(spark, [listing(i) for i in range(60)] + [listing(0, job_listing_id=None, job_url="n0")])
    M.write_bronze(spark, first, t)
    M.upsert_bronze(spark, first.limit(0), t)  # a table without buckets gets them
    whole = V.current(spark, target)
    assert whole.buckets == 8 and len(whole.parts) == 1
    change = bronze(spark, [listing(3, job_title="Changed", ingestion_timestamp="2025-05-02 02:00:00"),
                            listing(1, job_listing_id=None, job_url="n1")])
    M.upsert_bronze(spark, change, t)
    old, new = V.current(spark, target).parts
    files = {f.rsplit(V.BUCKET + "=", 1)[1].split("/")[0] for f in spark.read.parquet(new.path).inputFiles()}
    bucket = str(change.where("job_listing_id = 'id3'").select(V._bucket_of("job_listing_id", 8)).first()[0])
    assert files == {bucket, "-1"} and old.path == whole.parts[0].path and bucket not in old.where.replace("(", " ").replace(")", "").split()
    rows = spark.table(target)
    assert rows.count() == 62 and rows.where("job_listing_id IS NULL").count() == 2
    assert [r.job_title for r in rows.where("job_listing_id = 'id3'").collect()] == ["Changed"]
    want = D.dedup_latest(first.unionByName(change))
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.select(rows.columns).collect()))
    # folders stay few: beyond MAX_PARTS all buckets are written into one again
    V.MAX_PARTS, limit = 3, V.MAX_PARTS
    try:
        for i in range(3):
            M.upsert_bronze(spark, bronze(spark, [listing(100 + i)]), t)
    finally:
        V.MAX_PARTS = limit
    assert len(V.current(spark, target).parts) <= 3 and spark.table(target).count() == 65


def test_upsert_into_nothing_and_of_nothing(spark, t):
    empty = bronze(spark, [listing(1)]).limit(0)
    M.upsert_bronze(spark, empty, t)
    assert spark.table(t.name(t.bronze)).count() == 0
    M.upsert_bronze(spark, bronze(spark, [listing(1), listing(1, ingestion_timestamp="2025-06-01 00:00:00", job_title="New")]), t)
    assert [r.job_title for r in spark.table(t.name(t.bronze)).collect()] == ["New"]


# --- Silver and the drop log ------------------------------------------------------------------

def test_silver_reads_bronze_once_and_counts(spark, t, monkeypatch):
    rows = [listing(i) for i in range(5)] + [listing(9, job_title=None), listing(8, expiration_date="1 May 2020"),
                                             listing(7, expiration_date="soon")]
    M.write_bronze(spark, bronze(spark, rows), t)
    reads = []
    table = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, name: (reads.append(name), table(self, name))[1])
    counts = M.load_silver(spark, t, AS_OF, run_id="r")
    assert reads.count(t.name(t.bronze)) == 1
    assert {k: counts[k] for k in ("bronze", "valid", "dropped", "before_filter", "after_filter", "unparsed_expiry")} == {
        "bronze": 8, "valid": 7, "dropped": 1, "before_filter": 7, "after_filter": 5, "unparsed_expiry": 1}
    assert counts["status"] == "PASSED" and spark.table(t.name(t.silver)).count() == 5
    assert [r.reason_dropped for r in spark.table(t.name(t.drop_log)).collect()] == ["Missing job_title, "]


def test_a_clean_rerun_leaves_no_stale_drop_log(spark, t):
    def load(run, rows):
        M.write_bronze(spark, bronze(spark, rows), t)
        M.load_silver(spark, t, AS_OF, run_id=run)
    load("a'b", [listing(1), listing(2, company_name=None)])
    load("other", [listing(3, job_level=None)])
    load("a'b", [listing(1), listing(2)])
    assert [(r.run_id, r.reason_dropped) for r in spark.table(t.name(t.drop_log)).collect()] == [("other", "Missing job_level, ")]
    load("other", [listing(3, job_title=None, expiration_date="1 May 2020")])  # no active row at all
    assert [r.reason_dropped for r in spark.table(t.name(t.drop_log)).collect()] == ["Missing job_title, "]
    assert spark.table(t.name(t.silver)).count() == 0


# --- sinks, headers ------------------------------------------------------------------------------

def test_an_empty_run_leaves_the_published_snapshot(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    rows = spark.createDataFrame([listing(1)], ", ".join(f"{c} string" for c in LANDING_COLUMNS))
    run = dt.datetime(2025, 5, 1, 2)
    path = L.write_csv_snapshot(rows, landing, run)
    assert L.write_csv_snapshot(rows.limit(0), landing, run) is None
    with pytest.raises(Exception, match="lost"):
        L.write_csv_snapshot(rows.withColumn("job_title", F.raise_error(F.lit("lost"))), landing, run)
    assert L.read_landing_csv(spark, path).count() == 1
    assert os.listdir(landing) == [os.path.basename(path)]


def test_json_keeps_arrays_nulls_and_columns(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    record = dict.fromkeys(LANDING_COLUMNS) | {"job_url": "u", "expected_technologies": ["C#", "a, b"], "requirements": []}
    rows = spark.createDataFrame([tuple(record[c] for c in LANDING_COLUMNS)], RECORD_SCHEMA)
    path = L.write_json_snapshot(rows, landing, dt.datetime(2025, 5, 1, 2))
    L.write_json_snapshot(rows, landing, dt.datetime(2024, 5, 1, 2))
    assert L.latest_snapshot(spark, landing, suffix="json") == path or L.latest_snapshot(spark, landing, suffix="json").endswith(path)
    with pytest.raises(ValueError):
        L.latest_snapshot(spark, landing)  # no CSV there
    back = L.read_landing_json(spark, path).drop("source_file").collect()
    assert back == rows.collect()
    text = spark.read.text(path).first().value
    assert all(f'"{c}"' in text for c in LANDING_COLUMNS)


def test_files_of_any_header_in_one_stream(spark, scratch_dir):
    ship_package(spark)
    landing = os.path.join(scratch_dir, "landing")
    os.makedirs(os.path.join(landing, "deep"))

    def put(name, header, *rows):
        with open(os.path.join(landing, name), "w", encoding="utf-8") as fh:
            fh.write("\n".join([header, *rows]) + "\n")
    put("a.csv", ",".join(LANDING_COLUMNS), *[",".join(f"{c}{i}" for c in LANDING_COLUMNS) for i in range(3)])
    put("b.csv", ",".join(c for c in LANDING_COLUMNS if c != "job_posting_date"),
        ",".join("" if c == "location" else c for c in LANDING_COLUMNS if c != "job_posting_date"))
    put("deep/c.csv", "\ufeff" + ",".join(["job_url", "extra", "job_title", "job_title"]), 'u1,x,"two\nlines, ""quoted""",second', "u2,y")
    put("only_header.csv", ",".join(LANDING_COLUMNS))
    put("none.csv", "other,columns", "1,2")
    open(os.path.join(landing, "empty.csv"), "w").close()
    out, ckpt = os.path.join(scratch_dir, "bronze"), os.path.join(scratch_dir, "ckpt")
    S.file_arrival_ingest(spark, landing, ckpt, S.bronze_batch_writer(out))
    rows = {r.job_url: r for r in spark.read.parquet(out).collect()}
    assert len(rows) == 7 and spark.read.parquet(out).select("batch_id").distinct().count() == 1
    assert rows["job_url0"].job_posting_date == "job_posting_date0" and rows["job_url2"].job_level == "job_level2"
    assert rows["job_url"].job_posting_date is None and rows["job_url"].location is None and rows["job_url"].job_title == "job_title"
    assert rows["u1"].job_title == 'two\nlines, "quoted"' and rows["u2"].job_title is None
    assert rows["u1"].source_file.endswith("deep/c.csv") and rows[None].job_title is None
    batch = L.read_mixed_csv(spark, landing)
    assert batch.count() == 7 and batch.columns == [*LANDING_COLUMNS, "source_file"]
    put("wide.csv", ",".join(f"x{i}" for i in range(70)) + ",job_title", ",".join("1" * 71))
    with pytest.raises(Exception, match="more than 64 columns"):
        L.read_mixed_csv(spark, landing).collect()


# --- pages ------------------------------------------------------------------------------------------

def test_pages_are_parsed_once_and_in_parallel(spark):
    pages = spark.range(4000).select(F.concat(F.lit("u"), "id").alias("job_url"),
                                     F.lit("<p>x</p>").alias("html")).coalesce(1)
    details = P.detail_fields(pages)
    assert details.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    cards = spark.createDataFrame([("<a></a>",)], "html string")
    joined = P.assemble_listings(P.listing_cards(cards), details, "t", "d")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 2  # list pages once, detail pages once


def test_a_wide_scan_of_pages_is_not_shuffled(spark, scratch_dir, monkeypatch):
    path = os.path.join(scratch_dir, "pages")
    spark.range(500).select("id", F.repeat(F.lit("<p>x</p>"), 50).alias("html")).write.parquet(path)
    pages = spark.read.parquet(path)
    assert X.spread_for_parsing(pages).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(X, "SCAN_BYTES_PER_CORE", 1)
    assert X.spread_for_parsing(pages) is pages
    grouped = pages.groupBy("id").agg(F.max("html").alias("html"))
    assert "RebalancePartitions" in X.spread_for_parsing(grouped)._jdf.queryExecution().optimizedPlan().toString()


def test_cards_without_a_url_keep_their_rows_and_keys(spark):
    cards = spark.createDataFrame([(f"i{i}", None, "t", "c", "l", "w") for i in range(5)] + [("k", "u1", "t", "c", "l", "w")],
                                  "job_listing_id string, job_url string, job_title string, company_name string, location string, work_mode string")
    pages = spark.createDataFrame([("u1", '<span data-test="content-positionLevels">mid</span>'), (None, "x")], "job_url string, html string")
    out = P.assemble_records(cards, P.detail_fields(pages), "t", "d").collect()
    assert sorted(r.job_listing_id for r in out) == ["i0", "i1", "i2", "i3", "i4", "k"]
    assert {r.job_level for r in out if r.job_url is None} == {None} and [r.job_level for r in out if r.job_url] == ["mid"]
    assert all(r.requirements == [] for r in out)


# --- sketches, functions, dates -----------------------------------------------------------------------

def test_sketches_merge_and_keep_their_error(spark, t):
    values = spark.range(30_000).select((F.col("id") % 3).alias("part"), F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("g"),
                                        F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(9_999))).alias("pay"))
    for part in (0, 1, 2, 2):
        M.store_sketches(spark, t, str(part), values.where(F.col("part") == part), ["g"], "pay")
    stored = spark.table(t.name(t.sketches))
    assert stored.count() == 6 and stored.agg(F.max(F.length("sketch"))).first()[0] < 60_000
    merged = K.merged_sketches(stored, ["g"])
    assert {r.g: r.n for r in merged.collect()} == {r.g: r.n for r in values.groupBy("g").agg(F.count("pay").alias("n")).collect()}
    checked = K.within_error(K.quantiles(merged, ["g"], (0.0, 0.1, 0.5, 0.9, 1.0)), values, ["g"], "pay", K.rank_error())
    assert [r.ok for r in checked.collect()] == [True] * 10
    off = K.within_error(K.quantiles(merged, ["g"]).withColumn("rank", F.col("rank") - 0.1), values, ["g"], "pay", K.rank_error())
    assert [r.ok for r in off.collect()] == [False] * 6


def test_functions_are_called_from_another_session(spark, t):
    names = create_sql_functions(spark, t.database)
    other = spark.newSession()
    assert other.sql(f"SELECT {t.database}.convert_date('7 grudnia 2025')").first()[0] == "2025-12-07"
    assert other.sql(f"SELECT {t.database}.expiry_bucket(0)").first()[0] == "Expires Today"
    assert len(names) == 10


def test_dates_are_matched_once(spark):
    df = spark.createDataFrame([("7 May 2025",), ("x",), ("",), (None,), ("7\x1fMay\x1f2025",), ("7 May 2025 x",)], "s string")
    assert [r[0] for r in df.select(C.convert_date("s")).collect()] == ["2025-05-07", None, None, None, "2025-05-07", None]
    plan = df.select(C.convert_date("s").alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan
