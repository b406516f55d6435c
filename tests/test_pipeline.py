"""Landing -> Bronze -> Silver -> Gold on tiny hand-made snapshots."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from offerlake.operators import dedup as D
from offerlake.operators import quality as Q
from offerlake.plans import gold, medallion as M
from offerlake.plans.silver import build_silver
from offerlake.schemas import LANDING_COLUMNS, SILVER_COLUMNS
from offerlake.sources import landing as L
from offerlake.sources import pages as P
from offerlake.streaming import ingest as S

AS_OF = dt.date(2025, 5, 1)


def row(**kw):
    base = {c: None for c in LANDING_COLUMNS}
    base.update(job_listing_id="id", job_title="Analyst", company_name="ACME", job_level="mid",
                contract_type="kontrakt B2B", expiration_date="10 maja 2025", job_posting_date="28 kwietnia 2025",
                ingestion_timestamp="2025-05-01 02:00:00", ingestion_date="2025-05-01", job_url="u")
    base.update(kw)
    return base


SNAPSHOT = [
    row(job_listing_id="a", job_url="ua", remuneration="20 000 - 25 000", frequency="mth",
        location="Oferta w wielu lokalizacjach", work_mode="zdalna, hybrydowa", expected_technologies="SQL, Python"),
    row(job_listing_id="b", job_url="ub", remuneration="100 - 150", frequency="godz.", location="Kraków",
        job_level="mid • senior", expected_technologies="SQL"),
    row(job_listing_id="c", job_url="uc", expiration_date="1 kwietnia 2025"),          # expired
    row(job_listing_id="d", job_url="ud", expiration_date="3 gru 2025"),                # unparsed expiry
    row(job_listing_id=None, job_url="ue", job_title=None),                              # dropped
    row(job_listing_id="f", job_url="uf", contract_type=None),                           # dropped
    row(job_listing_id="g", job_url="ug", job_title="", location="Kraków"),             # blank passes
]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in LANDING_COLUMNS) for r in rows],
                                 ", ".join(f"{c} string" for c in LANDING_COLUMNS))


def test_validation_and_drop_log(spark):
    v = Q.with_validation(frame(spark, SNAPSHOT))
    reasons = {r.job_url: r.validation_errors for r in v.select("job_url", Q.ERRORS_COL).collect()}
    assert reasons["ue"] == "Missing job_listing_id, Missing job_title, "
    assert reasons["uf"] == "Missing contract_type, "
    assert reasons["ug"] == ""
    log = Q.dropped_projection(Q.dropped_rows(v), validated_at="2025-05-01 03:00:00")
    assert log.columns == ["job_listing_id", "job_title", "company_name", "reason_dropped",
                           "ingestion_timestamp", "validation_timestamp", "validation_date"]
    assert log.count() == 2


def test_silver_rows_and_order(spark):
    silver = build_silver(frame(spark, SNAPSHOT), as_of=AS_OF)
    assert silver.columns == SILVER_COLUMNS
    got = {r.job_listing_id: r for r in silver.collect()}
    assert set(got) == {"a", "b", "g"}
    a, b = got["a"], got["b"]
    assert (a.days_left, a.days_since_posted) == (9, 3)
    assert (a.min_salary, a.max_salary, a.min_salary_mth, a.max_salary_mth, a.min_salary_hr) == (20000, 25000, 20000, 25000, None)
    assert (b.frequency, b.min_salary_hr, b.max_salary_hr, b.min_salary_mth) == ("hourly", 100, 150, None)
    assert a.location == "Multiple locations" and a.work_mode == "remote, hybrid"
    assert a.contract_type == "B2B contract" and b.job_level == "mid , senior"


def test_reference_frequency_order_option(spark):
    silver = build_silver(frame(spark, SNAPSHOT), as_of=AS_OF, translate_frequency_first=False)
    a = [r for r in silver.collect() if r.job_listing_id == "a"][0]
    assert a.min_salary_mth is None and a.frequency == "monthly"


def test_stage_counts_and_reconcile(spark):
    from offerlake.functions import cleaning as C
    v = Q.with_validation(frame(spark, SNAPSHOT))
    counts = Q.stage_counts(v, C.days_left(C.to_listing_date("expiration_date"), AS_OF))
    c = counts.first().asDict()
    assert c == {"bronze": 7, "valid": 5, "dropped": 2, "before_filter": 5, "after_filter": 3, "unparsed_expiry": 1}
    fixed = Q.reconcile(counts, count_expired=True).first()
    ref = Q.reconcile(counts, count_expired=False).first()
    assert (fixed.status, fixed.difference) == ("PASSED", 0)
    assert (ref.status, ref.difference, ref.expected) == ("WARNING", 2, 5)
    assert Q.run_summary(counts).first().asDict() == {"processed": 7, "dropped": 2, "filtered": 2, "loaded": 3}


def test_profile_and_layer_counts(spark):
    df = frame(spark, SNAPSHOT)
    prof = {r.column_name: (r.null_count, r.row_count) for r in Q.profile_nulls(df).collect()}
    assert prof["job_title"] == (1, 7) and prof["address_1"] == (7, 7)
    lc = {r.layer: r.row_count for r in Q.layer_counts({"bronze": df, "silver": build_silver(df, AS_OF)}).collect()}
    assert lc == {"bronze": 7, "silver": 3}


def test_gold_views_small(spark):
    silver = build_silver(frame(spark, SNAPSHOT), as_of=AS_OF)
    views = gold.gold_views(silver, AS_OF)
    ov = views["v_job_market_overview"].first()
    assert (ov.total_active_listings, ov.listings_with_salary, ov.salary_coverage_pct) == (3, 2, 66.67)
    tech = views["v_top_technologies"].collect()
    assert tech == []  # no technology has more than 5 listings
    assert [r.expiry_status for r in views["v_jobs_expiring_soon"].collect()] == []
    dash = {r.metric: r.value for r in gold.gold_dashboard(silver).collect()}
    assert dash["Total Active Listings"] == "3" and dash["Top Technology"] is None
    assert dash["Top Location"] == "Kraków"


def test_dedup_keeps_newest_and_null_ids(spark):
    rows = [row(job_listing_id="a", job_url="u1", ingestion_timestamp="2025-01-01 00:00:00", job_title="old"),
            row(job_listing_id="a", job_url="u1", ingestion_timestamp="2025-01-02 00:00:00", job_title="new"),
            row(job_listing_id=None, job_url="n1"), row(job_listing_id=None, job_url="n2"),
            row(job_listing_id=None, job_url="n2")]
    df = frame(spark, rows).withColumn("source_file", F.lit("f"))
    out = D.dedup_latest(df).collect()
    assert len(out) == 4
    assert sorted(r.job_url for r in out if r.job_listing_id is None) == ["n1", "n2", "n2"]
    assert [r.job_title for r in out if r.job_listing_id == "a"] == ["new"]


def test_csv_roundtrip_and_latest_snapshot(spark, scratch_dir):
    tricky = [row(job_listing_id="m", job_url="um", requirements='line one\nline "two", quoted',
                  job_title="  padded  ", address_1="")]
    df = frame(spark, tricky + SNAPSHOT[:2])
    landing = os.path.join(scratch_dir, "landing")
    old = L.write_csv_snapshot(df.withColumn("job_title", F.lit("old")), landing, dt.datetime(2025, 4, 30, 2))
    new = L.write_csv_snapshot(df, landing, dt.datetime(2025, 5, 1, 2), files=2)
    assert old and new
    # an impossible timestamp and an unmatched name rank below any real timestamp
    L.write_csv_snapshot(df, landing, dt.datetime(2025, 5, 1, 2), prefix="notes")
    os.makedirs(os.path.join(landing, "x"), exist_ok=True)
    with open(os.path.join(landing, "x", "the_it_protocol_jobs_20251399_999999.csv"), "w") as fh:
        fh.write("job_title\nbad\n")
    assert L.latest_snapshot(spark, landing).endswith("the_it_protocol_jobs_20250501_020000.csv")
    back = {r.job_url: r for r in L.read_landing_csv(spark, new).collect()}
    assert back["um"].requirements == 'line one\nline "two", quoted'
    assert back["um"].job_title == "  padded  "
    assert back["um"].address_1 is None  # '' reads back as NULL
    assert L.write_csv_snapshot(df.limit(0), landing, dt.datetime(2026, 1, 1)) is None


def test_by_name_csv_scan(spark, scratch_dir):
    path = os.path.join(scratch_dir, "nineteen.csv")
    cols = [c for c in LANDING_COLUMNS if c != "job_posting_date"][::-1] + ["extra"]
    with open(path, "w") as fh:
        fh.write(",".join(cols) + "\n")
        fh.write(",".join(("Analyst" if c == "job_title" else "x" if c == "extra" else "") for c in cols) + "\n")
    r = L.read_landing_csv(spark, path).first()
    assert r.job_title == "Analyst" and r.job_posting_date is None and "extra" not in r.asDict()


def test_no_csv_raises(spark, scratch_dir):
    os.makedirs(os.path.join(scratch_dir, "empty"), exist_ok=True)
    with open(os.path.join(scratch_dir, "empty", "readme.txt"), "w") as fh:
        fh.write("x")
    with pytest.raises(ValueError):
        L.latest_snapshot(spark, os.path.join(scratch_dir, "empty"))


def test_tables_run_and_upsert(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    L.write_csv_snapshot(frame(spark, SNAPSHOT), landing, dt.datetime(2025, 5, 1, 2))
    t = M.Tables(database="offerlake_test")
    counts = M.run_all(spark, landing, t, as_of=AS_OF, loaded_at="2025-05-01 03:00:00")
    # through CSV the blank title '' of row g reads back as NULL, so g is dropped as well
    assert (counts["bronze"], counts["dropped"], counts["after_filter"], counts["status"]) == (7, 3, 2, "PASSED")
    assert spark.table(t.name(t.silver)).columns == SILVER_COLUMNS
    assert spark.table(t.name(t.drop_log)).count() == 3
    assert "v_jobs_by_location" in M.list_views(spark)
    assert spark.sql("SELECT * FROM v_jobs_by_location").count() >= 1
    incoming = M.bronze_metadata(frame(spark, [row(job_listing_id="a", job_url="ua",
                                                   ingestion_timestamp="2025-05-02 02:00:00", job_title="re"),
                                               row(job_listing_id="z", job_url="uz")]),
                                 source_file="new.csv", loaded_at="2025-05-02 03:00:00")
    M.upsert_bronze(spark, incoming, t)
    b = spark.table(t.name(t.bronze))
    assert b.count() == 8
    assert [r.job_title for r in b.filter("job_listing_id = 'a'").collect()] == ["re"]


def test_persistent_views_follow_silver(spark, scratch_dir):
    """The SQL views equal the DataFrame views, for another session and after refreshes."""
    rows = [row(job_listing_id=f"id{i % 9}", job_url=f"u{i}", company_name=f"firm {i % 3}",
                expected_technologies="SQL, Spark,,SQL" if i % 2 else "SQL") for i in range(24)]
    t = M.Tables(database="offerlake_views", location=os.path.join(scratch_dir, "db"))
    M.write_bronze(spark, M.bronze_metadata(frame(spark, SNAPSHOT + rows), source_file="a.csv",
                                            loaded_at="2025-05-01 03:00:00"), t)
    M.load_silver(spark, t, AS_OF)
    M.create_views(spark, t, AS_OF)
    other = spark.newSession()
    for _ in range(2):
        silver = spark.table(t.name(t.silver))
        want = gold.gold_views(silver, AS_OF) | {"gold_dashboard": gold.gold_dashboard(silver)}
        assert set(want) <= set(M.list_views(other, "*", t.database))
        for name, df in want.items():
            got = other.table(t.name(name))
            assert got.columns == df.columns, name
            assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name
        assert other.table(t.name("v_top_technologies")).count() == 3  # '', SQL, Spark
        for _ in range(3):  # more refreshes than versions kept
            M.load_silver(spark, t, AS_OF)


def test_streaming_ingest_is_incremental(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    L.write_csv_snapshot(frame(spark, SNAPSHOT), landing, dt.datetime(2025, 5, 1, 2))
    bronze_path = os.path.join(scratch_dir, "bronze")
    ckpt = os.path.join(scratch_dir, "ckpt")
    glob = f"{landing}/*.csv/*.csv"  # a glob works as well as the directory itself
    S.file_arrival_ingest(spark, glob, ckpt, S.bronze_batch_writer(bronze_path))
    assert spark.read.parquet(bronze_path).count() == 7
    S.file_arrival_ingest(spark, glob, ckpt, S.bronze_batch_writer(bronze_path))   # nothing new
    assert spark.read.parquet(bronze_path).count() == 7
    L.write_csv_snapshot(frame(spark, SNAPSHOT[:2]), landing, dt.datetime(2025, 5, 2, 2))
    S.file_arrival_ingest(spark, glob, ckpt, S.bronze_batch_writer(bronze_path))
    assert spark.read.parquet(bronze_path).count() == 9


def test_file_arrival_runs_the_medallion(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    glob = landing  # the directory: every *.csv below it
    ckpt = os.path.join(scratch_dir, "ckpt")
    t = M.Tables(database="offerlake_stream_test", location=os.path.join(scratch_dir, "db"))
    runner = S.medallion_batch_runner(t, landing, as_of=AS_OF, loaded_at="2025-05-01 03:00:00")
    L.write_csv_snapshot(frame(spark, SNAPSHOT[:2]), landing, dt.datetime(2025, 4, 30, 2))
    L.write_csv_snapshot(frame(spark, SNAPSHOT), landing, dt.datetime(2025, 5, 1, 2))
    S.file_arrival_ingest(spark, glob, ckpt, runner)
    assert spark.table(t.name(t.bronze)).count() == 7          # newest snapshot only
    assert spark.table(t.name(t.silver)).count() == 2
    # a late, older file does not replace the newer snapshot
    L.write_csv_snapshot(frame(spark, SNAPSHOT[:1]), landing, dt.datetime(2025, 4, 1, 2))
    S.file_arrival_ingest(spark, glob, ckpt, runner)
    spark.catalog.refreshTable(t.name(t.bronze))  # tables were rewritten by the stream's session
    assert spark.table(t.name(t.bronze)).count() == 7
    # a newer one does
    L.write_csv_snapshot(frame(spark, SNAPSHOT[:3]), landing, dt.datetime(2025, 5, 2, 2))
    S.file_arrival_ingest(spark, glob, ckpt, runner)
    spark.catalog.refreshTable(t.name(t.bronze))
    spark.catalog.refreshTable(t.name(t.silver))
    assert spark.table(t.name(t.bronze)).count() == 3
    silver_ids = {r.job_listing_id for r in spark.table(t.name(t.silver)).collect()}
    assert silver_ids == {"a", "b"}
    assert "v_job_market_overview" in M.list_views(spark, database="global_temp")
    overview = spark.sql("SELECT * FROM global_temp.v_job_market_overview").first()
    assert overview.total_active_listings == len(silver_ids)
    locations = {r.location for r in spark.sql("SELECT location FROM global_temp.v_jobs_by_location").collect()}
    assert locations == {"Multiple locations", "Kraków"}


def test_drop_log_run_id_is_idempotent(spark, scratch_dir):
    t = M.Tables(database="offerlake_droplog_test", location=os.path.join(scratch_dir, "db"))
    M.write_bronze(spark, M.bronze_metadata(frame(spark, SNAPSHOT), source_file="s.csv",
                                            loaded_at="2025-05-01 03:00:00"), t)
    for _ in range(2):
        M.load_silver(spark, t, as_of=AS_OF, validated_at="2025-05-01 03:00:00", run_id="r1")
    assert spark.table(t.name(t.drop_log)).count() == 2
    M.load_silver(spark, t, as_of=AS_OF, validated_at="2025-05-01 03:00:00", run_id="r2")
    assert spark.table(t.name(t.drop_log)).count() == 4


def test_drop_log_without_run_id_appends_and_foreign_log_is_refused(spark, scratch_dir):
    t = M.Tables(database="offerlake_droplog_plain", location=os.path.join(scratch_dir, "db"))
    M.write_bronze(spark, M.bronze_metadata(frame(spark, SNAPSHOT), source_file="s.csv",
                                            loaded_at="2025-05-01 03:00:00"), t)
    for run in (None, None, "r", "r"):
        M.load_silver(spark, t, as_of=AS_OF, validated_at="2025-05-01 03:00:00", run_id=run)
    assert spark.table(t.name(t.drop_log)).count() == 6
    other = M.Tables(database=t.database, drop_log="plain_log")
    spark.createDataFrame([("x",)], "reason string").write.saveAsTable(other.name(other.drop_log))
    with pytest.raises(ValueError):
        M.load_silver(spark, other, as_of=AS_OF, run_id="r")
    assert spark.table(other.name(other.drop_log)).count() == 1


def test_unstamped_and_nested_units_load_whole(spark, scratch_dir):
    parent = os.path.join(scratch_dir, "the_it_protocol_jobs_20300101_000000")  # a stamped parent is no snapshot
    df = frame(spark, SNAPSHOT).repartition(4)
    df.select(*[F.col(c).cast("string") for c in LANDING_COLUMNS]).write.options(**L.CSV_WRITE_OPTIONS).csv(
        f"{parent}/manual_export.csv")
    assert L.latest_snapshot(spark, parent).endswith("manual_export.csv")
    assert L.read_latest_snapshot(spark, parent).count() == len(SNAPSHOT)
    L.write_csv_snapshot(df.limit(2), parent, dt.datetime(2025, 5, 1, 2))
    assert L.read_latest_snapshot(spark, parent).count() == 2
    L.write_csv_snapshot(df.limit(1), parent, dt.datetime(2025, 6, 1, 2))
    os.makedirs(os.path.join(parent, "the_it_protocol_jobs_20250601_020000.csv", "_temporary"))
    assert L.read_latest_snapshot(spark, parent).count() == 2  # still being written


def test_stream_loads_whole_units_and_repeats_failed_runs(spark, scratch_dir, monkeypatch):
    landing, ckpt = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "ckpt")
    t = M.Tables(database="offerlake_stream_units", location=os.path.join(scratch_dir, "db"))
    runner = S.medallion_batch_runner(t, landing, as_of=AS_OF, loaded_at="2025-05-01 03:00:00")
    L.write_csv_snapshot(frame(spark, SNAPSHOT), landing, dt.datetime(2025, 5, 1, 2), files=4)
    whole = M.load_silver

    def broken(*a, **k):
        raise RuntimeError("lost")
    monkeypatch.setattr(M, "load_silver", broken)
    with pytest.raises(Exception, match="lost"):
        S.file_arrival_ingest(spark, landing, ckpt, runner, max_files_per_trigger=1)
    monkeypatch.setattr(M, "load_silver", whole)
    S.file_arrival_ingest(spark, landing, ckpt, runner, max_files_per_trigger=1)
    assert spark.table(t.name(t.bronze)).count() == len(SNAPSHOT)
    assert spark.table(t.name(t.silver)).count() == 2
    assert spark.table(t.name(t.completed)).count() == 1
    late = L.write_csv_snapshot(frame(spark, SNAPSHOT[:1]), landing, dt.datetime(2024, 5, 1, 2))
    S.file_arrival_ingest(spark, landing, ckpt, runner)
    assert late and spark.table(t.name(t.bronze)).count() == len(SNAPSHOT)


def test_republished_unit_is_loaded_again(spark, scratch_dir):
    landing, ckpt = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "ckpt")
    t = M.Tables(database="offerlake_stream_again", location=os.path.join(scratch_dir, "db"))
    runner = S.medallion_batch_runner(t, landing, as_of=AS_OF, loaded_at="2025-05-01 03:00:00")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {t.database}")
    spark.createDataFrame([("old", None, 1)], "unit string, snapshot_ts timestamp, files bigint").write.saveAsTable(
        t.name(t.completed))  # a mark of the earlier layout
    for rows in (SNAPSHOT, SNAPSHOT[:3], SNAPSHOT[:2]):
        L.write_csv_snapshot(frame(spark, rows), landing, dt.datetime(2025, 5, 1, 2), files=1)
        S.file_arrival_ingest(spark, landing, ckpt, runner)
        spark.catalog.refreshTable(t.name(t.bronze))
        assert spark.table(t.name(t.bronze)).count() == len(rows)
    assert spark.table(t.name(t.completed)).count() == 4


def test_refresh_keeps_the_name_and_a_failed_one_changes_nothing(spark, scratch_dir):
    t = M.Tables(database="offerlake_versions", location=os.path.join(scratch_dir, "db"))
    rows = M.bronze_metadata(frame(spark, SNAPSHOT), source_file="s.csv", loaded_at="2025-05-01 03:00:00")
    M.write_bronze(spark, rows, t)
    with pytest.raises(Exception):
        M.replace_table(spark, rows.withColumn("x", F.raise_error(F.lit("lost"))), t.name(t.bronze))
    assert spark.table(t.name(t.bronze)).count() == len(SNAPSHOT)
    M.write_bronze(spark, rows.limit(3), t)
    assert spark.table(t.name(t.bronze)).count() == 3 and spark.newSession().table(t.name(t.bronze)).count() == 3


def test_repeated_detail_pages_do_not_multiply_cards(spark):
    cards = spark.createDataFrame([("i1", "u1", "t", "c", "l", "w"), ("i2", None, "t", "c", "l", "w")],
                                  "job_listing_id string, job_url string, job_title string, company_name string, "
                                  "location string, work_mode string")
    html = '<span data-test="content-positionLevels">{}</span>'
    pages = spark.createDataFrame([("u1", html.format("mid")), ("u1", html.format("senior")), (None, "")],
                                  "job_url string, html string")
    out = P.assemble_listings(cards, P.detail_fields(pages), "2025-01-01 00:00:00", "2025-01-01").collect()
    assert sorted((r.job_listing_id, r.job_level) for r in out if r.job_url) == [("i1", "senior")]
    assert [r.job_listing_id for r in out if not r.job_url] == ["i2"]


def test_validation_predicates_reach_the_scan(spark, scratch_dir):
    path = os.path.join(scratch_dir, "bronze")
    frame(spark, SNAPSHOT).write.parquet(path)
    plan = Q.valid_rows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert all(f"IsNotNull({c})" in pushed for c in ("job_title", "company_name"))


def test_salary_percentiles_are_not_kept_per_listing(spark):
    silver = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "job_listing_id string, min_salary int, max_salary int")
    plan = gold.v_salary_insights(silver)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" in plan
    assert not any("job_listing_id" in line and "percentile" in line for line in plan.splitlines())
