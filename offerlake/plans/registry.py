"""Named queries over the driver's tables: each ``fn(spark, sf_dir) -> DataFrame``.

Every query derives listings from the order tables (so its work grows with them) and
runs one operator or view of the engine on the whole derived data.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions import cleaning as C
from ..functions.ids import listing_id
from ..functions.register import create_sql_functions
from ..operators import dedup as D
from ..operators import quality as Q
from ..operators import sketches as K
from ..schemas import LANDING_COLUMNS, LIST_COLUMNS, SILVER_COLUMNS
from ..session import shared_path
from ..sources import derived
from ..sources import landing as L
from ..sources import pages as P
from ..sources.tables import pages_scan
from ..streaming import ingest as S
from . import gold
from . import medallion as M
from . import versions as V
from .bronze import bronze_metadata, bronze_summary
from .silver import build_silver, clean_listings

AS_OF = derived.AS_OF


def derived_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.derived_bronze_rows(spark, sf_dir)


def derived_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(derived_bronze(spark, sf_dir), as_of=AS_OF)


def stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` written once under the shared checkpoint root: a query that reads them several
    times derives them once, and each reading takes the columns it needs from Parquet."""
    path = shared_path(spark, "stored", unique=True)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = gold.VIEWS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = derived_silver(spark, sf_dir)
        return fn(silver, AS_OF) if name == "v_job_market_overview" else fn(silver)

    run.__name__ = name
    return run


def relisted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in which some listings occur twice, the second time with other pay and with
    blank and repeated technologies: counts of listings and of rows differ."""
    silver = derived_silver(spark, sf_dir)
    once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    listed = silver.withColumn("__again", F.explode(F.when(F.expr("ascii(right(job_listing_id, 1)) % 3 = 0"), twice).otherwise(once)))
    again = {"min_salary": (F.col("min_salary") + 1000).cast(silver.schema["min_salary"].dataType),
             "expected_technologies": F.concat("expected_technologies", F.lit(",,Relisting, Relisting"))}
    return listed.withColumns({c: F.when(F.col("__again"), v).otherwise(F.col(c)) for c, v in again.items()}).drop("__again")


RELISTED = ("v_job_market_overview", "v_jobs_by_location", "v_jobs_by_contract_type", "v_jobs_by_work_mode",
            "v_jobs_by_level", "v_salary_insights", "v_top_technologies", "v_top_hiring_companies", "v_market_heatmap")
READ_TWICE = ("v_salary_insights", "v_top_technologies")  # views that read Silver more than once


def _relisted_view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = gold.VIEWS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = relisted_silver(spark, sf_dir)
        silver = stored(spark, silver) if name in READ_TWICE else silver
        return fn(silver, AS_OF) if name == "v_job_market_overview" else fn(silver)

    run.__name__ = f"relisted_{name}"
    return run


def q_gold_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_dashboard(derived_silver(spark, sf_dir))


def q_silver_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_silver(spark, sf_dir)


# ---------------------------------------------------------------------------
# Operator-level queries: each applies one operator to every derived listing.
# ---------------------------------------------------------------------------


RUN_TS = derived.RUN_TIMESTAMP
LATER_TS = "1998-06-02 02:00:00"
EARLIER_TS = "1998-05-31 02:00:00"


def _per_listing(spark, sf_dir, *cols):
    return derived_bronze(spark, sf_dir).select("job_url", *cols)


def q_convert_date(spark, sf_dir):
    return _per_listing(
        spark, sf_dir,
        F.col("expiration_date").alias("expiration_raw"),
        C.convert_date("expiration_date").alias("expiration_iso"),
        C.to_listing_date("expiration_date").alias("expiration_date"),
        F.col("job_posting_date").alias("posting_raw"),
        C.convert_date("job_posting_date").alias("posting_iso"),
        C.to_listing_date("job_posting_date").alias("job_posting_date"))


def q_extract_salary_range(spark, sf_dir):
    df = _per_listing(spark, sf_dir, "remuneration", C.extract_salary_range("remuneration").alias("s"))
    return df.select("job_url", "remuneration", "s.min_salary", "s.max_salary")


def _one_rule(raw: str, fn, out: str):
    def run(spark, sf_dir):
        return _per_listing(spark, sf_dir, F.col(raw), fn(raw).alias(out))
    return run


def q_listing_id(spark, sf_dir):
    return derived_bronze(spark, sf_dir).select("job_url", listing_id("job_url").alias("job_listing_id"))


def q_validation_errors(spark, sf_dir):
    return Q.with_validation(derived_bronze(spark, sf_dir)).select("job_url", Q.ERRORS_COL)


def _all_cleaned(spark, sf_dir):
    """Cleaned valid rows before the active-only filter."""
    return clean_listings(Q.valid_rows(Q.with_validation(derived_bronze(spark, sf_dir))), as_of=AS_OF)


def q_expiry_bucket(spark, sf_dir):
    return _all_cleaned(spark, sf_dir).select("job_url", "days_left",
                                              B.expiry_bucket("days_left").alias("expiry_status"))


def q_posting_bucket(spark, sf_dir):
    return _all_cleaned(spark, sf_dir).select("job_url", "days_since_posted",
                                              B.posting_bucket("days_since_posted").alias("posting_status"))


def q_salary_by_frequency(spark, sf_dir):
    return _all_cleaned(spark, sf_dir).select("job_url", "frequency", "min_salary", "max_salary",
                                              "min_salary_mth", "max_salary_mth", "min_salary_hr",
                                              "max_salary_hr")


def q_dropped_records(spark, sf_dir):
    validated = Q.with_validation(derived_bronze(spark, sf_dir))
    return Q.dropped_projection(Q.dropped_rows(validated), validated_at=RUN_TS)


def q_drop_reasons(spark, sf_dir):
    return Q.drop_reasons(q_dropped_records(spark, sf_dir))


def _stage_counts(spark, sf_dir):
    validated = Q.with_validation(derived_bronze(spark, sf_dir))
    return Q.stage_counts(validated, C.days_left(C.to_listing_date("expiration_date"), AS_OF))


def q_stage_counts(spark, sf_dir):
    return _stage_counts(spark, sf_dir)


def q_reconcile(spark, sf_dir):
    return Q.reconcile(_stage_counts(spark, sf_dir), count_expired=True)


def q_reconcile_reference(spark, sf_dir):
    return Q.reconcile(_stage_counts(spark, sf_dir), count_expired=False)


def q_run_summary(spark, sf_dir):
    return Q.run_summary(_stage_counts(spark, sf_dir))


def q_layer_counts(spark, sf_dir):
    bronze = derived_bronze(spark, sf_dir)
    validated = Q.with_validation(bronze)
    return Q.layer_counts({
        "bronze": bronze,
        "dropped_records_log": Q.dropped_rows(validated),
        "silver": derived_silver(spark, sf_dir),
    })


def q_profile_nulls(spark, sf_dir):
    return Q.profile_nulls(derived_bronze(spark, sf_dir))


def _bronze_table(spark, sf_dir):
    return bronze_metadata(derived_bronze(spark, sf_dir), source_file="derived:orders", loaded_at=RUN_TS)


def q_bronze_metadata(spark, sf_dir):
    return _bronze_table(spark, sf_dir)


def q_bronze_summary(spark, sf_dir):
    return bronze_summary(_bronze_table(spark, sf_dir), completed_at=RUN_TS)


def q_explode_technologies(spark, sf_dir):
    from .gold import explode_technologies
    return explode_technologies(derived_silver(spark, sf_dir))


def two_snapshots(spark, sf_dir):
    """Snapshot A (first run) and a re-scrape B of every listing: B is newer for even
    order keys and older (a late file) for odd ones, with a changed title."""
    rows = stored(spark, derived_bronze(spark, sf_dir))
    a = rows.withColumn("source_file", F.lit("snapshot_a.csv"))
    k = F.substring_index("job_url", "-", -1).cast("bigint")
    b = (rows
         .withColumn("job_title", F.concat(F.col("job_title"), F.lit(" [re-listed]")))
         .withColumn("ingestion_timestamp",
                     F.when(k % 2 == 0, F.lit(LATER_TS)).otherwise(F.lit(EARLIER_TS)))
         .withColumn("source_file", F.lit("snapshot_b.csv")))
    return a, b


def q_dedup_latest(spark, sf_dir):
    a, b = two_snapshots(spark, sf_dir)
    return D.dedup_latest(a.unionByName(b))


# ---------------------------------------------------------------------------
# Landing: CSV sink -> snapshot discovery -> by-name scan.
# ---------------------------------------------------------------------------


OLD_RUN = _dt.datetime(1998, 5, 31, 2, 0, 0)
NEW_RUN = _dt.datetime(1998, 6, 1, 2, 0, 0)
PACKED = "gzip"  # of landed text: a listing takes some 400 bytes as CSV, 800 as JSON


def write_landing_fixture(spark, sf_dir) -> str:
    """Land the derived listings as an older and a newer snapshot plus an export whose
    name carries no timestamp; returns the landing directory."""
    landing = shared_path(spark, "landing", unique=True)
    rows = stored(spark, derived_bronze(spark, sf_dir))
    L.write_csv_snapshot(rows.withColumn("job_title", F.concat("job_title", F.lit(" [old]"))), landing, OLD_RUN, compression=PACKED)
    L.write_csv_snapshot(rows, landing, NEW_RUN, compression=PACKED)
    rows.write.options(**L.CSV_WRITE_OPTIONS, compression=PACKED).csv(f"{landing}/manual_export.csv")
    return landing


def q_latest_snapshot(spark, sf_dir):
    landing = write_landing_fixture(spark, sf_dir)
    df = L.read_landing_csv(spark, L.latest_snapshot(spark, landing))
    return df.select(*LANDING_COLUMNS, L.name_timestamp(F.col("source_file")).alias("snapshot_ts"))


# ---------------------------------------------------------------------------
# Pages: HTML extraction (one parse per page) and listing assembly.
# ---------------------------------------------------------------------------


def _order_key() -> F.Column:
    return F.substring_index("job_url", "-", -1).cast("bigint")


def q_html_fields(spark, sf_dir):
    ex = P.generic_fields(pages_scan(spark, sf_dir))
    return ex.select("page_id", "url", "title", "heading", "ad_text", "footer_text", "article_text",
                     F.array_join("nav_links", " | ").alias("nav_links"),
                     F.size("nav_links").alias("nav_count"))


def fixture_pages(spark, sf_dir, rows=None):
    """(list pages, detail pages) of the derived listings; of ``rows``, if both are read."""
    return P.render_fixture_pages(derived_bronze(spark, sf_dir) if rows is None else rows, _order_key())


def q_detail_fields(spark, sf_dir):
    _, details = fixture_pages(spark, sf_dir)
    d = P.detail_fields(details)
    return d.select(*[F.array_join(c, ", " if c == "expected_technologies" else " | ").alias(c)
                      if c in ("expected_technologies", "requirements", "responsibilities") else F.col(c)
                      for c in d.columns])


def q_listing_cards(spark, sf_dir):
    list_pages, _ = fixture_pages(spark, sf_dir)
    return P.listing_cards(list_pages)


def q_assemble_listings(spark, sf_dir):
    list_pages, details = fixture_pages(spark, sf_dir, stored(spark, derived_bronze(spark, sf_dir)))
    return P.assemble_listings(P.listing_cards(list_pages),
                               P.detail_fields(details),
                               RUN_TS, derived.RUN_DATE)


# ---------------------------------------------------------------------------
# Streaming: incremental file-arrival ingestion into Bronze history.
# ---------------------------------------------------------------------------


def q_file_arrival_ingest(spark, sf_dir):
    """Land three files, ingest them with an availableNow stream, read Bronze back."""
    landing = write_landing_fixture(spark, sf_dir)
    bronze_path = shared_path(spark, "bronze_stream", unique=True)
    checkpoint = shared_path(spark, "stream_checkpoints", unique=True)
    S.file_arrival_ingest(spark, landing, checkpoint,
                          S.bronze_batch_writer(bronze_path, loaded_at=RUN_TS))
    bronze = spark.read.parquet(bronze_path)
    return bronze.select(*LANDING_COLUMNS, L.name_timestamp(F.col("source_file")).alias("snapshot_ts"))


# ---------------------------------------------------------------------------
# Tables and sinks: Bronze/Silver/drop-log writes, view registration, upsert, JSON.
# ---------------------------------------------------------------------------


def _fresh_tables(spark) -> M.Tables:
    """A new database under the shared checkpoint root (never a machine-local folder)."""
    return M.Tables(database=f"offerlake_{_uuid.uuid4().hex[:10]}",
                    location=shared_path(spark, "warehouse", unique=True))


def _keeping_current_database(spark, fn):
    """Run ``fn`` and restore the caller's current database afterwards."""
    current = spark.catalog.currentDatabase()
    try:
        return fn()
    finally:
        spark.catalog.setCurrentDatabase(current)


def _run_tables(spark, sf_dir) -> M.Tables:
    """Land the fixture, then run landing -> Bronze -> Silver (+drop log) -> views in a
    fresh database."""
    landing = write_landing_fixture(spark, sf_dir)
    t = _fresh_tables(spark)
    _keeping_current_database(spark, lambda: M.run_all(spark, landing, t, as_of=AS_OF, loaded_at=RUN_TS))
    return t


def q_silver_table(spark, sf_dir):
    t = _run_tables(spark, sf_dir)
    assert "v_jobs_by_location" in M.list_views(spark)
    return spark.table(t.name(t.silver)).select(*[c for c in SILVER_COLUMNS if c != "source_file"])


def q_registered_views(spark, sf_dir):
    """Rows of every persistent Gold view, read by another session after Silver was
    refreshed twice behind the views."""
    t = _run_tables(spark, sf_dir)

    def refresh():
        for _ in range(2):
            M.load_silver(spark, t, AS_OF, validated_at=RUN_TS, run_id="refresh")

    _keeping_current_database(spark, refresh)
    other = spark.newSession()
    names = M.list_views(other, "*", t.database)
    names = [n for n in names if n in gold.VIEWS or n == "gold_dashboard"]
    return other.sql(" UNION ALL ".join(
        f"SELECT '{n}' AS view_name, COUNT(*) AS row_count FROM {t.name(n)}" for n in names))


def q_drop_log_table(spark, sf_dir):
    t = _run_tables(spark, sf_dir)
    return spark.table(t.name(t.drop_log)).drop("run_id")


def q_upsert_bronze(spark, sf_dir):
    """Bronze holds snapshot A; snapshot B is upserted (newest row per id wins)."""
    a, b = two_snapshots(spark, sf_dir)
    t = _fresh_tables(spark)
    _keeping_current_database(spark, lambda: (M.write_bronze(spark, a, t), M.upsert_bronze(spark, b, t)))
    return spark.table(t.name(t.bronze))


def fixture_records(spark, sf_dir, rows=None):
    """Assembled listings with their lists as arrays."""
    rows = stored(spark, derived_bronze(spark, sf_dir)) if rows is None else rows
    list_pages, details = fixture_pages(spark, sf_dir, rows)
    return P.assemble_records(P.listing_cards(list_pages), P.detail_fields(details), RUN_TS, derived.RUN_DATE)


def q_json_sink(spark, sf_dir):
    """Array-typed records -> JSON snapshot, newest of two -> typed scan, all 20 columns."""
    landing = shared_path(spark, "landing_json", unique=True)
    rows = stored(spark, derived_bronze(spark, sf_dir))
    records = fixture_records(spark, sf_dir, rows)
    L.write_json_snapshot(derived_records(spark, sf_dir, rows).withColumn("job_title", F.lit("old")), landing, OLD_RUN, compression=PACKED)
    L.write_json_snapshot(records, landing, NEW_RUN, compression=PACKED)
    back = L.read_landing_json(spark, L.latest_snapshot(spark, landing, suffix="json"))
    size = [F.size(c).alias(f"n_{c}") for c in LIST_COLUMNS]  # -1 for NULL: lists come back as lists
    return L.flatten_lists(back.select(*LANDING_COLUMNS, *size))


def derived_records(spark, sf_dir, rows=None):
    """The derived listings with their lists split into arrays."""
    split = {"expected_technologies": L.TECH_SEPARATOR, "requirements": " \\| ", "responsibilities": " \\| "}
    rows = derived_bronze(spark, sf_dir) if rows is None else rows
    return rows.withColumns({c: F.split(c, sep) for c, sep in split.items()})


def q_flatten_lists(spark, sf_dir):
    """Array-typed records -> CSV snapshot (lists flattened) -> newest snapshot by name."""
    landing = shared_path(spark, "landing", unique=True)
    L.write_csv_snapshot(fixture_records(spark, sf_dir), landing, NEW_RUN, compression=PACKED)
    return L.read_landing_csv(spark, L.latest_snapshot(spark, landing)).select(*LANDING_COLUMNS)


def write_mixed_landing(spark, sf_dir) -> str:
    """The derived listings as three runs whose files differ in their headers: the 20
    columns, 19 of them (without the posting date), and all in another order with one more."""
    landing = shared_path(spark, "landing_mixed", unique=True)
    rows = stored(spark, derived_bronze(spark, sf_dir).select(*LANDING_COLUMNS))
    third = F.pmod(_order_key(), F.lit(3))
    shuffled = ["job_url", "extra", *reversed(LANDING_COLUMNS[:-1])]
    for i, (stamp, part) in enumerate([("19980530", rows), ("19980531", rows.drop("job_posting_date")),
                                       ("19980601", rows.withColumn("extra", F.lit("x, y")).select(*shuffled))]):
        part.where(third == i).write.options(**L.CSV_WRITE_OPTIONS).csv(f"{landing}/{L.DEFAULT_PREFIX}_{stamp}_020000.csv")
    return landing


def q_file_arrival_mixed_headers(spark, sf_dir):
    """Files of three different headers in one micro-batch; every column by its name."""
    landing = write_mixed_landing(spark, sf_dir)
    bronze_path = shared_path(spark, "bronze_stream", unique=True)
    S.file_arrival_ingest(spark, landing, shared_path(spark, "stream_checkpoints", unique=True),
                          S.bronze_batch_writer(bronze_path, loaded_at=RUN_TS))
    return spark.read.parquet(bronze_path).select(*LANDING_COLUMNS, L.name_timestamp(F.col("source_file")).alias("snapshot_ts"))


def q_drop_log_republished(spark, sf_dir):
    """Three units are loaded; then one is published again without its faults and one is
    loaded again: the log holds the first unit's rows no more and the others' once."""
    t = _fresh_tables(spark)
    rows = bronze_metadata(stored(spark, derived_bronze(spark, sf_dir)), source_file="derived:orders", loaded_at=RUN_TS)
    third = F.pmod(_order_key(), F.lit(3))
    clean = Q.valid_rows(rows)

    def load(unit, part):
        M.write_bronze(spark, part, t)
        M.load_silver(spark, t, AS_OF, validated_at=RUN_TS, run_id=f"unit {unit}'s")

    def run():
        for unit in (0, 1, 2):
            load(unit, rows.where(third == unit))
        load(0, clean.where(third == 0))
        load(1, rows.where(third == 1))

    _keeping_current_database(spark, run)
    return spark.table(t.name(t.drop_log))


def q_silver_schema_merge(spark, sf_dir):
    """Silver is loaded, then published with a wider type, a new column and one less: both
    versions read under the merged columns."""
    t = _run_tables(spark, sf_dir)
    target = t.name(t.silver)
    silver = spark.table(target)
    newer = (silver.where("min_salary IS NOT NULL").drop("source_file")
             .withColumns({"min_salary": F.col("min_salary").cast("bigint") * 1_000_000_000, "currency": F.lit("PLN")}))
    M.replace_table(spark, newer, target, merge_schema=True)
    old = V.read_version(spark, target, V.current(spark, target).number - 1)
    both = old.withColumn("version", F.lit("old")).unionByName(spark.table(target).withColumn("version", F.lit("new")))
    return both.select("version", "job_url", "min_salary", "max_salary", "currency", (F.col("source_file").isNull()).alias("no_file"))


def q_salary_sketch(spark, sf_dir):
    """Three snapshots' pay sketches are stored (one of them twice) and merged: are the
    quartiles of each location within the stated rank error of the exact ones?"""
    t = _fresh_tables(spark)
    silver = stored(spark, derived_silver(spark, sf_dir).select("location", "min_salary", "job_url"))
    third = F.pmod(_order_key(), F.lit(3))

    def run():
        for i in (0, 1, 2, 1):
            M.store_sketches(spark, t, f"snapshot {i}", silver.where(third == i))

    _keeping_current_database(spark, run)
    merged = K.merged_sketches(spark.table(t.name(t.sketches)), ["location"])
    known = silver.where(F.col("location").isNotNull())
    checked = K.within_error(K.quantiles(merged, ["location"]), known, ["location"], "min_salary", K.rank_error())
    return checked.select("location", "n", F.col("rank").alias("quartile"), "ok")


def q_sql_functions(spark, sf_dir):
    """The rules as persistent SQL functions, called by another session over a table."""
    t = _fresh_tables(spark)
    rows = derived_bronze(spark, sf_dir)
    _keeping_current_database(spark, lambda: M.write_bronze(spark, rows, t))
    create_sql_functions(spark, t.database)
    f = t.database
    return spark.newSession().sql(f"""
        SELECT job_url, {f}.convert_date(expiration_date) AS expiration_iso, {f}.extract_salary_range(remuneration).min_salary AS min_salary,
               {f}.extract_salary_range(remuneration).max_salary AS max_salary, {f}.translate_frequency(frequency) AS frequency_clean,
               {f}.translate_work_modes(work_mode) AS work_mode_clean, {f}.translate_contract_type(contract_type) AS contract_type_clean,
               {f}.clean_location(location) AS location_clean, {f}.clean_job_level(job_level) AS job_level_clean,
               {f}.extract_listing_id(job_url) AS listing_id
        FROM {t.name(t.bronze)}""")


def q_now_functions(spark, sf_dir):
    """Day counts without a fixed date: relative to the day the query runs."""
    days = C.days_left(C.to_listing_date("expiration_date"), None), C.days_since_posted(C.to_listing_date("job_posting_date"), None)
    return _per_listing(spark, sf_dir, days[0].alias("days_left"), days[1].alias("days_since_posted"))


def q_preview(spark, sf_dir):
    """Top 10 rows of chosen columns of an ordered view (the notebook-style preview)."""
    view = gold.v_jobs_by_location(derived_silver(spark, sf_dir))
    return M.preview(view, ["location", "job_count", "avg_min_salary"], 10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query: key -> fn(spark, sf_dir)."""
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _view(name) for name in gold.VIEWS}
    q["gold_dashboard"] = q_gold_dashboard
    q["silver_listings"] = q_silver_listings
    q["convert_date"] = q_convert_date
    q["extract_salary_range"] = q_extract_salary_range
    q["translate_frequency"] = _one_rule("frequency", C.translate_frequency, "frequency_clean")
    q["translate_work_modes"] = _one_rule("work_mode", C.translate_work_modes, "work_mode_clean")
    q["translate_contract_type"] = _one_rule("contract_type", C.translate_contract_type, "contract_type_clean")
    q["clean_location"] = _one_rule("location", C.clean_location, "location_clean")
    q["clean_job_level"] = _one_rule("job_level", C.clean_job_level, "job_level_clean")
    q["listing_id"] = q_listing_id
    q["validation_errors"] = q_validation_errors
    q["expiry_bucket"] = q_expiry_bucket
    q["posting_bucket"] = q_posting_bucket
    q["salary_by_frequency"] = q_salary_by_frequency
    q["dropped_records"] = q_dropped_records
    q["drop_reasons"] = q_drop_reasons
    q["stage_counts"] = q_stage_counts
    q["reconcile"] = q_reconcile
    q["reconcile_reference"] = q_reconcile_reference
    q["run_summary"] = q_run_summary
    q["layer_counts"] = q_layer_counts
    q["profile_nulls"] = q_profile_nulls
    q["bronze_metadata"] = q_bronze_metadata
    q["bronze_summary"] = q_bronze_summary
    q["explode_technologies"] = q_explode_technologies
    q["dedup_latest"] = q_dedup_latest
    q["latest_snapshot"] = q_latest_snapshot
    q["html_fields"] = q_html_fields
    q["detail_fields"] = q_detail_fields
    q["listing_cards"] = q_listing_cards
    q["assemble_listings"] = q_assemble_listings
    q["file_arrival_ingest"] = q_file_arrival_ingest
    q["silver_table"] = q_silver_table
    q |= {f"relisted_{name}": _relisted_view(name) for name in RELISTED}
    q["relisted_gold_dashboard"] = lambda spark, sf_dir: gold.gold_dashboard(stored(spark, relisted_silver(spark, sf_dir)))
    q["registered_views"] = q_registered_views
    q["drop_log_table"] = q_drop_log_table
    q["upsert_bronze"] = q_upsert_bronze
    q["json_sink"] = q_json_sink
    q["flatten_lists"] = q_flatten_lists
    q["file_arrival_mixed_headers"] = q_file_arrival_mixed_headers
    q["drop_log_republished"] = q_drop_log_republished
    q["silver_schema_merge"] = q_silver_schema_merge
    q["now_functions"] = q_now_functions
    q["salary_sketch"] = q_salary_sketch
    q["sql_functions"] = q_sql_functions
    q["preview"] = q_preview
    return q
