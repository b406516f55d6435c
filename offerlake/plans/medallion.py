"""Table-level runs: landing -> Bronze table -> Silver table (+ drop log) -> Gold views.

Each layer hands over through a table.  One scan of Bronze writes Silver and the dropped
rows and observes every stage count on the way; every refresh publishes a new numbered
version of its table (``versions.py``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup as D
from ..operators import quality as Q
from ..operators import sketches as K
from ..schemas import SILVER_SCHEMA
from ..sources import landing as L
from . import gold, gold_sql
from . import versions as V
from .bronze import bronze_metadata
from .silver import clean_listings


@dataclass(frozen=True)
class Tables:
    database: str = "listings"
    bronze: str = "jobs_raw"
    silver: str = "jobs_cleaned"
    drop_log: str = "dropped_records_log"
    completed: str = "completed_snapshots"
    sketches: str = "salary_sketches"
    bronze_buckets: int = 64  # buckets of a Bronze table kept by upserts
    fmt: str = "parquet"
    location: str | None = None  # database location (shared storage); None = warehouse dir

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"


def ensure_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS (optionally at a shared location) + make it current."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    spark.catalog.setCurrentDatabase(database)


def replace_table(spark: SparkSession, df: DataFrame, target: str, fmt: str = "parquet",
                  options: dict | None = None, keep: int = V.KEEP, merge_schema: bool = False) -> str:
    """Replace ``target`` with ``df`` as its next version (``plans/versions.py``); with
    ``merge_schema`` the columns of the version before stay and types widen."""
    V.replace(spark, df, target, fmt, options, merge_schema, keep)
    return target


def write_bronze(spark: SparkSession, df: DataFrame, t: Tables) -> str:
    """Full replacement of the Bronze table."""
    ensure_schema(spark, t.database, t.location)
    return replace_table(spark, df, t.name(t.bronze), t.fmt)


def load_latest_to_bronze(spark: SparkSession, landing_dir: str, t: Tables, loaded_at=None) -> str:
    """Pick the newest snapshot, read it by header name, add metadata, overwrite Bronze."""
    rows = L.read_latest_snapshot(spark, landing_dir)
    return write_bronze(spark, bronze_metadata(rows, source_file=F.col("source_file"), loaded_at=loaded_at), t)


def write_drop_log(spark: SparkSession, dropped: DataFrame | None, t: Tables, run_id: str | None = None) -> None:
    """The rejected rows of one run (None: there are none) under ``run_id``, the log's last
    column and partition; a fresh id if none is given.  Writing a run again replaces that
    run's rows, also by none, and leaves those of all other runs."""
    target = t.name(t.drop_log)
    if spark.catalog.tableExists(target) and spark.table(target).columns[-1:] != ["run_id"]:
        raise ValueError(f"{target} has no run_id partition: rename it, then load again")
    replace_partition(spark, target, dropped, "run_id", run_id or uuid.uuid4().hex, t.fmt)


def replace_partition(spark: SparkSession, target: str, rows: DataFrame | None, column: str, value: str, fmt: str = "parquet") -> None:
    """Replace the rows of one partition of a managed table, also by none (None); all other
    partitions stay as they are."""
    named = f"PARTITION ({column} = '" + value.replace("\\", "\\\\").replace("'", "\\'") + "')"
    exists = spark.catalog.tableExists(target)
    if rows is None:
        if exists:
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {named}")
        return
    if not exists:
        rows.limit(0).withColumn(column, F.lit("")).write.format(fmt).partitionBy(column).saveAsTable(target)
    columns = ", ".join(f"`{c}`" for c in spark.table(target).columns[:-1])
    spark.sql(f"INSERT OVERWRITE TABLE {target} {named} SELECT {columns} FROM {{rows}}", rows=rows)


def store_sketches(spark: SparkSession, t: Tables, snapshot: str, silver: DataFrame, keys: list[str] = ("location",),
                   value: str = "min_salary") -> None:
    """Quantile sketches of one snapshot's groups; storing a snapshot again replaces its own."""
    ensure_schema(spark, t.database, t.location)
    replace_partition(spark, t.name(t.sketches), K.quantile_sketches(silver, list(keys), value), "snapshot", snapshot, t.fmt)


def is_completed(spark: SparkSession, t: Tables, unit) -> bool:
    """Was this snapshot unit (with the same files), or a newer one, loaded to the end?"""
    target = t.name(t.completed)
    if not spark.catalog.tableExists(target):
        return False
    done = spark.table(target)
    # Marks of an earlier layout have no digest: such a unit is loaded once more.
    same = (F.col("unit") == unit["unit"]) & (F.col("digest") == unit["digest"]) if "digest" in done.columns else F.lit(False)
    newer = F.col("snapshot_ts") > F.lit(unit["snapshot_ts"]) if unit["snapshot_ts"] else F.col("snapshot_ts").isNotNull()
    return not done.where(same | newer).isEmpty()


def mark_completed(spark: SparkSession, t: Tables, unit) -> None:
    target = t.name(t.completed)
    if spark.catalog.tableExists(target) and "digest" not in spark.table(target).columns:
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS (digest string)")
    row = [(unit["unit"], unit["snapshot_ts"], unit["files"], unit["digest"])]
    spark.createDataFrame(row, "unit string, snapshot_ts timestamp, files bigint, digest string").write.format(t.fmt) \
        .mode("append").saveAsTable(target)


def load_silver(spark: SparkSession, t: Tables, as_of=None, validated_at=None,
                count_expired: bool = True, run_id: str | None = None) -> dict:
    """Validate + clean Bronze, publish Silver, replace the run's part of the drop log;
    returns counts.

    One job reads Bronze once: it writes active and dropped rows, split by status, into the
    folder of Silver's next version and observes every stage count.  The drop log takes its
    rows from there and is written before the version is published, so a run that dies in
    between is repeated under the same ``run_id``."""
    target = t.name(t.silver)
    V.point(spark, target)
    base = V.current(spark, target)
    counts: dict = {}

    def write(folder: str) -> V.Version:
        rows, observed = Q.observe_stages(clean_listings(Q.with_validation(spark.table(t.name(t.bronze))), as_of,
                                                         keep=[Q.ERRORS_COL]))
        status = F.when(F.col(Q.ERRORS_COL) != "", F.lit("dropped")).when(F.col("days_left") >= 0, F.lit("active"))
        split = rows.withColumn("status", status).where(F.col("status").isNotNull())
        with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "4"):  # two folders a task, without a sort
            split.write.format(t.fmt).partitionBy("status").save(folder)
        counts.update(observed.get)
        struct = SILVER_SCHEMA
        if not counts["after_filter"]:
            spark.createDataFrame([], struct).write.format(t.fmt).save(f"{folder}/status=active")
        dropped = spark.read.format(t.fmt).load(f"{folder}/status=dropped") if counts["dropped"] else None
        write_drop_log(spark, None if dropped is None else Q.dropped_projection(dropped, validated_at), t, run_id)
        merged = V.merged_schema(base.struct, struct) if base else struct
        return V.Version(0, t.fmt, merged.json(), (V.Part(f"{folder}/status=active", tuple(struct.names)),))

    V.publish(spark, target, write, base)
    counts["expected_silver"] = counts["bronze"] - counts["dropped"] - (
        counts["before_filter"] - counts["after_filter"] if count_expired else 0)
    counts["status"] = "PASSED" if counts["after_filter"] == counts["expected_silver"] else "WARNING"
    return counts


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def register_views(spark: SparkSession, silver: DataFrame, as_of=None, scope: str = "session") -> list[str]:
    """Register every Gold view (and the dashboard).

    ``scope="session"`` makes temporary views of this session; ``"global"`` makes
    application-wide views under ``global_temp`` (needed when another session, such as
    a streaming micro-batch, refreshes them)."""
    views = dict(gold.gold_views(silver, as_of))
    views["gold_dashboard"] = gold.gold_dashboard(silver)
    for name, df in views.items():
        if scope == "global":
            df.createOrReplaceGlobalTempView(name)
        else:
            df.createOrReplaceTempView(name)
    return list(views)


def create_views(spark: SparkSession, t: Tables, as_of=None) -> list[str]:
    """Create every Gold view (and the dashboard) persistently in the tables' database, as
    SQL text over Silver by name: any session reads them, also after Silver is refreshed.
    Without ``as_of`` the overview shows the date on which it is read."""
    ensure_schema(spark, t.database, t.location)
    texts = gold_sql.view_sql(t.name(t.silver), t.database, as_of)
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {t.name(name)} AS {text}")
    return list(texts)


def list_views(spark: SparkSession, pattern: str = "v_*", database: str | None = None) -> list[str]:
    """Names of the registered views matching ``pattern`` (``database="global_temp"``
    lists the application-wide ones)."""
    tables = spark.catalog.listTables(dbName=database, pattern=pattern) if database else \
        spark.catalog.listTables(pattern=pattern)
    return sorted(t.name for t in tables if t.tableType in ("VIEW", "TEMPORARY"))


def preview(df: DataFrame, columns: list[str] | None = None, n: int = 10) -> DataFrame:
    """Top rows of chosen columns (a LIMIT, not a collect)."""
    return (df.select(*columns) if columns else df).limit(n)


def upsert_bronze(spark: SparkSession, incoming: DataFrame, t: Tables) -> str:
    """Merge a new snapshot into Bronze by listing id (newest wins, else insert).

    Bronze lies in ``t.bronze_buckets`` hash buckets of the id: only those that the snapshot's
    ids fall into are read and written again.  Rows without an id are added as they are."""
    ensure_schema(spark, t.database, t.location)
    target = t.name(t.bronze)
    V.upsert(spark, incoming, target, D.upsert, "job_listing_id", t.bronze_buckets, t.fmt)
    return target


def run_all(spark: SparkSession, landing_dir: str, t: Tables = Tables(), as_of: _dt.date | None = None,
            loaded_at=None) -> dict:
    """Landing -> Bronze -> Silver (+drop log) -> Gold views, persistent ones and those of
    this session."""
    load_latest_to_bronze(spark, landing_dir, t, loaded_at)
    counts = load_silver(spark, t, as_of, validated_at=loaded_at)
    create_views(spark, t, as_of)
    register_views(spark, spark.table(t.name(t.silver)), as_of)
    return counts
