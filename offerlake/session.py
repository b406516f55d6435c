"""Session construction and shared-storage helpers.

Scratch data (landing snapshots, lineage-cutting tables, stream checkpoints) always
lives under the directory the cluster names in ``spark.checkpoint.dir``.  A local
directory is only chosen when that setting is absent, which is the test/laptop case.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Runtime SQL settings for a large cluster (~1000 executors, ~100 TB of input).
# Shuffles start wide and AQE coalesces them to ~256 MB partitions; skewed join
# partitions are split; scans read 256 MB splits; page extraction ships small Arrow
# batches to Python (rows are whole HTML pages).  Broadcasts stay behind the planner's
# size estimate (64 MB).
LARGE_CLUSTER_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def apply_large_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set the runtime SQL settings above on an existing (cluster) session."""
    for k, v in {**LARGE_CLUSTER_SQL_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def build_session(master: str = "local[*]", app: str = "offerlake",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory; set a local one only when none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the SQL conf is visible
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    if not spark.conf.get("spark.master", "local").startswith("local") or "cluster" in spark.conf.get("spark.master", ""):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="offerlake-ckpt-")  # one machine: tests and laptops
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    return local


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint root; ``unique`` appends a fresh run id."""
    root = checkpoint_root(spark).rstrip("/")
    tail = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return "/".join([root, "offerlake", *tail])


def ship_package(spark: SparkSession) -> None:
    """Make ``offerlake`` importable in executor Python workers (what ``--py-files``
    does): zip the package once per SparkContext and ``addPyFile`` it.  Needed by the
    Arrow-batched page extraction, whose functions live in this package."""
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: dependencies are shipped by the client
        return
    if getattr(sc, "_offerlake_shipped", False):
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="offerlake-pyfiles-"), "offerlake.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(root, name)
                    zf.write(path, os.path.relpath(path, os.path.dirname(package_dir)))
    sc.addPyFile(archive)
    sc._offerlake_shipped = True
