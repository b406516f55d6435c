"""File-arrival ingestion with Structured Streaming.

New landing CSV files are picked up incrementally by the file stream source (its
checkpoint remembers which files were processed).  The stream reads them by place and maps
each file to the 20 landing columns by its own header row (``landing.by_header``), so files
of 20 and of 19 columns, in any order, arrive in one micro-batch; then it hands the rows to
a ``foreachBatch`` function.
``trigger(availableNow=True)`` processes everything that has arrived and stops, which
is the scheduled-job form; a second run on the same checkpoint finds nothing new.

The default batch sink appends Bronze rows into a Parquet directory partitioned by
``batch_id`` with dynamic partition overwrite, so a batch replayed after a failure
replaces its own partition instead of duplicating rows (exactly-once output).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.bronze import bronze_metadata
from ..sources.landing import CSV_READ_OPTIONS, DEFAULT_PREFIX, by_header, file_glob, raw_csv_schema


def landing_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over landing CSV files, each mapped by its own header.

    ``landing`` is a directory (every ``*.csv`` and ``*.csv.gz`` below it, single files and
    Spark-written snapshot directories alike) or a glob pattern."""
    reader = spark.readStream.schema(raw_csv_schema()).options(**{**CSV_READ_OPTIONS, "header": "false"})
    if not any(ch in landing for ch in "*?[{"):
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", file_glob())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return by_header(reader.csv(landing).withColumn("source_file", F.col("_metadata.file_path")))


def bronze_batch_writer(bronze_path: str, loaded_at=None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: Bronze rows of one micro-batch -> its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        src = F.col("source_file") if "source_file" in batch.columns else None
        rows = bronze_metadata(batch, source_file=src, loaded_at=loaded_at)
        (rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(bronze_path))

    return write


def file_arrival_ingest(spark: SparkSession, landing: str, checkpoint: str,
                        on_batch: Callable[[DataFrame, int], None],
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Process every landing file not yet seen by ``checkpoint``, then stop."""
    stream = landing_stream(spark, landing, max_files_per_trigger)
    query = (stream.writeStream
             .foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query


def medallion_batch_runner(tables, landing: str, as_of=None, loaded_at=None,
                           prefix: str = DEFAULT_PREFIX) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for the file-arrival trigger: newest snapshot -> Bronze ->
    Silver (+ drop log) -> views.

    The stream only says that something arrived; what is loaded is always the newest whole
    snapshot unit of ``landing``, however its files are spread over micro-batches.  A unit
    is marked completed after Silver, drop log and views, so a run that failed half-way is
    done again on replay; a unit marked with the same files (paths, lengths,
    modification times), or older than a marked one, leaves the tables unchanged.  The drop log is written under the unit's
    name, so a repeated run replaces its rows."""
    from ..plans import medallion as M
    from ..sources import landing as L

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        unit = L.newest_unit(spark, landing, prefix)
        if unit is None or M.is_completed(spark, tables, unit):
            return
        rows = L.read_landing_csv(spark, unit["unit"])
        M.write_bronze(spark, bronze_metadata(rows, source_file=F.col("source_file"), loaded_at=loaded_at), tables)
        M.load_silver(spark, tables, as_of=as_of, validated_at=loaded_at,
                      run_id=unit["unit"].rstrip("/").rsplit("/", 1)[-1])
        M.create_views(spark, tables, as_of)
        M.register_views(spark, spark.table(tables.name(tables.silver)), as_of, scope="global")
        M.mark_completed(spark, tables, unit)

    return run
