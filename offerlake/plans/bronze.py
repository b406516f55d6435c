"""Bronze: raw landing rows plus load metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LANDING_COLUMNS


def bronze_metadata(df: DataFrame, source_file=None, loaded_at=None) -> DataFrame:
    """Add source_file, _bronze_ingestion_time and _record_processed_date.

    ``source_file`` defaults to the hidden file-metadata path of file scans (pass a
    Column or literal for other inputs); ``loaded_at`` fixes the load time (default now).
    """
    src = F.col("_metadata.file_path") if source_file is None else (
        source_file if not isinstance(source_file, str) else F.lit(source_file))
    ts = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return df.select(
        *LANDING_COLUMNS,
        src.cast("string").alias("source_file"),
        ts.alias("_bronze_ingestion_time"),
        ts.cast("date").alias("_record_processed_date"),
    )


def bronze_summary(bronze: DataFrame, completed_at=None) -> DataFrame:
    """One row: status, completion_time, total_unique_jobs, last_loaded."""
    ts = F.current_timestamp() if completed_at is None else F.lit(completed_at).cast("timestamp")
    return bronze.agg(
        F.lit("ETL Bronze Complete").alias("status"),
        ts.alias("completion_time"),
        F.countDistinct("job_listing_id").alias("total_unique_jobs"),
        F.max("_bronze_ingestion_time").alias("last_loaded"),
    )
