"""Latest-row-per-listing deduplication and snapshot upsert.

The newest row per ``job_listing_id`` is picked with a hash aggregation of
``max(struct(ingestion_timestamp, source_file, job_url, ...))``: struct ordering gives
the tie-breaks, and map-side partial aggregation collapses a hot id inside each task
before the shuffle, so even an id holding a third of all rows never lands whole in
one task (a ``row_number`` window would sort that whole group in one task).
Rows with a NULL key pass through a separate filtered scan; on a Parquet table that
scan skips every row group whose statistics show no NULL ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_COLUMNS = ["ingestion_timestamp", "source_file", "job_url"]


def dedup_latest(df: DataFrame, key: str = "job_listing_id",
                 order_columns: list[str] = ORDER_COLUMNS) -> DataFrame:
    """One row per non-NULL key: greatest (ingestion_timestamp, source_file, job_url,
    remaining columns); rows with a NULL key are kept unchanged."""
    cols = df.columns
    rest = [c for c in cols if c not in order_columns and c != key]
    ranked = F.struct(*[F.col(c) for c in order_columns + rest]).alias("__best")
    best = (df.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.max(ranked).alias("__best"))
            .select(key, "__best.*"))
    return best.select(*cols).unionByName(df.filter(F.col(key).isNull()))


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "job_listing_id") -> DataFrame:
    """Merge a new snapshot into existing rows by key (newest wins, else insert)."""
    return dedup_latest(existing.unionByName(incoming, allowMissingColumns=True), key)
