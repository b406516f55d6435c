"""Validation, drop log, stage counts, reconciliation and profiling.

Counts are gathered with ``DataFrame.observe`` so they ride along the job that writes
the data instead of re-running the plan once per count; summaries are one-row
DataFrames built on the executors, never Python loops over collected rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import REQUIRED_COLUMNS

ERRORS_COL = "validation_errors"


def validation_errors(required: list[str] = REQUIRED_COLUMNS) -> Column:
    """``'Missing <col>, '`` for each NULL required column, in order; '' when valid.
    Only NULL fails: blank text passes."""
    return F.concat(*[
        F.when(F.col(c).isNull(), F.lit(f"Missing {c}, ")).otherwise(F.lit(""))
        for c in required
    ])


def with_validation(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    return df.withColumn(ERRORS_COL, validation_errors(required))


def valid_rows(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows without a NULL in a required column; tested on the bare columns, so that the
    predicates reach the scan."""
    kept = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))
    return kept.drop(ERRORS_COL)


def dropped_rows(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows with a NULL in a required column, with the reason text (built for them only)."""
    bad = df.drop(ERRORS_COL).filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required]))
    return with_validation(bad, required)


def dropped_projection(dropped: DataFrame, validated_at=None) -> DataFrame:
    """The drop-log row shape (7 columns)."""
    ts = F.current_timestamp() if validated_at is None else F.lit(validated_at).cast("timestamp")
    return dropped.select(
        "job_listing_id", "job_title", "company_name",
        F.col(ERRORS_COL).alias("reason_dropped"),
        "ingestion_timestamp",
        ts.alias("validation_timestamp"),
        ts.cast("date").alias("validation_date"),
    )


def observe_stages(cleaned: DataFrame, name: str = "stages") -> tuple[DataFrame, Observation]:
    """Attach all stage counters to cleaned rows that still carry their validation errors
    (dropped rows included); expiry is counted on valid rows only."""
    obs = Observation(name)
    ok = F.col(ERRORS_COL) == ""
    out = cleaned.observe(
        obs,
        F.count(F.lit(1)).alias("bronze"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("dropped"),
        F.count_if(ok).alias("before_filter"),
        F.count_if(ok & (F.col("days_left") >= 0)).alias("after_filter"),
        F.count_if(ok & F.col("days_left").isNull()).alias("unparsed_expiry"),
    )
    return out, obs


def stage_counts(validated: DataFrame, days_left: Column) -> DataFrame:
    """All stage counts of a run as one row, in a single aggregation pass.

    ``validated`` carries ``validation_errors``; ``days_left`` is the expiry expression
    (only meaningful on valid rows, which is all it is counted on).
    """
    ok = F.col(ERRORS_COL) == ""
    return validated.agg(
        F.count(F.lit(1)).alias("bronze"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("dropped"),
        F.count_if(ok).alias("before_filter"),
        F.count_if(ok & (days_left >= 0)).alias("after_filter"),
        F.count_if(ok & days_left.isNull()).alias("unparsed_expiry"),
    )


def reconcile(counts: DataFrame, count_expired: bool = True) -> DataFrame:
    """One-row reconciliation from a frame with bronze/dropped/before/after counts.

    ``count_expired=False`` is the original formula (expected = bronze - dropped), which
    warns whenever a listing expired; True also subtracts the rows the expiry filter
    removed, so PASSED means no row went missing unaccounted.
    """
    filtered = F.col("before_filter") - F.col("after_filter")
    expected = F.col("bronze") - F.col("dropped") - (filtered if count_expired else F.lit(0))
    silver = F.col("after_filter")
    return counts.select(
        F.col("bronze").alias("bronze"),
        F.col("dropped").alias("dropped"),
        filtered.alias("filtered"),
        silver.alias("silver"),
        expected.alias("expected"),
        F.abs(silver - expected).alias("difference"),
        F.when(silver == expected, F.lit("PASSED")).otherwise(F.lit("WARNING")).alias("status"),
    )


def run_summary(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("bronze").alias("processed"),
        F.col("dropped").alias("dropped"),
        (F.col("before_filter") - F.col("after_filter")).alias("filtered"),
        F.col("after_filter").alias("loaded"),
    )


def drop_reasons(drop_log: DataFrame) -> DataFrame:
    """``SELECT reason_dropped, COUNT(*) ... GROUP BY reason_dropped`` (partial agg)."""
    return drop_log.groupBy("reason_dropped").agg(F.count(F.lit(1)).alias("count"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, row_count) for each named frame; one global count per layer."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
             for name, df in layers.items()]
    return reduce(DataFrame.unionAll, parts)


def profile_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count, row_count): one aggregation pass, unpivoted with stack."""
    cols = columns or df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)],
    )
    stacked = F.expr(
        "stack({n}, {args}) as (column_name, null_count)".format(
            n=len(cols),
            args=", ".join(f"'{c}', __n{i}" for i, c in enumerate(cols)),
        )
    )
    return wide.select(stacked, F.col("__rows").alias("row_count"))
