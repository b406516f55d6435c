"""Silver: validated, cleaned, active listings in the fixed 28-column order.

The whole layer is narrow (no shuffle): one projection of native expressions over
the Bronze scan and a filter, so it streams through whole-stage codegen at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators import quality as Q
from ..schemas import SILVER_COLUMNS


def ensure_column(df: DataFrame, name: str, dtype: str = "string") -> DataFrame:
    """Add ``name`` as a typed NULL column when the frame does not have it."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def clean_listings(valid: DataFrame, as_of=None, translate_frequency_first: bool = True, keep: list[str] = ()) -> DataFrame:
    """All Silver columns for validated rows, before the active-only filter, and those of
    ``keep`` unchanged behind them.

    ``translate_frequency_first=False`` keeps the original order of operations, where the
    monthly/hourly split runs on the untranslated frequency text.
    """
    valid = ensure_column(valid, "source_file")
    # Stage 1: the expensive parses, each evaluated once per row.
    parsed = valid.select(
        "*",
        C.to_listing_date("expiration_date").alias("__exp"),
        C.to_listing_date("job_posting_date").alias("__posted"),
        C.extract_salary_range("remuneration").alias("__salary"),
        C.translate_frequency("frequency").alias("__freq"),
    )
    split_on = F.col("__freq") if translate_frequency_first else F.col("frequency")
    mn, mx = F.col("__salary.min_salary"), F.col("__salary.max_salary")
    out = parsed.select(
        "job_listing_id",
        C.days_since_posted("__posted", as_of).alias("days_since_posted"),
        "company_name",
        "job_title",
        C.days_left("__exp", as_of).alias("days_left"),
        "expected_technologies",
        mn.alias("min_salary"),
        mx.alias("max_salary"),
        C.salary_for(split_on, mn, "monthly").alias("min_salary_mth"),
        C.salary_for(split_on, mx, "monthly").alias("max_salary_mth"),
        C.salary_for(split_on, mn, "hourly").alias("min_salary_hr"),
        C.salary_for(split_on, mx, "hourly").alias("max_salary_hr"),
        F.col("__freq").alias("frequency"),
        C.clean_location("location").alias("location"),
        "address_1",
        "address_2",
        C.translate_contract_type("contract_type").alias("contract_type"),
        C.clean_job_level("job_level").alias("job_level"),
        C.translate_work_modes("work_mode").alias("work_mode"),
        "responsibilities",
        "requirements",
        "ingestion_date",
        "ingestion_timestamp",
        F.col("__posted").alias("job_posting_date"),
        F.col("__exp").alias("expiration_date"),
        "remuneration",
        "job_url",
        F.col("source_file").cast("string").alias("source_file"),
        *keep,
    )
    return out.select(*SILVER_COLUMNS, *keep)


def active_only(df: DataFrame) -> DataFrame:
    """Keep ``days_left >= 0``; unparsed (NULL) expiry is removed as well."""
    return df.filter(F.col("days_left") >= 0)


def build_silver(bronze: DataFrame, as_of=None, translate_frequency_first: bool = True) -> DataFrame:
    """Lazy Silver plan from Bronze: validate -> keep valid -> clean -> active only."""
    validated = Q.with_validation(bronze)
    return active_only(clean_listings(Q.valid_rows(validated), as_of, translate_frequency_first))


def silver_projection(silver: DataFrame) -> DataFrame:
    """The ordered 28-column projection (a no-op on frames from ``build_silver``)."""
    return ensure_column(silver, "source_file").select(*SILVER_COLUMNS)
