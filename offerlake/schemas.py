"""Fixed schemas of the listing layers (landing 20, bronze 23, silver 28, drop log 7)."""

from __future__ import annotations

from pyspark.sql import types as T

# landing/writer column order of one scraped record.
LANDING_COLUMNS = [
    "job_listing_id", "job_title", "expiration_date", "job_posting_date",
    "company_name", "location", "address_1", "address_2", "work_mode", "job_level",
    "contract_type", "remuneration", "frequency", "gross_or_net",
    "expected_technologies", "requirements", "responsibilities",
    "ingestion_timestamp", "ingestion_date", "job_url",
]

# Silver column order.
SILVER_COLUMNS = [
    "job_listing_id", "days_since_posted", "company_name", "job_title", "days_left",
    "expected_technologies", "min_salary", "max_salary", "min_salary_mth",
    "max_salary_mth", "min_salary_hr", "max_salary_hr", "frequency", "location",
    "address_1", "address_2", "contract_type", "job_level", "work_mode",
    "responsibilities", "requirements", "ingestion_date", "ingestion_timestamp",
    "job_posting_date", "expiration_date", "remuneration", "job_url", "source_file",
]

# Columns that must be non-NULL for a row to reach Silver, in message order.
REQUIRED_COLUMNS = ["job_listing_id", "job_title", "company_name", "job_level", "contract_type"]

BRONZE_METADATA_COLUMNS = ["source_file", "_bronze_ingestion_time", "_record_processed_date"]

LIST_COLUMNS = ["expected_technologies", "requirements", "responsibilities"]

LANDING_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in LANDING_COLUMNS])

#: The landing row before its lists are flattened (JSON snapshots hold it as it is).
RECORD_SCHEMA = T.StructType([
    T.StructField(c, T.ArrayType(T.StringType()) if c in LIST_COLUMNS else T.StringType(), True) for c in LANDING_COLUMNS])

BRONZE_SCHEMA = T.StructType(
    list(LANDING_SCHEMA.fields)
    + [
        T.StructField("source_file", T.StringType(), True),
        T.StructField("_bronze_ingestion_time", T.TimestampType(), True),
        T.StructField("_record_processed_date", T.DateType(), True),
    ]
)

_SILVER_TYPES = {
    "days_since_posted": T.IntegerType(), "days_left": T.IntegerType(),
    "min_salary": T.IntegerType(), "max_salary": T.IntegerType(),
    "min_salary_mth": T.IntegerType(), "max_salary_mth": T.IntegerType(),
    "min_salary_hr": T.IntegerType(), "max_salary_hr": T.IntegerType(),
    "job_posting_date": T.DateType(), "expiration_date": T.DateType(),
}

SILVER_SCHEMA = T.StructType(
    [T.StructField(c, _SILVER_TYPES.get(c, T.StringType()), True) for c in SILVER_COLUMNS]
)

DROP_LOG_SCHEMA = T.StructType([
    T.StructField("job_listing_id", T.StringType(), True),
    T.StructField("job_title", T.StringType(), True),
    T.StructField("company_name", T.StringType(), True),
    T.StructField("reason_dropped", T.StringType(), True),
    T.StructField("ingestion_timestamp", T.StringType(), True),
    T.StructField("validation_timestamp", T.TimestampType(), True),
    T.StructField("validation_date", T.DateType(), True),
])

SALARY_SCHEMA = T.StructType([
    T.StructField("min_salary", T.IntegerType(), True),
    T.StructField("max_salary", T.IntegerType(), True),
])
