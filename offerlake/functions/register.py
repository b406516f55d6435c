"""SQL-callable registrations of the cleaning rules.

The rules are registered as SQL functions whose bodies are the same native
expressions (``CREATE TEMPORARY FUNCTION ... RETURN <expr>``), rendered from the
analyzed Column expression, so SQL users get the JVM path too; nothing runs in a
Python worker.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import buckets, cleaning, ids

_STRING_RULES = {
    "convert_date": cleaning.convert_date,
    "translate_contract_type": cleaning.translate_contract_type,
    "translate_frequency": cleaning.translate_frequency,
    "clean_location": cleaning.clean_location,
    "clean_job_level": cleaning.clean_job_level,
    "extract_listing_id": ids.listing_id,
}


def _sql_of(spark: SparkSession, column_fn, arg: str = "s", arg_type: str = "string") -> str:
    """SQL text of ``column_fn(col(arg))`` from Catalyst's analyzed expression."""
    dummy = spark.createDataFrame([], f"{arg} {arg_type}")
    plan = dummy.select(column_fn(F.col(arg)).alias("out"))._jdf.queryExecution().analyzed()
    return plan.expressions().head().child().sql()


def _definitions(spark: SparkSession) -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, return type, body)."""
    out = {name: ("s STRING", "STRING", _sql_of(spark, fn)) for name, fn in _STRING_RULES.items()}
    out["translate_work_modes"] = "s STRING", "STRING", _sql_of(spark, cleaning.translate_work_modes)
    out["extract_salary_range"] = ("s STRING", "STRUCT<min_salary: INT, max_salary: INT>",
                                   _sql_of(spark, cleaning.extract_salary_range))
    for name, fn in {"expiry_bucket": buckets.expiry_bucket, "posting_bucket": buckets.posting_bucket}.items():
        out[name] = "d INT", "STRING", _sql_of(spark, fn, "d", "int")
    return out


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Temporary functions of this session."""
    return _define(spark, "TEMPORARY FUNCTION", "")


def create_sql_functions(spark: SparkSession, database: str) -> list[str]:
    """Persistent functions of ``database``: any session of the catalog calls them by
    ``database.name``."""
    return _define(spark, "FUNCTION", f"{database}.")


def _define(spark: SparkSession, kind: str, qualifier: str) -> list[str]:
    names = []
    for name, (params, returns, body) in _definitions(spark).items():
        spark.sql(f"CREATE OR REPLACE {kind} {qualifier}{name}({params}) RETURNS {returns} RETURN {body}")
        names.append(qualifier + name)
    return names
