"""Scans of the driver's parquet tables and of managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """Full read of a managed table (Bronze, Silver, drop log)."""
    return spark.table(name)


def pages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extractors' input: one row per page (page_id, url, html)."""
    return read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
