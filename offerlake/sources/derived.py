"""Listings derived from the driver's order tables.

The engine's inputs are scraped listings; to exercise it at any scale factor we derive
one Bronze-shaped listing per order (``k = o_orderkey``) with plain joins and
expressions, so the work grows with the tables.  Deterministic k-based rules make
every cleaning branch (dropped, expired, unparsed, mapped, passed through) occur.

Plan shape: ``orders`` joins ``customer`` (shuffle join on the customer key; AQE splits
a hot customer), ``nation``/``region`` are 25/5-row dimension tables and are broadcast
behind a size check, and the per-order technology list is a map-side-deduplicated
``collect_set`` of part names (a fixed 64-name vocabulary, so every set is bounded
regardless of how many line items an order has).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import listing_id
from ..operators.joins import join_dimension
from .tables import read_table

# The fixture's snapshot date and run stamp.
AS_OF = _dt.date(1998, 6, 1)
RUN_TIMESTAMP = "1998-06-01 02:00:00"
RUN_DATE = "1998-06-01"

# Fixture text.
UUID_PREFIX = "7f000001-0a0b-4c0d-8e0f-"
URL_PREFIX = "https://theprotocol.it/szczegoly/praca/oferta,"
ENGLISH_MONTHS = ["January", "February", "March", "April", "May", "June", "July",
                  "August", "September", "October", "November", "December"]
POLISH_MONTHS = ["stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca",
                 "sierpnia", "września", "października", "listopada", "grudnia"]
TITLES = ["Data Analyst", "BI Developer", "Data Engineer", "Analytics Engineer"]
LEVELS = ["junior", "mid", "senior", "mid • senior"]
CONTRACTS = ["kontrakt B2B (pełny etat)", "umowa o pracę (pełny etat)",
             "kontrakt B2B (część etatu, pełny etat)", "kontrakt B2B", "B2B", "umowa zlecenie"]
WORK_MODES_RAW = ["zdalna", "hybrydowa", "Stacjonarna, Zdalna", "hybrydowa,zdalna,"]
FREQUENCIES_RAW = ["mth", "mies.", "hr", "godz.", "netto / day"]


def _pick(values: list[str], idx: Column) -> Column:
    """values[idx] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _date_text(d: Column, k: Column, english_mod: int, upper_mod: int) -> Column:
    m = F.month(d)
    name = F.when(k % english_mod == 0, F.element_at(F.array(*map(F.lit, ENGLISH_MONTHS)), m)) \
        .otherwise(F.element_at(F.array(*map(F.lit, POLISH_MONTHS)), m))
    name = F.when(k % upper_mod == 0, F.upper(name)).otherwise(name)
    return F.concat_ws(" ", F.dayofmonth(d).cast("string"), name, F.year(d).cast("string"))


def order_technologies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, expected_technologies): sorted distinct part names joined by ', '."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    named = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return named.groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_set("p_name")), ", ").alias("expected_technologies")
    )


def derived_bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing-shaped (20 string columns) listing per order."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    geo = join_dimension(nation, region, nation.n_regionkey == region.r_regionkey, "left")
    cust = join_dimension(customer, geo, customer.c_nationkey == geo.n_nationkey, "left")
    techs = order_technologies(spark, sf_dir)

    df = (orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
          .join(techs, orders.o_orderkey == techs.l_orderkey, "left"))
    return df.select(*bronze_projection())


def bronze_projection() -> list[Column]:
    k = F.col("o_orderkey")
    uuid = F.concat(F.lit(UUID_PREFIX), F.lpad(k.cast("string"), 12, "0"))
    url = F.concat(F.lit(URL_PREFIX), F.when(k % 23 == 0, F.upper(uuid)).otherwise(uuid))
    order_day = F.to_date("o_orderdate")
    posted_day = F.date_sub(F.lit(AS_OF.isoformat()).cast("date"), (k % 40).cast("int"))

    expiration = (
        F.when(k % 41 == 0, F.concat(F.lit("31 lutego "), F.year(order_day).cast("string")))
        .when(k % 17 == 0, F.concat_ws(" ", F.dayofmonth(order_day).cast("string"), F.lit("gru"),
                                       F.year(order_day).cast("string")))
        .when(k % 9 == 0, F.concat(F.lit("  "), _date_text(order_day, k, 2, 11), F.lit(" ")))
        .otherwise(_date_text(order_day, k, 2, 11))
    )
    t = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    t5 = (t + 5).cast("string")
    ts = t.cast("string")
    r = k % 10
    remuneration = (
        F.when(k % 3 == 0, F.lit(None).cast("string"))
        .when(r == 1, F.concat(ts, F.lit("\u00a0000 - "), t5, F.lit("\u00a0500")))
        .when(r == 2, F.concat(ts, F.lit(",5 - "), t5, F.lit(",9")))
        .when(r == 4, F.concat(ts, F.lit(" 000 \u2013 "), t5, F.lit(" 500")))
        .when(r == 5, F.concat(F.lit("null - "), ts))
        .when(r == 7, F.concat(ts, F.lit("\u202f000-"), t5, F.lit("\u2009000")))
        .otherwise(F.concat(ts, F.lit(" 000 - "), t5, F.lit(" 500")))
    )
    nation_name = F.col("n_name")
    location = (
        F.when(k % 31 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.lit("Oferta w wielu lokalizacjach"))
        .when(k % 7 == 3, F.concat(F.lit("Multiple locations offer: "), nation_name))
        .otherwise(nation_name)
    )
    return [
        listing_id(url).alias("job_listing_id"),
        F.when(k % 13 != 0, F.concat(_pick(TITLES, k % 4), F.lit(" ("), F.col("o_orderpriority"),
                                     F.lit(")"))).alias("job_title"),
        expiration.alias("expiration_date"),
        _date_text(posted_day, k, 3, 7).alias("job_posting_date"),
        F.when(k % 29 != 0, F.col("c_name")).alias("company_name"),
        location.alias("location"),
        F.concat_ws(", ", F.col("r_name"), nation_name).alias("address_1"),
        F.when(k % 2 == 1, F.concat(F.lit("Zmyslona "), (k % 100).cast("string"))).alias("address_2"),
        F.when(k % 5 != 4, _pick(WORK_MODES_RAW, k % 5)).alias("work_mode"),
        F.when(k % 19 != 0, _pick(LEVELS, k % 4)).alias("job_level"),
        F.when(k % 37 != 0, _pick(CONTRACTS, k % 6)).alias("contract_type"),
        remuneration.alias("remuneration"),
        F.when(k % 3 != 0, _pick(FREQUENCIES_RAW, k % 5)).alias("frequency"),
        F.when(k % 3 != 0, F.when(k % 2 == 0, F.lit("brutto")).otherwise(F.lit("netto")))
        .alias("gross_or_net"),
        F.col("expected_technologies"),
        F.concat(F.lit("Segment "), F.coalesce(F.col("c_mktsegment"), F.lit("?")),
                 F.lit(" | Priority "), F.col("o_orderpriority")).alias("requirements"),
        F.concat(F.lit("Status "), F.col("o_orderstatus")).alias("responsibilities"),
        F.lit(RUN_TIMESTAMP).alias("ingestion_timestamp"),
        F.lit(RUN_DATE).alias("ingestion_date"),
        url.alias("job_url"),
    ]
