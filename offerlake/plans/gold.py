"""Gold: analytical views over Silver, each a lazy DataFrame.

Plan notes (the same at 1 GB or 100 TB):

* Every grouped view is a hash aggregation with map-side partial aggregation, so a hot
  group (say ``Multiple locations`` holding a third of all rows) is pre-combined in
  each task before the shuffle.  ``COUNT(DISTINCT ...)`` over several columns is
  rewritten by Catalyst into an ``Expand`` whose shuffle key includes the distinct
  value, so a hot group still spreads over many reducers.
* Orderings carry an explicit tie-break on the grouping key so ``LIMIT`` and top-1
  picks are deterministic.  ``orderBy().limit(n)`` plans as ``TakeOrderedAndProject``
  (per-task top-n, then a merge of n rows per task), never a full sort.
* Whole-table denominators and dashboard picks are scalar subqueries (one row each).
* The exact percentile keeps a value -> count map per aggregation buffer, so memory
  follows the number of distinct salary figures, not the number of rows;
  ``approx=True`` switches to ``percentile_approx`` (bounded sketch) for very wide
  value domains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import expiry_bucket, posting_bucket
from ..functions.cleaning import as_of_col

ID = "job_listing_id"


def _with_salary_id() -> Column:
    return F.when(F.col("min_salary").isNotNull(), F.col(ID))


def pct(numerator: Column, denominator: Column) -> Column:
    """``ROUND(n * 100.0 / d, 2)`` in exact decimal arithmetic (HALF_UP), as DOUBLE;
    NULL when the denominator is 0."""
    return F.round(F.try_divide(numerator * F.lit(100.0).cast("decimal(4,1)"), denominator), 2) \
        .cast("double")


def avg0(c: str) -> Column:
    return F.round(F.avg(c), 0)


def segment_summary(df: DataFrame, keys: list[str], measures: tuple[str, str] = ("min_salary", "max_salary"),
                    coverage: str = "pct") -> DataFrame:
    """Shared shape of the per-dimension views.

    ``coverage='pct'`` adds salary_coverage_pct, ``'count'`` adds listings_with_salary,
    ``None`` adds neither.  ``measures`` picks the averaged pay columns (e.g. the
    ``*_mth`` pair to avoid mixing hourly and monthly pay).
    """
    aggs = [
        F.countDistinct(ID).alias("job_count"),
        F.countDistinct("company_name").alias("company_count"),
        avg0(measures[0]).alias("avg_min_salary"),
        avg0(measures[1]).alias("avg_max_salary"),
    ]
    if coverage == "pct":
        aggs.append(pct(F.countDistinct(_with_salary_id()), F.countDistinct(ID)).alias("salary_coverage_pct"))
    elif coverage == "count":
        aggs.append(F.countDistinct(_with_salary_id()).alias("listings_with_salary"))
    filtered = df
    for k in keys:
        filtered = filtered.filter(F.col(k).isNotNull())
    return filtered.groupBy(*keys).agg(*aggs)


def _ordered(df: DataFrame, count_col: str, keys: list[str]) -> DataFrame:
    return df.orderBy(F.desc(count_col), *[F.asc(k) for k in keys])


def v_job_market_overview(silver: DataFrame, as_of=None) -> DataFrame:
    return silver.agg(
        F.countDistinct(ID).alias("total_active_listings"),
        F.countDistinct("company_name").alias("total_companies"),
        F.countDistinct(_with_salary_id()).alias("listings_with_salary"),
        pct(F.countDistinct(_with_salary_id()), F.countDistinct(ID)).alias("salary_coverage_pct"),
        as_of_col(as_of).alias("snapshot_date"),
    )


def v_jobs_by_location(silver: DataFrame) -> DataFrame:
    s = segment_summary(silver, ["location"], coverage="count").select(
        "location", "job_count", "company_count", "avg_min_salary", "avg_max_salary",
        "listings_with_salary")
    return _ordered(s, "job_count", ["location"])


def _by_dimension(silver: DataFrame, key: str) -> DataFrame:
    s = segment_summary(silver, [key], coverage="pct").select(
        key, "job_count", "company_count", "avg_min_salary", "avg_max_salary", "salary_coverage_pct")
    return _ordered(s, "job_count", [key])


def v_jobs_by_contract_type(silver: DataFrame) -> DataFrame:
    return _by_dimension(silver, "contract_type")


def v_jobs_by_work_mode(silver: DataFrame) -> DataFrame:
    return _by_dimension(silver, "work_mode")


def v_jobs_by_level(silver: DataFrame) -> DataFrame:
    return _by_dimension(silver, "job_level")


def v_salary_insights(silver: DataFrame, approx: bool = False) -> DataFrame:
    """Salary summary.  The exact quartiles come from a histogram (one row per distinct
    salary), the distinct count and the averages from aggregates of their own, joined as
    one-row frames: no percentile buffer is ever kept per listing."""
    paid = silver.filter(F.col("min_salary").isNotNull())
    points = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    if approx:
        quartiles = paid.agg(F.percentile_approx("min_salary", points, F.lit(10000)).alias("q"))
    else:
        quartiles = (paid.groupBy("min_salary").agg(F.count("*").alias("n"))
                     .agg(F.percentile("min_salary", points, F.col("n")).alias("q")))
    averages = paid.agg(avg0("min_salary").alias("avg_min_salary"), avg0("max_salary").alias("avg_max_salary"),
                        F.round(F.min("min_salary"), 0).alias("min_salary_lowest"),
                        F.round(F.max("max_salary"), 0).alias("max_salary_highest"))
    counts = paid.agg(F.countDistinct(ID).alias("job_count"))
    one_row = [f.withColumn("__one", F.lit(1)) for f in (counts, averages, quartiles)]
    joined = one_row[0].join(one_row[1], "__one").join(one_row[2], "__one")
    quartile = lambda i, name: F.round(F.get("q", F.lit(i)).cast("double"), 0).alias(name)
    return joined.select(F.lit("Overall Market").alias("segment"), "job_count", "avg_min_salary", "avg_max_salary",
                         "min_salary_lowest", "max_salary_highest", quartile(0, "q1_min_salary"),
                         quartile(1, "median_min_salary"), quartile(2, "q3_min_salary"))


def explode_technologies(silver: DataFrame) -> DataFrame:
    """(technology, job_listing_id, company_name) per listed item; the filter runs
    below the generator; empty items survive as ''."""
    return (silver
            .filter(F.col("expected_technologies").isNotNull() & (F.col("expected_technologies") != ""))
            .select(F.explode(F.split("expected_technologies", ",", -1)).alias("__t"), ID, "company_name")
            .select(F.trim("__t").alias("technology"), ID, "company_name"))


def distinct_listings(silver: DataFrame) -> Column:
    """Scalar subquery: distinct listings over the whole table."""
    return silver.agg(F.countDistinct(ID)).scalar()


def v_top_technologies(silver: DataFrame, min_jobs: int = 5, top_n: int = 50) -> DataFrame:
    per_tech = explode_technologies(silver).groupBy("technology").agg(
        F.countDistinct(ID).alias("job_count"),
        F.countDistinct("company_name").alias("company_count"),
    ).filter(F.col("job_count") > min_jobs)
    out = per_tech.select(
        "technology", "job_count",
        pct(F.col("job_count"), distinct_listings(silver)).alias("pct_of_all_jobs"),
        "company_count")
    return _ordered(out, "job_count", ["technology"]).limit(top_n)


_DETAIL_COLUMNS = ["company_name", "job_title", "min_salary", "max_salary", "expected_technologies",
                   "responsibilities", "requirements", "location", "work_mode", "contract_type", "job_url"]


def v_jobs_expiring_soon(silver: DataFrame, within_days: int = 7) -> DataFrame:
    cols = _DETAIL_COLUMNS[:1] + ["days_left"] + _DETAIL_COLUMNS[1:]
    return (silver.filter(F.col("days_left") < within_days)
            .select(*cols, expiry_bucket("days_left").alias("expiry_status"))
            .orderBy(F.asc("days_left"), F.asc("job_url")))


def v_top_hiring_companies(silver: DataFrame, min_positions: int = 2, top_n: int = 50) -> DataFrame:
    per_company = silver.filter(F.col("company_name").isNotNull()).groupBy("company_name").agg(
        F.countDistinct(ID).alias("open_positions"),
        F.countDistinct("job_title").alias("unique_roles"),
        avg0("min_salary").alias("avg_min_salary"),
        avg0("max_salary").alias("avg_max_salary"),
        F.max("job_title").alias("sample_role"),
    ).filter(F.col("open_positions") >= min_positions)
    return _ordered(per_company, "open_positions", ["company_name"]).limit(top_n)


def v_market_heatmap(silver: DataFrame) -> DataFrame:
    s = segment_summary(silver, ["location", "work_mode"], coverage=None).select(
        "location", "work_mode", "job_count", "avg_min_salary", "avg_max_salary")
    return _ordered(s, "job_count", ["location", "work_mode"])


def v_jobs_just_posted(silver: DataFrame, within_days: int = 7) -> DataFrame:
    cols = _DETAIL_COLUMNS[:1] + ["days_since_posted"] + _DETAIL_COLUMNS[1:]
    return (silver.filter(F.col("days_since_posted") < within_days)
            .select(*cols, posting_bucket("days_since_posted").alias("posting_status"))
            .orderBy(F.asc("days_since_posted"), F.asc("job_url")))


def v_jobs_summary(silver: DataFrame) -> DataFrame:
    """All listings with the key preview fields."""
    return silver.select("company_name", "job_title", "min_salary_mth", "max_salary_mth",
                         "days_left", "work_mode", "contract_type")


def _top1(view: DataFrame, value_col: str) -> Column:
    return view.select(value_col).limit(1).scalar()


def _metric(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("metric"), value.cast("string").alias("value"))


def gold_dashboard(silver: DataFrame) -> DataFrame:
    """(metric, value) strings: header, two row counts and three top-1 picks.

    One pass over Silver for both counts; each pick is a scalar subquery over its
    (already ordered, tie-broken) view; the six rows come out of ``stack``.
    """
    top_location = _top1(v_jobs_by_location(silver), "location")
    top_mode = _top1(v_jobs_by_work_mode(silver), "work_mode")
    top_tech = _top1(v_top_technologies(silver), "technology")
    counts = silver.agg(
        F.count(F.lit(1)).cast("string").alias("total"),
        F.count_if(F.col("min_salary").isNotNull()).cast("string").alias("with_salary"),
    )
    return counts.select(
        F.inline(F.array(
            _metric("=== GOLD LAYER SUMMARY ===", F.lit("")),
            _metric("Total Active Listings", F.col("total")),
            _metric("Listings with Salary Data", F.col("with_salary")),
            _metric("Top Location", top_location),
            _metric("Most Common Work Mode", top_mode),
            _metric("Top Technology", top_tech),
        ))
    )


# The view names registered in the catalog.
VIEWS = {
    "v_job_market_overview": v_job_market_overview,
    "v_jobs_by_location": v_jobs_by_location,
    "v_jobs_by_contract_type": v_jobs_by_contract_type,
    "v_jobs_by_work_mode": v_jobs_by_work_mode,
    "v_jobs_by_level": v_jobs_by_level,
    "v_salary_insights": v_salary_insights,
    "v_top_technologies": v_top_technologies,
    "v_jobs_expiring_soon": v_jobs_expiring_soon,
    "v_top_hiring_companies": v_top_hiring_companies,
    "v_market_heatmap": v_market_heatmap,
    "v_jobs_just_posted": v_jobs_just_posted,
    "v_jobs_summary": v_jobs_summary,
}


def gold_views(silver: DataFrame, as_of=None) -> dict[str, DataFrame]:
    out = {}
    for name, fn in VIEWS.items():
        out[name] = fn(silver, as_of) if name == "v_job_market_overview" else fn(silver)
    return out
