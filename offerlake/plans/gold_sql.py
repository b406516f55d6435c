"""Gold views as Spark SQL text over the Silver table by name.

``CREATE VIEW`` stores the text in the catalog, so any session or BI tool reads the views,
and they follow Silver through its refreshes because the name is resolved at each read.
The definitions are those of :mod:`.gold`; a test holds the two forms together.
"""

from __future__ import annotations

from ..functions import buckets as B
from .gold import _DETAIL_COLUMNS

_JOBS = "COUNT(DISTINCT job_listing_id)"
_PAID = "COUNT(DISTINCT CASE WHEN min_salary IS NOT NULL THEN job_listing_id END)"
_COMPANIES = "COUNT(DISTINCT company_name)"
_AVERAGES = "ROUND(AVG(min_salary), 0) AS avg_min_salary, ROUND(AVG(max_salary), 0) AS avg_max_salary"


def _pct(numerator: str, denominator: str) -> str:
    return f"CAST(ROUND(try_divide({numerator} * 100.0, {denominator}), 2) AS DOUBLE)"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bucket(column: str, rules: list[tuple[str, str]], last: str) -> str:
    whens = " ".join(f"WHEN {column} {test} THEN {_literal(label)}" for test, label in rules)
    return f"CASE {whens} ELSE {_literal(last)} END"


def _segments(silver: str, keys: list[str], measures: str) -> str:
    names = ", ".join(keys)
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT {names}, {_JOBS} AS job_count, {measures} FROM {silver} WHERE {present} "
            f"GROUP BY {names} ORDER BY job_count DESC, {names}")


def _details(silver: str, days: str, within_days: int, bucket: str, status: str) -> str:
    first, *others = _DETAIL_COLUMNS
    return (f"SELECT {first}, {days}, {', '.join(others)}, {bucket} AS {status} FROM {silver} "
            f"WHERE {days} < {within_days} ORDER BY {days}, job_url")


def view_sql(silver: str, database: str, as_of=None) -> dict[str, str]:
    """View name -> SELECT text over the table ``silver``; the dashboard reads three of the
    other views in ``database``, so it comes last."""
    today = "current_date()" if as_of is None else f"DATE '{as_of}'"
    by_dimension = f"{_COMPANIES} AS company_count, {_AVERAGES}, {_pct(_PAID, _JOBS)} AS salary_coverage_pct"
    expiry = _bucket("days_left", [("< 0", B.EXPIRED), ("= 0", B.EXPIRES_TODAY), ("<= 3", B.EXPIRES_VERY_SOON),
                                   ("<= 7", B.EXPIRES_SOON), ("<= 14", B.EXPIRES_1_2_WEEKS)], B.MORE_THAN_2_WEEKS)
    posting = _bucket("days_since_posted", [("< 1", B.POSTED_TODAY), ("<= 3", B.POSTED_1_3_DAYS),
                                            ("<= 7", B.POSTED_WEEK), ("<= 14", B.POSTED_2_WEEKS)], B.POSTED_OLDER)
    views = {
        "v_job_market_overview":
            f"SELECT {_JOBS} AS total_active_listings, {_COMPANIES} AS total_companies, {_PAID} AS listings_with_salary, "
            f"{_pct(_PAID, _JOBS)} AS salary_coverage_pct, {today} AS snapshot_date FROM {silver}",
        "v_jobs_by_location": _segments(silver, ["location"], f"{_COMPANIES} AS company_count, {_AVERAGES}, "
                                                              f"{_PAID} AS listings_with_salary"),
        "v_jobs_by_contract_type": _segments(silver, ["contract_type"], by_dimension),
        "v_jobs_by_work_mode": _segments(silver, ["work_mode"], by_dimension),
        "v_jobs_by_level": _segments(silver, ["job_level"], by_dimension),
        # Quartiles over a histogram of salaries, apart from the distinct count.
        "v_salary_insights":
            f"WITH paid AS (SELECT job_listing_id, min_salary, max_salary FROM {silver} WHERE min_salary IS NOT NULL), "
            "counts AS (SELECT COUNT(DISTINCT job_listing_id) AS job_count FROM paid), "
            f"averages AS (SELECT {_AVERAGES}, ROUND(MIN(min_salary), 0) AS min_salary_lowest, "
            "ROUND(MAX(max_salary), 0) AS max_salary_highest FROM paid), "
            "quartiles AS (SELECT percentile(min_salary, array(0.25, 0.5, 0.75), n) AS q FROM "
            "(SELECT min_salary, COUNT(*) AS n FROM paid GROUP BY min_salary)) "
            "SELECT 'Overall Market' AS segment, job_count, avg_min_salary, avg_max_salary, min_salary_lowest, "
            "max_salary_highest, ROUND(CAST(get(q, 0) AS DOUBLE), 0) AS q1_min_salary, "
            "ROUND(CAST(get(q, 1) AS DOUBLE), 0) AS median_min_salary, "
            "ROUND(CAST(get(q, 2) AS DOUBLE), 0) AS q3_min_salary "
            "FROM (SELECT 1 AS one, * FROM counts) JOIN (SELECT 1 AS one, * FROM averages) USING (one) "
            "JOIN (SELECT 1 AS one, * FROM quartiles) USING (one)",
        "v_top_technologies":
            f"SELECT technology, job_count, "
            f"{_pct('job_count', f'(SELECT {_JOBS} FROM {silver})')} AS pct_of_all_jobs, company_count FROM ("
            f"SELECT technology, {_JOBS} AS job_count, {_COMPANIES} AS company_count FROM ("
            f"SELECT TRIM(item) AS technology, job_listing_id, company_name FROM {silver} "
            "LATERAL VIEW EXPLODE(SPLIT(expected_technologies, ',')) AS item "
            "WHERE expected_technologies <> '') GROUP BY technology HAVING job_count > 5) "
            "ORDER BY job_count DESC, technology LIMIT 50",
        "v_jobs_expiring_soon": _details(silver, "days_left", 7, expiry, "expiry_status"),
        "v_top_hiring_companies":
            f"SELECT company_name, {_JOBS} AS open_positions, COUNT(DISTINCT job_title) AS unique_roles, {_AVERAGES}, "
            f"MAX(job_title) AS sample_role FROM {silver} WHERE company_name IS NOT NULL GROUP BY company_name "
            "HAVING open_positions >= 2 ORDER BY open_positions DESC, company_name LIMIT 50",
        "v_market_heatmap": _segments(silver, ["location", "work_mode"], _AVERAGES),
        "v_jobs_just_posted": _details(silver, "days_since_posted", 7, posting, "posting_status"),
        "v_jobs_summary": "SELECT company_name, job_title, min_salary_mth, max_salary_mth, days_left, work_mode, "
                          f"contract_type FROM {silver}",
    }
    metrics = [("=== GOLD LAYER SUMMARY ===", "''"), ("Total Active Listings", "total"),
               ("Listings with Salary Data", "with_salary")]
    for label, key, view in (("Top Location", "location", "v_jobs_by_location"),
                             ("Most Common Work Mode", "work_mode", "v_jobs_by_work_mode"),
                             ("Top Technology", "technology", "v_top_technologies")):
        metrics.append((label, f"(SELECT {key} FROM {database}.{view} ORDER BY job_count DESC, {key} LIMIT 1)"))
    structs = ", ".join(f"named_struct('metric', '{label}', 'value', CAST({value} AS STRING))" for label, value in metrics)
    views["gold_dashboard"] = (f"SELECT inline(array({structs})) FROM (SELECT COUNT(*) AS total, "
                               f"COUNT_IF(min_salary IS NOT NULL) AS with_salary FROM {silver})")
    return views
