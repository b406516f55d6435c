"""Independent ANSI-SQL restatements (DuckDB dialect) of the registered queries.

These are the correctness oracle: the same fixture derivation, cleaning rules and
views written directly in SQL over the driver's pre-registered tables, with no code
shared with the Spark plans.  Rounding of percentages is done in exact integer
arithmetic (HALF_UP), matching decimal arithmetic on the Spark side.
"""

from __future__ import annotations

AS_OF = "DATE '1998-06-01'"
RUN_TS = "1998-06-01 02:00:00"
LATER_TS = "1998-06-02 02:00:00"

# Month names of the listing dates, in calendar order.
_EN = "['January','February','March','April','May','June','July','August','September','October','November','December']"
_PL = ("['stycznia','lutego','marca','kwietnia','maja','czerwca','lipca','sierpnia','września',"
       "'października','listopada','grudnia']")


def _date_text(d: str, english_mod: int, upper_mod: int) -> str:
    name = f"(CASE WHEN k % {english_mod} = 0 THEN {_EN}[month({d})] ELSE {_PL}[month({d})] END)"
    name = f"(CASE WHEN k % {upper_mod} = 0 THEN upper({name}) ELSE {name} END)"
    return f"(CAST(day({d}) AS VARCHAR) || ' ' || {name} || ' ' || CAST(year({d}) AS VARCHAR))"


_RAW = f"""
techs AS (
  SELECT l_orderkey, string_agg(p_name, ', ' ORDER BY p_name) AS expected_technologies
  FROM (SELECT DISTINCT l_orderkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey) lp
  GROUP BY l_orderkey
),
base AS (
  SELECT o.o_orderkey AS k, o.o_orderpriority, o.o_orderstatus, o.o_totalprice,
         CAST(o.o_orderdate AS DATE) AS od, DATE '1998-06-01' - CAST(o.o_orderkey % 40 AS INTEGER) AS pd,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS t,
         c.c_name, c.c_mktsegment, n.n_name, r.r_name, tt.expected_technologies,
         '7f000001-0a0b-4c0d-8e0f-' || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0') AS uuid
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN techs tt ON o.o_orderkey = tt.l_orderkey
),
urls AS (
  SELECT *, 'https://theprotocol.it/szczegoly/praca/oferta,' ||
            CASE WHEN k % 23 = 0 THEN upper(uuid) ELSE uuid END AS job_url
  FROM base
),
raw AS (
  SELECT
    k,
    NULLIF(regexp_extract(job_url, '([a-f0-9]{{8}}-[a-f0-9]{{4}}-[a-f0-9]{{4}}-[a-f0-9]{{4}}-[a-f0-9]{{12}})', 1), '') AS job_listing_id,
    CASE WHEN k % 13 <> 0 THEN ['Data Analyst','BI Developer','Data Engineer','Analytics Engineer'][k % 4 + 1]
         || ' (' || o_orderpriority || ')' END AS job_title,
    CASE WHEN k % 41 = 0 THEN '31 lutego ' || CAST(year(od) AS VARCHAR)
         WHEN k % 17 = 0 THEN CAST(day(od) AS VARCHAR) || ' gru ' || CAST(year(od) AS VARCHAR)
         WHEN k % 9 = 0 THEN '  ' || {_date_text('od', 2, 11)} || ' '
         ELSE {_date_text('od', 2, 11)} END AS expiration_date,
    {_date_text('pd', 3, 7)} AS job_posting_date,
    CASE WHEN k % 29 <> 0 THEN c_name END AS company_name,
    CASE WHEN k % 31 = 0 THEN NULL
         WHEN k % 7 = 0 THEN 'Oferta w wielu lokalizacjach'
         WHEN k % 7 = 3 THEN 'Multiple locations offer: ' || n_name
         ELSE n_name END AS location,
    concat_ws(', ', r_name, n_name) AS address_1,
    CASE WHEN k % 2 = 1 THEN 'Zmyslona ' || CAST(k % 100 AS VARCHAR) END AS address_2,
    CASE WHEN k % 5 <> 4 THEN ['zdalna','hybrydowa','Stacjonarna, Zdalna','hybrydowa,zdalna,'][k % 5 + 1] END AS work_mode,
    CASE WHEN k % 19 <> 0 THEN ['junior','mid','senior','mid • senior'][k % 4 + 1] END AS job_level,
    CASE WHEN k % 37 <> 0 THEN ['kontrakt B2B (pełny etat)','umowa o pracę (pełny etat)',
         'kontrakt B2B (część etatu, pełny etat)','kontrakt B2B','B2B','umowa zlecenie'][k % 6 + 1] END AS contract_type,
    CASE WHEN k % 3 = 0 THEN NULL
         WHEN k % 10 = 1 THEN CAST(t AS VARCHAR) || chr(160) || '000 - ' || CAST(t + 5 AS VARCHAR) || chr(160) || '500'
         WHEN k % 10 = 2 THEN CAST(t AS VARCHAR) || ',5 - ' || CAST(t + 5 AS VARCHAR) || ',9'
         WHEN k % 10 = 4 THEN CAST(t AS VARCHAR) || ' 000 ' || chr(8211) || ' ' || CAST(t + 5 AS VARCHAR) || ' 500'
         WHEN k % 10 = 5 THEN 'null - ' || CAST(t AS VARCHAR)
         WHEN k % 10 = 7 THEN CAST(t AS VARCHAR) || chr(8239) || '000-' || CAST(t + 5 AS VARCHAR) || chr(8201) || '000'
         ELSE CAST(t AS VARCHAR) || ' 000 - ' || CAST(t + 5 AS VARCHAR) || ' 500' END AS remuneration,
    CASE WHEN k % 3 <> 0 THEN ['mth','mies.','hr','godz.','netto / day'][k % 5 + 1] END AS frequency,
    CASE WHEN k % 3 <> 0 THEN CASE WHEN k % 2 = 0 THEN 'brutto' ELSE 'netto' END END AS gross_or_net,
    expected_technologies,
    'Segment ' || coalesce(c_mktsegment, '?') || ' | Priority ' || o_orderpriority AS requirements,
    'Status ' || o_orderstatus AS responsibilities,
    '{RUN_TS}' AS ingestion_timestamp,
    '1998-06-01' AS ingestion_date,
    job_url
  FROM urls
)"""

LANDING_COLS = ("job_listing_id, job_title, expiration_date, job_posting_date, company_name, location, "
                "address_1, address_2, work_mode, job_level, contract_type, remuneration, frequency, "
                "gross_or_net, expected_technologies, requirements, responsibilities, "
                "ingestion_timestamp, ingestion_date, job_url")


def _month_case(x: str) -> str:
    names = ["january", "february", "march", "april", "may", "june", "july", "august",
             "september", "october", "november", "december",
             "stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca",
             "sierpnia", "września", "października", "listopada", "grudnia"]
    whens = " ".join(f"WHEN '{n}' THEN '{(i % 12) + 1:02d}'" for i, n in enumerate(names))
    return f"(CASE lower({x}) {whens} END)"


def convert_date_sql(x: str) -> str:
    """SQL text: raw date -> 'YYYY-MM-DD' string or NULL."""
    parts = f"regexp_split_to_array(trim({x}), '\\s+')"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' OR len({parts}) <> 3 OR {_month_case(parts + '[2]')} IS NULL "
            f"THEN NULL ELSE {parts}[3] || '-' || {_month_case(parts + '[2]')} || '-' || "
            f"CASE WHEN length({parts}[1]) < 2 THEN '0' || {parts}[1] ELSE {parts}[1] END END)")


def salary_side_sql(g: str) -> str:
    v = f"TRY_CAST(replace(replace(trim({g}), ' ', ''), ',', '.') AS DOUBLE)"
    return f"TRY_CAST(trunc({v}) AS INTEGER)"


_SAL_RE = "'([\\d\\s,]+)\\s*-\\s*([\\d\\s,]+)'"


def _norm_spaces(x: str) -> str:
    return f"replace(replace(replace({x}, chr(160), ' '), chr(8201), ' '), chr(8239), ' ')"


def work_modes_sql(x: str) -> str:
    item = "lower(trim(m))"
    mapped = (f"coalesce(CASE {item} WHEN 'hybrydowa' THEN 'hybrid' WHEN 'zdalna' THEN 'remote' "
              f"WHEN 'stacjonarna' THEN 'full office' END, {item})")
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE "
            f"array_to_string(list_transform(string_split({x}, ','), lambda m: {mapped}), ', ') END)")


def contract_sql(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE coalesce(CASE {x} "
            "WHEN 'kontrakt B2B (pełny etat)' THEN 'B2B contract (full-time)' "
            "WHEN 'umowa o pracę (pełny etat)' THEN 'contract of employment (full-time)' "
            "WHEN 'kontrakt B2B (część etatu, pełny etat)' THEN 'B2B contract (part-time, full-time)' "
            f"WHEN 'kontrakt B2B' THEN 'B2B contract' END, {x}) END)")


def frequency_sql(x: str) -> str:
    f = f"lower(trim({x}))"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL "
            f"WHEN contains({f}, 'mth') OR contains({f}, 'mies') THEN 'monthly' "
            f"WHEN contains({f}, 'hr') OR contains({f}, 'godz') THEN 'hourly' ELSE {x} END)")


def location_sql(x: str) -> str:
    return (f"(CASE WHEN contains({x}, 'Oferta w wielu lokalizacjach') OR contains({x}, 'Multiple locations offer') "
            f"THEN 'Multiple locations' ELSE {x} END)")


def level_sql(x: str) -> str:
    return f"trim(replace({x}, '•', ','))"


_VALIDATION = " || ".join(
    f"CASE WHEN {c} IS NULL THEN 'Missing {c}, ' ELSE '' END"
    for c in ["job_listing_id", "job_title", "company_name", "job_level", "contract_type"])

_CLEAN = f"""
validated AS (
  SELECT *, {_VALIDATION} AS validation_errors FROM raw
),
parsed AS (
  SELECT *,
    TRY_CAST({convert_date_sql('expiration_date')} AS DATE) AS exp_d,
    TRY_CAST({convert_date_sql('job_posting_date')} AS DATE) AS post_d,
    {frequency_sql('frequency')} AS freq,
    {salary_side_sql(f"regexp_extract({_norm_spaces('remuneration')}, {_SAL_RE}, 1)")} AS lo,
    {salary_side_sql(f"regexp_extract({_norm_spaces('remuneration')}, {_SAL_RE}, 2)")} AS hi
  FROM validated WHERE validation_errors = ''
),
cleaned AS (
  SELECT *,
    CASE WHEN remuneration IS NOT NULL AND remuneration <> '' AND NOT contains(lower(remuneration), 'null')
              AND lo IS NOT NULL AND hi IS NOT NULL THEN lo END AS min_s,
    CASE WHEN remuneration IS NOT NULL AND remuneration <> '' AND NOT contains(lower(remuneration), 'null')
              AND lo IS NOT NULL AND hi IS NOT NULL THEN hi END AS max_s
  FROM parsed
),
all_clean AS (
  SELECT
    job_listing_id,
    CAST(date_diff('day', post_d, {AS_OF}) AS INTEGER) AS days_since_posted,
    company_name, job_title,
    CAST(date_diff('day', {AS_OF}, exp_d) AS INTEGER) AS days_left,
    expected_technologies,
    min_s AS min_salary, max_s AS max_salary,
    CASE WHEN freq = 'monthly' THEN min_s END AS min_salary_mth,
    CASE WHEN freq = 'monthly' THEN max_s END AS max_salary_mth,
    CASE WHEN freq = 'hourly' THEN min_s END AS min_salary_hr,
    CASE WHEN freq = 'hourly' THEN max_s END AS max_salary_hr,
    freq AS frequency,
    {location_sql('location')} AS location,
    address_1, address_2,
    {contract_sql('contract_type')} AS contract_type,
    {level_sql('job_level')} AS job_level,
    {work_modes_sql('work_mode')} AS work_mode,
    responsibilities, requirements, ingestion_date, ingestion_timestamp,
    post_d AS job_posting_date, exp_d AS expiration_date, remuneration, job_url,
    CAST(NULL AS VARCHAR) AS source_file
  FROM cleaned
),
silver AS (
  SELECT * FROM all_clean WHERE days_left >= 0
)"""

SILVER_COLS = ("job_listing_id, days_since_posted, company_name, job_title, days_left, expected_technologies, "
               "min_salary, max_salary, min_salary_mth, max_salary_mth, min_salary_hr, max_salary_hr, "
               "frequency, location, address_1, address_2, contract_type, job_level, work_mode, "
               "responsibilities, requirements, ingestion_date, ingestion_timestamp, job_posting_date, "
               "expiration_date, remuneration, job_url, source_file")


def with_silver(body: str) -> str:
    return f"WITH {_RAW},{_CLEAN}\n{body}"


def with_raw(body: str) -> str:
    return f"WITH {_RAW}\n{body}"


def pct_sql(n: str, d: str) -> str:
    """HALF_UP rounding of n*100/d to 2 decimals, exactly, as DOUBLE."""
    return f"(CAST(({n} * 20000 + ({d})) // (2 * NULLIF({d}, 0)) AS DOUBLE) / 100)"


_CD = "COUNT(DISTINCT job_listing_id)"
_CD_SAL = "COUNT(DISTINCT CASE WHEN min_salary IS NOT NULL THEN job_listing_id END)"
_AVGS = ("ROUND(AVG(min_salary), 0) AS avg_min_salary, ROUND(AVG(max_salary), 0) AS avg_max_salary")


def _dimension_view(key: str) -> str:
    return with_silver(f"""
SELECT {key}, {_CD} AS job_count, COUNT(DISTINCT company_name) AS company_count, {_AVGS},
       {pct_sql(_CD_SAL, _CD)} AS salary_coverage_pct
FROM silver WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY job_count DESC, {key}""")


_TECH = """tech AS (
  SELECT trim(item) AS technology, job_listing_id, company_name FROM (
    SELECT unnest(string_split(expected_technologies, ',')) AS item, job_listing_id, company_name
    FROM silver WHERE expected_technologies IS NOT NULL AND expected_technologies <> '') x
),
top_tech AS (
  SELECT technology, COUNT(DISTINCT job_listing_id) AS job_count,
         COUNT(DISTINCT company_name) AS company_count
  FROM tech GROUP BY technology HAVING COUNT(DISTINCT job_listing_id) > 5
  ORDER BY job_count DESC, technology LIMIT 50
)"""

_DETAIL = ("company_name, {day_col}, job_title, min_salary, max_salary, expected_technologies, "
           "responsibilities, requirements, location, work_mode, contract_type, job_url")


def _expiry_case(d: str) -> str:
    return (f"CASE WHEN {d} < 0 THEN 'Expired' WHEN {d} = 0 THEN 'Expires Today' "
            f"WHEN {d} <= 3 THEN 'Expires Very Soon (1-3 days)' WHEN {d} <= 7 THEN 'Expires Soon (4-7 days)' "
            f"WHEN {d} <= 14 THEN 'Expires in 1-2 weeks' ELSE 'More than 2 weeks left' END")


def _posting_case(d: str) -> str:
    return (f"CASE WHEN {d} < 1 THEN 'Be an early applicant - posted Today!' "
            f"WHEN {d} <= 3 THEN 'Be an early applicant - only 1-3 days old!' "
            f"WHEN {d} <= 7 THEN 'Get in now  - less than a week old!' "
            f"WHEN {d} <= 14 THEN 'Been over a week now - get your skates on!' "
            f"ELSE 'More than 2 weeks old - what are you waiting for?' END")


def gold_sql() -> dict[str, str]:
    q = {}
    q["v_job_market_overview"] = with_silver(f"""
SELECT {_CD} AS total_active_listings, COUNT(DISTINCT company_name) AS total_companies,
       {_CD_SAL} AS listings_with_salary, {pct_sql(_CD_SAL, _CD)} AS salary_coverage_pct,
       {AS_OF} AS snapshot_date
FROM silver""")
    q["v_jobs_by_location"] = with_silver(f"""
SELECT location, {_CD} AS job_count, COUNT(DISTINCT company_name) AS company_count, {_AVGS},
       {_CD_SAL} AS listings_with_salary
FROM silver WHERE location IS NOT NULL GROUP BY location ORDER BY job_count DESC, location""")
    q["v_jobs_by_contract_type"] = _dimension_view("contract_type")
    q["v_jobs_by_work_mode"] = _dimension_view("work_mode")
    q["v_jobs_by_level"] = _dimension_view("job_level")
    q["v_salary_insights"] = with_silver(f"""
SELECT 'Overall Market' AS segment, {_CD} AS job_count, {_AVGS},
       CAST(MIN(min_salary) AS INTEGER) AS min_salary_lowest,
       CAST(MAX(max_salary) AS INTEGER) AS max_salary_highest,
       ROUND(CAST(quantile_cont(min_salary, 0.25) AS DOUBLE), 0) AS q1_min_salary,
       ROUND(CAST(quantile_cont(min_salary, 0.5) AS DOUBLE), 0) AS median_min_salary,
       ROUND(CAST(quantile_cont(min_salary, 0.75) AS DOUBLE), 0) AS q3_min_salary
FROM silver WHERE min_salary IS NOT NULL""")
    q["v_top_technologies"] = with_silver(f""",{_TECH}
SELECT technology, job_count,
       {pct_sql('job_count', '(SELECT COUNT(DISTINCT job_listing_id) FROM silver)')} AS pct_of_all_jobs,
       company_count
FROM top_tech ORDER BY job_count DESC, technology""")
    q["v_jobs_expiring_soon"] = with_silver(f"""
SELECT {_DETAIL.format(day_col='days_left')}, {_expiry_case('days_left')} AS expiry_status
FROM silver WHERE days_left < 7 ORDER BY days_left, job_url""")
    q["v_top_hiring_companies"] = with_silver(f"""
SELECT company_name, {_CD} AS open_positions, COUNT(DISTINCT job_title) AS unique_roles, {_AVGS},
       MAX(job_title) AS sample_role
FROM silver WHERE company_name IS NOT NULL GROUP BY company_name
HAVING COUNT(DISTINCT job_listing_id) >= 2 ORDER BY open_positions DESC, company_name LIMIT 50""")
    q["v_market_heatmap"] = with_silver(f"""
SELECT location, work_mode, {_CD} AS job_count, {_AVGS}
FROM silver WHERE location IS NOT NULL AND work_mode IS NOT NULL
GROUP BY location, work_mode ORDER BY job_count DESC, location, work_mode""")
    q["v_jobs_just_posted"] = with_silver(f"""
SELECT {_DETAIL.format(day_col='days_since_posted')}, {_posting_case('days_since_posted')} AS posting_status
FROM silver WHERE days_since_posted < 7 ORDER BY days_since_posted, job_url""")
    q["v_jobs_summary"] = with_silver("""
SELECT company_name, job_title, min_salary_mth, max_salary_mth, days_left, work_mode, contract_type
FROM silver""")
    q["gold_dashboard"] = with_silver(f""",{_TECH}
SELECT '=== GOLD LAYER SUMMARY ===' AS metric, '' AS value
UNION ALL SELECT 'Total Active Listings', CAST((SELECT COUNT(*) FROM silver) AS VARCHAR)
UNION ALL SELECT 'Listings with Salary Data', CAST((SELECT COUNT(*) FROM silver WHERE min_salary IS NOT NULL) AS VARCHAR)
UNION ALL SELECT 'Top Location', (SELECT location FROM silver WHERE location IS NOT NULL GROUP BY location
                                  ORDER BY COUNT(DISTINCT job_listing_id) DESC, location LIMIT 1)
UNION ALL SELECT 'Most Common Work Mode', (SELECT work_mode FROM silver WHERE work_mode IS NOT NULL GROUP BY work_mode
                                  ORDER BY COUNT(DISTINCT job_listing_id) DESC, work_mode LIMIT 1)
UNION ALL SELECT 'Top Technology', (SELECT technology FROM top_tech ORDER BY job_count DESC, technology LIMIT 1)""")
    return q


_RELISTED = """
,relisted AS (
  SELECT * FROM silver
  UNION ALL
  SELECT * REPLACE (min_salary + 1000 AS min_salary,
                    expected_technologies || ',,Relisting, Relisting' AS expected_technologies)
  FROM silver WHERE ascii(right(job_listing_id, 1)) % 3 = 0)
"""


def relisted_sql() -> dict[str, str]:
    """The aggregating views over a Silver that holds some listings twice."""
    head = with_silver("")
    return {f"relisted_{name}": head + _RELISTED + sql.removeprefix(head).replace("FROM silver", "FROM relisted")
            for name, sql in gold_sql().items()
            if name not in ("v_jobs_summary", "v_jobs_expiring_soon", "v_jobs_just_posted")}


def silver_sql() -> dict[str, str]:
    return {"silver_listings": with_silver(f"SELECT {SILVER_COLS} FROM silver")}




def _rule(raw: str, expr: str, out: str) -> str:
    return with_raw(f"SELECT job_url, {raw}, {expr} AS {out} FROM raw")


_STAGE = f"""
SELECT COUNT(*) AS bronze,
       COUNT(*) FILTER (WHERE validation_errors = '') AS valid,
       COUNT(*) FILTER (WHERE validation_errors <> '') AS dropped,
       COUNT(*) FILTER (WHERE validation_errors = '') AS before_filter,
       COUNT(*) FILTER (WHERE validation_errors = '' AND
             date_diff('day', {AS_OF}, TRY_CAST({convert_date_sql('expiration_date')} AS DATE)) >= 0) AS after_filter,
       COUNT(*) FILTER (WHERE validation_errors = '' AND
             TRY_CAST({convert_date_sql('expiration_date')} AS DATE) IS NULL) AS unparsed_expiry
FROM validated"""

_DROPPED = f"""
SELECT job_listing_id, job_title, company_name, validation_errors AS reason_dropped, ingestion_timestamp,
       TIMESTAMP '{RUN_TS}' AS validation_timestamp, DATE '1998-06-01' AS validation_date
FROM validated WHERE validation_errors <> ''"""

_LANDING = [c.strip() for c in LANDING_COLS.split(",")]


def operator_sql() -> dict[str, str]:
    q = {}
    q["convert_date"] = with_raw(f"""
SELECT job_url, expiration_date AS expiration_raw, {convert_date_sql('expiration_date')} AS expiration_iso,
       TRY_CAST({convert_date_sql('expiration_date')} AS DATE) AS expiration_date,
       job_posting_date AS posting_raw, {convert_date_sql('job_posting_date')} AS posting_iso,
       TRY_CAST({convert_date_sql('job_posting_date')} AS DATE) AS job_posting_date
FROM raw""")
    ok = "remuneration IS NOT NULL AND remuneration <> '' AND NOT contains(lower(remuneration), 'null')"
    lo = salary_side_sql(f"regexp_extract({_norm_spaces('remuneration')}, {_SAL_RE}, 1)")
    hi = salary_side_sql(f"regexp_extract({_norm_spaces('remuneration')}, {_SAL_RE}, 2)")
    q["extract_salary_range"] = with_raw(f"""
SELECT job_url, remuneration,
       CASE WHEN {ok} AND {hi} IS NOT NULL THEN {lo} END AS min_salary,
       CASE WHEN {ok} AND {lo} IS NOT NULL THEN {hi} END AS max_salary
FROM raw""")
    q["translate_frequency"] = _rule("frequency", frequency_sql("frequency"), "frequency_clean")
    q["translate_work_modes"] = _rule("work_mode", work_modes_sql("work_mode"), "work_mode_clean")
    q["translate_contract_type"] = _rule("contract_type", contract_sql("contract_type"), "contract_type_clean")
    q["clean_location"] = _rule("location", location_sql("location"), "location_clean")
    q["clean_job_level"] = _rule("job_level", level_sql("job_level"), "job_level_clean")
    q["listing_id"] = with_raw("SELECT job_url, job_listing_id FROM raw")
    q["validation_errors"] = with_raw(f"SELECT job_url, {_VALIDATION} AS validation_errors FROM raw")
    q["expiry_bucket"] = with_silver(
        f"SELECT job_url, days_left, {_expiry_case('days_left')} AS expiry_status FROM all_clean")
    q["posting_bucket"] = with_silver(
        f"SELECT job_url, days_since_posted, {_posting_case('days_since_posted')} AS posting_status FROM all_clean")
    q["salary_by_frequency"] = with_silver(
        "SELECT job_url, frequency, min_salary, max_salary, min_salary_mth, max_salary_mth, "
        "min_salary_hr, max_salary_hr FROM all_clean")
    q["dropped_records"] = with_silver(_DROPPED)
    q["drop_reasons"] = with_silver(f"SELECT reason_dropped, COUNT(*) AS count FROM ({_DROPPED}) d GROUP BY reason_dropped")
    q["stage_counts"] = with_silver(_STAGE)
    q["reconcile"] = with_silver(f"""
SELECT bronze, dropped, before_filter - after_filter AS filtered, after_filter AS silver,
       bronze - dropped - (before_filter - after_filter) AS expected,
       abs(after_filter - (bronze - dropped - (before_filter - after_filter))) AS difference,
       CASE WHEN after_filter = bronze - dropped - (before_filter - after_filter) THEN 'PASSED' ELSE 'WARNING' END AS status
FROM ({_STAGE}) s""")
    q["reconcile_reference"] = with_silver(f"""
SELECT bronze, dropped, before_filter - after_filter AS filtered, after_filter AS silver,
       bronze - dropped AS expected, abs(after_filter - (bronze - dropped)) AS difference,
       CASE WHEN after_filter = bronze - dropped THEN 'PASSED' ELSE 'WARNING' END AS status
FROM ({_STAGE}) s""")
    q["run_summary"] = with_silver(f"""
SELECT bronze AS processed, dropped, before_filter - after_filter AS filtered, after_filter AS loaded
FROM ({_STAGE}) s""")
    q["layer_counts"] = with_silver("""
SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM raw
UNION ALL SELECT 'dropped_records_log', COUNT(*) FROM validated WHERE validation_errors <> ''
UNION ALL SELECT 'silver', COUNT(*) FROM silver""")
    unions = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, COUNT(*) AS row_count FROM raw"
        for c in _LANDING)
    q["profile_nulls"] = with_raw(unions)
    meta = (f"'derived:orders' AS source_file, TIMESTAMP '{RUN_TS}' AS _bronze_ingestion_time, "
            "DATE '1998-06-01' AS _record_processed_date")
    q["bronze_metadata"] = with_raw(f"SELECT {LANDING_COLS}, {meta} FROM raw")
    q["bronze_summary"] = with_raw(f"""
SELECT 'ETL Bronze Complete' AS status, TIMESTAMP '{RUN_TS}' AS completion_time,
       COUNT(DISTINCT job_listing_id) AS total_unique_jobs, TIMESTAMP '{RUN_TS}' AS last_loaded FROM raw""")
    q["explode_technologies"] = with_silver(""",
tech AS (
  SELECT trim(item) AS technology, job_listing_id, company_name FROM (
    SELECT unnest(string_split(expected_technologies, ',')) AS item, job_listing_id, company_name
    FROM silver WHERE expected_technologies IS NOT NULL AND expected_technologies <> '') x
)
SELECT technology, job_listing_id, company_name FROM tech""")
    other = ", ".join(c for c in _LANDING if c not in ("job_title", "ingestion_timestamp"))
    q["dedup_latest"] = with_raw(f"""
, snaps AS (
  SELECT {LANDING_COLS}, 'snapshot_a.csv' AS source_file FROM raw
  UNION ALL BY NAME
  SELECT {other.replace('job_listing_id, ', 'job_listing_id, job_title || \' [re-listed]\' AS job_title, ')},
         CASE WHEN k % 2 = 0 THEN '{LATER_TS}' ELSE '1998-05-31 02:00:00' END AS ingestion_timestamp,
         'snapshot_b.csv' AS source_file FROM raw
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY job_listing_id
            ORDER BY ingestion_timestamp DESC, source_file DESC, job_url DESC) AS rn FROM snaps
)
SELECT {LANDING_COLS}, source_file FROM ranked WHERE job_listing_id IS NULL OR rn = 1""")
    return q



def landing_sql() -> dict[str, str]:
    return {"latest_snapshot": with_raw(
        f"SELECT {LANDING_COLS}, TIMESTAMP '{RUN_TS}' AS snapshot_ts FROM raw")}



def _decode(x: str) -> str:
    """Decode the entities that occur in the pages: named references with ';', and the
    legacy form without ';' when no letter or digit follows (e.g. a title cut after
    '&amp').  '&amp' is decoded last so '&amp;quot;' stays '&quot;'."""
    out = x
    for name, char in (("quot", "'\"'"), ("copy", "chr(169)"), ("middot", "chr(183)"),
                       ("lt", "'<'"), ("gt", "'>'")):
        out = f"regexp_replace({out}, '&{name}(;|([^a-zA-Z0-9])|$)', {char} || '\\2', 'g')"
    return f"regexp_replace({out}, '&amp(;|([^a-zA-Z0-9])|$)', '&' || '\\2', 'g')"


def _pystrip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _text_nodes(fragment: str) -> str:
    """Concatenated stripped text nodes of an HTML fragment without comments/scripts."""
    pieces = f"string_split(regexp_replace({fragment}, '<[^>]*>', chr(1), 'g'), chr(1))"
    return f"array_to_string(list_transform({pieces}, lambda x: {_pystrip(_decode('x'))}), '')"


def pages_sql() -> dict[str, str]:
    q = {}
    links = ("list_filter(list_transform(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1), "
             f"lambda x: {_pystrip(_decode('x'))}), lambda x: x <> '')")
    q["html_fields"] = f"""
SELECT page_id, url,
  {_pystrip(_decode("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS title,
  {_pystrip(_decode("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS heading,
  {_text_nodes("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")} AS ad_text,
  {_text_nodes("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} AS footer_text,
  {_text_nodes("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} AS article_text,
  array_to_string({links}, ' | ') AS nav_links,
  CAST(len({links}) AS INTEGER) AS nav_count
FROM pages"""
    miss = "k % 59 = 0"
    detail_cols = f"""
  job_url,
  CASE WHEN {miss} THEN NULL ELSE trim(expiration_date) END AS expiration_date,
  CASE WHEN {miss} THEN NULL ELSE trim(job_posting_date) END AS job_posting_date,
  CASE WHEN {miss} THEN NULL ELSE job_level END AS job_level,
  CASE WHEN {miss} THEN NULL ELSE contract_type END AS contract_type,
  CASE WHEN {miss} THEN NULL ELSE remuneration END AS remuneration,
  CASE WHEN {miss} THEN NULL ELSE frequency END AS frequency,
  CASE WHEN {miss} THEN NULL ELSE gross_or_net END AS gross_or_net,
  CASE WHEN {miss} THEN '' ELSE coalesce(expected_technologies, '') END AS expected_technologies,
  CASE WHEN {miss} THEN NULL ELSE address_1 END AS address_1,
  CASE WHEN {miss} THEN NULL ELSE address_2 END AS address_2,
  CASE WHEN {miss} THEN '' ELSE requirements END AS requirements,
  CASE WHEN {miss} THEN '' ELSE responsibilities END AS responsibilities"""
    q["detail_fields"] = with_raw(f"SELECT {detail_cols} FROM raw")
    q["listing_cards"] = with_raw(
        "SELECT job_listing_id, job_url, job_title, company_name, location, work_mode FROM raw")
    q["assemble_listings"] = with_raw(f"""
, det AS (SELECT {detail_cols} FROM raw)
SELECT r.job_listing_id, r.job_title, d.expiration_date, d.job_posting_date, r.company_name, r.location,
       d.address_1, d.address_2, r.work_mode, d.job_level, d.contract_type, d.remuneration, d.frequency,
       d.gross_or_net, d.expected_technologies, d.requirements, d.responsibilities,
       r.ingestion_timestamp, r.ingestion_date, r.job_url
FROM raw r JOIN det d ON r.job_url = d.job_url""")
    return q



def streaming_sql() -> dict[str, str]:
    old_cols = LANDING_COLS.replace("job_title,", "job_title || ' [old]' AS job_title,", 1)
    return {"file_arrival_ingest": with_raw(f"""
SELECT {old_cols}, TIMESTAMP '1998-05-31 02:00:00' AS snapshot_ts FROM raw
UNION ALL SELECT {LANDING_COLS}, TIMESTAMP '{RUN_TS}' AS snapshot_ts FROM raw
UNION ALL SELECT {LANDING_COLS}, CAST(NULL AS TIMESTAMP) AS snapshot_ts FROM raw"""),
            "file_arrival_mixed_headers": with_raw(f"""
SELECT {LANDING_COLS.replace('job_posting_date', 'CASE WHEN k % 3 <> 1 THEN job_posting_date END AS job_posting_date')},
       CASE k % 3 WHEN 0 THEN TIMESTAMP '1998-05-30 02:00:00' WHEN 1 THEN TIMESTAMP '1998-05-31 02:00:00'
       ELSE TIMESTAMP '{RUN_TS}' END AS snapshot_ts FROM raw""")}



def tables_sql() -> dict[str, str]:
    q = {}
    cols = ", ".join(c.strip() for c in SILVER_COLS.split(",") if c.strip() != "source_file")
    q["silver_table"] = with_silver(f"SELECT {cols} FROM silver")
    q["registered_views"] = " UNION ALL ".join(
        f"SELECT '{name}' AS view_name, COUNT(*) AS row_count FROM ({sql})" for name, sql in gold_sql().items())
    q["drop_log_table"] = with_silver(_DROPPED)
    q["upsert_bronze"] = operator_sql()["dedup_latest"]
    miss = "k % 59 = 0"
    q["preview"] = with_silver("""
SELECT location, COUNT(DISTINCT job_listing_id) AS job_count, ROUND(AVG(min_salary), 0) AS avg_min_salary
FROM silver WHERE location IS NOT NULL GROUP BY location ORDER BY job_count DESC, location LIMIT 10""")
    landed = pages_sql()["assemble_listings"]
    nulls = ", ".join(f"nullif({c}, '') AS {c}" for c in _LANDING)
    q["flatten_lists"] = f"SELECT {nulls} FROM ({landed})"
    sizes = ", ".join(
        f"CAST(CASE WHEN {c} = '' THEN 0 ELSE len(string_split({c}, '{sep}')) END AS INTEGER) AS n_{c}"
        for c, sep in (("expected_technologies", ", "), ("requirements", " | "), ("responsibilities", " | ")))
    q["json_sink"] = f"SELECT *, {sizes} FROM ({landed})"
    run = "'unit ' || (k % 3) || chr(39) || 's' AS run_id"
    q["drop_log_republished"] = with_silver(_DROPPED.replace("AS validation_date", f"AS validation_date, {run}") + " AND k % 3 <> 0")
    q["silver_schema_merge"] = with_silver("""
SELECT 'old' AS version, job_url, CAST(min_salary AS BIGINT) AS min_salary, max_salary, CAST(NULL AS VARCHAR) AS currency,
       FALSE AS no_file FROM silver
UNION ALL
SELECT 'new', job_url, CAST(min_salary AS BIGINT) * 1000000000, max_salary, 'PLN', TRUE FROM silver WHERE min_salary IS NOT NULL""")
    q["salary_sketch"] = with_silver("""
SELECT location, COUNT(*) AS n, quartile, TRUE AS ok
FROM silver, (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE]) AS quartile)
WHERE min_salary IS NOT NULL AND location IS NOT NULL GROUP BY location, quartile""")
    rules = operator_sql()
    parts = [f"(SELECT job_url, {cols} FROM ({rules[name]}))" for name, cols in (
        ("convert_date", "expiration_iso"), ("extract_salary_range", "min_salary, max_salary"),
        ("translate_frequency", "frequency_clean"), ("translate_work_modes", "work_mode_clean"),
        ("translate_contract_type", "contract_type_clean"), ("clean_location", "location_clean"),
        ("clean_job_level", "job_level_clean"), ("listing_id", "job_listing_id AS listing_id"))]
    q["sql_functions"] = "SELECT * FROM " + " JOIN ".join(
        f"{part} p{i}" + (" USING (job_url)" if i else "") for i, part in enumerate(parts))
    q["now_functions"] = with_raw(f"""
SELECT job_url, CAST(date_diff('day', current_date, TRY_CAST({convert_date_sql('expiration_date')} AS DATE)) AS INTEGER) AS days_left,
       CAST(date_diff('day', TRY_CAST({convert_date_sql('job_posting_date')} AS DATE), current_date) AS INTEGER) AS days_since_posted
FROM raw""")
    return q


def oracle_queries() -> dict[str, str]:
    """Every oracle statement, keyed like ``registry.queries()``."""
    out: dict[str, str] = {}
    for part in (gold_sql, relisted_sql, silver_sql, operator_sql, landing_sql, pages_sql, streaming_sql, tables_sql):
        out.update(part())
    return out
