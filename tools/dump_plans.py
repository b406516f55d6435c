"""Write the physical plans of the headline queries to docs/PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]
Gold views are planned over a written Silver table (as they run in production); the
Silver plan is shown over a written Bronze table.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from offerlake.operators import dedup as D  # noqa: E402
from offerlake.plans import gold, registry  # noqa: E402
from offerlake.plans.silver import build_silver  # noqa: E402
from offerlake.session import build_session  # noqa: E402
from offerlake.sources import pages as P  # noqa: E402
from offerlake.sources.tables import pages_scan  # noqa: E402


def plan_text(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)                       # expression ids
    text = re.sub(r"file:[^\],]*/", "<dir>/", text)          # local paths
    return text


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="offerlake-plans-")
    spark = build_session("local[8]", shuffle_partitions=16)
    registry.derived_bronze(spark, sf_dir).write.mode("overwrite").parquet(f"{scratch}/bronze")
    bronze = spark.read.parquet(f"{scratch}/bronze")
    build_silver(bronze, registry.AS_OF).write.mode("overwrite").parquet(f"{scratch}/silver")
    silver = spark.read.parquet(f"{scratch}/silver")
    sections = {
        "Bronze derivation (orders, customer, nation, region, lineitem, part)": registry.derived_bronze(spark, sf_dir),
        "Silver over the Bronze table": build_silver(bronze, registry.AS_OF),
        "v_jobs_by_location": gold.v_jobs_by_location(silver),
        "v_top_technologies": gold.v_top_technologies(silver),
        "v_salary_insights": gold.v_salary_insights(silver),
        "v_jobs_expiring_soon": gold.v_jobs_expiring_soon(silver),
        "gold_dashboard": gold.gold_dashboard(silver),
        "dedup_latest over Bronze": D.dedup_latest(bronze.withColumn("source_file", bronze.job_url)),
        "html_fields over the pages table": P.generic_fields(pages_scan(spark, sf_dir)),
    }
    out = ["# Physical plans", "",
           "Generated by `tools/dump_plans.py` (adaptive plans before execution; expression ids and "
           "local paths removed).", ""]
    for title, df in sections.items():
        out += [f"## {title}", "", "```", plan_text(df).rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
