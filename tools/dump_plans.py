"""Record the final (adaptive) physical plans of the main models.

Builds bronze at the given scale as Parquet (as the daily run does), then
runs silver / gold over it and prints each executed plan tree as markdown.
Usage: python tools/dump_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.operators.lookup import city_dimension  # noqa: E402
from stratum.plans import queries as Q  # noqa: E402
from stratum.plans.bronze import bronze_listings, bronze_reviews  # noqa: E402
from stratum.plans.gold import fct_revenue_by_city, fct_seasonal_trends  # noqa: E402
from stratum.plans.silver import silver_listings, silver_reviews  # noqa: E402
from stratum.session import local_session, shared_dir  # noqa: E402
from stratum.sources.tables import write_table  # noqa: E402


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)                      # expression ids
    out = []
    for line in text.splitlines():
        if "FileScan" in line and "PushedFilters" in line:   # keep what reaches the scan
            pushed = line[line.index("PushedFilters"):].split("], ", 1)[0] + "]"
            line = line[:line.index("FileScan") + len("FileScan parquet")] + " ... " + pushed
        out.append(line[:160] if "PushedFilters" not in line else line)
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    root = shared_dir(spark, "plans")
    bl = write_table(bronze_listings(Q.raw_listings(spark, sf_dir)), root, "bronze", "bronze_listings")
    br = write_table(bronze_reviews(Q.raw_reviews(spark, sf_dir)), root, "bronze", "bronze_reviews")
    sl = silver_listings(bl, city_dimension(spark), Q.AS_OF)
    sr = silver_reviews(br)
    cases = [
        ("bronze_reviews (dedupe, from the raw extract)", bronze_reviews(Q.raw_reviews(spark, sf_dir))),
        ("silver_listings over the bronze table", sl),
        ("fct_revenue_by_city over silver", fct_revenue_by_city(sl)),
        ("fct_seasonal_trends over silver", fct_seasonal_trends(sr, sl)),
    ]
    print(f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `tools/dump_plans.py`; expression ids removed, long lines cut.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
