"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each figure is the median of the timed runs after one warm-up; every run plans
and executes the query anew and takes all rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tillstar.operators import clean, features, quality, scd2
from tillstar.plans import analytics, measures, reads, reports, summaries, trends
from tillstar.plans.star import SourceStar
from tillstar.session import local_session, materialize
from tillstar.sources import commerce

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CORES, shuffle_partitions=CORES, app="tillstar-bench")
    spark.sparkContext.setLogLevel("ERROR")
    star = SourceStar(spark, FOLDER)
    # The text layer that cleaning starts from, as several files; written once, outside the timing.
    bronze = materialize(commerce.blemished_order_lines(spark, FOLDER).repartition(2 * CORES))

    def history():
        changes = scd2.customer_changes(clean.fix_data_types(bronze))
        return scd2.scd2_history(changes, "customer_id", ("customer_name", "segment"), "order_date", scd2.latest_first(changes)[1:])

    queries = {
        "revenue_by_month": lambda: analytics.revenue_by_month(star),
        "revenue_by_month_of_year": lambda: analytics.revenue_by_month(star, 1997),
        "top_customers": lambda: analytics.top_customers(star),
        "top_products": lambda: analytics.top_products(star),
        "regional_performance": lambda: analytics.regional_performance(star),
        "sales_trends_daily": lambda: analytics.sales_trends(star, "daily"),
        "profitability_by_category": lambda: analytics.profitability_analysis(star),
        "kpis": lambda: analytics.get_kpis(star),
        "discount_impact": lambda: analytics.discount_impact(star),
        "monthly_growth": lambda: analytics.monthly_growth(star),
        "sales_trends_view": lambda: trends.sales_trends_view(star),
        "top_products_view": lambda: trends.top_products_view(star),
        "customer_segmentation": lambda: trends.customer_segmentation(star),
        "measures_by_segment": lambda: measures.measure_table(star, ("segment", "year")),
        "retention": lambda: measures.retention(star),
        "place_matrix": lambda: reports.place_matrix(star),
        "monthly_sales_summary": lambda: summaries.monthly_sales(star),
        "sales_lines": lambda: reads.sales_lines(star),
        "validation": lambda: quality.validate(bronze),
        "clean": lambda: clean.clean(bronze),
        "clean_and_transform": lambda: features.transform(materialize(clean.clean(bronze))),
        "scd2_history": history,
    }
    timings = {}
    for name, build in queries.items():
        seconds(build)
        timings[name] = round(statistics.median(seconds(build) for _ in range(RUNS)), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total of median query seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"), "cores": CORES,
        "shuffle_partitions": CORES, "spark": spark.version, "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
