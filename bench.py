"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs per query
(their median counts, after one warm-up; a query that takes over eight seconds is timed once).
Results go to Spark's noop sink, so that every row and column is produced and nothing but the query
is timed.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidecart.battery import QUERIES
from tidecart.session import local_session

SLOW_SECONDS = 8

HEADLINE = [
    "latest_order_mean_by_priority", "csv_write_and_scan", "csv_mixed_encodings", "parse_number", "parse_money",
    "clean_text_documents", "parse_zoned_timestamp", "parse_short_date", "derived_features", "distinct_wide_rows",
    "latest_event_per_user", "drop_low_value_columns", "repair_groups", "fill_with_group_mean", "fill_median",
    "knn_customers", "knn_orders", "chained_equations", "outliers_lines", "exact_quantiles", "describe_all",
    "distinct_counts_documents", "correlations", "top_rows", "histogram", "recipe_product_feed", "recipe_purchases",
    "recipe_products", "recipe_marketing", "recipe_marketing_older",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or os.cpu_count()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores, int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    seconds, once = {}, []
    for name in names:
        run, _ = QUERIES[name]
        times = []
        for _ in range(runs + 1):
            if len(times) > 1 and times[-1] > SLOW_SECONDS:
                break
            start = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            spark.catalog.clearCache()
        seconds[name] = round(statistics.median(times[1:]), 3)
        once += [name] if len(times) == 2 and runs > 1 else []
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "timed_once": once, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
