"""Times the headline queries over whole tables and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402
from newsquake.session import build_session  # noqa: E402

HEADLINE = [
    "reaction_counts",
    "join1_first_trading_day",
    "join4_to_7_facts_as_of",
    "fn1_to_3_labelled_headlines",
    "fn6_to_18_valuation",
    "fn4_5_fused_headlines",
    "flt11_selected_headlines",
    "flt3_low_content_documents",
    "win6_7_kept_headlines",
    "win11_set5_rebalanced",
    "join16_agg5_6_threshold_grid",
    "agg2_price_percentiles",
    "agg10_accuracy",
    "join11_12_template_rows",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
