"""Times the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice over its whole tables, the second run counts. Results go to the `noop`
sink, so every row and column is computed. Queries that train models train in every run.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txguard.plans import queries  # noqa: E402
from txguard.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    # applications end to end
    "scored_batch", "scored_stream", "flagged_stream", "rule_flag_inner", "rule_flag_cascade",
    # features and profiles
    "haversine_distance", "temporal_features", "transaction_features", "behavior_features",
    "velocity_features", "asof_profile", "card_profile", "last10_avg", "customer_enrichment",
    # quality, metrics, monitoring
    "quality_report", "duplicate_transactions", "classification_metrics", "fraud_rate_windows",
    "fraud_spikes", "error_rate_windows", "stream_dedup", "stream_rate_windows",
    # sources, sinks, reports
    "src_history_typed", "src_stream_files", "decode_json_payload", "publish_json_records",
    "sink_scored_partitioned", "sink_customers", "catalog_adhoc_table", "fraud_by_category",
    "top_cards_by_fraud_amount", "pii_masked",
    # models
    "scaled_features", "rf_score", "final_status_models_on", "anomaly_by_distance",
]


def run(spark, name):
    queries._fitted.clear()
    begin = time.perf_counter()
    queries.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main():
    spark = build_session(
        "txguard-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = round(run(spark, name), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "sum of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": events,
                "rows_per_second_scored_batch": round(events / seconds["scored_batch"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
