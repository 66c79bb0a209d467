"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the tables, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` an optional comma-separated choice of registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fraudlens.plans import queries as q  # noqa: E402
from fraudlens.plans import forest, training  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "parse_events", "minute_windows", "tumbling_windows", "alerts_built", "alert_detail",
    "alerts_filtered_page", "velocity", "velocity_trend_n", "actor_rollup", "training_features",
    "training_features_orders", "serving_features", "sequence_position", "anchored_groups",
    "alert_labels", "label_explode_join", "per_class_metrics", "ingest_rate_report",
    "detection_report", "stream_windows", "stream_alerts",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def scoring_rate(spark: SparkSession) -> dict:
    """Score every (actor, day) group with a saved model in one job, and one actor from its transactions."""
    path = q.fresh_path(spark, "bench")
    model = q._fitted(spark, SF_DIR, path)
    groups = q.daily_windows(spark, SF_DIR)
    rows = groups.count()
    scorer = training.model_scorer(model)
    seconds = timed(lambda: run(training.score_groups(groups, scorer)))
    flat = forest.forest_scorer(forest.flat_forest(model, f"{path}/model", spark))
    flat_seconds = timed(lambda: run(training.score_groups(groups, flat)))
    actors = q.actor_groups(spark, SF_DIR)
    first = timed(lambda: training.score_actor(actors, flat, "A1").collect())
    # a service goes on answering: the next ten calls, each for another actor
    single = timed(lambda: [training.score_actor(actors, flat, f"A{i}").collect() for i in range(2, 12)]) / 10
    return {
        "rows": rows, "seconds": seconds, "predictions_per_min": round(rows / seconds * 60),
        "flat_forest_seconds": flat_seconds, "flat_forest_predictions_per_min": round(rows / flat_seconds * 60),
        "first_single_actor_seconds": first, "single_actor_seconds": round(single, 3), "single_actor_per_min": round(60 / single),
    }


def main() -> None:
    spark = session()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    run(q.QUERIES["class_distribution"](spark, SF_DIR))  # start the session's executors
    seconds = {"store_alert_tables": timed(lambda: q.alert_tables(spark, SF_DIR))}
    for name in names:
        seconds[name] = timed(lambda: run(q.QUERIES[name](spark, SF_DIR)))
    scoring = {} if chosen else scoring_rate(spark)
    if scoring:
        seconds["batch_scoring"] = scoring["seconds"]
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    rates = {
        f"{name}_events_per_sec": round(events / seconds[name])
        for name in ("parse_events", "minute_windows", "training_features", "serving_features", "anchored_groups")
        if name in seconds
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "scoring": scoring,
                "rates": rates,
            }
        )
    )


if __name__ == "__main__":
    main()
