"""Headline timings: one JSON line.

Every query is built and fully computed (all columns, into Spark's no-op sink); the figure is the
median of ``BENCH_RUNS`` runs after one warm-up. Reads ``BENCH_SF_DIR`` on ``BENCH_CPUS`` threads.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.queries import REGISTRY
from tidemark.session import create_session

HEADLINE = (
    "features_batch",
    "features_velocity",
    "features_amount",
    "features_behavioral",
    "features_device",
    "a06_roc_auc",
    "l09_evaluate",
    "l02_prepare_dataset",
    "j03_user_history",
    "j08_orphan_report",
    "k01_earliest_active_method",
    "p02_parse_messages",
    "s11_append_with_keys",
)
ONCE = (
    "features_batch_sliced",
    "j10_minority_neighbours",
    "l03_oversampled_classes",
    "r04_stream_replay",
)


def run(spark, name: str, directory: str) -> float:
    begun = time.perf_counter()
    REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = create_session(
        "bench",
        f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
        log_level="ERROR",
    )
    seconds = {}
    for name in HEADLINE:
        run(spark, name, directory)
        seconds[name] = round(statistics.median(run(spark, name, directory) for _ in range(runs)), 3)
    for name in ONCE:
        seconds[name] = round(run(spark, name, directory), 3)
    rows = spark.read.parquet(f"{directory}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "seconds for all 20 features of every event (features_batch)",
                "value": seconds["features_batch"],
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "rows_per_sec": round(rows / seconds["features_batch"]),
                "replay_rows_per_sec": round(rows / seconds["r04_stream_replay"]),
                "sf": os.path.basename(directory.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
