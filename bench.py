"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of cores. After a warm-up
every query is run twice into a sink that takes all rows and keeps none; the faster run counts.

``events`` is one row group, which one task reads whatever the cores, so the queries run over a copy of it in many
files, made once before the clock starts; ``readings_per_second`` and ``hops`` are the measures that the
deployment watches: readings through the whole pipeline, and the latencies that a stream's batches report.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from wardline.operators.serve import HOPS
from wardline.plans.catalog import CATALOG
from wardline.session import build_session

HEADLINES = (
    "enrich_measurements",
    "score_all_one_pass",
    "news2_pipeline",
    "half_hour_all_patients",
    "half_hour_one_patient",
    "distinct_patients",
    "stage_latency_avg",
    "served_half_hour_one_patient",
    "raw_topic",
    "upsert_topic",
    "upsert_latest",
    "unique_key_compact",
    "stored_table_by_day",
    "stream_tumble_final",
    "stream_staged_final",
    "metric_rate",
    "metric_irate",
    "metric_sum_by",
    "metric_topk",
    "tiered_table",
    "incremental_copy",
    "cdc_apply",
    "overwrite_stream_final",
    "stream_ttl",
    "metric_instant_range",
    "bucketed_half_hour",
)
#: Rows of ``events`` in a file of the copy: six times as many readings.
ROWS_PER_FILE = 8_000
READINGS_PER_EVENT = 6


def run(spark: SparkSession, name: str, sf_dir: str) -> None:
    CATALOG[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def many_files(spark: SparkSession, sf_dir: str) -> str:
    """The tables again, ``events`` in many files and the others as they are."""
    folder = tempfile.mkdtemp(prefix="wardline-bench-")
    for name in os.listdir(sf_dir):
        if name != "events.parquet":
            os.symlink(os.path.join(os.path.abspath(sf_dir), name), os.path.join(folder, name))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    files = max(1, -(-events.count() // ROWS_PER_FILE))
    events.repartition(files).write.parquet(f"{folder}/events.parquet")
    return folder


def hops(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Mean and longest latency over a stream's batches, as they report it, in seconds of the fixed clocks."""
    rows = CATALOG["stream_observed"](spark, sf_dir).collect()
    n = sum(r["n_rows"] for r in rows)
    found = {}
    for name, _, _ in HOPS:
        mean = sum(r[f"avg_{name}_latency"] * r["n_rows"] for r in rows) / n if n else 0.0
        found[f"avg_{name}"] = round(mean, 3)
        found[f"max_{name}"] = max((r[f"max_{name}_latency"] for r in rows), default=0)
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "wardline-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINES
    given, sf_dir = sf_dir, many_files(spark, sf_dir)
    n_readings = spark.read.parquet(f"{sf_dir}/events.parquet").count() * READINGS_PER_EVENT
    for _ in range(3):
        run(spark, "news2_pipeline", sf_dir)
    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            run(spark, name, sf_dir)
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"),
                "readings_per_second": {
                    name: round(n_readings / seconds[name])
                    for name in ("enrich_measurements", "news2_pipeline", "stream_tumble_final", "overwrite_stream_final")
                    if seconds.get(name)
                },
                "hops": hops(spark, sf_dir),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
