"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    timed runs per query after one warm-up; the fastest counts (default 2)
BENCH_QUERIES "headline" (default) or "all"

Results go to Spark's no-op sink, so every row and column is computed. ``rows_per_sec`` relates a
query to the rows that it reads itself; ``shuffle_mb`` is what one run writes to shuffles. Tables are read as
they are stored, one row group being one task; nothing is dealt out first.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from catalog import views
from catalog.queries import FULL_RUN_CAPS, QUERIES
from pairloom.plans import prepare_training_set
from pairloom.session import new_folder
from pairloom.sources import load_named_splits, write_splits

HEADLINE = [
    "clean_split",
    "dedup_pairs",
    "seeded_shuffle",
    "split_80_10_10",
    "clean_text_documents",
    "length_budget_512",
    "pair_totals",
]


def run(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffle_bytes(log_folder: str) -> dict[str, int]:
    """Bytes written to shuffles per job description, from the event log."""
    description: dict[int, str] = {}
    total: dict[str, int] = {}
    for path in sorted(Path(log_folder).rglob("events*")) + sorted(Path(log_folder).glob("local*")):
        if not path.is_file():
            continue
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = event.get("Properties", {}).get("spark.job.description", "")
                description.update({stage: name for stage in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                name = description.get(event["Stage ID"], "")
                written = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                total[name] = total.get(name, 0) + written
    return total


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    log_folder = tempfile.mkdtemp(prefix="bench-log-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pairloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log_folder}")
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    folder = new_folder(spark, "bench-splits")
    start = time.perf_counter()
    write_splits(views.splits(spark, sf_dir), folder)
    write_seconds = time.perf_counter() - start

    names = sorted(QUERIES) if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE
    jobs = {name: lambda name=name: QUERIES[name](spark, sf_dir) for name in names}
    jobs["prepare_from_splits"] = lambda: prepare_training_set(
        load_named_splits(spark, folder), **FULL_RUN_CAPS
    )
    rows_of = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
        for name in ("documents", "conversations")
    }
    n_rows = sum(rows_of.values())
    own_rows = {
        "clean_text_documents": rows_of["documents"],
        "prepare_from_splits": jobs["prepare_from_splits"]().count(),
    }

    seconds, failed = {}, {}
    for name, job in jobs.items():
        try:
            spark.sparkContext.setJobDescription(f"warm-up {name}")
            run(job())
            times = []
            for _ in range(runs):
                spark.sparkContext.setJobDescription(name)
                times.append(run(job()))
            seconds[name] = round(min(times), 3)
        except Exception as error:
            failed[name] = str(error)[:200]
    spark.stop()

    written = shuffle_bytes(log_folder)
    result = {
        "metric": "seconds for the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "input_rows": n_rows,
        "rows_per_sec": {name: round(own_rows.get(name, n_rows) / s) for name, s in seconds.items()},
        "shuffle_mb": {name: round(written.get(name, 0) / runs / 2**20, 2) for name in seconds},
        "first_write_seconds": round(write_seconds, 3),
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
