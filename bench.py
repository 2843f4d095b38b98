"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from quirefold.operators import fold, ingest, reads, validate
from quirefold.plans.queries import QUERIES
from quirefold.session import configure
from quirefold.sources.testdata import lineitem_events, raw_events

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
HEADLINE = (
    "ingest_counts",
    "accept_filter",
    "replay_pacing",
    "validate_reasons",
    "valid_events",
    "deadletter",
    "ledger_dedup",
    "page_state",
    "changelog",
    "changelog_in_slices",
    "upsert",
    "stats",
    "feed",
    "leaderboard",
    "page_history",
    "history_with_state",
    "discrepancy",
    "state_check",
    "rebuild_current",
    "stream_ledger",
    "stream_page_state",
    "rebuild",
)


def lineitem_page_state(spark, sf_dir):
    return fold.fold_pages(lineitem_events(spark, sf_dir))


def lineitem_changelog(spark, sf_dir):
    return fold.changelog(lineitem_events(spark, sf_dir))


def lineitem_leaderboard(spark, sf_dir):
    return reads.leaderboard(fold.fold_pages(lineitem_events(spark, sf_dir)))


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("quirefold-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:]
    runs = {name: QUERIES[name] for name in HEADLINE}
    runs |= {f.__name__: f for f in (lineitem_page_state, lineitem_changelog, lineitem_leaderboard)}
    # start the workers and load the classes before the clock runs
    accepted = ingest.accept(raw_events(spark, SF_DIR))
    timed(lambda: fold.fold_pages(validate.valid_events(validate.classify(accepted))))
    runs = {name: run for name, run in runs.items() if not wanted or name in wanted}
    seconds = {name: timed(lambda run=run: run(spark, SF_DIR)) for name, run in runs.items()}
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
