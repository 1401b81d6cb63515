"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 3). Each query runs once to warm up; the median of the timed runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from matchlake import checked_queries, configure, standins  # noqa: E402
from matchlake.operators import enrich  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = [
    # Gold metrics: scan and aggregate.
    "results_by_season",
    "result_distribution",
    "goals_stats",
    "stats_by_category",
    "goals_histogram",
    "elapsed_counts",
    "value_counts",
    "n_unique",
    "null_counts",
    "gold_metrics",
    # Row by row work over a whole table.
    "match_winner",
    "flatten_nested",
    "season_current_year",
    "gold_fixtures_full",
    # Landing, merging, layers.
    "json_envelope",
    "merge_insert_new",
    "merge_insert_new_repeated_keys",
    "merge_upsert",
    "write_partitioned",
    "medallion_flow",
    "incremental_stream",
]


def season_winner_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = standins.matches(spark, sf_dir)
    df = df.transform(enrich.match_winner).transform(enrich.total_goals)
    return df.groupBy("league_season", "match_winner").agg(
        F.count(F.lit(1)).alias("matches"),
        F.avg("total_goals").alias("mean"),
        F.median("total_goals").alias("median"),
    )


def timed(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("matchlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # No call-site capture per column expression: plans build faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {"season_winner_stats": season_winner_stats}
    queries |= {name: checked_queries.QUERIES[name] for name in HEADLINES}
    seconds = {}
    for name, query in queries.items():
        timed(query, spark)
        seconds[name] = round(statistics.median(timed(query, spark) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
