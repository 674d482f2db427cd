"""Times the headline queries on one folder of tables and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfsense.operators import factors
from shelfsense.operators.factors import AlsSettings
from shelfsense.registry import cleaning, layouts, measuring, profiling, recommending, serving, storing  # noqa: F401
from shelfsense.registry.core import QUERIES
from shelfsense.sources.session import scratch

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "value_frequency", "user_segments", "season_units", "numeric_summary", "pseudo_rating", "rating_bins",
    "prep_pipeline", "user_bridge", "stratified_split", "item_mean_rmse", "baseline_learning_curve", "roc_auc",
    "curated_scores", "curated_recommendations", "lists_from_purchases", "member_rows", "als_recommend", "als_roc_auc",
    "als_fit_rmse",
]


def results_study(spark: SparkSession, folder: str):
    """Rank 12, 10 iterations, 90 % train: the setting of the largest run the study reports (500,000 ratings)."""
    triples = recommending._triples(spark, folder)
    pairs = factors.train_and_test(triples, 0.1, AlsSettings(rank=12, max_iter=10))[2]
    return pairs.agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), F.lit(2)))).alias("rmse"))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()  # start-up is not timed

    seconds = {}
    jobs = {name: QUERIES[name] for name in HEADLINE} | {"als_results_study": results_study}
    for name, job in jobs.items():
        started = time.perf_counter()
        with scratch(spark):
            job(spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total wall-clock of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
