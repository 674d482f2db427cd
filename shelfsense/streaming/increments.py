"""Totals that grow with each batch of new purchases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["user_tag", "item_id"]


def batch_totals(purchases: DataFrame) -> DataFrame:
    """The additive part of a batch: units, rows and date range per (user, item)."""
    return purchases.groupBy(*KEYS).agg(
        F.sum("units").alias("bottles"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def merge_totals(parts: DataFrame) -> DataFrame:
    """All batches put together; the same columns as ``batch_totals``."""
    return parts.groupBy(*KEYS).agg(
        F.sum("bottles").alias("bottles"),
        F.sum("n_rows").alias("n_rows"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def absorb_new(
    arrivals: DataFrame, to_purchases: Callable[[DataFrame], DataFrame], totals_path: str, progress_path: str
) -> DataFrame:
    """Take in everything that arrived since the last call, then return the totals so far.

    Each micro-batch overwrites its own folder, so a batch that is replayed after a failure does
    not count twice. ``arrivals`` is a streaming DataFrame, ``to_purchases`` turns a batch of it
    into purchase rows. Before anything has arrived the totals are an empty table.
    """
    nothing = arrivals.sparkSession.createDataFrame([], arrivals.schema)
    batch_totals(to_purchases(nothing)).write.mode("overwrite").parquet(f"{totals_path}/batch=-1")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch_totals(to_purchases(batch)).write.mode("overwrite").parquet(f"{totals_path}/batch={batch_id}")

    job = (
        arrivals.writeStream.foreachBatch(store)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return merge_totals(arrivals.sparkSession.read.parquet(totals_path))
