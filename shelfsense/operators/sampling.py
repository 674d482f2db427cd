"""Splits and samples by the hash of the row keys, so that any SQL engine can repeat them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.functions.hashing import HASH_BITS, key_fraction, key_hash
from shelfsense.operators.positions import global_position
from shelfsense.sources.session import small_side

_CELL_BITS = 18  # the hash range is counted in 262,144 cells


def mark_first(
    df: DataFrame,
    keys: Sequence[str],
    take: Callable[[Column], Column],
    by: str | None = None,
    into: str = "selected",
    seed: int | None = None,
) -> DataFrame:
    """Flag exactly the first ``take(rows)`` rows in hash order, per value of ``by`` if given.

    ``keys`` must identify a row. No group is sorted: the hash cells are counted, the one cell where
    the cut falls is ranked, and the rows are then compared with the cut row in one pass. That
    reads ``df`` three times, so pass a stored table or cut a long lineage first.
    """
    strata = [by] if by else []
    hashed = df.withColumn("_hash", key_hash(keys, seed)).withColumn(
        "_cell", F.shiftright("_hash", HASH_BITS - _CELL_BITS)
    )
    cells = hashed.groupBy(*strata, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    through = F.sum("_n").over(Window.partitionBy(*strata).orderBy("_cell"))
    rows = F.sum("_n").over(Window.partitionBy(*strata))
    cut_cell = (
        cells.withColumn("_through", through)
        .withColumn("_take", take(rows))
        .where((F.col("_through") - F.col("_n") < F.col("_take")) & (F.col("_take") <= F.col("_through")))
        .select(*strata, "_cell", (F.col("_take") - F.col("_through") + F.col("_n")).alias("_left"))
    )
    def beside(rows: DataFrame, cuts: DataFrame, keys: list[str], how: str) -> DataFrame:
        """Join on keys that may be null: a null stratum is a stratum."""
        named = cuts.withColumnsRenamed({k: f"{k}_cut" for k in keys})
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_cut")) for k in keys])
        return rows.join(named, same, how).drop(*(f"{k}_cut" for k in keys))

    in_cell = Window.partitionBy(*strata).orderBy("_hash", *keys)
    cut_row = (
        beside(hashed, small_side(cut_cell), [*strata, "_cell"], "inner")
        .withColumn("_rank", F.row_number().over(in_cell))
        .where(F.col("_rank") == F.col("_left"))
        .select(*strata, F.struct("_hash", *keys).alias("_cut"))
    )
    if by:
        marked = beside(hashed, small_side(cut_row), [by], "left")
    else:
        marked = hashed.withColumn("_cut", cut_row.select("_cut").scalar())
    inside = F.coalesce(F.struct("_hash", *keys) <= F.col("_cut"), F.lit(False))
    return marked.withColumn(into, inside).drop("_hash", "_cell", "_cut")


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int | None = None) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), chosen by hash."""
    marked = mark_first(df, keys, lambda rows: F.least(F.lit(n), rows), seed=seed)
    return marked.where("selected").drop("selected")


def split_exact(df: DataFrame, keys: Sequence[str], test_fraction: float, into: str = "is_test") -> DataFrame:
    """Mark ``ceil(test_fraction * rows)`` rows as the test part."""
    return mark_first(df, keys, lambda rows: F.ceil(F.lit(test_fraction) * rows), into=into)


def split_stratified(
    df: DataFrame, keys: Sequence[str], label: str, test_fraction: float, into: str = "is_test"
) -> DataFrame:
    """Mark the same share of every label, rounded to whole rows, as the test part."""
    return mark_first(df, keys, lambda rows: F.floor(F.lit(test_fraction) * rows + 0.5), by=label, into=into)


def split_by_weights(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], into: str = "part", seed: int | None = None
) -> DataFrame:
    """Give each row a part number with the given weights; a map-side expression, no shuffle."""
    whole = float(sum(weights))
    bounds = [sum(weights[: i + 1]) / whole for i in range(len(weights) - 1)]
    at = key_fraction(keys, seed)
    part = sum(((at >= F.lit(b)).cast("int") for b in bounds), F.lit(0))
    return df.withColumn(into, part)


def shuffled(df: DataFrame, keys: Sequence[str], into: str = "position", seed: int | None = None) -> DataFrame:
    """Add each row's place in a seeded random order."""
    placed = global_position(df.withColumn("_hash", key_hash(keys, seed)), ["_hash", *keys], into)
    return placed.drop("_hash")


def nested_fractions(df: DataFrame, keys: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Train and test sizes of nested hold-out splits, counted in one pass."""
    inside = [F.count_if(F.col("_at") < F.lit(f)) for f in fractions]
    sizes = F.array(*[
        F.struct(F.lit(f).alias("train_fraction"), n.alias("n_train"), (F.count(F.lit(1)) - n).alias("n_test"))
        for f, n in zip(fractions, inside)
    ])
    hashed = df.select(key_fraction(keys).alias("_at"))
    return hashed.agg(sizes.alias("sizes")).select(F.explode("sizes").alias("s")).select("s.*")
