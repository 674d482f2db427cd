"""Column profiles: frequencies, nulls, distinct values, numeric summaries, attribute imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.functions.labels import safe_ratio
from shelfsense.operators.positions import quantiles
from shelfsense.operators.spread import spread_join


def value_frequency(df: DataFrame, columns: Sequence[str], dropna: bool = False) -> DataFrame:
    """Counts of every value of several columns in one job: ``(column, value, n)``, values as text."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select(F.explode(cells).alias("cell")).select("cell.*")
    if dropna:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def by_count(frequency: DataFrame, value: str = "value", count: str = "n", by_value: bool = False) -> DataFrame:
    """Order a frequency table by count (ties by value) or by value, largest first."""
    return frequency.orderBy(F.desc(value)) if by_value else frequency.orderBy(F.desc(count), F.col(value))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null, null and distinct counts and the null share of each column, from its frequencies."""
    frequency = value_frequency(df, columns)
    missing = F.col("value").isNull()
    profile = frequency.groupBy("column").agg(
        F.sum(F.when(~missing, F.col("n")).otherwise(0)).alias("n_present"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("n_missing"),
        F.count("value").alias("n_distinct"),
    )
    return profile.withColumn("missing_share", safe_ratio(F.col("n_missing"), F.col("n_missing") + F.col("n_present")))


def null_ratio(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is null, where it is not, and the null share."""
    counts = df.agg(
        F.count_if(F.col(column).isNull()).alias("n_missing"), F.count(column).alias("n_present")
    )
    return counts.withColumn("missing_share", safe_ratio(F.col("n_missing"), F.col("n_missing") + F.col("n_present")))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def numeric_summary(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a column, in one row."""
    moments = df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    points = quantiles(df, value, [0.25, 0.5, 0.75])
    at = F.col("probability")
    quartiles = points.agg(
        F.max(F.when(at == 0.25, F.col("quantile"))).alias("q25"),
        F.max(F.when(at == 0.5, F.col("quantile"))).alias("q50"),
        F.max(F.when(at == 0.75, F.col("quantile"))).alias("q75"),
    ).agg(F.max(F.struct("q25", "q50", "q75")))
    return moments.withColumn("_q", quartiles.scalar()).select("n", "mean", "std", "min", "max", "_q.*")


def impute_by_similar(df: DataFrame, column: str, similar_on: Sequence[str]) -> DataFrame:
    """Fill nulls of ``column`` with its most frequent value among rows alike on ``similar_on``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*similar_on, column).agg(F.count(F.lit(1)).alias("_n"))
    first = Window.partitionBy(*similar_on).orderBy(F.desc("_n"), F.col(column))
    usual = counts.withColumn("_r", F.row_number().over(first)).where("_r = 1").select(
        *similar_on, F.col(column).alias("_usual")
    )
    filled = spread_join(df, usual, similar_on, "left").withColumn(column, F.coalesce(column, "_usual"))
    return filled.drop("_usual")
