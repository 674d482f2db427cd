"""Readers and writers: delimited text in, Parquet between jobs, Parquet or JSON out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the source files.

PURCHASES = T.StructType([
    T.StructField("CustomerHash", T.StringType()),
    T.StructField("ProductKey", T.LongType()),
    T.StructField("Units", T.DoubleType()),
    T.StructField("Date", T.DateType()),
])

PRODUCTS = T.StructType([
    T.StructField("ProductKey", T.LongType()),
    T.StructField("ProductId", T.LongType()),
    T.StructField("ProductName", T.StringType()),
    T.StructField("ProductType", T.StringType()),
    T.StructField("Class", T.StringType()),
    T.StructField("Varietal", T.StringType()),
    T.StructField("Vineyard", T.StringType()),
    T.StructField("Appellation", T.StringType()),
    T.StructField("Region", T.StringType()),
    T.StructField("CountryOfOrigin", T.StringType()),
    T.StructField("WarehouseState", T.StringType()),
    T.StructField("WineStyle", T.StringType()),
    T.StructField("Vintage", T.IntegerType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("HighestRating", T.IntegerType()),
])

EXPLICIT_RATINGS = T.StructType([
    T.StructField("CustomerHash", T.StringType()),
    T.StructField("ProductId", T.LongType()),
    T.StructField("Rating", T.DoubleType()),
])

FILM_RATINGS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

FILM_TITLES = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated table with a header row."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


def read_csv_columns(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]
) -> DataFrame:
    """Comma-separated table with a header row; quoted fields may hold commas. Keeps ``columns``."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path).select(*columns)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Saved table, with only the asked columns read."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Save ``df``, replacing what the path held, in one folder per value of ``partition_by``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Save ``df`` as JSON lines."""
    df.write.mode("overwrite").partitionBy(*partition_by).json(path)


def read_run(spark: SparkSession, path: str, **setting: float) -> DataFrame:
    """One stored run out of many, picked by its settings: ``read_run(s, p, reg=0.1, rank=16)``."""
    runs = spark.read.parquet(path)
    for name, value in setting.items():
        runs = runs.where(F.col(name) == F.lit(value))
    return runs


def matrix_table(
    cells: DataFrame, row: str, column: str, value: str, columns: Sequence[str], fill: float = 0.0
) -> DataFrame:
    """Sparse cells ``(row, column, value)`` to one line per row key and one field per listed column."""
    wide = cells.groupBy(row).pivot(column, list(columns)).agg(F.first(value))
    return wide.fillna(fill, subset=list(columns))
