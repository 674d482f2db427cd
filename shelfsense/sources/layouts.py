"""Tables laid out for the jobs that read them again: by buckets of a key, by month, and as sparse rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.operators.positions import global_position
from shelfsense.operators.spread import spread_join
from shelfsense.sources.session import fresh_path, stored


# --- buckets ---------------------------------------------------------------------------------------------

def bucketed(df: DataFrame, name: str, keys: Sequence[str], n_buckets: int) -> DataFrame:
    """Save ``df`` as a catalogue table, dealt out and sorted by ``keys``, and return it as read back.

    Two tables with the same keys and number of buckets join, and a table groups by its keys, without a shuffle: it
    is paid once, here. The rows go to one task per bucket first, so there is one file per bucket.
    """
    path = fresh_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    writer = df.repartition(n_buckets, *keys).write.option("path", path).format("parquet")
    writer.bucketBy(n_buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


# --- months -----------------------------------------------------------------------------------------------

def write_by_month(purchases: DataFrame, path: str, date: str = "date") -> None:
    """Save purchases in one folder per month; rows without a date go to the null month."""
    by_month = purchases.withColumn("month", F.trunc(date, "month"))
    # every task may hold rows of every month, so months are brought together, a large one in several files
    by_month.repartition("month", F.pmod(F.xxhash64(*purchases.columns), F.lit(8))).write.mode("overwrite").partitionBy(
        "month"
    ).parquet(path)


def season_units_by_month(
    spark: SparkSession, path: str, periods: DataFrame, item: str = "item_id", units: str = "units", date: str = "date"
) -> DataFrame:
    """Units of each item in each period of a table ``(period, first_day, last_day)``; periods may overlap.

    Purchases come from ``write_by_month``. The months of the periods are a small table joined on the folder
    column, so at run time Spark reads the folders of these months and no others.
    """
    months = F.sequence(F.trunc("first_day", "month"), F.trunc("last_day", "month"), F.expr("INTERVAL 1 MONTH"))
    wanted = stored(periods, "periods").where("first_day <= last_day").withColumn("month", F.explode(months))
    purchases = spark.read.parquet(path).withColumn("month", F.col("month").cast("date"))
    inside = purchases.join(F.broadcast(wanted), "month").where(F.col(date).between(F.col("first_day"), F.col("last_day")))
    return inside.groupBy("period", item).agg(F.sum(units).alias("total_units"))


# --- sparse rows ------------------------------------------------------------------------------------------

def column_dictionary(cells: DataFrame, column: str) -> DataFrame:
    """``(column, place)``: every column key with its place, from 0 in the order of the keys."""
    return stored(global_position(cells.select(column).distinct().where(F.col(column).isNotNull()), [column], "place"), "dictionary")


def sparse_rows(cells: DataFrame, row: str, column: str, value: str, dictionary: DataFrame) -> DataFrame:
    """Cells ``(row, column, value)`` as one sparse vector per row key: ``(row, places, values)``, places ascending.

    Any number of columns, none of them listed beforehand. A cell given twice counts with its largest value; cells without
    row, column or value are left out, as are columns that the dictionary does not have.
    """
    placed = spread_join(cells.select(row, column, value).dropna(), dictionary, [column])
    single = placed.groupBy(row, "place").agg(F.max(value).alias("_value"))
    # a vector has at most one entry per column
    vectors = single.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("place", "_value"))).alias("_cells"))
    return vectors.select(row, F.col("_cells.place").alias("places"), F.col("_cells._value").alias("values"))


def dense_cells(vectors: DataFrame, row: str, dictionary: DataFrame, column: str, value: str) -> DataFrame:
    """Sparse vectors back to cells ``(row, column, value)``."""
    each = vectors.select(row, F.explode(F.arrays_zip("places", "values")).alias("_cell")).select(
        row, F.col("_cell.places").alias("place"), F.col("_cell.values").alias(value)
    )
    return spread_join(each, dictionary, ["place"]).select(row, column, value)
