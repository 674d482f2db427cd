"""Queries: every reader against what the matching writer stored, and totals over arriving batches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsense.operators import baseline
from shelfsense.operators.factors import TRAIN_FRACTIONS
from shelfsense.registry.core import KEYS, query, rounded, with_views
from shelfsense.registry.measuring import _FRACTIONS, _SPREAD, _mean_curve
from shelfsense.sources import logical, tables
from shelfsense.sources.session import fresh_path
from shelfsense.streaming.increments import absorb_new


@query(with_views("purchases") + "SELECT user_tag, item_id, units, date FROM purchases")
def tsv_scan(spark, folder):
    path = fresh_path(spark, "purchases-tsv")
    logical.purchases(spark, folder).write.option("sep", "\t").option("header", True).csv(path)
    named = ["user_tag", "item_id", "units", "date"]
    return tables.read_tsv(spark, path, tables.PURCHASES).toDF(*named)


@query(with_views("products") + """SELECT item_id, varietal || ', "' || product_name || '"' AS title FROM products""")
def csv_scan(spark, folder):
    """Titles with commas and quotes through a CSV that has one more column than is kept."""
    path = fresh_path(spark, "titles-csv")
    title = F.format_string('%s, "%s"', "varietal", "product_name").alias("title")
    titles = logical.products(spark, folder).select("item_id", title, F.col("klass").alias("genres"))
    titles.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_csv_columns(spark, path, T.StructType(titles.schema.fields), ["item_id", "title"])


@query(with_views("purchases", "triples") + "SELECT user_tag, item_id, rating FROM triples")
def saved_table(spark, folder):
    path = fresh_path(spark, "triples")
    tables.write_table(logical.rating_triples(spark, folder), path, ["rating"])
    return tables.read_table(spark, path, ["user_tag", "item_id", "rating"])


@query(with_views("products") + "SELECT item_id, product_name, varietal, klass FROM products")
def json_sink(spark, folder):
    path = fresh_path(spark, "products-json")
    tables.write_json(logical.products(spark, folder).select("item_id", "product_name", "varietal", "klass"), path, ["klass"])
    return spark.read.schema("item_id long, product_name string, varietal string, klass string").json(path)


@query(with_views("purchases", "triples", "hashed", fractions=_FRACTIONS, spread=_SPREAD, curve=_mean_curve("item_id"))
       + "SELECT train_fraction, train_rmse, test_rmse FROM curve WHERE train_fraction = 0.8")
def stored_run(spark, folder):
    """A learning curve stored by train fraction, and one point of it read back by its setting."""
    path = fresh_path(spark, "curves")
    curve = baseline.mean_learning_curve(
        logical.rating_triples(spark, folder), KEYS, ["item_id"], "rating", TRAIN_FRACTIONS
    )
    tables.write_table(rounded(curve, "train_rmse", "test_rmse"), path, ["train_fraction"])
    return tables.read_run(spark, path, train_fraction=0.8)


def _is_one_file(spark, path):
    """Whether a table is a single file and not a folder of them."""
    files = spark.read.parquet(path).select("_metadata.file_path").limit(1).collect()
    return bool(files) and files[0][0].rstrip("/").endswith(path.rsplit("/", 1)[1])


def order_line_stream(spark, folder):
    """Order lines as a file stream, and what makes purchases of a batch: orders and customers at rest."""
    orders = logical.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderdate").cast("date").alias("date")
    )
    tags = logical.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("user_tag")
    )

    def to_purchases(lines):
        return lines.join(orders, "l_orderkey").join(tags, "o_custkey").select("user_tag", "item_id", "units", "date")

    schema = logical.table(spark, folder, "lineitem").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8)
    if _is_one_file(spark, f"{folder}/lineitem.parquet"):
        stream = stream.option("pathGlobFilter", "lineitem.parquet").parquet(folder)
    else:
        stream = stream.parquet(f"{folder}/lineitem.parquet")
    arrivals = stream.select(
        "l_orderkey", F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("units")
    )
    return arrivals, to_purchases


@query(with_views("purchases") + """SELECT user_tag, item_id, sum(units) AS bottles, count(*) AS n_rows,
    min(date) AS first_date, max(date) AS last_date FROM purchases GROUP BY user_tag, item_id""")
def incremental_totals(spark, folder):
    """Order lines taken in as a file stream, in batches, against orders and customers at rest."""
    arrivals, to_purchases = order_line_stream(spark, folder)
    return absorb_new(arrivals, to_purchases, fresh_path(spark, "totals"), fresh_path(spark, "progress"))
