"""Named queries, the SQL each must agree with, and the SQL of the logical tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.operators.baseline import predict_item_mean
from shelfsense.operators.joins import with_products
from shelfsense.operators.sampling import split_by_weights
from shelfsense.sources import logical
from shelfsense.sources.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

CLASSES = ["PROMO", "ECONOMY"]
ALL_CLASSES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
KEYS = ["user_tag", "item_id"]

VIEWS = {
    "purchases": """SELECT c.c_name AS user_tag, l.l_partkey AS item_id, l.l_quantity AS units,
            CAST(o.o_orderdate AS DATE) AS date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
            JOIN customer c ON c.c_custkey = o.o_custkey""",
    "products": """SELECT p_partkey AS item_id, p_name AS product_name, p_type AS klass, p_brand AS varietal,
            p_size AS size, p_retailprice AS price
        FROM part""",
    "listed_purchases": """SELECT p.*, klass FROM purchases p JOIN products USING (item_id)
        WHERE klass IN ('PROMO', 'ECONOMY')""",
    "triples": """SELECT user_tag, item_id, CAST(least(10, ceil(sum(units) / 5)) AS INTEGER) AS rating
        FROM purchases GROUP BY user_tag, item_id""",
    "hashed": """SELECT *, CAST('0x' || substr(md5(concat_ws('|', user_tag, item_id)), 1, 8) AS BIGINT) AS h
        FROM triples""",
    "train": "SELECT user_tag, item_id, rating FROM hashed WHERE h / 4294967296.0 < 0.8",
    "test": "SELECT user_tag, item_id, rating FROM hashed WHERE h / 4294967296.0 >= 0.8",
    "item_means": "SELECT item_id, round(avg(rating), 6) AS prediction FROM train GROUP BY item_id",
    "pairs": "SELECT user_tag, item_id, rating, prediction FROM test JOIN item_means USING (item_id)",
    "scored": """SELECT user_tag, t.item_id, prediction, varietal AS category, klass
        FROM triples t JOIN item_means USING (item_id) JOIN products USING (item_id)
        WHERE prediction >= 5.0""",
    "rated": """SELECT user_tag, item_id, klass, round((bottles - CAST(c AS DOUBLE) / a) / c, 6) AS rating
        FROM (SELECT user_tag, item_id, klass, sum(units) AS bottles FROM kept GROUP BY ALL)
            JOIN (SELECT user_tag, klass, count(*) AS c FROM kept GROUP BY ALL) USING (user_tag, klass)
            JOIN (SELECT user_tag, count(*) AS a FROM kept GROUP BY ALL) USING (user_tag)""",
    # equal-count bins: ranks from 0, bins floor(N / 10) + 1 wide, the closing row of a bin left out
    "ranked": """SELECT rating, row_number() OVER (ORDER BY rating) - 1 AS r,
            count(*) OVER () // 10 + 1 AS w FROM rated""",
    "edges": """SELECT CAST(r // w + 1 AS INTEGER) AS bin, min(rating) AS lo, max(rating) AS hi
        FROM ranked WHERE r = 0 OR r % w <> 0 GROUP BY 1""",
    "binned": """SELECT rated.*, CAST(coalesce(
            (SELECT min(bin) FROM edges WHERE hi >= rated.rating), (SELECT max(bin) FROM edges)) AS INTEGER) AS label
        FROM rated""",
}


def with_views(*names: str, **own: str) -> str:
    """WITH clause of the named logical tables, and of own ones given as keywords, in that order."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in names] + [f"{name} AS ({sql})" for name, sql in own.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def listed_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases of the two listed classes with their class."""
    products = logical.products(spark, folder).where(F.col("klass").isin(CLASSES))
    return logical.purchases(spark, folder).join(products.select("item_id", "klass"), "item_id")


def stored_triples(spark: SparkSession, folder: str) -> DataFrame:
    """Rating triples as a stored table, which is how they come to jobs that read them several times."""
    return stored(logical.rating_triples(spark, folder), "triples")


def train_and_test(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = split_by_weights(triples, KEYS, [8, 2])
    return parts.where("part = 0").drop("part"), parts.where("part = 1").drop("part")


def test_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out ratings with the item mean of the other part: ``user_tag, item_id, rating, prediction``."""
    return predict_test(stored_triples(spark, folder))


def predict_test(triples: DataFrame) -> DataFrame:
    train, test = train_and_test(triples)
    return predict_item_mean(train, test).select("user_tag", "item_id", "rating", "prediction")


def scored_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """All rated pairs scored by item mean, at 5 or more, with category and class."""
    triples = stored_triples(spark, folder)
    train, _ = train_and_test(triples)
    products = logical.products(spark, folder).select("item_id", F.col("varietal").alias("category"), "klass")
    scored = with_products(predict_item_mean(train, triples.select(*KEYS)), products)
    return scored.where("prediction >= 5.0").select("user_tag", "item_id", "prediction", "category", "klass")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})
