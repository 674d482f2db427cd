"""Queries: filters, membership, purchase cleaning, pseudo-ratings and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsense.operators import binning, filters, joins, pseudo_ratings
from shelfsense.operators.profile import value_frequency
from shelfsense.plans.prepare import prepared_ratings, rated_purchases
from shelfsense.registry.core import CLASSES, VIEWS, listed_purchases, query, rounded, test_pairs, with_views
from shelfsense.sources import logical
from shelfsense.sources.session import stored

_PRODUCT_COLUMNS = "item_id, product_name, klass, varietal, size, price"


@query(with_views("products") + f"SELECT {_PRODUCT_COLUMNS} FROM products WHERE klass IN ('PROMO', 'ECONOMY')")
def category_keep(spark, folder):
    return filters.keep_classes(logical.products(spark, folder), CLASSES)


@query(with_views("products") + f"""SELECT {_PRODUCT_COLUMNS} FROM products WHERE klass = 'PROMO'
UNION ALL SELECT {_PRODUCT_COLUMNS} FROM products WHERE klass = 'ECONOMY'""")
def classes_union(spark, folder):
    return filters.union_classes(logical.products(spark, folder), CLASSES)


@query(with_views("purchases", "products") + """SELECT user_tag, item_id, units, date, klass
FROM purchases LEFT JOIN products USING (item_id)""")
def purchases_with_class(spark, folder):
    return joins.with_class(logical.purchases(spark, folder), logical.products(spark, folder))


@query(with_views("purchases", "products") + """SELECT user_tag, item_id, units, date, klass
FROM purchases LEFT JOIN products USING (item_id)
WHERE klass IS NULL OR klass NOT IN ('PROMO', 'ECONOMY')""")
def class_rejects(spark, folder):
    return filters.class_rejects(purchases_with_class(spark, folder), CLASSES)


@query(with_views("purchases") + "SELECT * FROM purchases WHERE units < 10")
def bulk_filter(spark, folder):
    return filters.drop_bulk(logical.purchases(spark, folder))


@query(with_views("purchases", "triples", "hashed", "train", "test", "item_means", "pairs")
       + "SELECT * FROM pairs WHERE prediction >= 6.0")
def threshold_filter(spark, folder):
    return filters.at_least(test_pairs(spark, folder), "prediction", 6.0)


@query(with_views("products") + """SELECT 'size' AS "column", CAST(size AS VARCHAR) AS value, count(*) AS n
FROM products WHERE size BETWEEN 10 AND 30 GROUP BY size""")
def vintage_range_frequency(spark, folder):
    return value_frequency(filters.between(logical.products(spark, folder), "size", 10, 30), ["size"])


@query(with_views("purchases", "products", "listed_purchases") + """SELECT user_tag, count(*) AS n_purchases
FROM listed_purchases GROUP BY user_tag HAVING count(*) >= 5""")
def active_users(spark, folder):
    return filters.active_users(listed_purchases(spark, folder))


@query(with_views("purchases", "products", "listed_purchases") + """SELECT user_tag, count(DISTINCT item_id) AS n_purchases
FROM listed_purchases GROUP BY user_tag HAVING count(DISTINCT item_id) >= 5""")
def active_users_by_items(spark, folder):
    return filters.active_users(listed_purchases(spark, folder), distinct_items=True)


@query(with_views("purchases", "products", "listed_purchases") + """SELECT user_tag FROM listed_purchases
GROUP BY user_tag HAVING count(DISTINCT date) > 1""")
def repeat_buyers(spark, folder):
    return filters.repeat_buyers(listed_purchases(spark, folder))


@query(with_views("purchases", "products", "listed_purchases") + """SELECT user_tag FROM listed_purchases
GROUP BY user_tag HAVING count(DISTINCT date) > 8""")
def frequent_buyers(spark, folder):
    return filters.repeat_buyers(listed_purchases(spark, folder), more_than=8)


@query(with_views("purchases", "products", "listed_purchases") + """SELECT * FROM listed_purchases
WHERE user_tag IN (SELECT user_tag FROM listed_purchases GROUP BY 1 HAVING count(*) >= 5)""")
def member_rows(spark, folder):
    rows = listed_purchases(spark, folder)
    return filters.rows_of(rows, filters.active_users(rows), ["user_tag"])


@query(with_views("purchases", "products", "listed_purchases") + """SELECT * FROM listed_purchases
WHERE user_tag NOT IN (SELECT user_tag FROM listed_purchases GROUP BY 1 HAVING count(*) >= 5)""")
def non_member_rows(spark, folder):
    rows = listed_purchases(spark, folder)
    return filters.rows_without(rows, filters.active_users(rows), ["user_tag"])


@query(with_views("purchases", "products", "listed_purchases", kept="""SELECT * FROM listed_purchases
        WHERE user_tag IN (SELECT user_tag FROM listed_purchases GROUP BY 1
            HAVING count(*) >= 5 AND count(DISTINCT date) > 1)""") + """SELECT *,
    round(100.0 * users_after / users_before, 6) AS users_percent,
    round(100.0 * purchases_after / purchases_before, 6) AS purchases_percent
FROM (SELECT count(DISTINCT user_tag) AS users_before, count(*) AS purchases_before FROM listed_purchases),
    (SELECT count(DISTINCT user_tag) AS users_after, count(*) AS purchases_after FROM kept)""")
def retention_report(spark, folder):
    keep = (F.col("n_purchases") >= 5) & (F.col("first_date") < F.col("last_date"))
    report = filters.retention(listed_purchases(spark, folder), keep)
    return rounded(report, "users_percent", "purchases_percent")


@query(with_views("purchases", "products", "listed_purchases") + """SELECT user_tag,
    round(r * 1.0 / (r + w), 6) AS freq_PROMO, round(w * 1.0 / (r + w), 6) AS freq_ECONOMY,
    r AS total_PROMO, w AS total_ECONOMY
FROM (SELECT user_tag, count(*) FILTER (klass = 'PROMO') AS r, count(*) FILTER (klass = 'ECONOMY') AS w
    FROM listed_purchases GROUP BY user_tag)""")
def user_class_stats(spark, folder):
    stats = pseudo_ratings.user_class_stats(listed_purchases(spark, folder), CLASSES)
    return rounded(stats, "freq_PROMO", "freq_ECONOMY")


@query(with_views("purchases", "products", "listed_purchases", kept="SELECT * FROM listed_purchases")
       + """SELECT user_tag, item_id, klass, sum(units) AS bottles, count(*) AS n_rows FROM kept GROUP BY ALL""")
def units_per_item(spark, folder):
    return pseudo_ratings.units_per_item(listed_purchases(spark, folder))


_ALL_KEPT = "SELECT * FROM purchases JOIN products USING (item_id)"
_PREP_KEPT = """SELECT * FROM listed_purchases WHERE units < 10 AND user_tag IN (
        SELECT user_tag FROM listed_purchases GROUP BY 1 HAVING count(*) >= 5 AND count(DISTINCT date) > 1)"""


def _rating_sql(kept: str, *views: str) -> str:
    return with_views("purchases", "products", "listed_purchases", kept=kept, **{v: VIEWS[v] for v in views})


@query(_rating_sql(_ALL_KEPT, "rated") + "SELECT user_tag, item_id, klass, rating FROM rated")
def pseudo_rating(spark, folder):
    rows = joins.with_class(logical.purchases(spark, folder), logical.products(spark, folder))
    return pseudo_ratings.pseudo_ratings(pseudo_ratings.units_per_item(rows))


@query(_rating_sql(_PREP_KEPT, "rated") + "SELECT user_tag, item_id, klass, rating FROM rated")
def cleaned_ratings(spark, folder):
    return rated_purchases(logical.purchases(spark, folder), logical.products(spark, folder), CLASSES)


@query(_rating_sql(_ALL_KEPT, "rated", "ranked", "edges") + "SELECT bin, lo, hi FROM edges")
def bin_edges(spark, folder):
    return binning.bin_edges(pseudo_rating(spark, folder), "rating")


@query(_rating_sql(_ALL_KEPT, "rated", "ranked") + """SELECT CAST(r // w + 1 AS INTEGER) AS bin,
    min(rating) AS lo, max(rating) AS hi FROM ranked GROUP BY 1""")
def bin_edges_all_rows(spark, folder):
    return binning.bin_edges(pseudo_rating(spark, folder), "rating", skip_closing=False)


@query(_rating_sql(_ALL_KEPT, "rated", "ranked", "edges", "binned")
       + "SELECT user_tag, item_id, klass, rating, label FROM binned")
def rating_bins(spark, folder):
    rated = stored(pseudo_rating(spark, folder), "rated")
    return binning.assign_bins(rated, "rating", binning.bin_edges(rated, "rating"))


@query(_rating_sql(_ALL_KEPT, "rated", "ranked", "edges", "binned") + """SELECT label, count(*) AS n,
    round(count(*) * 1.0 / (SELECT count(*) FROM binned), 6) AS share FROM binned GROUP BY label""")
def bin_population(spark, folder):
    return rounded(binning.bin_population(rating_bins(spark, folder), "label"), "share")


@query(_rating_sql(_PREP_KEPT, "rated", "ranked", "edges", "binned")
       + "SELECT user_tag, item_id, klass, rating, label FROM binned")
def prep_pipeline(spark, folder):
    return prepared_ratings(logical.purchases(spark, folder), logical.products(spark, folder), CLASSES)


@query(with_views("products", edges="SELECT DISTINCT klass, CAST(floor(price / 10) * 10 AS BIGINT) AS edge FROM products")
       + """SELECT klass, CAST(row_number() OVER (PARTITION BY klass ORDER BY edge) - 1 AS INTEGER) AS label,
    edge AS lo, lead(edge) OVER (PARTITION BY klass ORDER BY edge) AS hi
FROM edges QUALIFY hi IS NOT NULL""")
def interval_labels(spark, folder):
    edge = (F.floor(F.col("price") / 10) * 10).alias("edge")
    return binning.intervals(logical.products(spark, folder).select("klass", edge).distinct(), "klass", "edge")
