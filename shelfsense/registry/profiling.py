"""Queries: frequencies, profiles, summaries, segments and seasons."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsense.functions.text import clean_text as clean_bytes
from shelfsense.functions.text import repair_text
from shelfsense.operators import accuracy, baseline, binning, profile, segments
from shelfsense.operators.filters import drop_bulk
from shelfsense.operators.joins import with_products
from shelfsense.registry.core import ALL_CLASSES, listed_purchases, query, rounded, with_views
from shelfsense.sources import logical
from shelfsense.sources.tables import matrix_table

ATTRIBUTES = ["product_name", "klass", "varietal", "size", "price"]
PERIODS = [
    ("december_a", "1996-12-01", "1996-12-31"),
    ("december_b", "1997-12-01", "1997-12-31"),
    ("july_a", "1998-07-01", "1998-07-31"),
    ("july_b", "1999-07-01", "1999-07-31"),
]


@query(with_views("purchases") + "SELECT user_tag, sum(units) AS total_units FROM purchases GROUP BY user_tag")
def purchases_by_user(spark, folder):
    return segments.units_per_user(logical.purchases(spark, folder))


@query(with_views("purchases") + """SELECT max(units) AS max_units, count(*) AS n_purchases,
    count(DISTINCT user_tag) AS n_users, count(DISTINCT item_id) AS n_items FROM purchases""")
def global_counts(spark, folder):
    rows = logical.purchases(spark, folder)
    users = rows.groupBy("user_tag").agg(F.max("units").alias("max_units"), F.count(F.lit(1)).alias("n"))
    items = rows.select("item_id").where("item_id IS NOT NULL").distinct().agg(F.count(F.lit(1))).scalar()
    return users.agg(
        F.max("max_units").alias("max_units"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_purchases"),
        F.count("user_tag").alias("n_users"),
    ).withColumn("n_items", items)


@query(with_views("purchases") + """SELECT count(*) FILTER (t <= 1000) AS n_users,
    round(avg(CASE WHEN t <= 1000 THEN 1 ELSE 0 END), 6) AS share
FROM (SELECT sum(units) AS t FROM purchases GROUP BY user_tag)""")
def user_unit_share(spark, folder):
    totals = segments.units_per_user(logical.purchases(spark, folder))
    return rounded(segments.share_at_most(totals, "total_units", 1000), "share")


def _frequency_sql(view: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {view} GROUP BY {c}"
        for c in columns
    )


@query(with_views("products") + _frequency_sql("products", ATTRIBUTES))
def value_frequency(spark, folder):
    return profile.by_count(profile.value_frequency(logical.products(spark, folder), ATTRIBUTES))


@query(with_views(origins="""SELECT n_name AS nation, r_name AS region FROM supplier
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
       + _frequency_sql("origins", ["nation", "region"]))
def origin_frequency(spark, folder):
    nations = logical.table(spark, folder, "nation").withColumnsRenamed(
        {"n_nationkey": "s_nationkey", "n_name": "nation", "n_regionkey": "r_regionkey"}
    )
    regions = logical.table(spark, folder, "region").withColumnRenamed("r_name", "region")
    origins = logical.table(spark, folder, "supplier").join(nations, "s_nationkey").join(regions, "r_regionkey")
    return profile.value_frequency(origins, ["nation", "region"])


@query("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n_present, count(*) - count({c}) AS n_missing,
    count(DISTINCT {c}) AS n_distinct, round((count(*) - count({c})) * 1.0 / count(*), 6) AS missing_share
FROM documents LEFT JOIN labels USING (doc_id)"""
    for c in ["lang", "source", "quality", "toxic"]
))
def column_profile(spark, folder):
    rows = logical.table(spark, folder, "documents").join(logical.table(spark, folder, "labels"), "doc_id", "left")
    return rounded(profile.column_profile(rows, ["lang", "source", "quality", "toxic"]), "missing_share")


@query("""SELECT count(*) - count(quality) AS n_missing, count(quality) AS n_present,
    round((count(*) - count(quality)) * 1.0 / count(*), 6) AS missing_share
FROM documents LEFT JOIN labels USING (doc_id)""")
def null_ratio(spark, folder):
    rows = logical.table(spark, folder, "documents").join(logical.table(spark, folder, "labels"), "doc_id", "left")
    return rounded(profile.null_ratio(rows, "quality"), "missing_share")


@query(with_views("products") + "SELECT DISTINCT klass, varietal FROM products")
def distinct_values(spark, folder):
    return profile.distinct_values(logical.products(spark, folder), ["klass", "varietal"])


@query(with_views("purchases") + """SELECT count(t) AS n, round(avg(t), 6) AS mean, round(stddev_samp(t), 6) AS std,
    min(t) AS min, max(t) AS max, round(quantile_cont(t, 0.25), 6) AS q25, round(quantile_cont(t, 0.5), 6) AS q50,
    round(quantile_cont(t, 0.75), 6) AS q75
FROM (SELECT sum(units) AS t FROM purchases GROUP BY user_tag)""")
def numeric_summary(spark, folder):
    totals = segments.units_per_user(logical.purchases(spark, folder))
    return rounded(profile.numeric_summary(totals, "total_units"), "mean", "std", "q25", "q50", "q75")


@query(with_views("purchases") + """SELECT bin, count(*) AS n, CAST(bin * 40 AS DOUBLE) AS bin_lo
FROM (SELECT CAST(least(floor(t / 40), 99) AS INTEGER) AS bin
    FROM (SELECT sum(units) AS t FROM purchases GROUP BY user_tag) WHERE t BETWEEN 0 AND 4000)
GROUP BY bin""")
def equal_width_histogram(spark, folder):
    totals = segments.units_per_user(logical.purchases(spark, folder))
    return binning.equal_width_histogram(totals, "total_units", 0.0, 4000.0, 100)


@query(with_views("products") + "SELECT CAST(ceil(price) AS BIGINT) AS value, count(*) AS n FROM products GROUP BY 1")
def ceil_histogram(spark, folder):
    return binning.ceil_histogram(logical.products(spark, folder), "price")


@query(with_views("purchases") + "SELECT date, count(*) AS n FROM purchases GROUP BY date")
def daily_purchases(spark, folder):
    return profile.by_count(segments.purchases_per_day(logical.purchases(spark, folder)), "date", by_value=True)


@query(with_views("purchases", "triples") + """SELECT item_id, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating
FROM triples GROUP BY item_id""")
def item_count_mean(spark, folder):
    return baseline.item_count_mean(logical.rating_triples(spark, folder))


@query(with_views("purchases", "triples") + """SELECT n_pairs, n_rows, n_columns,
    round(n_pairs * 1.0 / (n_rows * n_columns), 6) AS density
FROM (SELECT count(*) AS n_pairs, count(DISTINCT user_tag) AS n_rows, count(DISTINCT item_id) AS n_columns FROM triples)""")
def rating_density(spark, folder):
    return rounded(accuracy.density(logical.rating_triples(spark, folder), "user_tag", "item_id"), "density")


@query(with_views("purchases", "triples", "products") + """SELECT 'varietal' AS "column", varietal AS value, count(*) AS n
FROM triples JOIN products USING (item_id) GROUP BY varietal""")
def ratings_per_category(spark, folder):
    rated = with_products(logical.rating_triples(spark, folder), logical.products(spark, folder))
    return profile.value_frequency(rated, ["varietal"])


@query(with_views("purchases", "triples", "products") + """SELECT item_id, price, rating
FROM triples JOIN products USING (item_id)""")
def price_vs_rating(spark, folder):
    rated = with_products(logical.rating_triples(spark, folder), logical.products(spark, folder))
    return rated.select("item_id", "price", "rating").orderBy("item_id")


@query(with_views("purchases") + """SELECT user_tag, item_id, round(avg(units), 6) AS mean_units
FROM purchases GROUP BY ALL""")
def rating_pivot_long(spark, folder):
    means = logical.purchases(spark, folder).groupBy("user_tag", "item_id").agg(F.avg("units").alias("mean_units"))
    return rounded(means, "mean_units")


@query(with_views("purchases", "products") + "SELECT user_tag, " + ", ".join(
    f"coalesce(round(avg(units) FILTER (klass = '{c}'), 6), 0) AS {c}" for c in ALL_CLASSES
) + " FROM purchases JOIN products USING (item_id) GROUP BY user_tag")
def matrix_pivot(spark, folder):
    rows = with_products(logical.purchases(spark, folder), logical.products(spark, folder).select("item_id", "klass"))
    cells = rows.groupBy("user_tag", "klass").agg(F.round(F.avg("units"), 6).alias("mean_units"))
    return matrix_table(cells, "user_tag", "klass", "mean_units", ALL_CLASSES)


@query(with_views("products", known="SELECT *, nullif(klass, 'PROMO') AS style FROM products", usual="""
        SELECT varietal, product_name, style AS usual FROM known WHERE style IS NOT NULL
        GROUP BY varietal, product_name, style
        QUALIFY row_number() OVER (PARTITION BY varietal, product_name ORDER BY count(*) DESC, style) = 1""")
       + """SELECT item_id, coalesce(style, usual) AS style
FROM known LEFT JOIN usual USING (varietal, product_name)""")
def imputed_style(spark, folder):
    known = logical.products(spark, folder).withColumn("style", F.when(F.col("klass") != "PROMO", F.col("klass")))
    return profile.impute_by_similar(known, "style", ["varietal", "product_name"]).select("item_id", "style")


_SMALL_TOTALS = "SELECT user_tag, sum(units) AS total_units FROM listed_purchases WHERE units < 10 GROUP BY user_tag"
_SEGMENTED = """SELECT user_tag, total_units, CASE
        WHEN total_units > 100 THEN 'onehundred_plus' WHEN total_units >= 26 THEN 'twentysix_onehundred'
        WHEN total_units = 25 THEN 'twentyfive' WHEN total_units >= 13 THEN 'thirteen_twentyfour'
        WHEN total_units = 12 THEN 'twelve' WHEN total_units >= 7 THEN 'seven_eleven' WHEN total_units = 6 THEN 'six'
        WHEN total_units = 5 THEN 'five' WHEN total_units = 4 THEN 'four' WHEN total_units = 3 THEN 'three'
        WHEN total_units = 2 THEN 'two' WHEN total_units = 1 THEN 'one' END AS segment FROM totals"""


@query(with_views("purchases", "products", "listed_purchases", totals=_SMALL_TOTALS, segmented=_SEGMENTED)
       + "SELECT * FROM segmented")
def user_segments(spark, folder):
    return segments.user_segments(drop_bulk(listed_purchases(spark, folder)))


@query(with_views("purchases", "products", "listed_purchases", totals=_SMALL_TOTALS, segmented=_SEGMENTED)
       + """SELECT segment, list_no,
    to_json({'segment': segment, 'users': list(user_tag ORDER BY user_tag)})::VARCHAR AS json
FROM (SELECT segment, user_tag,
    CAST((row_number() OVER (PARTITION BY segment ORDER BY user_tag) - 1) // 1000 AS BIGINT) AS list_no FROM segmented)
GROUP BY segment, list_no""")
def segment_lists_json(spark, folder):
    return segments.segment_lists(user_segments(spark, folder))


_SEASONS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS period, item_id, sum(units) AS total_units FROM purchases "
    f"WHERE date BETWEEN DATE '{a}' AND DATE '{b}' GROUP BY item_id"
    for name, a, b in PERIODS
)


@query(with_views("purchases", seasons=_SEASONS) + "SELECT * FROM seasons")
def season_units(spark, folder):
    return segments.season_units(logical.purchases(spark, folder), PERIODS)


@query(with_views("purchases", seasons=_SEASONS) + "SELECT * FROM seasons WHERE total_units IN (1, 2, 3, 12)")
def season_exact_units(spark, folder):
    return segments.exact_units(season_units(spark, folder))


@query(with_views("purchases", seasons=_SEASONS) + """SELECT CAST(least(floor(total_units), 49) AS INTEGER) AS bin,
    count(*) AS n, CAST(least(floor(total_units), 49) AS DOUBLE) AS bin_lo
FROM seasons WHERE period = 'december_a' AND total_units BETWEEN 0 AND 50 GROUP BY ALL""")
def season_histogram(spark, folder):
    december = season_units(spark, folder).where("period = 'december_a'")
    return binning.equal_width_histogram(december, "total_units", 0.0, 50.0, 50)


@query("SELECT doc_id, text AS as_is, text AS from_double_decoding, text AS from_bytes FROM documents")
def clean_text(spark, folder):
    """Whole texts three ways: as they are, decoded once too often, and as bytes of the narrowest charset."""
    text = F.col("text")
    double = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    fits = F.when(text.rlike(r"^[\x00-\xFF]*$"), text)
    raw = F.coalesce(F.encode(fits, "ISO-8859-1"), F.encode(text, "UTF-8"))
    return logical.table(spark, folder, "documents").select(
        "doc_id",
        repair_text(text).alias("as_is"),
        repair_text(double).alias("from_double_decoding"),
        clean_bytes(raw).alias("from_bytes"),
    )
