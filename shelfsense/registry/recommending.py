"""Queries: candidates, curation, and the ALS jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsense.operators import candidates, factors, joins, ranking
from shelfsense.operators.factors import AlsSettings
from shelfsense.operators.joins import with_products
from shelfsense.plans.prepare import prepared_ratings
from shelfsense.plans.recommend import integer_triples, recommend, recommend_by_item_mean
from shelfsense.plans.validate import als_roc_study
from shelfsense.registry.core import ALL_CLASSES, CLASSES, query, scored_purchases, stored_triples, with_views
from shelfsense.registry.measuring import _BRIDGE as BRIDGE
from shelfsense.sources import logical
from shelfsense.sources.session import cut_lineage, fresh_path, stored

_SCORED = ("purchases", "products", "triples", "hashed", "train", "item_means", "scored")
_LISTED = "'PROMO', 'ECONOMY'"


def _curation(candidates: str, user: str) -> dict[str, str]:
    """SQL of the curation steps over a table of candidates."""
    return {
        "counts": f"SELECT {user}, category, count(*) AS n_items FROM {candidates} GROUP BY ALL",
        "top": f"""SELECT *, CAST(row_number() OVER (PARTITION BY {user} ORDER BY n_items DESC, category) AS INTEGER)
            AS category_rank FROM counts QUALIFY category_rank <= 3""",
        "best": f"""SELECT *, CAST(row_number() OVER (PARTITION BY {user}, category ORDER BY prediction DESC, item_id)
            AS INTEGER) AS item_rank FROM {candidates} QUALIFY item_rank <= 3""",
        "by_class": f"""SELECT *, CAST(row_number() OVER (PARTITION BY {user}, klass ORDER BY prediction DESC, item_id)
            AS INTEGER) AS item_rank FROM {candidates} WHERE klass IN ({_LISTED}) QUALIFY item_rank <= 5""",
        "choice": f"""SELECT {user}, count(*) AS n_top, count(*) FILTER (n_items >= 3) AS n_full,
            CASE WHEN count(*) FILTER (n_items >= 3) = 3 THEN 'categories' ELSE 'classes' END AS strategy
            FROM top GROUP BY {user}""",
        "lists": f"""SELECT {user}, item_id, prediction, strategy, CAST(category_rank AS VARCHAR) AS part
            FROM best JOIN top USING ({user}, category) JOIN choice USING ({user}) WHERE strategy = 'categories'
            UNION ALL SELECT {user}, item_id, prediction, strategy, klass
            FROM by_class JOIN choice USING ({user}) WHERE strategy = 'classes'""",
    }


_STEPS = _curation("scored", "user_tag")
_RANK = "CAST(row_number() OVER (PARTITION BY user_tag ORDER BY part, prediction DESC, item_id) AS INTEGER) AS rank"


@query(with_views(*_SCORED, **_STEPS) + "SELECT * FROM top")
def top_categories(spark, folder):
    return ranking.top_categories(scored_purchases(spark, folder))


@query(with_views(*_SCORED, **_STEPS) + """SELECT user_tag, item_id, prediction, category, klass, item_rank, n_items,
    category_rank FROM best JOIN top USING (user_tag, category)""")
def top_items_in_top_categories(spark, folder):
    return ranking.top_items_in_categories(scored_purchases(spark, folder))


@query(with_views(*_SCORED, **_STEPS) + "SELECT user_tag, item_id, prediction, category, klass, item_rank FROM by_class")
def top_by_class(spark, folder):
    return ranking.top_items_by_class(scored_purchases(spark, folder), CLASSES)


@query(with_views(*_SCORED, **_STEPS) + "SELECT user_tag, n_top, n_full, strategy FROM choice")
def curation_strategy(spark, folder):
    return ranking.curation_strategy(scored_purchases(spark, folder))


@query(with_views(*_SCORED, **_STEPS) + "SELECT strategy, count(*) AS n_users FROM choice GROUP BY strategy")
def curation_strategy_count(spark, folder):
    return ranking.strategy_counts(curation_strategy(spark, folder))


@query(with_views(*_SCORED, **_STEPS) + f"SELECT user_tag, item_id, prediction, strategy, {_RANK} FROM lists")
def curated_scores(spark, folder):
    lists = ranking.curate(scored_purchases(spark, folder), CLASSES, n_rows=logical.table(spark, folder, "lineitem").count())
    return lists.select("user_tag", "item_id", "prediction", "strategy", "rank")


@query(with_views("purchases", "triples", bridge=BRIDGE) + """SELECT 700::BIGINT AS user_id, item_id
FROM (SELECT DISTINCT item_id FROM triples)
WHERE item_id NOT IN (SELECT item_id FROM triples JOIN bridge USING (user_tag) WHERE user_id = 700)""")
def unpurchased_items(spark, folder):
    ratings = stored_triples(spark, folder)
    triples = joins.to_user_ids(ratings, joins.user_bridge(ratings))
    return candidates.unpurchased_items(triples, 700).withColumn("user_id", F.col("user_id").cast("long"))


@query(with_views("purchases", "triples") + """SELECT user_tag, count(*) AS n_unpurchased
FROM (SELECT user_tag, item_id FROM (SELECT DISTINCT user_tag FROM triples)
        CROSS JOIN (SELECT DISTINCT item_id FROM triples)
    EXCEPT SELECT user_tag, item_id FROM triples) GROUP BY user_tag""")
def unpurchased_counts(spark, folder):
    return candidates.unpurchased_counts(stored_triples(spark, folder), user="user_tag")


@query(with_views(*_SCORED) + """SELECT user_tag, item_id, prediction, product_name, s.klass, varietal, size, price
FROM scored s JOIN products p USING (item_id)""")
def enriched_recommendations(spark, folder):
    ratings = stored_triples(spark, folder)
    bridge = cut_lineage(joins.user_bridge(ratings))
    recs = joins.to_user_ids(scored_purchases(spark, folder).select("user_tag", "item_id", "prediction"), bridge)
    return with_products(joins.to_user_tags(recs, bridge), logical.products(spark, folder))


_UNBOUGHT = """SELECT user_tag, item_id, prediction, varietal AS category, klass
        FROM (SELECT DISTINCT user_tag FROM triples)
            CROSS JOIN (SELECT item_id, round(avg(rating), 6) AS prediction FROM triples GROUP BY item_id) m
            JOIN products USING (item_id)
        WHERE prediction >= 6.5 AND (user_tag, item_id) NOT IN (SELECT (user_tag, item_id) FROM triples)"""


@query(with_views("purchases", "products", "triples", unbought=_UNBOUGHT, **_curation("unbought", "user_tag"))
       + f"""SELECT user_tag, item_id, prediction, strategy, rank, product_name, klass, varietal, size, price
FROM (SELECT *, {_RANK} FROM lists) JOIN products USING (item_id)""")
def curated_recommendations(spark, folder):
    """All unpurchased items of all users, scored by item mean, kept at 6.5 or more and curated."""
    ratings = stored_triples(spark, folder)
    return recommend_by_item_mean(ratings, logical.products(spark, folder), CLASSES, threshold=6.5)


def _triples(spark, folder):
    """Integer rating triples with dense ids on the shared folder, as every fit reads them again."""
    return integer_triples(stored_triples(spark, folder))[0]


@query()
def als_fit_rmse(spark, folder):
    _, test, pairs = factors.train_and_test(_triples(spark, folder), settings=AlsSettings())
    error = F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), F.lit(2))))
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"), error.alias("rmse"))


@query()
def als_predict(spark, folder):
    return factors.train_and_test(_triples(spark, folder), settings=AlsSettings())[2]


_DENSE = BRIDGE.replace("* 100", "* 1")
_HASHED_IDS = """SELECT *, CAST('0x' || substr(md5(concat_ws('|', user_id, item_id)), 1, 8) AS BIGINT)
            / 4294967296.0 AS place FROM triples JOIN bridge USING (user_tag)"""


@query(with_views("purchases", "triples", bridge=_DENSE, hashed=_HASHED_IDS,
                  users="SELECT DISTINCT user_id FROM hashed WHERE place < 0.05",
                  items="SELECT DISTINCT item_id FROM hashed WHERE place < 0.05")
       + """SELECT user_id, item_id, rating FROM hashed JOIN users USING (user_id) JOIN items USING (item_id)
WHERE place >= 0.05""")
def als_prediction_coverage(spark, folder):
    """Which test pairs get a prediction when only 5 % of the ratings are seen in training."""
    _, test, pairs = factors.train_and_test(_triples(spark, folder), test_fraction=0.95, settings=AlsSettings())
    return pairs.where("prediction is not null").select(
        F.col("user_id").cast("long"), F.col("item_id").cast("long"), "rating"
    )


@query(with_views("purchases", "triples") + """SELECT 20::INTEGER AS rank, count(*) AS n_pairs,
    0::BIGINT AS n_different FROM triples""")
def als_model_roundtrip(spark, folder):
    """Save over an older model, load, and compare the predictions of both models on all pairs."""
    triples = _triples(spark, folder)
    model = factors.fit(triples, AlsSettings())
    path = fresh_path(spark, "als-model")
    factors.save(model, path)
    factors.save(model, path)
    loaded = factors.load(path)
    before = factors.predict(model, triples)
    after = factors.predict(loaded, triples).withColumnRenamed("prediction", "reloaded")
    both = before.join(after.select("user_id", "item_id", "reloaded"), ["user_id", "item_id"])
    return both.agg(
        F.lit(loaded.rank).cast("int").alias("rank"),
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.col("prediction") != F.col("reloaded")).alias("n_different"),
    )


@query()
def als_learning_curve(spark, folder):
    return factors.learning_curve(_triples(spark, folder))


@query()
def als_regularization_scan(spark, folder):
    return factors.regularisation_scan(_triples(spark, folder))


@query()
def als_grid_search(spark, folder):
    curves = factors.grid_search(_triples(spark, folder), (0.1, 0.01), (4, 8), (3, 5), train_fractions=(0.8,))
    return factors.lowest_errors(curves, k=6, ties=["reg", "rank", "max_iter"])


@query()
def als_rank_search(spark, folder):
    return factors.rank_search(_triples(spark, folder), settings=AlsSettings(max_iter=10, nonnegative=False))


@query()
def als_recommend(spark, folder):
    ratings = stored_triples(spark, folder)
    return recommend(ratings, logical.products(spark, folder), CLASSES, AlsSettings())


@query()
def lists_from_purchases(spark, folder):
    """The whole way: clean and rate the purchases of all classes, bin, fit, and curate at the production threshold."""
    products = logical.products(spark, folder)
    rated = prepared_ratings(logical.purchases(spark, folder), products, ALL_CLASSES, bulk_units=51)
    ratings = stored(rated.select("user_tag", "item_id", F.col("label").alias("rating")), "ratings")
    return recommend(ratings, products, CLASSES, AlsSettings())


@query()
def als_roc_auc(spark, folder):
    return als_roc_study(_triples(spark, folder), AlsSettings())
