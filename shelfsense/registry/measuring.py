"""Queries: ids, splits, samples, errors and ROC measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsense.operators import accuracy, baseline, factors, joins, sampling
from shelfsense.operators.filters import at_least
from shelfsense.plans.validate import roc_study, user_report
from shelfsense.registry.core import (
    KEYS, predict_test, query, rounded, stored_triples, test_pairs, train_and_test, with_views,
)
from shelfsense.sources import logical

_TRIPLES = ("purchases", "triples", "hashed")
_PAIRS = (*_TRIPLES, "train", "test", "item_means", "pairs")
_USER_COLUMNS = ["user_tag", "item_id", "rating"]


@query(with_views("purchases", "triples") + """SELECT user_tag, (row_number() OVER (ORDER BY user_tag) - 1) * 100 AS user_id
FROM (SELECT DISTINCT user_tag FROM triples)""")
def user_bridge(spark, folder):
    return joins.user_bridge(logical.rating_triples(spark, folder))


_BRIDGE = """SELECT user_tag, (row_number() OVER (ORDER BY user_tag) - 1) * 100 AS user_id
        FROM (SELECT DISTINCT user_tag FROM triples)"""


@query(with_views("purchases", "triples", bridge=_BRIDGE)
       + "SELECT user_id, item_id, rating FROM triples JOIN bridge USING (user_tag)")
def rating_triples(spark, folder):
    ratings = stored_triples(spark, folder)
    return joins.to_user_ids(ratings, joins.user_bridge(ratings))


@query(with_views(*_TRIPLES) + """SELECT user_tag, item_id, rating,
    CASE WHEN h / 4294967296.0 >= 0.8 THEN 2 WHEN h / 4294967296.0 >= 0.6 THEN 1 ELSE 0 END AS part FROM hashed""")
def hash_split(spark, folder):
    return sampling.split_by_weights(logical.rating_triples(spark, folder), KEYS, [6, 2, 2])


@query(with_views(*_TRIPLES) + """SELECT user_tag, item_id, rating,
    row_number() OVER (ORDER BY h, user_tag, item_id) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM hashed""")
def exact_split(spark, folder):
    return sampling.split_exact(stored_triples(spark, folder), KEYS, 0.2)


@query(with_views(*_TRIPLES) + """SELECT user_tag, item_id, rating,
    row_number() OVER (PARTITION BY rating ORDER BY h, user_tag, item_id)
        <= floor(0.2 * count(*) OVER (PARTITION BY rating) + 0.5) AS is_test FROM hashed""")
def stratified_split(spark, folder):
    return sampling.split_stratified(stored_triples(spark, folder), KEYS, "rating", 0.2)


@query(with_views(*_TRIPLES) + "SELECT user_tag, item_id, rating FROM hashed ORDER BY h, user_tag, item_id LIMIT 20000")
def sample_n(spark, folder):
    return sampling.sample_rows(stored_triples(spark, folder), KEYS, 20_000)


@query(with_views(*_TRIPLES) + """SELECT user_tag, item_id, rating,
    row_number() OVER (ORDER BY h, user_tag, item_id) - 1 AS position FROM hashed""")
def seeded_shuffle(spark, folder):
    return sampling.shuffled(logical.rating_triples(spark, folder), KEYS)


_FRACTIONS = "SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS train_fraction"


@query(with_views(*_TRIPLES, fractions=_FRACTIONS) + """SELECT train_fraction,
    count(*) FILTER (h / 4294967296.0 < train_fraction) AS n_train,
    count(*) FILTER (h / 4294967296.0 >= train_fraction) AS n_test
FROM hashed CROSS JOIN fractions GROUP BY train_fraction""")
def learning_fractions(spark, folder):
    return sampling.nested_fractions(logical.rating_triples(spark, folder), KEYS, factors.TRAIN_FRACTIONS)


@query(with_views("purchases") + """SELECT user_tag, item_id, units, date,
    count(*) OVER (PARTITION BY user_tag) AS n_rows FROM purchases""")
def rows_with_user_count(spark, folder):
    return joins.with_group_size(logical.purchases(spark, folder), "user_tag")


@query(with_views(*_PAIRS) + "SELECT user_tag, item_id, rating, prediction FROM pairs")
def actual_vs_predicted(spark, folder):
    triples = stored_triples(spark, folder)
    _, test = train_and_test(triples)
    predicted = predict_test(triples).select("user_tag", "item_id", "prediction")
    return joins.actual_and_predicted(test, predicted, user="user_tag")


@query(with_views(*_PAIRS) + """SELECT count(*) AS n_pairs,
    round(sqrt(avg((rating - prediction) ** 2)), 6) AS rmse FROM pairs""")
def item_mean_rmse(spark, folder):
    return rounded(baseline.item_mean_rmse(*train_and_test(stored_triples(spark, folder))), "rmse")


@query(with_views(*_PAIRS) + """SELECT rating, count(*) AS n_pairs,
    round(sqrt(avg((rating - prediction) ** 2)), 6) AS rmse FROM pairs GROUP BY rating""")
def rmse_by_rating(spark, folder):
    return rounded(accuracy.rmse(test_pairs(spark, folder), by=["rating"]), "rmse")


@query(with_views(*_PAIRS) + """SELECT user_tag, item_id, rating FROM test
WHERE user_tag IN (SELECT user_tag FROM pairs WHERE prediction >= 6)""")
def common_users(spark, folder):
    triples = stored_triples(spark, folder)
    _, test = train_and_test(triples)
    predicted = at_least(predict_test(triples), "prediction", 6)
    return joins.common_users(test, predicted, user="user_tag").select(*_USER_COLUMNS)


@query(with_views(*_PAIRS) + """SELECT user_tag, item_id, rating FROM test
WHERE (user_tag, item_id) IN (SELECT (user_tag, item_id) FROM pairs WHERE prediction >= 6)""")
def common_pairs(spark, folder):
    triples = stored_triples(spark, folder)
    _, test = train_and_test(triples)
    predicted = at_least(predict_test(triples), "prediction", 6)
    return joins.common_pairs(test, predicted, user="user_tag").select(*_USER_COLUMNS)


@query(with_views(*_PAIRS) + """SELECT user_tag, n_left, n_right
FROM (SELECT user_tag, count(*) AS n_left FROM test GROUP BY 1)
    JOIN (SELECT user_tag, count(*) AS n_right FROM pairs WHERE prediction >= 6 GROUP BY 1) USING (user_tag)
WHERE n_left <> n_right""")
def set_size_mismatch(spark, folder):
    triples = stored_triples(spark, folder)
    _, test = train_and_test(triples)
    return accuracy.set_size_mismatch(test, at_least(predict_test(triples), "prediction", 6), "user_tag")


_THRESHOLDS = "SELECT unnest([2, 3, 4, 5, 6, 7, 8, 9, 10])::DOUBLE AS threshold"
_LEVELS = """SELECT min_pairs, rating, prediction FROM (SELECT *, count(*) OVER (PARTITION BY user_tag) AS k FROM pairs)
        JOIN (SELECT unnest([3, 4, 5, 6, 7, 8, 9, 10])::INTEGER AS min_pairs) ON k >= min_pairs"""


def _counts(rows: str, actual_at: str = "threshold", by: str = "") -> str:
    return f"""SELECT {by} threshold,
            count(*) FILTER (rating >= {actual_at} AND prediction >= threshold) AS tp,
            count(*) FILTER (rating < {actual_at} AND prediction >= threshold) AS fp,
            count(*) FILTER (rating >= {actual_at} AND prediction < threshold) AS fn,
            count(*) FILTER (rating < {actual_at} AND prediction < threshold) AS tn
        FROM {rows} CROSS JOIN thresholds GROUP BY ALL"""


_RATES = """SELECT *, CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) END AS tpr,
            CASE WHEN fp + tn > 0 THEN fp * 1.0 / (fp + tn) END AS fpr FROM counts"""
_ROUNDED_RATES = "SELECT * REPLACE (round(tpr, 6) AS tpr, round(fpr, 6) AS fpr) FROM rates"


def _points(by: str = "") -> str:
    keys = f"SELECT DISTINCT {by} NULL::DOUBLE AS threshold," if by else "SELECT NULL::DOUBLE AS threshold,"
    source = " FROM counts" if by else ""
    return f"""SELECT {by} threshold, fpr, tpr FROM rates WHERE tpr IS NOT NULL AND fpr IS NOT NULL
        UNION ALL {keys} 1.0, 1.0{source} UNION ALL {keys} 0.0, 0.0{source}"""


_AREAS = """SELECT min_pairs, round(sum((fpr - x) * (tpr + y) / 2), 6) AS auc
FROM (SELECT min_pairs, fpr, tpr, lag(fpr) OVER w AS x, lag(tpr) OVER w AS y FROM points
    WINDOW w AS (PARTITION BY min_pairs ORDER BY fpr, tpr))
GROUP BY min_pairs"""


@query(with_views(*_PAIRS, thresholds=_THRESHOLDS, counts=_counts("pairs"), rates=_RATES) + _ROUNDED_RATES)
def confusion_by_threshold(spark, folder):
    return rounded(accuracy.confusion_by_threshold(test_pairs(spark, folder)), "tpr", "fpr")


@query(with_views(*_PAIRS, thresholds=_THRESHOLDS, counts=_counts("pairs", "7"), rates=_RATES) + _ROUNDED_RATES)
def confusion_fixed_positive(spark, folder):
    rates = accuracy.confusion_by_threshold(test_pairs(spark, folder), positive_at=7.0)
    return rounded(rates, "tpr", "fpr")


@query(with_views(*_PAIRS, thresholds=_THRESHOLDS, counts=_counts("pairs"), rates=_RATES, points=_points())
       + "SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM points")
def roc_points(spark, folder):
    rates = accuracy.confusion_by_threshold(test_pairs(spark, folder))
    return rounded(accuracy.roc_points(rates), "fpr", "tpr")


@query(with_views(*_PAIRS, thresholds=_THRESHOLDS, levels=_LEVELS, counts=_counts("levels", by="min_pairs,"), rates=_RATES)
       + _ROUNDED_RATES)
def roc_by_activity(spark, folder):
    return rounded(accuracy.activity_rates(test_pairs(spark, folder), "user_tag"), "tpr", "fpr")


@query(with_views(*_PAIRS, thresholds=_THRESHOLDS, levels=_LEVELS, counts=_counts("levels", by="min_pairs,"),
                  rates=_RATES, points=_points("min_pairs,")) + _AREAS)
def roc_auc(spark, folder):
    return rounded(roc_study(test_pairs(spark, folder), "user_tag"), "auc")


@query(with_views(*_PAIRS, "products") + """SELECT user_tag, item_id, rating, prediction, product_name, klass, varietal,
    size, price FROM pairs JOIN products USING (item_id) WHERE user_tag = 'Customer#000000007'
ORDER BY item_id LIMIT 10""")
def user_actual_vs_predicted(spark, folder):
    return user_report(test_pairs(spark, folder), logical.products(spark, folder), "Customer#000000007")


def _mean_curve(by: str) -> str:
    key = f"{by}, " if by else ""
    using = f"USING ({by}, train_fraction)" if by else "USING (train_fraction)"
    return f"""SELECT '{by or "global"}' AS mean_of, train_fraction,
    round(sqrt(avg((rating - prediction) ** 2) FILTER (train)), 6) AS train_rmse,
    round(sqrt(avg((rating - prediction) ** 2) FILTER (NOT train)), 6) AS test_rmse
FROM spread JOIN (SELECT {key}train_fraction, round(avg(rating), 6) AS prediction FROM spread WHERE train GROUP BY ALL)
    {using} GROUP BY train_fraction"""


_SPREAD = "SELECT *, h / 4294967296.0 < train_fraction AS train FROM hashed CROSS JOIN fractions"
_CURVES = "\nUNION ALL\n".join(_mean_curve(by) for by in ("item_id", "user_tag", ""))


@query(with_views(*_TRIPLES, fractions=_FRACTIONS, spread=_SPREAD) + _CURVES)
def baseline_learning_curve(spark, folder):
    ratings = stored_triples(spark, folder)
    curves = None
    for name, key in (("item_id", ["item_id"]), ("user_tag", ["user_tag"]), ("global", [])):
        curve = baseline.mean_learning_curve(ratings, KEYS, key, "rating", factors.TRAIN_FRACTIONS)
        curve = rounded(curve, "train_rmse", "test_rmse").withColumn("mean_of", F.lit(name))
        curves = curve if curves is None else curves.unionByName(curve)
    return curves


@query(with_views(*_TRIPLES, fractions=_FRACTIONS, spread=_SPREAD, curves=_CURVES) + """SELECT * FROM curves
WHERE train_fraction = (SELECT max(train_fraction) FROM curves) ORDER BY test_rmse, mean_of LIMIT 2""")
def lowest_error_params(spark, folder):
    return factors.lowest_errors(baseline_learning_curve(spark, folder), k=2, ties=["mean_of"])
