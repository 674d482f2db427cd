"""Hold-out validation: RMSE, ROC points by activity level, and areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.operators.accuracy import activity_rates, auc, roc_points
from shelfsense.operators.factors import AlsSettings, train_and_test


def roc_study(pairs: DataFrame, user: str = "user_id") -> DataFrame:
    """Area under the curve per activity level, from actual and predicted ratings."""
    return auc(roc_points(activity_rates(pairs, user), ["min_pairs"]), ["min_pairs"])


def als_roc_study(triples: DataFrame, settings: AlsSettings = AlsSettings()) -> DataFrame:
    """Split, fit, predict the test rows, and measure. ``predict`` leaves out unseen users and items."""
    _, _, pairs = train_and_test(triples, settings=settings)
    return roc_study(pairs)


def user_report(
    predictions: DataFrame, products: DataFrame, user_tag: str, klass: str | None = None, n: int = 10
) -> DataFrame:
    """One user's actual and predicted ratings with product attributes, first ``n`` items by id.

    ``predictions`` holds ``user_tag, item_id, rating, prediction``.
    """
    own = predictions.where(predictions.user_tag == user_tag).join(products, "item_id")
    if klass is not None:
        own = own.where(own.klass == klass)
    return own.distinct().orderBy("item_id").limit(n)


def user_reports(predictions: DataFrame, products: DataFrame, classes: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """``user_report`` of every user: the first ``n`` items by id, with ``rank`` from 1.

    Each user's rows are at most one per item of the catalogue; Spark cuts them to ``n`` before they are shuffled.
    """
    listed = products if classes is None else products.where(F.col("klass").isin(list(classes)))
    rows = predictions.join(listed, "item_id").distinct()
    place = F.row_number().over(Window.partitionBy("user_tag").orderBy("item_id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= n)
