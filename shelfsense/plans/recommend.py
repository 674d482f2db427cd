"""Rating triples and products to a curated list for every user."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.operators.baseline import item_count_mean
from shelfsense.operators.candidates import best_candidates
from shelfsense.operators.factors import AlsSettings, fit, load, save
from shelfsense.operators.foldin import fold_in
from shelfsense.operators.joins import to_user_ids, to_user_tags, user_bridge, with_products
from shelfsense.operators.ranking import curate
from shelfsense.sources.session import stored
from shelfsense.sources.tables import write_table

RATING_THRESHOLD = 7.0  # fixed value: the production threshold; validation used 9


def curated_lists(
    user_factors: DataFrame,
    item_factors: DataFrame,
    triples: DataFrame,
    bridge: DataFrame,
    products: DataFrame,
    classes: Sequence[str],
    threshold: float = RATING_THRESHOLD,
) -> DataFrame:
    """Curated unpurchased items for every user in ``user_factors``.

    Factor tables are ``(user_id, features)`` and ``(item_id, features)``; products need
    ``item_id, varietal, klass``. Output: the user's tag, the product's columns, ``prediction``,
    ``strategy`` and ``rank``.
    """
    grouped = products.select("item_id", F.col("varietal").alias("category"), "klass")
    best = best_candidates(user_factors, with_products(item_factors, grouped), triples, threshold, classes)
    lists = curate(best, classes, user="user_id", n_rows=best.count()).select("user_id", "item_id", "prediction", "strategy", "rank")
    return with_products(to_user_tags(lists, bridge), products)


@dataclass(frozen=True)
class Trained:
    """A fitted model with what is needed to use it: the integer triples and the tag bridge."""

    model: ALSModel
    triples: DataFrame
    bridge: DataFrame


def integer_triples(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(user_id, item_id, rating)`` on the shared folder, and the bridge back to the tags.

    The ids serve the model only, so they are dense: 32 bits then hold two billion users.
    """
    bridge = user_bridge(ratings, step=1)
    triples = to_user_ids(ratings, bridge).select("user_id", "item_id", "rating")
    return stored(triples, "triples"), bridge


def train(ratings: DataFrame, settings: AlsSettings = AlsSettings(), save_to: str | None = None) -> Trained:
    """``(user_tag, item_id, rating)`` to a fitted model, saved if a path is given."""
    triples, bridge = integer_triples(ratings)
    model = fit(triples, settings)
    if save_to is not None:
        save(model, save_to)
    return Trained(model, triples, bridge)


def factor_tables(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """``(user_id, features)`` and ``(item_id, features)`` of a model."""
    users = model.userFactors.select(F.col("id").cast("long").alias("user_id"), "features")
    items = model.itemFactors.select(F.col("id").cast("long").alias("item_id"), "features")
    return users, items


def recommend_with(
    trained: Trained, products: DataFrame, classes: Sequence[str], threshold: float = RATING_THRESHOLD
) -> DataFrame:
    """Curated lists from a fitted or loaded model."""
    users, items = factor_tables(trained.model)
    return curated_lists(users, items, trained.triples, trained.bridge, products, classes, threshold)


def lists_for(
    model: ALSModel,
    ratings: DataFrame,
    products: DataFrame,
    classes: Sequence[str],
    settings: AlsSettings = AlsSettings(),
    threshold: float = RATING_THRESHOLD,
) -> DataFrame:
    """Curated lists of the users in ``ratings(user_tag, item_id, rating)`` from a model that need not know them.

    Each user's factors are solved from these ratings against the model's items, so users that came or whose
    ratings changed after training get lists without a new fit. ``settings`` are those the model was fitted with.
    """
    triples, bridge = integer_triples(ratings)
    items = factor_tables(model)[1]
    users = fold_in(triples, items, model.rank, settings.reg, settings.nonnegative)
    return curated_lists(users, items, triples, bridge, products, classes, threshold)


def serve_saved(
    spark: SparkSession,
    model_path: str,
    bridge: DataFrame,
    ratings: DataFrame,
    products: DataFrame,
    classes: Sequence[str],
    out: str,
    settings: AlsSettings = AlsSettings(),
    threshold: float = RATING_THRESHOLD,
) -> None:
    """Load a model, list for every user in ``ratings``, and write the lists in one folder per strategy.

    ``bridge(user_tag, user_id)`` holds the ids of training. Users in it keep the model's factors; all others get ids
    above those, and factors folded in from their ratings, instead of vanishing.
    """
    model = load(model_path)
    users, items = factor_tables(model)
    unseen = ratings.join(bridge, "user_tag", "left_anti")
    first = F.coalesce(bridge.agg(F.max("user_id")).scalar(), F.lit(-1)) + 1
    added = user_bridge(unseen, step=1).select("user_tag", (F.col("user_id") + first).alias("user_id"))
    everyone = stored(bridge.select("user_tag", "user_id").unionByName(added), "bridge")
    triples = stored(to_user_ids(ratings, everyone).select("user_id", "item_id", "rating"), "triples")
    new = fold_in(triples.where(F.col("user_id") >= first), items, model.rank, settings.reg, settings.nonnegative)
    known = users.join(triples.select("user_id").distinct(), "user_id", "left_semi")
    lists = curated_lists(stored(known.unionByName(new), "users"), items, triples, everyone, products, classes, threshold)
    write_table(lists, out, ["strategy"])


def recommend(
    ratings: DataFrame,
    products: DataFrame,
    classes: Sequence[str],
    settings: AlsSettings = AlsSettings(),
    threshold: float = RATING_THRESHOLD,
) -> DataFrame:
    """Ratings and products to curated lists: ids, fit, score, curate, enrich."""
    return recommend_with(train(ratings, settings), products, classes, threshold)


def recommend_by_item_mean(
    ratings: DataFrame, products: DataFrame, classes: Sequence[str], threshold: float = RATING_THRESHOLD
) -> DataFrame:
    """The same job with the item-mean baseline as a model of one factor per side."""
    triples, bridge = integer_triples(ratings)
    users = bridge.select("user_id", F.array(F.lit(1.0)).alias("features"))
    items = item_count_mean(triples).select("item_id", F.array("mean_rating").alias("features"))
    return curated_lists(users, items, triples, bridge, products, classes, threshold)
