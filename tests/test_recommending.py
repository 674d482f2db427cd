"""Curation, the blocked scorer against brute force, and the ALS jobs."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.operators import candidates, factors, joins, ranking
from shelfsense.operators.factors import AlsSettings
from shelfsense.plans.recommend import Trained, recommend_with, train
from shelfsense.sources import logical
from shelfsense.sources.session import fresh_path

CLASSES = ["Red", "White"]
SMALL = AlsSettings(rank=4, max_iter=3, blocks=4)


def test_bridge_ids_follow_the_sorted_tags(spark):
    ratings = spark.createDataFrame([("c",), ("a",), ("b",), ("a",)], "user_tag string")
    assert {r.user_tag: r.user_id for r in joins.user_bridge(ratings).collect()} == {"a": 0, "b": 100, "c": 200}


def test_unpurchased(spark):
    triples = spark.createDataFrame([(0, 10, 5), (0, 11, 6), (100, 10, 7), (100, 12, 8)], "user_id long, item_id long, rating int")
    assert [tuple(r) for r in candidates.unpurchased_items(triples, 0).collect()] == [(0, 12)]
    assert [tuple(r) for r in candidates.unpurchased_items(triples, 100).collect()] == [(100, 11)]
    assert {r.user_id: r.n_unpurchased for r in candidates.unpurchased_counts(triples).collect()} == {0: 1, 100: 1}


def candidate_rows(user, sizes, klass="Red"):
    return [
        (user, f"{category}{i}", category, klass, 9.0 - i)
        for category, n in sizes.items() for i in range(n)
    ]


def test_choice_of_curation(spark):
    rich = candidate_rows("rich", {"A": 4, "B": 3, "C": 3, "D": 1})
    poor = candidate_rows("poor", {"A": 4, "B": 3}) + candidate_rows("poor", {"C": 2}, "Other")
    df = spark.createDataFrame(rich + poor, "user_tag string, item_id string, category string, klass string, prediction double")
    lists = defaultdict(list)
    for r in ranking.curate(df, CLASSES).orderBy("user_tag", "rank").collect():
        lists[r.user_tag, r.strategy].append(r.item_id)
    assert lists == {
        ("rich", "categories"): ["A0", "A1", "A2", "B0", "B1", "B2", "C0", "C1", "C2"],
        ("poor", "classes"): ["A0", "B0", "A1", "B1", "A2"],
    }
    strategies = ranking.strategy_counts(ranking.curation_strategy(df)).collect()
    assert {r.strategy: r.n_users for r in strategies} == {"categories": 1, "classes": 1}


def brute_force(users, items, bought, threshold):
    """Curated lists by scoring every pair, one user at a time."""
    lists = {}
    for user, vector in users.items():
        open_items = [(float(vector @ v), i, c, k) for i, (v, c, k) in items.items() if (user, i) not in bought]
        open_items = sorted(((s, i, c, k) for s, i, c, k in open_items if s >= threshold), key=lambda x: (-x[0], x[1]))
        held = Counter(c for _, _, c, _ in open_items)
        top = sorted(held, key=lambda c: (-held[c], c))[:3]
        if len(top) == 3 and held[top[2]] >= 3:
            picked = [i for t in top for i in [i for _, i, c, _ in open_items if c == t][:3]]
        else:
            picked = [i for k0 in CLASSES for i in [i for _, i, _, k in open_items if k == k0][:5]]
        if picked:
            lists[user] = picked
    return lists


@pytest.mark.parametrize("threshold", [-1.0, 2.0, 3.2])
@pytest.mark.parametrize("block_items, group_users, group_bought", [(10_000, 10_000, 10_000), (17, 5, 10_000), (50, 10_000, 40)])
def test_scorer_agrees_with_brute_force(spark, threshold, block_items, group_users, group_bought):
    rng = np.random.default_rng(7)
    # halves give exact sums and many ties
    users = {u: rng.integers(0, 4, 3) / 2 for u in range(40)}
    items = {i: (rng.integers(0, 4, 3) / 2, f"cat{rng.integers(6)}", ["Red", "White", "Other"][rng.integers(3)]) for i in range(120)}
    bought = {(int(u), int(i)) for u, i in zip(rng.integers(0, 40, 900), rng.integers(0, 120, 900))}
    best = candidates.best_candidates(
        spark.createDataFrame([(u, v.tolist()) for u, v in users.items()], "user_id long, features array<double>"),
        spark.createDataFrame(
            [(i, v.tolist(), c, k) for i, (v, c, k) in items.items()],
            "item_id long, features array<double>, category string, klass string",
        ),
        spark.createDataFrame(list(bought), "user_id long, item_id long"),
        threshold, CLASSES, block_items=block_items, group_users=group_users, group_bought=group_bought,
    )
    got = defaultdict(list)
    for r in ranking.curate(best, CLASSES, user="user_id").orderBy("user_id", "rank").collect():
        got[r.user_id].append(r.item_id)
    assert got == brute_force(users, items, bought, threshold)


def test_blocks_that_cannot_reach_the_threshold_are_skipped(spark):
    users = spark.createDataFrame([(1, [1.0])], "user_id long, features array<double>")
    items = spark.range(0, 100).select(
        F.col("id").alias("item_id"), F.array(F.col("id") / 10.0).alias("features"),
        F.lit("a").alias("category"), F.lit("Red").alias("klass"),
    )
    none = spark.createDataFrame([], "user_id long, item_id long")
    best = candidates.best_candidates(users, items, none, 9.5, CLASSES, block_items=10)
    assert {r.item_id for r in best.collect()} == {95, 96, 97, 98, 99} and best.agg(F.sum("n")).first()[0] == 5


@pytest.fixture(scope="module")
def trained(spark, folder):
    return train(logical.rating_triples(spark, folder), SMALL, save_to=None)


def test_als_lists(spark, folder, trained):
    products = logical.products(spark, folder)
    lists = recommend_with(trained, products, ["PROMO", "ECONOMY"], threshold=6.0).persist()
    assert lists.where("prediction < 6.0").count() == 0
    ids = joins.to_user_ids(lists, trained.bridge)
    assert ids.join(trained.triples, ["user_id", "item_id"]).count() == 0
    sizes = lists.groupBy("user_tag", "strategy").count()
    assert sizes.where("strategy = 'categories' and count <> 9 or strategy = 'classes' and count > 10").count() == 0
    lists.unpersist()


def test_same_input_same_model(spark, trained):
    again = factors.fit(trained.triples, SMALL)
    pairs = factors.predict(trained.model, trained.triples)
    other = factors.predict(again, trained.triples).withColumnRenamed("prediction", "other")
    both = pairs.join(other, ["user_id", "item_id"]).agg(F.max(F.abs(F.col("prediction") - F.col("other"))), F.count(F.lit(1)))
    assert both.first()[0] < 1e-4 and both.first()[1] == trained.triples.count()


def test_saved_model_is_replaced_and_drops_unseen_keys(spark, folder, trained):
    path = fresh_path(spark, "model")
    factors.save(trained.model, path)
    factors.save(trained.model, path)
    loaded = factors.load(path)
    assert loaded.rank == SMALL.rank
    pairs = spark.createDataFrame([(0, 1), (10_000_000, 1), (0, 10_000_000)], "user_id int, item_id int")
    assert factors.predict(loaded, pairs).count() == 1
    again = recommend_with(Trained(loaded, trained.triples, trained.bridge), logical.products(spark, folder), ["PROMO"], 6.0)
    assert again.count() > 0


def test_parameter_curves(spark, trained):
    curves = factors.grid_search(trained.triples, (0.1, 1.0), (2,), (2,), train_fractions=(0.5, 0.9))
    assert curves.count() == 4 and curves.where("train_rmse is null or test_rmse is null").count() == 0
    best = factors.lowest_errors(curves, k=1).first()
    assert best.train_fraction == 0.9
    assert best.test_rmse == curves.where("train_fraction = 0.9").agg(F.min("test_rmse")).first()[0]
    ranks = factors.rank_search(trained.triples, ranks=(2, 3), settings=AlsSettings(max_iter=2, blocks=4)).collect()
    assert sum(r.test_rmse is not None for r in ranks) == 1
    assert min(ranks, key=lambda r: r.validation_rmse).test_rmse is not None


def test_tasks_of_curation_grow_with_the_rows(spark):
    rows = spark.range(600).select(
        (F.col("id") % 40).alias("user_id"), F.col("id").alias("item_id"), F.concat(F.lit("c"), F.col("id") % 5).alias("category"),
        F.lit("PROMO").alias("klass"), (F.col("id") * 37 % 101).cast("double").alias("prediction"),
    )
    plain, dealt = ranking.curate(rows, CLASSES, user="user_id"), ranking.curate(rows, CLASSES, user="user_id", n_rows=9_900_000)
    assert dealt.rdd.getNumPartitions() == 40
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dealt.collect()))


def test_items_go_to_few_groups_of_users(spark, monkeypatch):
    wanted, real = [], candidates.small_side
    monkeypatch.setattr(candidates, "small_side", lambda df: wanted.append(df.count()) or real(df))
    users = spark.range(400_000).select(F.col("id").alias("user_id"), F.array(F.lit(1.0)).alias("features"))
    items = spark.range(5).select(F.col("id").alias("item_id"), F.array(F.lit(9.0)).alias("features"), F.lit("c").alias("category"), F.lit("PROMO").alias("klass"))
    candidates.best_candidates(users, items, spark.createDataFrame([], "user_id long, item_id long"), 8.0, CLASSES)
    assert wanted[0] <= 13  # 49 with groups of 8,192


def test_labels_that_are_null_and_ids_below_zero(spark):
    rng = np.random.default_rng(2)
    users = {u: rng.random(2) for u in range(-3, 9)}
    labels = [None, "a", "b", "c"]
    items = {i: (rng.random(2), labels[rng.integers(4)], ["Red", None][rng.integers(2)]) for i in range(-40, 200)}
    best = candidates.best_candidates(
        spark.createDataFrame([(u, v.tolist()) for u, v in users.items()], "user_id long, features array<double>"),
        spark.createDataFrame([(i, v.tolist(), c, k) for i, (v, c, k) in items.items()],
                              "item_id long, features array<double>, category string, klass string"),
        spark.createDataFrame([(1, -40), (1, None), (None, 3)], "user_id long, item_id long"), 0.7, CLASSES, block_items=50,
    ).persist()
    assert best.count() == best.select("user_id", "item_id").distinct().count()
    for user, vector in users.items():
        scored = [(i, float(vector @ v), c) for i, (v, c, _) in items.items() if vector @ v >= 0.7 and (user, i) != (1, -40)]
        held = Counter(c for _, _, c in scored)
        top = sorted(held, key=lambda c: (-held[c], c is not None, c or ""))[:3]
        got = {r.category: r.n for r in best.where(F.col("user_id") == user).groupBy("category").agg(F.sum("n").alias("n")).collect()}
        assert {c: n for c, n in got.items() if n} == {c: held[c] for c in top}
        rows = {r.item_id: r for r in best.where(F.col("user_id") == user).collect()}
        assert all((r.category, r.klass) == items[i][1:] for i, r in rows.items())


def test_only_what_curation_can_use_leaves_the_scorer(spark):
    users = spark.range(50).select(F.col("id").alias("user_id"), F.array(F.lit(1.0) + F.col("id") / 100).alias("features"))
    items = spark.range(3_000).select(
        F.col("id").alias("item_id"), F.array(8.0 + F.col("id") % 7).alias("features"),
        F.concat(F.lit("c"), (F.col("id") % 40).cast("string")).alias("category"), F.lit("Red").alias("klass"),
    )
    none = spark.createDataFrame([], "user_id long, item_id long")
    best = candidates.best_candidates(users, items, none, 8.0, CLASSES, block_items=500)
    assert best.count() == 50 * 9  # 40 categories in 6 blocks
