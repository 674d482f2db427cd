"""Own half steps against Spark's ALS: the same start, the same factors, errors, cuts, and fits that go on."""

import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from shelfsense.operators import factors, half_steps, runs
from shelfsense.operators.factors import AlsSettings
from shelfsense.operators.half_steps import LaidOut


@pytest.fixture(scope="module")
def triples(spark):
    rng = random.Random(3)
    rows = [(100 * u - 700, 7 * i, rng.randint(1, 10)) for u in range(60) for i in range(45) if rng.random() < 0.4]
    rows += [(0, 7 * (i % 45), 1 + i % 9) for i in range(400)] + rows[:20]  # a user with many ratings, repeated pairs
    return spark.createDataFrame(rows, "user_id int, item_id long, rating int").withColumn("_at", F.rand(1)).persist()


def vectors(table):
    return {r.id: np.array(r.features) for r in table.collect()}


def apart(one, other):
    assert one.keys() == other.keys()
    return max(np.abs(one[i] - other[i]).max() for i in one)


def by_spark(triples, s, blocks):
    als = ALS(rank=s.rank, maxIter=s.max_iter, regParam=s.reg, nonnegative=s.nonnegative, seed=s.seed, numUserBlocks=blocks,
              numItemBlocks=blocks, userCol="user_id", itemCol="item_id", ratingCol="rating")
    return als.fit(triples.withColumn("rating", F.col("rating").cast("float")))


@pytest.mark.parametrize("nonnegative", [False, True])
@pytest.mark.parametrize("max_iter, most", [(1, 1e-5), (8, 1e-3)])
def test_the_factors_of_sparks_als(spark, triples, monkeypatch, nonnegative, max_iter, most):
    monkeypatch.setattr(half_steps, "RATINGS_PER_TASK", 300)
    monkeypatch.setattr(half_steps, "CELLS", 64)  # so the user with many ratings is summed in pieces
    settings = AlsSettings(rank=5, max_iter=max_iter, nonnegative=nonnegative, blocks=3)
    own, other = factors.fit(triples, settings), by_spark(triples, settings, 3)
    assert own.files is not None
    assert apart(vectors(own.userFactors), vectors(other.userFactors)) < most
    assert apart(vectors(own.itemFactors), vectors(other.itemFactors)) < most


def test_a_fit_shuffles_no_factors(spark, triples, monkeypatch):
    laid = LaidOut(triples)
    monkeypatch.setattr(ALS, "fit", lambda *_: pytest.fail("the whole fit went to Spark's ALS"))
    model = factors.fit(laid, AlsSettings(rank=3, max_iter=2))
    assert model.userFactors.count() == 60
    laid.drop()


def test_a_longer_fit_goes_on_from_a_shorter_one(spark, triples, monkeypatch):
    steps, real = [], half_steps._solving
    monkeypatch.setattr(half_steps, "_solving", lambda *a, **kw: steps.append(a) or real(*a, **kw))
    laid, settings = LaidOut(triples), AlsSettings(rank=4, max_iter=5)
    factors.fit(laid, AlsSettings(rank=4, max_iter=3))
    longer = factors.fit(laid, settings)
    assert len(steps) == 10
    laid.drop()
    assert apart(vectors(longer.userFactors), vectors(factors.fit(triples, settings).userFactors)) == 0


def test_a_cut_is_the_fit_of_its_rows(spark, triples):
    laid, settings = LaidOut(triples, "_at"), AlsSettings(rank=4, max_iter=4)
    cut, rows = laid.below(0.03), triples.where("_at < 0.03")
    assert cut.n == rows.count()
    model, alone = factors.fit(cut, settings), factors.fit(rows, settings)
    assert apart(vectors(model.userFactors), vectors(alone.userFactors)) < 1e-5
    assert apart(vectors(model.itemFactors), vectors(alone.itemFactors)) < 1e-5
    n, rmse, n_other, other = factors.errors(model, cut, triples)
    cut.triples, model.files = triples, None
    assert (n, n_other) == factors.errors(model, cut, triples)[::2] and n == rows.count() and n_other < triples.count() - n
    assert (rmse, other) == pytest.approx(factors.errors(model, cut, triples)[1::2], rel=1e-5)
    laid.drop()


def test_a_shared_folder_that_is_no_path_leaves_the_fit_to_spark(spark, triples, monkeypatch, tmp_path):
    settings = AlsSettings(rank=3, max_iter=2)
    usual = runs.resumable_search(triples, [settings], str(tmp_path / "a"), (0.5,)).first()
    monkeypatch.setattr(half_steps, "local_folder", lambda spark: None)
    model = factors.fit(triples, settings)
    assert model.files is None and model.userFactors.count() == 60
    other = runs.resumable_search(triples, [settings], str(tmp_path / "b"), (0.5,)).first()
    assert (usual.n_train, usual.n_test, usual.n_predicted) == (other.n_train, other.n_test, other.n_predicted)
    assert (usual.train_rmse, usual.test_rmse) == pytest.approx((other.train_rmse, other.test_rmse), rel=1e-4)


def test_ratings_that_are_not_finite_or_null_are_sparks(spark, triples):
    for odd in ("cast(null as int)", "cast('NaN' as double)"):
        assert LaidOut(triples.withColumn("rating", F.when(F.col("item_id") == 7, F.expr(odd)).otherwise(F.col("rating")))).folder is None
    assert LaidOut(triples.where("false")).folder is None
