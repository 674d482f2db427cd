"""Searches that go on after a stop, blocks that follow the data, and lists from saved models."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfsense.operators import factors, runs
from shelfsense.operators.factors import AlsSettings, blocks_for
from shelfsense.plans.recommend import integer_triples, lists_for, serve_saved, train
from shelfsense.sources import logical
from shelfsense.sources.session import fresh_path

CELLS = [AlsSettings(rank=r, max_iter=2, reg=g) for r in (2, 3) for g in (0.1, 1.0)]
FRACTIONS = (0.5, 0.8)
SMALL = AlsSettings(rank=4, max_iter=3)


@pytest.fixture(scope="module")
def triples(spark):
    rng = random.Random(8)
    rows = [(u, i, rng.randint(1, 10)) for u in range(30) for i in range(20) if rng.random() < 0.5]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating int").persist()


def test_a_stopped_search_goes_on(spark, triples, tmp_path, monkeypatch):
    path, fits = str(tmp_path), []
    real = factors.fit
    monkeypatch.setattr(runs, "fit", lambda table, settings: fits.append(settings) or real(table, settings))
    first = runs.resumable_search(triples, CELLS, path, FRACTIONS, most_runs=3)
    assert first.count() == 3 == len(fits)
    rows = runs.resumable_search(triples, CELLS, path, FRACTIONS).collect()
    assert len(rows) == 8 == len(fits)
    assert runs.resumable_search(triples, CELLS, path, FRACTIONS).count() == 8 == len(fits)
    n = triples.count()
    for r in rows:
        assert r.n_train + r.n_test == n and 0 < r.n_predicted <= r.n_test
        assert 0 <= r.train_rmse < 10 and 0 <= r.test_rmse < 10 and r.seconds > 0
    assert {(r.rank, r.reg, r.train_fraction) for r in rows} == {(s.rank, s.reg, f) for s in CELLS for f in FRACTIONS}


def test_a_half_written_run_is_done_again(spark, triples, tmp_path):
    runs.resumable_search(triples, CELLS[:1], str(tmp_path), FRACTIONS)
    marks = sorted(tmp_path.rglob("_SUCCESS"))
    marks[0].unlink()
    folder = str(next(tmp_path.glob("data=*")))
    assert len(runs.finished_runs(spark, folder)) == 1 == runs.read_runs(spark, folder).count()
    assert runs.resumable_search(triples, CELLS[:1], str(tmp_path), FRACTIONS).count() == 2


def test_a_failed_fit_leaves_the_others(spark, triples, tmp_path, monkeypatch):
    real = factors.fit

    def failing(table, settings):
        if settings.rank == 3:
            raise RuntimeError("executor lost")
        return real(table, settings)

    with monkeypatch.context() as broken:
        broken.setattr(runs, "fit", failing)
        with pytest.raises(RuntimeError):
            runs.resumable_search(triples, CELLS, str(tmp_path), FRACTIONS, parallel_fits=1)
    folder = str(next(tmp_path.glob("data=*")))
    assert 0 < len(runs.finished_runs(spark, folder)) <= 4
    assert runs.resumable_search(triples, CELLS, str(tmp_path), FRACTIONS).count() == 8


def test_other_ratings_have_runs_of_their_own(spark, triples, tmp_path):
    runs.resumable_search(triples, CELLS[:1], str(tmp_path), (0.5,))
    changed = triples.withColumn("rating", F.col("rating") % 5 + 1)
    runs.resumable_search(changed, CELLS[:1], str(tmp_path), (0.5,))
    assert len(list(tmp_path.glob("data=*"))) == 2
    assert runs.read_runs(spark, str(tmp_path / "data=none")).count() == 0


def test_blocks_follow_the_ratings():
    assert [blocks_for(n) for n in (0, 1, 59_000, 600_000, 10**9)] == [1, 1, 3, 11, 447]


def test_blocks_and_disk_of_a_fit_are_bounded(spark, triples, monkeypatch):
    asked, real = [], factors.ALS
    monkeypatch.setattr(factors, "ALS", lambda **kw: asked.append(kw) or real(**kw))
    monkeypatch.setattr(factors, "blocks_for", lambda n: 40)
    model = factors.fit(triples, AlsSettings(rank=2, max_iter=1))
    assert asked[0]["numUserBlocks"] == asked[0]["numItemBlocks"] == 12
    # the factors are files, so no shuffle of the fit is kept for them
    assert model.userFactors.inputFiles() and model.itemFactors.inputFiles()
    assert factors.predict(model, triples).count() == triples.count()
    factors.discard(model)
    assert not Path(model.factors_at.removeprefix("file:")).exists()


def test_same_model_under_any_parallelism(spark, triples):
    settings = AlsSettings(rank=3, max_iter=4, blocks=3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    models = []
    for parts in (1, 13):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        models.append(factors.fit(triples.repartition(parts, "item_id"), settings))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    one, other = ({r.id: r.features for r in m.userFactors.collect()} for m in models)
    assert one.keys() == other.keys()
    assert max(abs(a - b) for u in one for a, b in zip(one[u], other[u])) < 1e-3


def test_lists_of_users_the_model_never_saw(spark, folder):
    ratings, products = logical.rating_triples(spark, folder), logical.products(spark, folder)
    tags = [r.user_tag for r in ratings.select("user_tag").distinct().orderBy("user_tag").limit(8).collect()]
    fresh = F.col("user_tag").isin(tags)
    path, out = fresh_path(spark, "model"), fresh_path(spark, "lists")
    trained = train(ratings.where(~fresh), SMALL, save_to=path)
    lists = lists_for(trained.model, ratings.where(fresh), products, ["PROMO"], SMALL, threshold=1.0).collect()
    assert {r.user_tag for r in lists} <= set(tags) and len({r.user_tag for r in lists}) > 4
    bought = {(r.user_tag, r.item_id) for r in ratings.where(fresh).collect()}
    assert not bought & {(r.user_tag, r.item_id) for r in lists}

    serve_saved(spark, path, trained.bridge, ratings, products, ["PROMO"], out, SMALL, threshold=1.0)
    written = spark.read.parquet(out)
    got = {(r.user_tag, r.rank): (r.item_id, round(r.prediction, 3)) for r in written.where(fresh).collect()}
    assert got == {(r.user_tag, r.rank): (r.item_id, round(r.prediction, 3)) for r in lists}
    assert written.select("user_tag").distinct().count() > 0.9 * ratings.select("user_tag").distinct().count()


def test_changed_ratings_change_the_list(spark, folder):
    ratings, products = logical.rating_triples(spark, folder), logical.products(spark, folder)
    model = train(ratings, SMALL).model
    tag = ratings.agg(F.min("user_tag")).first()[0]
    own = ratings.where(F.col("user_tag") == tag)
    low = own.withColumn("rating", F.lit(1))
    before, after = (lists_for(model, r, products, ["PROMO"], SMALL, threshold=0.0) for r in (own, low))
    assert before.agg(F.max("prediction")).first()[0] > after.agg(F.max("prediction")).first()[0]


def test_no_ratings_no_lists(spark, folder):
    ratings, products = logical.rating_triples(spark, folder), logical.products(spark, folder)
    model = train(ratings, SMALL).model
    assert lists_for(model, ratings.where("false"), products, ["PROMO"], SMALL).count() == 0
    assert integer_triples(ratings.where("false"))[0].count() == 0
