"""Imputation by neighbours against a plain loop over all pairs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfsense.operators import neighbours
from shelfsense.operators.neighbours import FAR, impute_by_neighbours

SCHEMA = "id int, style string, a string, b string, c int, price double"


def plain(rows, k, least_shared, width):
    out = {}
    for i, style, *same, price in rows:
        if style is not None:
            out[i] = style
            continue
        near = []
        for _, other, *theirs, cost in rows:
            shared = sum(x is not None and x == y for x, y in zip(same, theirs))
            if other is None or shared < least_shared:
                continue
            steps = FAR if price is None or cost is None else min(FAR, abs(price // width - cost // width))
            near.append((FAR * (3 - shared) + steps, other))
        reach = sorted(d for d, _ in near)[: k][-1:]
        votes = Counter(v for d, v in near if d <= reach[0]) if near else {}
        out[i] = min(votes, key=lambda v: (-votes[v], v)) if votes else None
    return out


def products(seed, n, hot=0):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([None, *values])
    rows = [
        (i, pick("red", "white", "rosé"), pick("x", "y", "z"), pick("p", "q"), pick(1, 2, 3, 4, 5),
         None if rng.random() < 0.1 else round(rng.uniform(-20, 80), 2))
        for i in range(n)
    ]
    return rows + [(n + j, "red" if j % 3 else None, "x", "p", 1, 10.0) for j in range(hot)]


@pytest.mark.parametrize("k, least_shared, hot", [(5, 2, 0), (1, 1, 60), (3, 3, 60), (40, 2, 60)])
def test_agrees_with_all_pairs(spark, k, least_shared, hot):
    rows = products(k, 150, hot)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    filled = impute_by_neighbours(df, "style", ["a", "b", "c"], {"price": 5.0}, k, least_shared)
    assert filled.columns == df.columns and filled.count() == len(rows)
    assert {r.id: r.style for r in filled.collect()} == plain(rows, k, least_shared, 5.0)


def test_edges(spark):
    df = spark.createDataFrame(products(2, 30), SCHEMA)
    args = ("style", ["a", "b", "c"], {"price": 5.0})
    assert impute_by_neighbours(df.where("false"), *args).count() == 0
    nothing_known = df.withColumn("style", F.lit(None).cast("string"))
    assert impute_by_neighbours(nothing_known, *args).where("style is not null").count() == 0
    complete = df.where("style is not null")
    assert sorted(map(str, impute_by_neighbours(complete, *args).collect())) == sorted(map(str, complete.collect()))
    nan = df.withColumn("price", F.lit(float("nan")))
    assert impute_by_neighbours(nan, *args).count() == 30
    with pytest.raises(ValueError):
        impute_by_neighbours(df, "style", ["a"], least_shared=2)


def test_copies_are_one_profile(spark):
    """A product that makes up most of the table must not multiply the pairs."""
    rows = products(1, 20) + [(1000 + i, ["red", None][i % 2], "x", "p", 1, 1.0) for i in range(4_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    filled = impute_by_neighbours(df, "style", ["a", "b", "c"], {"price": 5.0})
    assert filled.where("id >= 1000 and style = 'red'").count() == 4_000


def test_profiles_with_enough_rows_like_them_meet_no_others(spark, monkeypatch):
    held, real = {}, neighbours.stored
    monkeypatch.setattr(neighbours, "stored", lambda df, name: held.setdefault(name, real(df, name)))
    # six known rows per combination of values, and one to fill; the last combination has two known rows only
    combos = [(a, b, c) for a in "xyz" for b in "pq" for c in (1, 2)]
    rows = [(a, b, c, s, 20.0 * (s % 3)) for a, b, c in combos for s in range(6)]
    known = [(i, ("red", "white")[s % 2], a, b, c, price) for i, (a, b, c, s, price) in enumerate(rows) if (a, b, c) != combos[-1] or s < 2]
    table = known + [(1000 + i, None, a, b, c, 20.0) for i, (a, b, c) in enumerate(combos)]
    got = {r.id: r.style for r in impute_by_neighbours(spark.createDataFrame(table, SCHEMA), "style", ["a", "b", "c"], {"price": 20.0}).collect()}
    assert got == plain(table, 5, 2, 20.0)
    assert {tuple(r[0]) for r in held["pairs"].select("_asked").distinct().collect()} == {("z", "q", "2")}
