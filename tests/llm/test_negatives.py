"""Hard negatives against a plain loop over all anchors and rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfsense.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows, is_anchor, positives=5, wanted=10, low=30, high=90, scale=256.0):
    fine = [
        (i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in fine if is_anchor(i)}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in fine if j != i)
        for down, j, m in [x for x in scored if x[2] == label][:positives]:
            inside = [x for x in scored if x[2] != label and low * -down <= 100 * -x[0] <= high * -down]
            out += [(i, j, r, n, -down, -d) for r, (d, n, _) in enumerate(inside[:wanted], 1)]
    return sorted(out)


def got(df):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def table(seed, n, labels=4, dims=6, copies=0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.3, 0.4) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]
    return rows + [(n + k, rows[0][1], 1 if k % 3 else 2) for k in range(copies)]


@pytest.mark.parametrize("piece, block, stripes", [(1024, 1024, 16), (7, 3, 2), (50, 1, 5)])
def test_agrees_with_a_plain_loop(spark, monkeypatch, piece, block, stripes):
    for name, value in (("PIECE", piece), ("BLOCK", block), ("STRIPES", stripes)):
        monkeypatch.setattr(negatives, name, value)
    rows = table(1, 300, copies=150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = got(negatives.hard_negatives(df, F.col("vec_id") % 20 == 0))
    assert found == expected(rows, lambda i: i % 20 == 0) and len(found) > 100


def test_other_settings(spark):
    rows = table(2, 200, labels=3)
    df = spark.createDataFrame(rows, SCHEMA)
    options = {"positives": 2, "low": -50, "high": 100, "scale": 16.0}
    found = got(negatives.hard_negatives(df, F.col("vec_id") < 9, negatives=3, **options))
    assert found == expected(rows, lambda i: i < 9, wanted=3, **options)


def test_nulls_odd_vectors_and_repeated_rows(spark):
    rows = table(3, 60, labels=2) + [
        (None, [0.5] * 6, 1), (70, None, 1), (71, [0.5] * 6, None), (72, [0.5, None, 0.5, 0.5, 0.5, 0.5], 0),
        (73, [0.5, float("nan"), 0.5, 0.5, 0.5, 0.5], 0), (74, [float("inf")] * 6, 0), (75, [], 0), (76, [0.9, 0.9], 1),
        (20, [0.4] * 6, 1), (20, [0.4] * 6, 1), (33, [0.4] * 6, 0), (33, [0.4] * 6, 0), (-20, [0.4] * 6, 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    first = {(i, tuple(v), label) for i, v, label in rows[:60]}
    assert len(first) == 60
    found = got(negatives.hard_negatives(df, F.col("vec_id") % 20 == 0))
    assert found == expected(rows, lambda i: i % 20 == 0)


def test_large_components_are_exact(spark):
    rows = [(i, [float(1 + i % 7) * 2.0**k, -3.0], i % 2) for i, k in enumerate([16, 17, 18, 19, 20] * 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(negatives.hard_negatives(df, F.col("vec_id") < 4)) == expected(rows, lambda i: i < 4)


def test_scores_beyond_a_long_do_not_crash(spark):
    rows = [(i, [1e30 * (i + 1), 1.0], i % 2) for i in range(6)]
    found = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert all(abs(r.positive_score) <= 2**63 - 1 for r in found)


def test_empty_tables_and_extra_columns(spark):
    df = spark.createDataFrame(table(4, 50), SCHEMA).withColumn("id", F.lit("x")).withColumn("block", F.lit(1)).withColumn("found", F.lit(2))
    assert negatives.hard_negatives(df.where("false"), F.col("vec_id") == 0).count() == 0
    assert negatives.hard_negatives(df, F.col("vec_id") < 0).count() == 0
    one_label = df.withColumn("label", F.lit(1))
    assert negatives.hard_negatives(one_label, F.col("vec_id") == 0).count() == 0
