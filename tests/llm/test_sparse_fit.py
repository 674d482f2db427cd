"""The penalised fit against the conditions of its minimum."""

import numpy as np
import pytest

from shelfsense.llm import sparse_fit

SCHEMA = "features array<string>, label double"


def sample(seed=2, n=400, words=60):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = float(i % 3 == 0)
        chosen = {f"w{w}" for w in rng.integers(0, words, 8)}
        if label and rng.random() < 0.8:
            chosen.add(f"bad{rng.integers(3)}")
        rows.append((sorted(chosen) if i % 50 else [], label))
    return rows


@pytest.mark.parametrize("penalty", [0.0005, 0.01, 0.2])
def test_conditions_of_the_minimum(penalty):
    rows = sample()
    names = sorted({f for fs, _ in rows for f in fs})
    place = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (fs, _) in enumerate(rows):
        x[i, [place[f] for f in fs]] = 1
    y = np.array([label for _, label in rows])
    columns = np.array([place[f] for fs, _ in rows for f in fs])
    lengths = np.array([len(fs) for fs, _ in rows])
    real = sparse_fit.orthant_descent
    sparse_fit.orthant_descent = lambda loss, start, cost, _: real(loss, start, cost, 3_000, tolerance=1e-14)
    try:
        bias, w = sparse_fit.fit_lists(columns, lengths, y, len(names), penalty)
    finally:
        sparse_fit.orthant_descent = real
    off = 1 / (1 + np.exp(-(x @ w + bias))) - y
    slope = x.T @ off / len(y)
    assert abs(off.mean()) < 1e-4
    assert np.abs(slope[w == 0]).max(initial=0) <= penalty + 1e-4
    assert np.abs(slope[w != 0] + penalty * np.sign(w[w != 0])).max(initial=0) < 1e-4
    assert (w == 0).any()


def test_rare_features_and_empty_tables(spark):
    rows = sample() + [(["once"], 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.feature: r.weight for r in sparse_fit.fit(df, 0.001, 3).collect()}
    assert None in got and "once" not in got and all(got[f"bad{i}"] > 0.5 for i in range(3))
    assert sparse_fit.fit(df.where("false"), 0.001, 3).collect() == []
