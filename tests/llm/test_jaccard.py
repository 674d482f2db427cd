"""Similar sets against brute force: many leaves, cut regions, ties, nulls and repeated rows."""

import itertools
import random

import numpy as np
import pytest

from shelfsense.llm import jaccard, regions
from shelfsense.llm.common import components
from shelfsense.llm.jaccard import one_of_each_group, similar_groups
from shelfsense.sources.session import stored


def brute_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(rows, num=75, den=100):
    sets = brute_sets([t for _, t in rows])
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if sets[i] and sets[j] and den * shared >= num * len(sets[i] | sets[j]):
            root[max(top(i), top(j))] = min(top(i), top(j))
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[top(i)] = min(best.get(top(i), d), d)
    return sorted(((d, len(sets[i]), best.get(top(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.6:
            base = rng.choice(texts).split()
            for _ in range(rng.randint(0, 3)):
                if base:
                    base[rng.randrange(len(base))] = rng.choice(words)
            texts.append(" ".join(base[rng.randint(0, 1) :]))
        else:
            texts.append(" ".join(rng.choices(words, k=rng.choice([0, 1, 3, 5, 8, 30, 80]))))
    return texts


@pytest.mark.parametrize("leaf_work", [4_000_000, 4_000])
def test_groups_equal_brute_force(spark, leaf_work):
    texts = corpus(3, 150) + [None, "", "  \n", "One two", "one\ttwo", "ONE TWO x"]
    rows = list(enumerate(texts)) + [(7, texts[7]), (8, "another text under a known id"), (None, texts[9]), (None, "alone without id")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n string, component_id int")
    got = similar_groups(docs, leaf_work=leaf_work)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("hot_cell", [0, 1e-5])
def test_shingles_of_hot_cells_lose_no_link(spark, monkeypatch, hot_cell):
    monkeypatch.setattr(jaccard, "HOT_CELL", hot_cell)
    rows = list(enumerate(corpus(8, 90)))
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("leaf_work, levels", [(6_000, 4), (6_000, 0), (12_000, 2)])
def test_cut_regions_lose_no_link(spark, leaf_work, levels):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    bags = []
    for i in range(120):  # a dense group, chains at the border of the threshold, and strangers
        if i % 3 == 0:
            keep = base[rng.random(60) < 0.93]
            bags.append(np.unique(np.r_[keep, rng.integers(0, 2**63, rng.integers(0, 5)).astype(np.uint64)]))
        elif i % 3 == 1:
            bags.append(np.unique(np.r_[base[i // 3 : i // 3 + 25], base[:6]]))
        else:
            bags.append(np.unique(rng.integers(0, 2**63, 40).astype(np.uint64)))
    names = [f"{i:03d}".encode() for i in range(len(bags))]
    rows = stored(
        spark.createDataFrame([(1, bytearray(n), bytearray(b.tobytes())) for n, b in zip(names, bags)], "region long, node binary, bag binary"),
        "bags",
    )
    got = components(regions.links(rows, leaf_work=leaf_work, pivots=4, levels=levels)).collect()
    root = {bytes(r["node"]): bytes(r["root"]) for r in got}
    labels = list(range(len(bags)))
    for i, j in itertools.combinations(range(len(bags)), 2):
        shared = len(np.intersect1d(bags[i], bags[j]))
        if 100 * shared >= 75 * (len(bags[i]) + len(bags[j]) - shared):
            a, b = sorted((labels[i], labels[j]))
            labels = [a if x == b else x for x in labels]
    assert [root.get(n, n) for n in names] == [names[x] for x in labels]


def test_links_are_few_for_many_near_copies():
    base = np.arange(400, dtype=np.uint64)
    bags = [np.delete(base, [i % 400]) for i in range(300)]
    assert len(regions.forest(bags, np.ones(300, bool), 75, 100)) == 299


def test_one_of_each_group_keeps_columns_and_clean_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(4, text, None), (2, text + " end", "a"), (9, "something else", "b"), (10, None, "c"), (11, None, "d")], "doc_id long, text string, lang string"
    )
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 9, 10, 11]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert similar_groups(docs).collect() == [] and one_of_each_group(docs).collect() == []


def test_components(spark):
    edges = [(1, 2), (3, 2), (4, 3), (9, 8), (5, 5), (8, 9), (7, 6), (6, 1), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in found} == {(2, 1), (3, 1), (4, 1), (6, 1), (7, 1), (9, 8)}
    chain = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b")
    assert {r["root"] for r in components(chain).collect()} == {0}
