import random

import numpy as np
from pyspark.sql import functions as F

from shelfsense.llm import passages
from shelfsense.llm.common import hashes, words_of
from shelfsense.llm.passages import cut_passages, repeated_passages


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(5000)}" for _ in range(n)]


def test_bands_keep_recall():
    for recall in (0.9, 0.98):
        bands, rows = passages.tuned_bands(0.75, recall)
        assert 1 - (1 - 0.75**rows) ** bands >= recall


def test_shipped_bands_keep_recall():
    assert 1 - (1 - 0.75**passages.ROWS) ** passages.BANDS >= 0.98


def test_cuts_depend_on_content_only():
    rng = random.Random(1)
    inside = words(rng, 80)
    cuts = []
    for left in (0, 3, 40):
        text = " ".join(words(rng, left) + inside + words(rng, 30))
        hashed = hashes(words_of(text))
        starts = passages.paragraph_starts(hashed, np.array([len(hashed)])) - left
        cuts.append({int(s) for s in starts if passages.RADIUS < s < 80 - passages.RADIUS - 1})
    assert cuts[0] == cuts[1] == cuts[2] and len(cuts[0]) > 2


def test_long_runs_of_one_word_are_cut():
    starts = passages.paragraph_starts(hashes([b"x"] * 1000), np.array([1000]))
    assert np.diff(np.r_[starts, 1000]).max() <= passages.MAX_WORDS


def test_texts_together_are_cut_as_alone():
    rng = random.Random(8)
    texts = [hashes([w.encode() for w in words(rng, n)]) for n in (0, 1, 3, 7, 40, 0, 200, 2)]
    together = passages.paragraphs(np.concatenate(texts), np.array([len(t) for t in texts]), 5)
    before, alone = 0, []
    for t in texts:
        starts, lengths, runs = passages.paragraphs(t, np.array([len(t)]), 5)
        alone.append((starts + before, lengths, runs))
        before += len(t)
    for i in range(3):
        assert np.array_equal(together[i], np.concatenate([a[i] for a in alone]))


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(2)
    rows, planted, clean = [], set(), set()
    for k in range(12):
        passage = words(rng, 52 + 6 * k)
        for copy in range(3):
            doc = len(rows)
            inside = list(passage)
            if copy == 2 and k > 2:  # a near copy
                inside[len(inside) // 3] = "changed"
            rows.append((doc, " ".join(words(rng, rng.randint(0, 60)) + inside + words(rng, 25))))
            if copy:
                planted.add(doc)
    for _ in range(20):
        clean.add(len(rows))
        rows.append((len(rows), " ".join(words(rng, 90)) + "\nLicensed under the Apache License, Version 2.0."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in repeated_passages(docs).collect()}
    assert {d for d, r in got.items() if r["repeated"]} == planted
    for d in planted:
        assert got[d]["n_words_repeated"] >= 25
        assert all(p["keeper"] < d for p in got[d]["passages"])
    assert not any(got[d]["n_passages"] for d in clean)


def test_repeats_are_really_repeats(spark):
    """Every reported passage, word for word or nearly so, stands in a smaller document: brute force."""
    rng = random.Random(3)
    texts = [words(rng, 120) for _ in range(10)]
    texts += [t[10:90] + words(rng, 20) for t in texts[:6]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in repeated_passages(docs).collect():
        for p in r["passages"]:
            mine = texts[r["doc_id"]][p["start"] : p["start"] + p["length"]]
            runs = {tuple(mine[i : i + 5]) for i in range(len(mine) - 4)}
            kept = texts[p["keeper"]]
            theirs = {tuple(kept[i : i + 5]) for i in range(len(kept) - 4)}
            assert len(runs & theirs) >= 0.75 * len(runs)


def test_odd_rows(spark):
    same = " ".join(words(random.Random(4), 70))
    rows = [(None, same, 1), (5, same, 1), (5, same, 1), (6, None, 1), (7, "", 1), (8, "one", 1), (9, "in " * 400, 1), (10, same.upper(), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = sorted(((r["doc_id"], r["repeated"]) for r in repeated_passages(docs).collect()), key=str)
    assert got == sorted([(None, False), (5, True), (5, True), (6, False), (7, False), (8, False), (9, False), (10, True)], key=str)
    assert repeated_passages(docs.limit(0)).collect() == []


def test_cut(spark):
    df = spark.createDataFrame([("a b\nc  d e", [(1, 2, 0)]), (None, [])], "text string, p array<struct<start:int,length:int,keeper:long>>")
    assert [r[0] for r in df.select(cut_passages(F.col("text"), F.col("p"))).collect()] == ["a d e", None]


def test_short_near_copies_are_found_with_their_edges(spark):
    """Copies of 51 to 60 words with one word changed, against the place where they were planted."""
    rng = random.Random(6)
    rows, planted = [], {}
    for k in range(100):
        passage = words(rng, 51 + k % 10)
        rows.append((len(rows), " ".join(words(rng, 30) + passage + words(rng, 30))))
        if k % 2:
            passage[rng.randrange(len(passage))] = "changed"
        left = rng.randint(0, 60)
        planted[len(rows)] = (left, len(passage), k % 2)
        rows.append((len(rows), " ".join(words(rng, left) + passage + words(rng, 25))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["passages"] for r in repeated_passages(docs).collect() if r["repeated"]}
    assert set(got) <= set(planted)
    for d, (left, n, edited) in planted.items():
        if not edited:  # a similar paragraph may bring a few words more
            (p,) = got[d]
            assert left - 4 <= p["start"] <= left and left + n <= p["start"] + p["length"] <= left + n + 4 and p["keeper"] == d - 1
    near = [d for d, (_, _, edited) in planted.items() if edited]
    assert sum(d in got for d in near) >= 0.96 * len(near)
    for d in set(near) & set(got):
        left, n, _ = planted[d]
        assert all(left - 4 <= p["start"] and p["start"] + p["length"] <= left + n + 4 for p in got[d])
        assert sum(p["length"] for p in got[d]) >= n - passages.WORDS - 1
