"""The language model against a plain evaluation of its parts; the decoder on known disguises."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfsense.llm import brown, toxicity


@pytest.fixture(scope="module")
def grammar():
    """Nouns and verbs take turns, in two languages that do not mix."""
    rng = random.Random(11)
    nouns = [[f"noun{k}{s}" for k in range(12)] for s in "ab"]
    verbs = [[f"verb{k}{s}" for k in range(12)] for s in "ab"]
    rows = []
    for i in range(220):
        s = i % 2
        words = [rng.choice(nouns[s] if k % 2 else verbs[s]) for k in range(rng.randint(1, 40))]
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(900, None), (901, ""), (902, "never\tseen éé words"), (5, "same id"), (None, "no id")]


def test_base_counts_and_a_better_model(spark, grammar):
    docs = spark.createDataFrame([(*r, 0.5) for r in grammar], "doc_id long, text string, score double")
    got = brown.score_texts(docs, rounds=8).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + [None]
    counts = Counter(w for i, t in grammar if not held(i) for w in tokens(t))
    n = sum(counts.values())
    expected = []
    for i, t in grammar:
        ts = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in ts)
        expected.append((i, held(i), len(ts), sum(counts[w] > 0 for w in ts), n, round(base, 6)))
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in got), key=str) == sorted(expected, key=str)
    heard = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in heard) > sum(r["base_score"] for r in heard) + 0.3 * sum(r["n_tokens"] for r in heard)
    assert all(r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"])) for r in got)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(16, "a b")], "doc_id long, text string")
    only_held = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
    for rows in (only_held, docs.limit(0)):
        got = brown.score_texts(rows).collect()
        assert len(got) == rows.count() and all(r["n_known"] == 0 and r["base_score"] == 0 for r in got)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    size = 10 + brown.ENDINGS + 1
    alphabet = brown.Alphabet(np.sort(rng.integers(0, 2**63, 10)).astype(np.uint64))
    totals = rng.integers(0, 50, size).astype(float)
    classes = np.append(1 + np.arange(size - 1) % (brown.CLASSES - 1), 0)
    counts = rng.integers(0, 9, (brown.CLASSES, brown.CLASSES)).astype(float)
    weight, kinds = rng.integers(5, 90, brown.CLASSES).astype(float), np.full(brown.CLASSES, 2.0)
    m = brown._model(alphabet, classes, totals, weight, kinds, alphabet.words, totals[:10], np.full(10, -1))
    assert np.allclose((10 ** brown._transitions(counts)).sum(1), 1)
    own_words = (weight + kinds * brown._PRIOR) / 10**m.norm  # two words of each class, of weight occurrences in all
    assert np.allclose(np.bincount(classes, 10**m.emission, brown.CLASSES) + own_words, 1)


def plain_scores(rows, lexicon_class, alphabet, classes, least):
    """Scores of all rows from the classes of symbols and words alone, by loops and dictionaries."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    split = lambda t: (t or "").encode().lower().split()
    symbol = lambda w: int(alphabet.symbols([w], brown.hashes([w]))[0])
    first, end = len(alphabet.words), alphabet.size - 1
    train = [split(t) for i, t in rows if not held(i)]
    count = Counter(w for ws in train for w in ws)
    of_own = lambda w: symbol(w) >= first and count[w] >= least
    klass = lambda w: lexicon_class[w] if of_own(w) else int(classes[symbol(w)])
    total, weight, steps = Counter({end: len(train)}), Counter(), Counter()
    for w, n in count.items():
        weight[klass(w)] += n
        total[None if of_own(w) else symbol(w)] += n
    weight[0] = len(train)
    kinds = Counter(int(c) for c in classes) + Counter(lexicon_class[w] for w in count if of_own(w))
    for ws in train:
        chain = [0, *map(klass, ws), 0]
        steps.update(zip(chain, chain[1:]))
    k, everything = brown.CLASSES, sum(steps.values())
    into, out_of = Counter(), Counter()
    for (a, b), n in steps.items():
        out_of[a] += n
        into[b] += n

    def step(a, b):
        return math.log10((steps[a, b] + k * (into[b] + 1) / (everything + k)) / (out_of[a] + k))

    def emit(c, n):
        return math.log10((n + brown._PRIOR) / (weight[c] + brown._PRIOR * kinds[c]))

    scores = []
    for _, t in rows:
        score, before = 0.0, 0
        for w in split(t):
            c = klass(w)
            score += step(before, c)
            if of_own(w):
                score += emit(c, count[w])
            else:
                score += emit(c, total[symbol(w)])
                if symbol(w) >= first:
                    score += math.log10(max(count[w], 1) / (total[symbol(w)] + 1))
            before = c
        scores.append(score + step(before, 0) + emit(0, total[end]))
    return scores


@pytest.mark.parametrize("counted_share", [0.0, 1e-3, 1.0])
def test_score_equals_a_plain_evaluation(spark, grammar, counted_share, monkeypatch):
    """Few symbols, so that most words get their class by their neighbours, sent along or joined; one text is long."""
    rng = random.Random(5)
    rare = [f"rare{k}{chr(97 + k % 7)}" for k in range(90)]
    rows = grammar + [(1000 + i, " ".join(rng.choices(rare, k=rng.randint(0, 6)) + ["noun1a", "verb2a"])) for i in range(60)]
    rows += [(2000, " ".join(rng.choices(rare + ["noun3b", "unheard"], k=30_000)))]
    caught = {}
    exchange, evidence, stored = brown.exchange, brown._evidence, brown.stored

    def keep(name, value):
        caught[name] = value
        return value

    monkeypatch.setattr(brown, "exchange", lambda pairs, *a: keep("classes", exchange(pairs, *a)))
    monkeypatch.setattr(brown, "_evidence", lambda counts: keep("evidence", evidence(counts)))
    monkeypatch.setattr(brown, "stored", lambda df, name: keep(name, stored(df, name)))
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, row int").repartition(3)
    got = brown.score_texts(docs, rounds=4, alphabet_share=0.02, counted_share=counted_share).collect()
    words = {w for _, t in rows for w in (t or "").encode().lower().split()}
    by_hash = {int(brown.hashes([w]).view(np.int64)[0]): w for w in words}
    lexicon = {by_hash[r["word"]]: r for r in caught["lexicon"].collect()}
    assert sum(r["class"] >= 0 for r in lexicon.values()) > 40 and any(r["class"] < 0 for r in lexicon.values())
    train = [(t or "").encode().lower().split() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    count = Counter(w for ws in train for w in ws)
    least = 0.02 * (sum(count.values()) + len(train))
    alphabet = brown.Alphabet(np.sort(brown.hashes([w for w, n in count.items() if n >= least])))
    classes = caught["classes"]
    symbol = lambda w: int(alphabet.symbols([w], brown.hashes([w]))[0])
    sides = {w: Counter() for w in lexicon}
    for ws in train:
        chain = [0, *(int(classes[symbol(w)]) for w in ws), 0]
        for j, w in enumerate(ws):
            if w in sides:
                sides[w].update([chain[j], brown.CLASSES + chain[j + 2]])
    for w, r in lexicon.items():
        assert r["n"] == count[w] and r["ending"] == symbol(w) and (r["class"] >= 0) == (count[w] >= brown.LEAST_SEEN)
        if r["class"] >= 0:
            value = [sum(n * caught["evidence"][side, c] for side, n in sides[w].items()) for c in range(brown.CLASSES)]
            assert value[r["class"]] >= max(value) - 1e-6
    plain = plain_scores(rows, {w: r["class"] for w, r in lexicon.items()}, alphabet, classes, brown.LEAST_SEEN)
    expected = sorted((str(i), round(x, 5)) for (i, _), x in zip(rows, plain))
    found = sorted((str(r["doc_id"]), round(r["score"], 5)) for r in got)
    assert [x for x, _ in found] == [x for x, _ in expected]
    assert [x for _, x in found] == pytest.approx([x for _, x in expected], abs=1e-4)


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(3)
    k = brown.CLASSES
    symbols, classes = 40, None
    pairs = rng.integers(0, 6, (symbols, symbols)).astype(float)
    classes = 1 + np.arange(symbols) % 5

    def likelihood(c):
        n = np.zeros((k, k))
        np.add.at(n, (c[:, None].repeat(symbols, 1), c[None, :].repeat(symbols, 0)), pairs)
        f = brown._entropy
        return f(n).sum() - f(n.sum(1)).sum() - f(n.sum(0)).sum(), n

    for s in range(symbols):
        before, n = likelihood(classes)
        own = np.delete(np.arange(symbols), s)
        to = brown.best_class(n, classes[s], np.bincount(classes[own], pairs[own, s], k), np.bincount(classes[own], pairs[s, own], k), pairs[s, s])
        moved = classes.copy()
        moved[s] = to
        assert likelihood(moved)[0] >= before - 1e-9
        best = max(likelihood(np.where(np.arange(symbols) == s, c, classes))[0] for c in range(1, 12))
        assert likelihood(moved)[0] >= best - 1e-6
        classes = moved


def test_shipped_rounds_offer_each_symbol_five_moves():
    assert brown.ROUNDS >= 10


@pytest.fixture(scope="module")
def letters(spark):
    text = " ".join(["you are an idiot and a stupid loser what a clown pathetic trash good morning book feel cool see the sun"] * 30)
    return toxicity.letter_model(spark.createDataFrame([(text,), (None,), ("",)], "text string"))


@pytest.mark.parametrize("disguise, word", [
    ("1d10t", "idiot"), ("id!ot", "idiot"), ("stuuuupid", "stupid"), ("l0s3r", "loser"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"),
    ("cl*wn", "clown"), ("tr@sh", "trash"), ("p4th3t1c", "pathetic"), ("cooool", "cool"), ("$tup1d", "stupid"), ("l-o-s-e-r", "loser"),
])
def test_disguises_are_decoded(letters, disguise, word):
    assert word in toxicity.restored(f"well {disguise} there", letters).split()


def test_plain_words_stay(letters):
    assert toxicity.restored("A good morning, book 42 (see) 10.0.0.1", letters) == "a good morning book 42 see 10.0.0.1"


def test_scores(spark):
    rng = random.Random(1)
    bad, good = ["idiot", "clown", "scum"], [f"word{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(5)]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(good, k=30)
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0) if i % 10 else None))
    rows += [(400, "what an 1d10t wordaa"), (401, None), (402, ""), (403, "clean wordab wordac"), (None, "scum"), (403, "x" * 9999)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, label int")
    marks = spark.createDataFrame(labels + [(999, 1), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert held and all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    by_id = {r["doc_id"]: r["predicted"] for r in got}
    assert by_id[400] == 1 and by_id[None] == 1 and by_id[401] == by_id[402] == by_id[403] == 0
    kept = toxicity.not_toxic(docs, marks)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if not r["predicted"]}
    assert toxicity.score_toxicity(docs.limit(0), marks).collect() == []
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, marks.limit(0)).collect()} <= {0, 1}
