"""Exact dedup, decontamination and licences: odd rows, both join ways, and brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from shelfsense.llm import decontaminate, licenses
from shelfsense.llm.decontaminate import contamination, uncontaminated
from shelfsense.llm.exact_dedup import exact_dedup

SPACE = re.compile("[\x20\x09-\x0d]")


@pytest.mark.parametrize("support", [1e-3, 0.2])
def test_exact_dedup_equals_brute_force(spark, support):
    texts = ["a b", "ab", "a\tb ", "A b", None, "", " \n", "x" * 5000, "ü u", "üu"] + ["hot text"] * 40
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, "a  b"), (None, "lone"), (60, "hot text")]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, digest string, rank int")
    got = exact_dedup(docs.repartition(5), support=support).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    expected = []
    for key, members in groups.items():
        best = min(members)
        for m in members:
            expected.append((m[3], best[3], len(members), hashlib.sha256(key.encode()).hexdigest()))
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == sorted(expected, key=str)
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def brute_windows(text, items, size=10):
    words = lambda t: re.findall(decontaminate.WORD, re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for i in range(len(doc) - n + 1):
                if doc[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    return len(doc), len(hit), sorted(found), bool(hit)


@pytest.mark.parametrize("broadcast_windows", [500_000, 0])
def test_contamination_equals_brute_force(spark, broadcast_windows):
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "of", "Été", "a1", "zz", "q", "ÉTÉ", "word"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([0, 1, 3, 9, 10, 11, 14, 30, 30])]
    items += [(20, None), (21, items[7][1]), (None, items[4][1]), (9, "only here, TWICE only here, twice only here")]
    rows = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(rng.randint(0, 25)))]
        if i % 2:
            item = rng.choice(items)[1] or ""
            parts.append(item[rng.randint(0, 8) :].replace(" ", "\n- ") if i % 4 == 1 else item)
        rows.append((i, " ".join(parts)))
    rows += [(50, None), (51, ""), (52, "?!"), (3, rows[3][1]), (3, "other text, same id"), (None, items[7][1]), (53, items[8][1] * 40)]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, n_hit int, item_id string")
    bench = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, n int")
    got = contamination(docs, bench, broadcast_windows=broadcast_windows)
    expected = [(i, *brute_windows(t, items)) for i, t in rows]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected, key=str)
    clean = uncontaminated(docs, bench, broadcast_windows=broadcast_windows)
    assert clean.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in clean.collect()))) == sorted(str(e[0]) for e in expected if not e[4])


def test_contamination_without_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in contamination(docs, bench).collect()] == [(1, 2, 0, [], False)]
    assert contamination(docs.limit(0), bench).collect() == []


def brute_cosine(line, notice):
    bags = [Counter(re.findall(licenses._WORD, t.lower())) for _, t in licenses.NOTICES]
    spread = Counter(w for b in bags for w in b)
    idf = lambda w: math.log((len(bags) + 1) / (spread[w] + 0.5)) if w in spread else math.log((len(bags) + 1) / 0.5)
    a, b = (Counter(re.findall(licenses._WORD, t.lower())) for t in (line, notice))
    length = lambda c: math.sqrt(sum((n * idf(w)) ** 2 for w, n in c.items()))
    return sum(n * idf(w) * b[w] * idf(w) for w, n in a.items()) / (length(a) * length(b)) if a else 0.0


def test_licences_equal_brute_force(spark):
    rng = random.Random(4)
    lines = [t for _, t in licenses.NOTICES]
    for text in list(lines):
        words = text.split()
        for _ in range(2):
            lines.append(" ".join(w for w in words if rng.random() < 0.8) + rng.choice(["", " whatever else"]))
    lines += ["the of and", "", "mit", "Licence nothing"]
    files = spark.createDataFrame([(f"d/{i}", t) for i, t in enumerate(lines)], "path string, text string")
    got = {r["path"]: r for r in licenses.licence_lines(files, "path", "text").collect()}
    for i, line in enumerate(lines):
        scores = [brute_cosine(line, t) for _, t in licenses.NOTICES]
        best = max(range(len(scores)), key=lambda k: (round(scores[k], 6), -k))
        if abs(scores[best] - licenses.THRESHOLD) < 1e-5:
            continue
        found = got.get(f"d/{i}")
        assert (found is not None) == (scores[best] >= licenses.THRESHOLD)
        if found:
            assert found["licence"] == licenses.NOTICES[best][0] and found["similarity"] == pytest.approx(scores[best], abs=2e-6)


GPL3 = licenses.TEMPLATES[9][1]


@pytest.mark.parametrize("text, licence", [
    ("x = 1\n" + " ".join(licenses.NOTICES[2][1].split()) + "\ny = 2", "MIT"),
    ("// SPDX-License-Identifier: MIT\nint main;", "MIT"), ("# SPDX-License-Identifier: Apache-2.0\nimport os", "Apache-2.0"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("Copyright 2020 Foo. Licensed under the MIT license.", "MIT"),
    ("some plain words before, then Copyright 2020 Foo, all of it licensed under the MIT license. And more words follow here.", "MIT"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright (C) the foundation and others, all of them", "GPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n", "GPL-2.0"), ("GNU GENERAL PUBLIC LICENSE", None),
    ("# " + "\n# ".join(GPL3.split("\n")) + "\n\nimport os\n" * 50, "GPL-3.0"),
    ("Copyright 2001 Them\n\n" + licenses.TEMPLATES[3][1], "BSD-2-Clause"),
    ("Copyright 2001 Them\n\n" + licenses.TEMPLATES[4][1], "BSD-3-Clause"), ("The MIT License (MIT)\n\n" + licenses.TEMPLATES[1][1], "MIT"),
    ("mit mit und mit, mit", None), ("word " * 5000 + licenses.TEMPLATES[8][1] + " word" * 5000, "GPL-2.0"),
])
def test_headers_files_and_notices_inside_lines(spark, text, licence):
    got = licenses.file_licences(spark.createDataFrame([("a/b.c", text)], "path string, text string")).collect()
    assert [r["licence"] for r in got] == [licence]


def test_windows_equal_brute_force(spark, monkeypatch):
    """Every heavy word, every occurrence, in chunks far shorter than the texts."""
    monkeypatch.setattr(licenses, "CHUNK", 16)
    rng = random.Random(8)
    templates = licenses.ALL_TEMPLATES[:12] + licenses.TEMPLATES[12:16] + licenses.TEMPLATES[-3:]
    noise = ["the", "of", "license", "version", "3", "gnu", "mit", "zebra", "copy"]
    rows = [(None, "Licensed under the MIT License."), ("none", None), ("empty", ""), ("repeated", "mit " * 400)]
    for k in range(30):
        pieces = []
        for _ in range(rng.randint(1, 3)):
            words = rng.choice(templates)[1].split()
            pieces += rng.choices(noise, k=rng.randint(0, 40)) + [w for w in words if rng.random() < 0.95]
        rows.append((f"f{k}", "\n".join(" ".join(pieces[i : i + 7]) for i in range(0, len(pieces), 7))))
    files = spark.createDataFrame([(*r, "x", 1) for r in rows], "path string, text string, part string, place int")
    got = {(r["path"], r["part"], r["place"], r["n_words"]): r["similarity"] for r in licenses.licence_parts(files, "path", "text", templates).collect()}
    bags = [re.findall(licenses._WORD, t.lower()) for _, t in templates]
    held = [(p, re.findall(licenses._WORD, (t or "").lower())) for p, t in rows]
    weights, _ = licenses.notice_words(templates)
    holders = {w: sum(w in ws for _, ws in held) for ws in bags for w in ws}
    heavy = licenses.heavy_words(weights, holders, licenses.THRESHOLD)
    spread = Counter(w for b in bags for w in set(b))
    idf = lambda w: math.log((len(bags) + 1) / (spread[w] + 0.5))
    vector = lambda words: {w: n * idf(w) for w, n in Counter(words).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    vectors = [(v, length(v)) for v in map(vector, bags)]

    def best(words):
        v = vector(words)
        near = [u for u in vectors if len(v.keys() & u[0].keys()) >= min(2, len(u[0]))]  # one word is no notice
        return max((round(sum(x * u.get(w, 0.0) for w, x in v.items()) / n / length(v), 6) for u, n in near), default=0.0)

    expected, seen = {}, {}
    for path, words in held:
        units = [("file", 0, words)]
        for notice, word in heavy:
            before, width = bags[notice].index(word), len(bags[notice])
            for i, w in enumerate(words):
                if w == word:
                    first = max(i - before, 0)
                    units.append(("window", first, words[first : i - before + width]))
        for part, place, unit in units:
            if not unit or not {w for _, w in heavy} & set(unit):
                continue
            if tuple(unit) not in seen:
                seen[tuple(unit)] = best(unit)
            value = seen[tuple(unit)]
            if value >= licenses.THRESHOLD:
                expected[path, part, place, len(unit)] = value
    found = {k: v for k, v in got.items() if k[1] != "line"}
    sure = {k for k, v in expected.items() if v > licenses.THRESHOLD + 1e-5}
    assert sure <= set(found) <= set(expected) and len(sure) > 60
    assert all(found[k] == pytest.approx(expected[k], abs=2e-6) for k in found)
    assert licenses.licence_parts(files.limit(0), "path", "text").collect() == []


def test_inheritance_takes_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    words = "some plain words that fill a file well beyond the notice in it, so that it stands for itself alone\n"
    rows = [
        ("LICENSE", mit), ("a/x.txt", words), ("a/b/COPYING", words + gpl), ("a/b/y.txt", None), ("a/b/c/z.txt", ""),
        ("q/own.txt", words + gpl), ("q/r.txt", words), ("s/t/COPYING", mit), ("s/t/u.txt", words), ("s/t/u.txt", words), (None, mit), (None, words),
    ]
    files = spark.createDataFrame([(*r, "x") for r in rows], "path string, text string, licence string")
    got = sorted(((r[0], r[1], r[3], r[4]) for r in licenses.file_licences(files).collect()), key=str)
    expected = [
        ("LICENSE", "MIT", "own", None), ("a/x.txt", "MIT", "inherited", ""), ("a/b/COPYING", "GPL-3.0", "own", None),
        ("a/b/y.txt", "GPL-3.0", "inherited", "a/b"), ("a/b/c/z.txt", "GPL-3.0", "inherited", "a/b"), ("q/own.txt", "GPL-3.0", "own", None),
        ("q/r.txt", "MIT", "inherited", ""), ("s/t/COPYING", "MIT", "own", None), ("s/t/u.txt", "MIT", "inherited", "s/t"),
        ("s/t/u.txt", "MIT", "inherited", "s/t"), (None, "MIT", "own", None), (None, "MIT", "own", None),
    ]
    assert got == sorted(expected, key=str)
    assert licenses.file_licences(files.limit(0)).collect() == []
