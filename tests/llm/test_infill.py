"""Fill-in-the-middle against plain string code, and the exception index against decoding."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.llm import infill

ALPHABET = ["a", "B", " ", "\n", "\n", "é", "ß", "€", "中", "😀", "́", "<", ">", "P"]


def texts():
    rng = random.Random(5)
    fixed = [
        None, "", "\n", "\n\n", "one line", "ends\n", "a\r\nb", "has <P> in it", "has <S>", "<M>", "<P", "é\n中\n😀",
        "long " * 40_000, "長い\n" * 30_000, "same\ntext", "same\ntext",
    ]
    return fixed + ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(200)]


def expected(doc_id, text, unit="lines", rate=100, spm_rate=50, seed=7):
    text = text or ""
    units = list(text) if unit == "characters" else re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, lo), (lo, hi), (hi, n)))
    if not text or any(s in text for s in infill.SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", infill.UNITS)
@pytest.mark.parametrize("rate, spm_rate, seed", [(100, 50, 7), (60, 20, 8)])
def test_agrees_with_string_code(spark, unit, rate, spm_rate, seed):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no\nid"), (3, "id\nagain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = infill.fill_in_middle(docs, unit=unit, rate=rate, spm_rate=spm_rate, seed=seed).withColumn("back", infill.restored())
    of = lambda i, t: (i is None, i, *(str(x) for x in expected(i, t, unit, rate, spm_rate, seed)), t or "")
    got = [(r.doc_id is None, r.doc_id, str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r.back) for r in cut.collect()]
    assert sorted(got, key=str) == sorted((of(i, t) for i, t in rows), key=str)
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_index_converts_both_ways():
    text = "".join(random.Random(1).choices(ALPHABET, k=5_000))
    data = np.frombuffer(text.encode(), np.uint8)
    index = infill.ExceptionIndex(data)
    points = np.arange(len(text) + 1)
    places = np.array([len(text[:i].encode()) for i in range(0, len(text) + 1)])
    assert (index.places(points) == places).all() and (index.points(places) == points).all()
    assert len(index.bytes_at) == sum(len(c.encode()) > 1 for c in text)


def test_index_of_ascii_is_empty():
    index = infill.ExceptionIndex(np.frombuffer(b"plain text", np.uint8))
    assert len(index.bytes_at) == 0 and index.places(np.array([4]))[0] == 4


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a\nb", "x", "y", "z")], "doc_id long, text string, n string, output string, id string")
    cut = infill.fill_in_middle(docs)
    assert cut.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and cut.first().n == 2
    assert infill.fill_in_middle(docs.where("false")).count() == 0
    renamed = docs.select(F.col("doc_id").cast("string").alias("key"), F.lit(None).cast("string").alias("body"))
    assert tuple(infill.fill_in_middle(renamed, "key", "body").first()) == ("1", 0, "plain", None, None, "")


@pytest.mark.parametrize("sentinels", [("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "bc", "d"), ("aa", "b", "c"), ("abc", "b", "d")])
def test_ambiguous_sentinels_are_refused(spark, sentinels):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, sentinels=sentinels)


def test_unknown_unit_is_refused(spark):
    with pytest.raises(ValueError):
        infill.fill_in_middle(spark.createDataFrame([(1, "a")], "doc_id long, text string"), unit="words")
