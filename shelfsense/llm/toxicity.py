"""Toxicity of disguised texts: a noisy-channel decoder restores words, a linear model scores them.

Letters may be written as digits or signs, stretched, masked, or set apart by spaces and dots. Such a token is
a lattice of letters; the Viterbi path under a character language model of the whole corpus, with a cost for
each disguise, is the word meant. Tokens of plain letters have one path, themselves, and are not decoded.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm import sparse_fit
from shelfsense.llm.brown import held_out
from shelfsense.sources.session import stored

MAX_SAMPLE = 20_000  # labelled rows for the classifier, chosen by hash
THRESHOLD = 0.3
MIN_DOCS = 3  # of a feature in the sample
PENALTY = 2e-4
_REMEMBERED = 100_000

# Letters that a digit or sign commonly stands for.
DISGUISES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
}
MASKS = "*#"  # stand for any letter
SEPARATORS = ".-_~ "
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_EDGE = 0  # code of everything that is no letter
_CODES = 1 + len(LETTERS)
_TABLE = bytes(
    1 + LETTERS.index(c) if (c := bytes([b]).decode("latin-1").lower()) in LETTERS else _EDGE for b in range(256)
)
_CODE = {c: 1 + i for i, c in enumerate(LETTERS)}
_SUBSTITUTE, _SQUEEZE, _SKIP, _MASK = -1.5, -0.7, -0.4, -2.0  # log probabilities of disguises
_BEAM = 24

_APART = re.compile(r"(?<![^\s])(?:[^\W_]|[@$!|+*#€])(?:[ .\-_~](?:[^\W_]|[@$!|+*#€])){2,}(?![^\s.,;:!?])")
_STRETCHED = re.compile(r"(.)\1\1")
_AROUND = ".,;:?\"'`)]}>%&=~^…«»“”„‘’"


# --- character language model -------------------------------------------------------------------------------

def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CODES**3, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            texts = [t for t in batch.column(0).slice(at, 512).to_pylist() if t]
            raw = ("  " + "  ".join(texts) + "  ").encode("latin-1", "replace").translate(_TABLE)
            code = np.frombuffer(raw, np.uint8).astype(np.int32)
            total += np.bincount((code[:-2] * _CODES + code[1:-1]) * _CODES + code[2:], minlength=len(total))
    cell = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total[cell])], names=["cell", "n"])


def letter_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(letter | two before), counted over all texts; a table of fixed size."""
    rows = docs.select(text_col).mapInArrow(_count_letters, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_CODES**3)
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    counts = counts.reshape(_CODES, _CODES, _CODES)
    pairs = counts.sum(0) + 0.5
    one = pairs / pairs.sum(1, keepdims=True)
    three = (counts + 4 * one[None]) / (counts.sum(2, keepdims=True) + 4)
    return np.log(three)


# --- decoding ------------------------------------------------------------------------------------------------

def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each place the strings it may stand for, with their log probabilities."""
    places: list[list[tuple[str, float]]] = []
    for sign, run in groupby(token.lower()):
        n = sum(1 for _ in run)
        if sign in MASKS:
            options = [(c, _MASK) for c in LETTERS[:26]]
            places += [options] * min(n, 12)
            continue
        if sign in _CODE:
            once = [(sign, 0.0)]
        elif sign in DISGUISES:
            once = [(c, _SUBSTITUTE) for c in DISGUISES[sign]]
        else:  # separators and other signs vanish
            places.append([("", _SKIP if sign in SEPARATORS else 2 * _SKIP)])
            continue
        if n == 1:
            places.append(once)
        else:
            squeezed = [(c, p + _SQUEEZE) for c, p in once]
            doubled = [(c + c, p + (0.0 if n == 2 else _SQUEEZE)) for c, p in once]
            places.append(squeezed + doubled)
    return places


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest plain word behind a token; the beam keeps the best of each two last letters."""
    best = {(_EDGE, _EDGE): (0.0, "")}
    for options in lattice(token):
        reached: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, word) in best.items():
            for letters, cost in options:
                x, y, p = a, b, score + cost
                for c in letters:
                    z = _CODE[c]
                    p += model[x, y, z]
                    x, y = y, z
                if (x, y) not in reached or p > reached[x, y][0]:
                    reached[x, y] = (p, word + letters)
        if len(reached) > _BEAM:
            reached = dict(sorted(reached.items(), key=lambda kv: -kv[1][0])[:_BEAM])
        best = reached
    return max(((p + model[a, b, _EDGE], word) for (a, b), (p, word) in best.items()), default=(0.0, ""))[1]


def disguised(token: str) -> bool:
    """Letters with signs among them, or stretched letters."""
    if token.isalpha():
        return bool(_STRETCHED.search(token))
    return any(c in _CODE for c in token) and len(token) <= 40 and not any(s in token for s in ("://", "@", "=")) or (
        "@" in token and len(token) <= 20 and "." not in token and any(c in _CODE for c in token)
    )


def _forms(token: str, model: np.ndarray) -> list[str]:
    plain = token.strip(_AROUND).lstrip("([{<" + _AROUND)
    if not plain:
        return []
    if not disguised(plain):
        return [plain] if plain.isalpha() else []
    word = decode(plain.rstrip("!*#|.-_"), model)
    return [word] if len(word) > 1 else []


def word_features(word: str) -> tuple[str, ...]:
    """The word and its beginnings: inflected and compound words share them."""
    return tuple({"w" + word, "4" + word[:4], "5" + word[:5]} if len(word) > 3 else {"w" + word})


def features(text: str | None, model: np.ndarray, known: dict[str, tuple]) -> set[str]:
    """Distinct features of the restored text. ``known`` remembers tokens."""
    lowered = (text or "").lower()
    tokens = set(lowered.split())
    if len(lowered) > 4:
        tokens.update(m.group() for m in _APART.finditer(lowered))
    out: set[str] = set()
    for token in tokens:
        found = known.get(token)
        if found is None:
            if len(known) > _REMEMBERED:
                known.clear()
            found = known[token] = tuple(f for w in _forms(token, model) for f in word_features(w))
        out.update(found)
    return out


def restored(text: str | None, model: np.ndarray) -> str:
    """The text with each disguised token replaced by the word behind it; for reading and tests."""
    apart = _APART.sub(lambda m: decode(m.group(), model), (text or "").lower())
    return " ".join(" ".join(_forms(t, model)) or t for t in apart.split())


# --- jobs --------------------------------------------------------------------------------------------------------

def _listed(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = [sorted(features(t, model.value, known)) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string())), part.column(1)], names=["features", "label"])

    return run


def _scored(model, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, (bias, weight), known = model.value, weights.value, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, scores = batch.slice(at, 512), []
                for text in part.column(1).to_pylist():
                    lowered = (text or "").lower()
                    tokens = set(lowered.split())
                    tokens.update(m.group() for m in _APART.finditer(lowered))
                    found: set[str] = set()
                    for token in tokens:
                        own = known.get(token)
                        if own is None:
                            if len(known) > _REMEMBERED:
                                known.clear()
                            own = known[token] = tuple(
                                f for w in _forms(token, letters) for f in word_features(w) if f in weight
                            )
                        if own:
                            found.update(own)
                    z = bias + math.fsum(weight[f] for f in found)
                    scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    return run


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label: str, most: int) -> DataFrame:
    """Texts and labels of at most ``most`` labelled ids that are not held out, chosen by hash."""
    wanted = labels.where(F.col(label).isNotNull() & ~held_out(F.col(label_id), 4)).select(
        F.col(label_id).alias("labelled"), (F.col(label) > 0).cast("double").alias("label")
    )
    chosen = stored(wanted.distinct().orderBy(F.xxhash64("labelled"), "labelled", "label").limit(most), "label-sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), texts["id"] == chosen["labelled"]).select("text", "label")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
    label: str = "toxic", most: int = MAX_SAMPLE, penalty: float = PENALTY,
):
    """The letter model, and ``(bias, {feature: weight})`` of a sparse logistic regression.

    Without labels of both kinds the weights are empty and the bias gives the share of toxic labels.
    """
    spark = docs.sparkSession
    letters = letter_model(docs, text_col)
    sent = spark.sparkContext.broadcast(letters)
    sample = _sample(docs, labels, id_col, text_col, label_id, label, most)
    listed = stored(sample.mapInArrow(_listed(sent), "features array<string>, label double"), "label-features")
    n, toxic = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    none = (math.log((toxic + 0.5) / (n - toxic + 0.5)), {})
    if not 0 < toxic < n or listed.where(F.size("features") > 0).isEmpty():
        return sent, none
    rows = stored(sparse_fit.fit(listed, penalty, min(MIN_DOCS, n)), "weights").collect()  # one row per weight that is not zero
    weights = {r["feature"]: r["weight"] for r in rows}
    return sent, (weights.pop(None), weights)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options
) -> DataFrame:
    """One row per document: the id, ``held_out, score, predicted``.

    Labels teach only from rows that are not held out (CRC-32 of the id as text, modulo 4, is 2), and from at
    most MAX_SAMPLE of them. The score depends on the text alone: null and empty texts get the score of a text
    without features. Rows that repeat are scored each; null labels are passed over; other columns are not
    read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    letters, weights = train(docs, labels, id_col, text_col, **options)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    scored = texts.mapInArrow(_scored(letters, spark.sparkContext.broadcast(weights)), f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id"), 4).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def not_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents below the threshold, all columns as they were."""
    spark = docs.sparkSession
    letters, weights = train(docs, labels, id_col, text_col, **options)
    sent = spark.sparkContext.broadcast(weights)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, scorer = names.index(text_col), _scored(letters, sent)
        for batch in batches:
            text = batch.column(place)
            pairs = pa.RecordBatch.from_arrays([text, text], names=["id", "text"])
            score = np.concatenate([b.column(1).to_numpy() for b in scorer(iter([pairs]))] or [np.empty(0)])
            yield batch.filter(pa.array(score < threshold))

    names = docs.columns
    return docs.mapInArrow(keep, docs.schema)
