"""Repeated passages: MinHash bands over paragraphs, exact verification, removal by components.

A passage may be pasted into the middle of another text, so line ends do not say where it starts. Paragraphs
here are cut by content: one starts where the hash of two adjoining words is the smallest among its
neighbours (or MAX_WORDS after the last start). Inside a passage the cuts fall alike wherever it stands. The
RADIUS words and the piece at each end, and pieces with an edit, are found by going on word by word from the
verified paragraphs, next to the keeper's text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.llm import regions
from shelfsense.llm.common import components, hashes, mixed, run_hashes, shingles, words_of
from shelfsense.sources.session import stored

WORDS = 5
NUM, DEN = 75, 100
RECALL = 0.98  # of pairs at the threshold; equal paragraphs are always found, nearer ones more often
RADIUS = 5
MAX_WORDS = 64
LEAST_RUN = 14  # words in whole paragraphs, as most passages of over 50 words have
LEAST_REACH = 40  # or words in all, where edits leave fewer in whole paragraphs
REACH = MAX_WORDS  # words followed beyond a paragraph: an equal stretch that is longer holds a whole one
MOST_EDITED = 3  # adjoining words that an edit changes, adds or leaves out
GAP = 16  # words: an edit inside a near copy spoils a paragraph, not the passage around it
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(2**64 - 1)
_LEAST_ID = -(2**63)


def tuned_bands(threshold: float = NUM / DEN, recall: float = RECALL, most_keys: int = 6) -> tuple[int, int]:
    """Bands and rows: the most selective bands that find ``recall`` of pairs at the threshold with so many keys.

    A pair at similarity s meets in a band of r rows with probability s^r. Paragraphs have few shingles, so
    one row already parts strangers; more rows are taken only while the keys per paragraph stay few.
    """
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands <= most_keys / 2:
            best = (bands, rows)
    return best


BANDS, ROWS = tuned_bands()


def _least(padded: np.ndarray, at: np.ndarray, shifts: range) -> np.ndarray:
    out = padded[at + shifts[0]]
    for s in shifts[1:]:
        np.minimum(out, padded[at + s], out=out)
    return out


def paragraph_starts(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """First words of the paragraphs of many texts, whose word hashes stand one after the other."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.int64)
    lengths = lengths[lengths > 0]
    first = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        pair = np.append(mixed(words[:-1] * _ODD + words[1:]), _TOP)
    pair[first[1:] - 1] = _TOP  # a text's last word has no neighbour
    at = np.arange(n) + np.repeat(np.arange(1, len(lengths) + 1) * RADIUS, lengths)  # room between texts
    padded = np.full(n + (len(lengths) + 1) * RADIUS, _TOP)
    padded[at] = pair
    low = (pair < _least(padded, at, range(-RADIUS, 0))) & (pair <= _least(padded, at, range(1, RADIUS + 1)))
    low[first] = True
    starts = np.flatnonzero(low)
    gaps = np.diff(np.append(starts, n))
    pieces = -(-gaps // MAX_WORDS)
    if (pieces > 1).any():
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + step * MAX_WORDS
    return starts


def paragraphs(words: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths in words, and shingle hashes by word with the top value where none starts.

    No shingle crosses a paragraph's end; a paragraph shorter than a shingle is one shingle of its words.
    """
    starts = paragraph_starts(words, lengths)
    n_words = np.diff(np.append(starts, len(words)))
    runs = np.full(len(words), _TOP)
    if len(words) >= size:
        runs[: len(words) - size + 1] = shingles(words, size)
    room = np.repeat(starts + n_words, n_words) - np.arange(len(words))
    runs[room < size] = _TOP
    for width in range(1, size):
        short = starts[n_words == width]
        if len(short):
            runs[short] = run_hashes([words[short + i] for i in range(width)])
    return starts, n_words, runs


def _names(starts: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """128 bits per paragraph, n x 2: the sum of its mixed shingles, and its first minimum."""
    with np.errstate(over="ignore"):
        total = np.add.reduceat(np.where(runs == _TOP, np.uint64(0), mixed(runs ^ _ODD)), starts)
    return np.stack([total, np.minimum.reduceat(runs, starts)], 1)


def _band_keys(starts: np.ndarray, runs: np.ndarray, bands: int, rows: int) -> list[np.ndarray]:
    """A key per band: its number and its MinHash values, the first under the shingles' own order."""
    keys = []
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(starts), np.uint64(b + 1))
            for k in range(b * rows, (b + 1) * rows):
                ranked = np.where(runs == _TOP, _TOP, mixed(runs + np.uint64(k) * _ODD)) if k else runs
                key = mixed(key * _ODD + np.minimum.reduceat(ranked, starts))
            keys.append(key.view(np.int64))
    return keys


def _blobs(names: np.ndarray) -> pa.Array:
    """16 bytes a row, without a Python object for each."""
    fixed = pa.Array.from_buffers(pa.binary(16), len(names), [None, pa.py_buffer(np.ascontiguousarray(names).tobytes())])
    return fixed.cast(pa.binary())


def _bags(starts: np.ndarray, runs: np.ndarray) -> pa.Array:
    """The shingles of each paragraph, cut to 32 bits: they are compared with a few other paragraphs only."""
    there = runs != _TOP
    ends = np.append(0, np.cumsum(np.add.reduceat(there.astype(np.int32), starts))).astype(np.int32) * 4
    data = runs[there].astype(np.uint32).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])


def _listed(size: int, bands: int, rows: int, keyed: bool):
    """Paragraphs of each document: with their band keys, or with their place and shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [words_of(t) for t in part.column(1).to_pylist()]
                lengths = np.array([len(t) for t in texts])
                words = hashes(list(chain.from_iterable(texts)))
                starts, n_words, runs = paragraphs(words, lengths, size)
                if not len(starts):
                    continue
                ends = np.cumsum(lengths)
                owner = np.searchsorted(ends, starts, side="right")
                id_ = part.column(0).take(pa.array(owner))
                node = _blobs(_names(starts, runs))
                if keyed:
                    keys = _band_keys(starts, runs, bands, rows)
                    yield pa.RecordBatch.from_arrays([id_, node, *map(pa.array, keys)], names=["id", "node", *(f"k{b}" for b in range(bands))])
                else:
                    place = (starts - (ends - lengths)[owner]).astype(np.int32)
                    row = part.column(2).take(pa.array(owner))
                    columns = [id_, row, node, pa.array(place), pa.array(n_words.astype(np.int32)), _bags(starts, runs)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "node", "start", "length", "bag"])

    return run


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bags as sorted distinct 64-bit numbers."""
    for batch in batches:
        bags = [np.unique(np.frombuffer(b, np.uint32)).astype(np.uint64).tobytes() for b in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bags, pa.binary())], names=["region", "node", "bag"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a paragraph and of up to REACH words on both sides, each as 32 bits, for every place asked for."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [])
        rows = []
        for r, (text, starts, lengths) in enumerate(zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))):
            words = hashes(words_of(text)).astype(np.uint32)
            for start, length in zip(starts, lengths):
                first = max(start - REACH, 0)
                rows.append(r)
                for column, value in zip(out, (start, start - first, words[first : start + length + REACH].tobytes())):
                    column.append(value)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())],
            names=["id", "row", "start", "head", "words"],
        )


_SKIPS = sorted(
    ((x, y) for x in range(MOST_EDITED + 1) for y in range(MOST_EDITED + 1) if x + y), key=lambda s: (max(s), abs(s[0] - s[1]), s)
)


def _followed(a: list, i: int, b: list, j: int) -> int:
    """How far ``a`` from ``i`` on goes with ``b`` from ``j`` on; an edit counts if WORDS equal words follow it."""
    n, m = len(a), len(b)
    while True:
        while i < n and j < m and a[i] == b[j]:
            i, j = i + 1, j + 1
        for x, y in _SKIPS:
            if i + x + WORDS <= n and a[i + x : i + x + WORDS] == b[j + y : j + y + WORDS]:
                i, j = i + x, j + y
                break
        else:
            return i


def reached(a: list, first: int, end: int, b: list, kept_first: int, kept_end: int) -> int:
    """The end of what ``a`` shares with ``b`` around and after the paragraph ``a[first:end]``, ``end`` at least.

    The walk starts at the last run of WORDS words (a shorter paragraph as a whole) in both paragraphs.
    """
    width = min(WORDS, end - first, kept_end - kept_first)
    places: dict[tuple, int] = {}
    for j in range(kept_first + width, kept_end + 1):
        places[tuple(b[j - width : j])] = j
    for i in range(end, first + width - 1, -1):
        j = places.get(tuple(a[i - width : i]))
        if j is not None:
            return max(end, _followed(a, i, b, j))
    return end


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends = [], []
        for start, length, head, words, kept_length, kept_head, kept_words in zip(*(batch.column(i).to_pylist() for i in range(1, 8))):
            a, b = np.frombuffer(words, np.uint32).tolist(), np.frombuffer(kept_words, np.uint32).tolist()
            end = reached(a, head, head + length, b, kept_head, kept_head + kept_length)
            n, m = len(a), len(b)
            before = reached(a[::-1], n - head - length, n - head, b[::-1], m - kept_head - kept_length, m - kept_head)
            starts.append(start - head + n - before)
            ends.append(start - head + end)
        start, end = np.array(starts, np.int32), np.array(ends, np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(start), pa.array(end - start), batch.column(8)], names=["id", "start", "length", "keeper"]
        )


def _number(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(_LEAST_ID))


def repeated_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, num: int = NUM, den: int = DEN,
    bands: int = BANDS, rows: int = ROWS, **options,
) -> DataFrame:
    """``(id, row, start, length, keeper, kept)`` of paragraphs that repeat in a document with a smaller id.

    Paragraphs are linked by equal or similar shingle sets (``den * shared >= num * union``, verified on the
    sets); of each component of links the smallest document, ``keeper``, keeps its paragraphs. ``row`` is the
    hash of the text, as rows may repeat an id; ``kept`` is the ``row, start, length`` of the keeper's first one.
    """
    texts = _texts(docs, id_col, text_col)
    keys = [f"k{b}" for b in range(bands)]
    keyed = texts.drop("row").mapInArrow(_listed(size, bands, rows, True), "id long, node binary, " + ", ".join(f"{k} long" for k in keys))
    # equal paragraphs become one row before any of them meet in a band
    classes = keyed.groupBy("node").agg(
        (F.min("id") < F.max("id")).alias("equal"), *[F.first(k).alias(k) for k in keys]
    )
    banded = classes.select("node", "equal", F.posexplode(F.array(*keys)).alias("band", "region"))
    bucket = Window.partitionBy("region")
    mixed_bucket = F.min("node").over(bucket) != F.max("node").over(bucket)
    met = stored(
        banded.withColumn("mixed", mixed_bucket).where("mixed OR (equal AND band = 0)").select("region", "node", "mixed"), "met-paragraphs"
    )
    wanted = stored(met.select("node").distinct(), "wanted-paragraphs")
    units = stored(
        texts.mapInArrow(_listed(size, bands, rows, False), "id long, row long, node binary, start int, length int, bag binary").join(wanted, "node"),
        "paragraphs",
    )
    bags = stored(
        met.where("mixed").select("region", "node").join(units.groupBy("node").agg(F.first("bag").alias("bag")), "node")
        .select("region", "node", "bag").mapInArrow(_widened, "region long, node binary, bag binary"),
        "paragraph-bags",
    )
    linked = components(regions.links(bags, num, den, **options))
    grouped = linked.union(linked.select("root", "root").distinct())
    ends = units.groupBy("node").agg(F.min("id").alias("least"), F.max("id").alias("greatest"))
    rooted = stored(ends.join(grouped.toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted-paragraphs")
    keepers = rooted.groupBy("root").agg(F.min("least").alias("keeper"), F.max("greatest").alias("last")).where("keeper < last")
    repeated = stored(rooted.join(keepers, "root").where("greatest > keeper OR least = keeper").select("node", "root", "keeper"), "repeated-paragraphs")
    placed = stored(units.drop("bag").join(repeated, "node").drop("node"), "repeated-places")
    kept = stored(
        placed.where("id = keeper").groupBy("root").agg(F.min(F.struct("row", "start", "length")).alias("kept")), "kept-paragraphs"
    )
    return placed.where("id > keeper").join(kept, "root").drop("root")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string").alias("text")
    return docs.select(_number(F.col(id_col)).alias("id"), text).withColumn("row", F.xxhash64("text"))


def extended_paragraphs(found: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, start, length, keeper)``: runs of repeated paragraphs followed word by word beyond their ends.

    Only paragraphs next to one that does not repeat are followed, in texts that hold such a paragraph or keep one.
    """
    in_text = Window.partitionBy("id", "row").orderBy("start", "keeper")
    at_edge = (
        (F.coalesce(F.lag(F.col("start") + F.col("length")).over(in_text), F.lit(-1)) < F.col("start"))
        & (F.col("start") > 0)
    ) | (F.coalesce(F.lead("start").over(in_text), F.lit(2**30)) > F.col("start") + F.col("length"))
    edges = stored(found.withColumn("edge", at_edge).where("edge").drop("edge"), "passage-edges")
    places = edges.select("id", "row", "start", "length").union(edges.select("keeper", "kept.row", "kept.start", "kept.length")).distinct()
    listed = places.groupBy("id", "row").agg(F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))
    windows = stored(
        _texts(docs, id_col, text_col).join(listed, ["id", "row"]).select("id", "row", "text", "starts", "lengths")
        .mapInArrow(_windows, "id long, row long, start int, head int, words binary"),
        "edge-windows",
    )
    # rows that repeat an id and its text have the same windows
    once = windows.groupBy("id", "row", "start").agg(F.first("head").alias("head"), F.first("words").alias("words"))
    kept = stored(
        once.join(edges.select("keeper", "kept.row", "kept.start").distinct().toDF("id", "row", "start"), ["id", "row", "start"], "left_semi"),
        "kept-windows",
    ).toDF("keeper", "kept_row", "kept_start", "kept_head", "kept_words")
    mine = edges.join(once, ["id", "row", "start"]).select(
        "*", F.col("kept.row").alias("kept_row"), F.col("kept.start").alias("kept_start"), F.col("kept.length").alias("kept_length")
    )
    return (
        mine.join(kept, ["keeper", "kept_row", "kept_start"])
        .select("id", "start", "length", "head", "words", "kept_length", "kept_head", "kept_words", "keeper")
        .mapInArrow(_extended, "id long, start int, length int, keeper long")
    )


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_run: int = LEAST_RUN,
    least_reach: int = LEAST_REACH, **options
) -> DataFrame:
    """One row per document: the id, ``n_passages, n_words_repeated, repeated, passages``.

    A passage is a run of adjoining repeated paragraphs, followed word by word to both sides as far as it goes
    with the keeper's text; edits of up to MOST_EDITED words on the way count as repeated. ``passages`` lists
    ``(start, length, keeper)`` in words (between ASCII white space), with the smallest document that keeps a
    copy of one of its paragraphs. Passages at most GAP words apart count together and must have ``least_run``
    words in whole paragraphs or ``least_reach`` words in all, gaps not counted and kept in the text. Fewer
    words, such as a licence line, are left alone. Case of A to Z does
    not matter. Null, empty and one-word texts have no passages. Repeats inside one document are no repeats.
    Ids must be whole numbers; a null id counts as the smallest. Rows that repeat an id share one result. Other
    columns are not read; an empty table gives an empty result.
    """
    paragraphs_found = stored(repeated_paragraphs(docs, id_col, text_col, **options).distinct(), "found-paragraphs")
    longer = extended_paragraphs(paragraphs_found, docs, id_col, text_col).withColumn("whole", F.lit(0))
    found = paragraphs_found.select("id", "start", "length", "keeper").distinct().withColumn("whole", F.col("length")).union(longer)
    through = Window.partitionBy("id").orderBy("start", "length", "keeper", "whole")
    before = F.max(F.col("start") + F.col("length")).over(through.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") - before, F.lit(2**30))
    joined = (
        found.withColumn("passage", F.sum((apart > 0).cast("int")).over(through))
        .groupBy("id", "passage")
        .agg(
            F.min("start").alias("start"), (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length"),
            F.min("keeper").alias("keeper"), F.sum("whole").alias("whole"),
        )
    )
    one_by_one = Window.partitionBy("id").orderBy("start")
    apart = F.coalesce(F.col("start") - F.lag(F.col("start") + F.col("length")).over(one_by_one), F.lit(2**30))
    here = Window.partitionBy("id", "place")
    runs = (
        joined.withColumn("place", F.sum((apart > GAP).cast("int")).over(one_by_one))
        .withColumn("whole_here", F.sum("whole").over(here))
        .withColumn("words_here", F.sum("length").over(here))
        .where((F.col("whole_here") >= least_run) | (F.col("words_here") >= least_reach))
        .groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("n_passages"), F.sum("length").alias("n_words_repeated"),
            F.sort_array(F.collect_list(F.struct("start", "length", "keeper"))).alias("passages"),
        )
    )
    rows = docs.select(F.col(id_col).alias("_own"), _number(F.col(id_col)).alias("id"))
    nothing = F.array().cast("array<struct<start:int,length:int,keeper:bigint>>")
    return rows.join(runs, "id", "left").select(
        F.col("_own").alias(id_col),
        F.coalesce("n_passages", F.lit(0)).alias("n_passages"),
        F.coalesce("n_words_repeated", F.lit(0)).alias("n_words_repeated"),
        F.col("n_passages").isNotNull().alias("repeated"),
        F.coalesce("passages", nothing).alias("passages"),
    )


def cut_passages(text: Column, passages: Column) -> Column:
    """The text without its passages; each word goes with the white space after it."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))

    def outside(_: Column, i: Column) -> Column:
        return ~F.exists(passages, lambda p: (i >= p["start"]) & (i < p["start"] + p["length"]))

    return F.when(F.size(passages) == 0, text).otherwise(F.concat_ws("", F.filter(pieces, outside)))
