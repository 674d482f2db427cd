"""Benchmark passages in documents: a prefix-filtered containment join, verified word by word.

A window is a run of ``size`` words of an item (a shorter item is one window). A window lies in a document
exactly if all its shingles do, at the right places. For containment at 1 the necessary prefix of a window
under any order of its shingles is one shingle; the rarest one, counted over all documents, makes the fewest
candidates. A candidate keeps its place in window and document, so it must fit the document's length on both
sides, and then the window is compared with as many document words.

Null and empty texts have no words and no hits; items without words have no windows; extra columns are not
read. Rows that repeat id and text get the same result each. An item without an id marks words but is not
listed. Empty tables give empty results, or documents without hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.llm.common import lower_ascii
from shelfsense.sources.session import stored

# Fixed value: letters and digits of ASCII, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_IN_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
SHINGLE_WORDS = 5
# Up to this many windows (some 300 bytes each) go to all tasks; more are shuffled.
BROADCAST_WINDOWS = 500_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _run_hash(all_words: Column, at: Column, n: int) -> Column:
    """Hash of ``n`` words from ``at``; past the end it covers fewer words, which verification turns away."""
    return F.xxhash64(*[F.get(all_words, at + i) for i in range(n)])


def _windows(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """``item, window_id, window, n`` for every window of every item."""
    worded = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).where("size(w) > 0")
    n = F.least(F.size("w"), F.lit(size))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - n))
    cut = worded.select("item", "w", n.alias("n"), at.alias("at"))
    window = F.slice("w", F.col("at") + 1, F.col("n"))
    return cut.select("item", window.alias("window"), "n").withColumn("window_id", F.md5(F.concat_ws(" ", "window")))


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``window_id, window, n, offset, h``: the shingles of each window, the last of equal ones included."""
    width = F.least(F.col("n"), F.lit(shingle))
    placed = windows.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("n") - width)))
    by_width = reduce(
        lambda rest, k: F.when(F.col("n") == k, _run_hash(F.col("window"), F.col("offset"), k)).otherwise(rest),
        range(1, shingle),
        _run_hash(F.col("window"), F.col("offset"), shingle),
    )
    return placed.withColumn("h", by_width)


def _places(docs: DataFrame, id_col: str, text: str, widths: list[int]) -> DataFrame:
    """``id, text_key, w, p, h``: a row for each word of each document and each shingle width."""
    worded = docs.select(F.col(id_col).alias("id"), _text_key(F.col(text)).alias("text_key"), words(F.col(text)).alias("w"))
    each = F.explode_outer(F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1)))
    placed = worded.select("id", "text_key", "w", each.alias("p"))
    runs = [_run_hash(F.col("w"), F.col("p"), k) for k in widths]
    if len(runs) == 1:
        return placed.withColumn("h", runs[0])
    return placed.withColumn("h", F.explode(F.array_distinct(F.array(*runs))))


def window_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> tuple[DataFrame, DataFrame]:
    """All occurrences ``(id, text_key, window_id, start, n)``, and ``(window_id, item)`` of all windows."""
    listed = stored(_windows(items, item_id, item_text, size), "windows")
    windows = listed.dropDuplicates(["window_id"]).drop("item")
    n_windows = listed.count()
    widths = sorted(r[0] for r in listed.select(F.least("n", F.lit(shingle))).distinct().collect()) or [shingle]
    small = n_windows <= broadcast_windows
    shipped = F.broadcast if small else lambda df: df

    shingles = stored(_window_shingles(windows, shingle), "window-shingles")
    places = _places(docs, id_col, text_col, widths)
    counts = (
        places.select("h")
        .join(shipped(shingles.select("h").distinct()), "h", "left_semi")
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    order = F.struct(F.coalesce("occurrences", F.lit(0)), "h", "offset")
    prefixes = (
        shingles.join(counts, "h", "left")
        .groupBy("window_id")
        .agg(F.min_by(F.struct("h", "offset", "n", "window"), order).alias("rarest"))
        .select("window_id", "rarest.*")
    )
    prefixes = stored(prefixes, "window-prefixes")

    start = F.col("p") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.size("w"))
    same = F.slice("w", start + 1, F.col("n")) == F.col("window")
    found = ["id", "text_key", "window_id", start.alias("start"), "n"]
    if small:
        matches = places.join(F.broadcast(prefixes), "h").where(fits & same).select(*found)
    else:  # the words stay behind, candidates meet them again by the document's key
        sized = places.select("id", "text_key", "p", "h", F.size("w").alias("n_words"))
        candidates = sized.join(prefixes.drop("window"), "h").where(
            (start >= 0) & (start + F.col("n") <= F.col("n_words"))
        )
        worded = docs.select(F.col(id_col).alias("d"), _text_key(F.col(text_col)).alias("k"), words(F.col(text_col)).alias("w"))
        matches = (
            candidates.join(worded.dropDuplicates(["d", "k"]), F.col("id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
            .join(prefixes.select("window_id", "window"), "window_id")
            .where(same)
            .select(*found)
        )
    return stored(matches.distinct(), "window-matches"), listed.select("window_id", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: the id, ``n_words, n_hit, item_ids, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window; ``item_ids`` are the items with occurring
    windows as strings, sorted.
    """
    matches, listed = window_matches(docs, items, id_col, text_col, **options)
    key = ["id", "text_key"]
    before = F.max("end").over(Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    spans = matches.select(*key, "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    new_words = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, "start")))
    hit = spans.withColumn("new", new_words).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    owners = (
        matches.select(*key, "window_id").distinct().join(listed.where("item IS NOT NULL"), "window_id")
        .select(*key, F.col("item").cast("string").alias("item")).distinct()
        .groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), _text_key(text).alias("text_key"), F.regexp_count(text, F.lit(_WORD_IN_ANY_CASE)).cast("long").alias("n_words"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"id": "r_id", "text_key": "r_key"})
        same = (F.col("text_key") == F.col("r_key")) & F.col("id").eqNullSafe(F.col("r_id"))
        return left.join(right, same, "left").drop("r_id", "r_key")

    return beside(beside(rows, hit), owners).select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without any benchmark window, all columns as they were."""
    matches, _ = window_matches(docs, items, id_col, text_col, **options)
    hit = matches.select(F.col("id").alias("_hit_id"), F.col("text_key").alias("_hit_key")).distinct()
    same = (_text_key(F.col(text_col)) == F.col("_hit_key")) & F.col(id_col).eqNullSafe(F.col("_hit_id"))
    return docs.join(hit, same, "left_anti")
