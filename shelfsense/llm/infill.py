"""Fill-in-the-middle: cut each text in three at unit borders and put the parts in another order.

Places in a text are kept as byte offsets. Between bytes and code points stands a sparse exception index: only
the multibyte characters are written down, each with its place and the bytes it has beyond the first. A cut is
converted by one binary search in that index and an addition, so a stretch of ASCII costs nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINELS = ("<P>", "<S>", "<M>")
UNITS = ("lines", "characters")
_COLUMNS = "n long, form string, prefix_chars long, middle_chars long, output string"
_DRAWS = ("_first_cut", "_second_cut", "_transform", "_order")


class ExceptionIndex:
    """Places and excess bytes of the multibyte characters of one UTF-8 buffer."""

    def __init__(self, data: np.ndarray):
        self.bytes_at = np.flatnonzero(data >= 0xC0)
        lead = data[self.bytes_at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(extra)))
        self.points_at = self.bytes_at - self.excess[:-1]

    def points(self, places: np.ndarray) -> np.ndarray:
        """Code points before each byte place; places lie at borders of characters."""
        return places - self.excess[np.searchsorted(self.bytes_at, places)]

    def places(self, points: np.ndarray) -> np.ndarray:
        """Byte place of each code point."""
        return points + self.excess[np.searchsorted(self.points_at, points)]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of n texts (n + 1 of them) and the UTF-8 bytes they point to."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or data is None:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    starts = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return starts - starts[0], np.frombuffer(data, np.uint8)[starts[0] : starts[-1]]


def _cut(texts: pa.Array, draws: np.ndarray, unit: str):
    """Units of each text, byte places of both cuts, and code points before, between them."""
    starts, data = _buffers(texts)
    index = ExceptionIndex(data)
    head, tail = starts[:-1], starts[1:]
    if unit == "characters":
        first = index.points(head)
        n = index.points(tail) - first
    else:
        breaks = np.flatnonzero(data == 10)
        before = np.searchsorted(breaks, head)
        closed = np.searchsorted(breaks, tail) - before
        open_end = (tail > head) & (np.append(data, 0)[tail - 1] != 10)
        n = closed + open_end
    wanted = np.sort(draws[:2] % (n + 1).astype(np.uint64), axis=0).astype(np.int64)
    if unit == "characters":
        cuts = index.places(first + wanted)
    else:
        at = np.clip(before + wanted - 1, 0, max(len(breaks) - 1, 0))
        ends = breaks[at] + 1 if len(breaks) else np.zeros_like(at)
        cuts = np.where(wanted == 0, head, np.where(wanted <= closed, ends, tail))
    points = index.points(np.vstack([head, cuts]))
    return n, starts, data, cuts, points[1] - points[0], points[2] - points[1]


def _reorder(unit: str, rate: int, spm_rate: int, sentinels: tuple[str, str, str]):
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, texts = batch.column(0), batch.column(1)
            if not len(texts):
                continue
            draws = np.vstack([batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)]).astype(np.uint64)
            n, starts, data, cuts, prefix, middle = _cut(texts, draws, unit)
            holds = np.zeros(len(texts), bool)
            for word in sentinels:
                holds |= pc.match_substring(texts, word).to_numpy(zero_copy_only=False)
            plain = (starts[1:] == starts[:-1]) | holds | (draws[2] % np.uint64(100) >= rate)
            spm = draws[3] % np.uint64(100) < spm_rate
            whole, out = data.tobytes(), []
            for lo, a, b, hi, is_plain, is_spm in zip(starts[:-1], *cuts, starts[1:], plain, spm):
                if is_plain:
                    out.append(whole[lo:hi])
                elif is_spm:
                    out.append(b"".join((s, whole[b:hi], p, whole[lo:a], m, whole[a:b])))
                else:
                    out.append(b"".join((p, whole[lo:a], s, whole[b:hi], m, whole[a:b])))
            columns = [
                kept,
                pa.array(n, pa.int64()),
                pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")), pa.string()),
                pa.array(prefix, pa.int64(), mask=plain),
                pa.array(middle, pa.int64(), mask=plain),
                pa.array(out, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def draws(id_col: str, seed: int) -> list[Column]:
    """Four whole numbers of 32 bits for each id: the first groups of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(name) for i, name in enumerate(_DRAWS)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "lines",
    rate: int = 100,
    spm_rate: int = 50,
    seed: int = 7,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Each text with its middle moved to the end: ``(id, n, form, prefix_chars, middle_chars, output)``.

    ``unit`` is what both cuts count: ``lines`` (each with its line feed) or ``characters`` (code points); ``n`` is how
    many a text has. ``rate`` per cent of the texts are cut, of these ``spm_rate`` per cent with the suffix first.
    Draws follow from the id alone: rows that repeat an id and a text give the same row again; a null id draws
    as the empty text. ``form`` is ``plain`` (text as it was, both lengths null) for texts that are null, empty or hold
    a sentinel. An empty table gives an empty result; further columns are not read. No sentinel may end as another
    or itself begins, else a border could not be told from text.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")
    if any(not x for x in sentinels) or len(set(sentinels)) < 3 or any(
        a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b) - (a == b)) + 1))
        for a in sentinels for b in sentinels
    ):
        raise ValueError("sentinels must differ, and none may hold another or end as one begins")
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), *draws(id_col, seed))
    cut = rows.mapInArrow(_reorder(unit, rate, spm_rate, sentinels), f"id {kind}, {_COLUMNS}")
    return cut.withColumnRenamed("id", id_col)


def restored(
    output: Column | str = "output", form: Column | str = "form", sentinels: tuple[str, str, str] = SENTINELS
) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    parts = F.split(output, "|".join(re.escape(x) for x in sentinels), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
