"""Hard-negative mining: for each anchor and each of its positives, the best rows of other labels in a score window.

The upper limits of an anchor's windows, one per positive, cut the line of scores into disjoint slots. A row's score lies
in one slot, so tasks keep the top k of each slot and nothing else; a window is the concatenation of the slots from its
own limit downwards, so merging slots from the lowest up answers all windows of an anchor at once.

Rows and anchors meet in blocks: packed vectors of a stripe of all rows against a block of anchors, in one pass over
the stripe with bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.sources.session import stored

PIECE = 1024  # vectors packed together
BLOCK = 1024  # anchors in a block, on average
STRIPES = 16  # parts that all rows are dealt to; each gives at most k candidates a slot
_EXACT = float(1 << 53)
_MOST = (1 << 63) - 1

_PACKED = "stripe int, n int, dims int, ids binary, labels binary, vectors binary, kind string"
_PIECE_SCHEMA = pa.schema([
    ("stripe", pa.int32()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
    ("vectors", pa.binary()), ("kind", pa.string()),
])


# --- packing -------------------------------------------------------------------------------------------------

def _matrix(lists: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of floor(scale * x), short ones filled with zeros; and which have finite components only."""
    lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dims = int(lengths.max(initial=0))
    out = np.zeros((len(lists), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    fine = np.isfinite(out).all(axis=1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * np.where(fine[:, None], out, 0.0)), -1e300, 1e300), fine


def _packed(stripe: int, ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    largest = float(np.abs(values).max(initial=0))
    kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<f8"
    row = [stripe, len(ids), values.shape[1], ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), values.astype(kind).tobytes(), kind]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PIECE_SCHEMA)], schema=_PIECE_SCHEMA)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = np.frombuffer(row["vectors"], row["kind"]).astype(np.float64).reshape(row["n"], row["dims"])
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), values


def _pack_rows(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                values, fine = _matrix(part.column(2), scale)
                ids, labels = (part.column(i).to_numpy(zero_copy_only=False)[fine] for i in (0, 1))
                if len(ids):
                    yield _packed(number % STRIPES, ids, labels, values[fine])
                number += 5  # odd: the pieces of a task visit all stripes
    return run


def _pack_block(scale: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        values, fine = _matrix(group.column("vector").chunk(0), scale)
        ids, labels = (group.column(n).to_numpy()[fine] for n in ("id", "label"))
        piece = pa.Table.from_batches([_packed(0, ids, labels, values[fine])])
        return piece.append_column("block", group.column("block").slice(0, 1)).drop_columns(["stripe"])

    return run


# --- scores of a block of anchors against a piece of rows ------------------------------------------------------

def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact: as doubles where all sums stay below 2^53, else as Python's integers."""
    dims = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :dims], rows[:, :dims]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(dims, 1) < _EXACT:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(a).dot(whole(b).T)


def _as_long(values: np.ndarray) -> np.ndarray:
    if values.dtype == object:
        return np.array([max(-_MOST, min(_MOST, int(x))) for x in values], np.int64)
    return values.astype(np.int64)


class _TopK:
    """The best k (score, id) of each cell, and what a score must reach to enter a full cell."""

    def __init__(self, cells: int, k: int):
        self.k, self.cell = k, np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = np.full(cells, -np.inf)

    def add(self, cell: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(cell):
            return
        cell, score, ids = (np.concatenate(x) for x in ((self.cell, cell), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, cell))
        cell, score, ids = cell[order], score[order], ids[order]
        starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        rank = np.arange(len(cell)) - np.repeat(starts, np.diff(np.append(starts, len(cell))))
        stay = rank < self.k
        self.cell, self.score, self.id = cell[stay], score[stay], ids[stay]
        full = rank[stay] == self.k - 1
        self.least[self.cell[full]] = self.score[full]


class _Positives:
    """Per anchor the best k other rows of its label."""

    def __init__(self, row: dict, k: int):
        self.ids, self.labels, self.vectors = _unpacked(row)
        self.found, self.slots = _TopK(len(self.ids), k), 1

    def see(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        for label in np.intersect1d(self.labels, labels):
            a, r = np.flatnonzero(self.labels == label), np.flatnonzero(labels == label)
            score = _scores(self.vectors[a], vectors[r])
            fits = (score >= self.found.least[a, None]) & (self.ids[a, None] != ids[r])
            i, j = np.nonzero(fits.astype(bool))
            self.found.add(a[i], _as_long(score[i, j]), ids[r[j]])


class _Negatives:
    """Per anchor and slot the best k rows of other labels."""

    def __init__(self, row: dict, k: int, low: int, high: int):
        self.ids, self.labels, self.vectors = _unpacked(row)
        limits = {x["a"]: [-p["down"] for p in x["positives"]] for x in row["limits"] or []}
        self.slots = max(map(len, limits.values()), default=1)
        # Slot j of an anchor holds scores in floors[j] to tops[j]; slots an anchor lacks hold none.
        self.tops = np.full((len(self.ids), self.slots), -np.inf)
        self.floors = np.full((len(self.ids), self.slots), np.inf)
        for a, scores in limits.items():
            tops = [high * s // 100 for s in scores]
            for j, s in enumerate(scores):
                self.tops[a, j] = tops[j]
                self.floors[a, j] = max([-(-low * s // 100)] + [t + 1 for t in tops[j + 1 : j + 2]])
        self.found = _TopK(self.tops.size, k)

    def see(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        least = np.maximum(self.floors, self.found.least.reshape(self.tops.shape))
        some = np.flatnonzero((least <= self.tops).any(axis=1))
        if not len(some):
            return
        open_slots = least[some] <= self.tops[some]
        least_of_all = np.where(open_slots, least[some], np.inf).min(axis=1)
        most_of_all = np.where(open_slots, self.tops[some], -np.inf).max(axis=1)
        score = _scores(self.vectors[some], vectors)
        fits = (score >= least_of_all[:, None]) & (score <= most_of_all[:, None])
        fits = fits.astype(bool) & (self.labels[some, None] != labels) & (self.ids[some, None] != ids)
        i, j = np.nonzero(fits)
        a, value = some[i], score[i, j]
        slot = (value[:, None] <= self.tops[a]).astype(bool).sum(axis=1) - 1
        enters = (value >= least[a, slot]).astype(bool)
        a, slot, value, j = a[enters], slot[enters], value[enters], j[enters]
        self.found.add(a * self.slots + slot, _as_long(value), ids[j])


_FOUND = "block int, a int, anchor_id long, found array<struct<slot:int,down:long,id:long>>"


def _found(block: int, state) -> pa.RecordBatch:
    """One row per anchor with its candidates; ``down`` is the score with its sign changed, so it sorts upwards."""
    top = state.found
    anchor, slot = top.cell // state.slots, top.cell % state.slots
    starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
    items = pa.StructArray.from_arrays(
        [pa.array(slot, pa.int32()), pa.array(-top.score, pa.int64()), pa.array(top.id, pa.int64())], names=["slot", "down", "id"]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(anchor)), pa.int32()), items)
    firsts = anchor[starts]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(firsts), block), pa.int32()), pa.array(firsts, pa.int32()), pa.array(state.ids[firsts], pa.int64()), lists],
        names=["block", "a", "anchor_id", "found"],
    )


def _scan(start):
    """Rows arrive by block and stripe, the anchors of a block before the pieces of its stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["block"], row["stripe"]) != key:
                    if state is not None:
                        yield _found(key[0], state)
                    key, state = (row["block"], row["stripe"]), None
                if row["is_row"]:
                    if state is not None:
                        state.see(*_unpacked(row))
                else:
                    state = start(row)
        if state is not None:
            yield _found(key[0], state)

    return run


def _meet(pieces: DataFrame, blocks: DataFrame, n_blocks: int, start) -> DataFrame:
    """Each block of anchors with each piece of rows, dealt by block and stripe."""
    rows = pieces.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(True).alias("is_row"), "*")
    anchors = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1))).alias("stripe"), F.lit(False).alias("is_row"), "*")
    both = rows.unionByName(anchors, allowMissingColumns=True)
    dealt = both.repartition(n_blocks * STRIPES, "block", "stripe").sortWithinPartitions("block", "stripe", "is_row")
    return dealt.mapInArrow(_scan(start), _FOUND)


def _gathered(found: DataFrame) -> DataFrame:
    """The candidates of an anchor from all stripes, by slot, then best first; at most stripes x slots x k of them."""
    return found.groupBy("block", "a", "anchor_id").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for every anchor and positive.

    Components become ``floor(scale * x)``; a score is the inner product with the anchor; higher is better, of equal
    scores the smaller id. An anchor's positives are its best ``positives`` other rows of its label; a positive's negatives
    are the best ``negatives`` rows of other labels with ``low`` to ``high`` per cent of the positive's score.

    Ids and labels are whole numbers. Rows with a null id, label or vector, or with a null or non-finite component,
    take no part. Of vectors of unequal length the shorter counts as filled with zeros; an empty vector scores 0.
    Rows that repeat an id are candidates of their own, but never for an anchor of that id; an anchor repeated in full counts
    once. Scores beyond 63 bits become the largest long. Without rows or anchors the result is empty; further columns are
    not read.

    Every anchor is compared with every row, in blocks: nothing is left out. All stripes are exact, so their merge is.
    """
    part = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"), is_anchor.alias("is_anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    pieces = stored(part.select("id", "label", "vector").mapInArrow(_pack_rows(scale), _PACKED), "pieces")
    chosen = part.where("is_anchor").select("id", "label", "vector")
    n_blocks = -(-chosen.count() // BLOCK) or 1
    dealt = chosen.distinct().withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(n_blocks)).cast("int"))
    blocks = stored(
        dealt.groupBy("block").applyInArrow(_pack_block(scale), _PACKED.removeprefix("stripe int, ") + ", block int"), "anchors"
    )

    same = _gathered(_meet(pieces, blocks, n_blocks, lambda row: _Positives(row, positives)))
    same = stored(same.select("block", "a", F.slice("found", 1, positives).alias("positives")), "positives")
    limits = same.groupBy("block").agg(F.collect_list(F.struct("a", "positives")).alias("limits"))
    limited = blocks.join(limits, "block")

    other = _gathered(_meet(pieces, limited, n_blocks, lambda row: _Negatives(row, negatives, low, high)))
    return _windows(other.join(same, ["block", "a"]), positives, negatives, low)


def _windows(anchors: DataFrame, positives: int, negatives: int, low: int) -> DataFrame:
    """Suffix merges: the answer at a limit is its slot's best rows and then the answer at the limit below."""
    def in_slot(j: int) -> Column:
        return F.slice(F.filter("found", lambda x: x.slot == j), 1, negatives)

    def over(least: Column, found: Column) -> Column:
        return F.filter(found, lambda x: x.down.cast("decimal(20,0)") * 100 <= least)

    merged, answers = F.array().cast("array<struct<slot:int,down:long,id:long>>"), []
    for j in reversed(range(positives)):
        merged = F.slice(F.concat(in_slot(j), merged), 1, negatives)
        positive = F.get("positives", F.lit(j))
        inside = over(positive.down.cast("decimal(20,0)") * low, merged)
        answers.append(F.when(positive.isNotNull(), F.struct(positive.alias("positive"), inside.alias("negatives"))))
    each = anchors.select("anchor_id", F.explode(F.array_compact(F.array(*answers))).alias("w"))
    ranked = each.select("anchor_id", "w.positive", F.posexplode("w.negatives").alias("place", "negative"))
    return ranked.select(
        "anchor_id", F.col("positive.id").alias("positive_id"), (F.col("place") + 1).cast("int").alias("rank"),
        F.col("negative.id").alias("negative_id"), (-F.col("positive.down")).alias("positive_score"),
        (-F.col("negative.down")).alias("negative_score"),
    )
