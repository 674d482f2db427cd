"""Half steps of ALS over ratings that stay where they are.

The ratings lie in the shared folder twice, sorted by user and by item and dealt to parts by a hash of the id; the factors of a
side are one file with a region per part. A half step is a job without a shuffle: each task maps the other side's factors into
memory, sums and solves the equations of its part in array steps, and writes its region. It starts from the factors that Spark's
ALS draws for the same blocks and solves the same equations, so the model is that of Spark's ALS but for rounding.

All that tasks call is defined inside the functions that make them, so executors need no copy of this package.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from copy import copy
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.sources.session import fresh_path

RATINGS_PER_TASK = 1_000_000
ROWS_OF_PAGES = 1_024  # regions begin at multiples of this many rows, so no two tasks write to one page
SPREAD = 2_654_435_761  # 2^32 by the golden ratio: deals ids of any step evenly
AT_ONCE = 512  # equations solved in one array step
CELLS = 32_768  # ratings gathered in one array step

IDS = {"users": "user_id", "items": "item_id"}
OTHER = {"users": "items", "items": "users"}


def local_folder(spark: SparkSession) -> str | None:
    """A new folder below the shared one as a path of the file system; None where the shared folder is of another kind."""
    path = spark._jvm.org.apache.hadoop.fs.Path(fresh_path(spark, "als-ratings"))
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        return None
    return path.toUri().getPath()


def _part_of(column: Column, parts: int) -> Column:
    return F.pmod(F.shiftright(column.cast("long") * F.lit(SPREAD), 16), F.lit(parts)).cast("int")


def _laying(folder: str, side: str):
    """Write the rows ``part, id, other, rating, place``, sorted, as arrays, with the distinct ids and where their rows begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, part, held, columns = uuid.uuid4().hex, None, [], ("other", "rating", "place")

        def close():
            ids, counts = (np.concatenate(arrays) for arrays in zip(*held))
            ids.tofile(f"{folder}/{side}-ids-{part}.{token}")
            np.r_[0, np.cumsum(counts)].astype(np.int64).tofile(f"{folder}/{side}-begin-{part}.{token}")
            counts.astype(np.int64).tofile(f"{folder}/{side}-count-{part}.{token}")
            for file in files:
                file.close()
            for name in ("ids", "begin", "count", *columns):  # a second attempt replaces whole files
                os.replace(f"{folder}/{side}-{name}-{part}.{token}", f"{folder}/{side}-{name}-{part}")
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_ids": pa.array([len(ids)], pa.int64())})

        for batch in batches:
            if not batch.num_rows:
                continue
            at, ids, *values = (batch.column(i).to_numpy() for i in range(5))
            edges = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True])
            for lo, hi in zip(edges[:-1], edges[1:]):
                if at[lo] != part:
                    if part is not None:
                        yield close()
                    part, held = int(at[lo]), []
                    files = [open(f"{folder}/{side}-{name}-{part}.{token}", "wb") for name in columns]
                for file, value in zip(files, values):
                    value[lo:hi].tofile(file)
                own = ids[lo:hi]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                found, counts = own[first], np.diff(np.r_[first, len(own)])
                if held and held[-1][0][-1] == found[0]:  # an id that goes on from the batch before
                    held[-1][1][-1] += counts[0]
                    found, counts = found[1:], counts[1:]
                if len(found):
                    held.append((found, counts))
        if part is not None:
            yield close()

    return run


def _numbering(folder: str, side: str, parts: int, starts: np.ndarray, spread: int):
    """Turn the other side's ids of a part into row numbers of its factor file; ``starts`` are its parts' first rows."""
    other_side, step = OTHER[side], 1_000_000

    def run(part: int) -> None:
        if not os.path.exists(f"{folder}/{side}-ids-{part}"):
            return
        ids = [np.empty(0, np.int32)] * parts
        for p in range(parts):
            if os.path.exists(f"{folder}/{other_side}-ids-{p}"):
                ids[p] = np.fromfile(f"{folder}/{other_side}-ids-{p}", np.int32)
        keys = np.concatenate([x.astype(np.int64) + (p << 33) for p, x in enumerate(ids)])
        before = starts[:-1] - np.r_[0, np.cumsum([len(x) for x in ids])][:-1]
        token = uuid.uuid4().hex
        with open(f"{folder}/{side}-other-{part}", "rb") as source, open(f"{folder}/{side}-row-{part}.{token}", "wb") as out:
            while len(other := np.fromfile(source, np.int32, step)):
                other = other.astype(np.int64)
                p = ((other * spread) >> 16) % parts
                (np.searchsorted(keys, other + (p << 33)) + before[p]).astype(np.int32).tofile(out)
        os.replace(f"{folder}/{side}-row-{part}.{token}", f"{folder}/{side}-row-{part}")

    return run


def _cutting(folder: str, cut: str, before: float):
    """Count the ratings of each id whose place is below ``before``: as rows are in the order of places, these come first."""

    def run(part: int) -> None:
        for side in ("users", "items"):
            if os.path.exists(f"{folder}/{side}-ids-{part}"):
                begin = np.fromfile(f"{folder}/{side}-begin-{part}", np.int64)
                inside = np.fromfile(f"{folder}/{side}-place-{part}", np.float64) < before
                counts, token = np.add.reduceat(inside, begin[:-1], dtype=np.int64), uuid.uuid4().hex
                counts.tofile(f"{folder}/{side}-count-{part}{cut}.{token}")
                os.replace(f"{folder}/{side}-count-{part}{cut}.{token}", f"{folder}/{side}-count-{part}{cut}")

    return run


def _measuring(folder: str, cut: str, users: str, items: str, rank: int):
    """Squared errors of the predicted ratings: how many and their sum, of those in the cut and of the others."""

    def run(part_and_start: tuple[int, int]) -> tuple[int, float, int, float]:
        part, start = part_and_start
        if not os.path.exists(f"{folder}/users-ids-{part}"):
            return 0, 0.0, 0, 0.0
        begin, counts = np.fromfile(f"{folder}/users-begin-{part}", np.int64), np.fromfile(f"{folder}/users-count-{part}{cut}", np.int64)
        rows = np.asarray(np.memmap(f"{folder}/users-row-{part}", np.int32, "r"))
        ratings = np.asarray(np.memmap(f"{folder}/users-rating-{part}", np.float32, "r"))
        x, y = (np.asarray(np.memmap(file, np.float32, "r")).reshape(-1, rank) for file in (users, items))
        found = [0, 0.0, 0, 0.0]
        for lo in range(0, len(rows), 65_536):
            at = np.arange(lo, min(lo + 65_536, len(rows)))
            user = np.searchsorted(begin, at, side="right") - 1
            prediction = np.einsum("ij,ij->i", x[start + user], y[rows[at]])
            error = (ratings[at].astype(np.float64) - prediction) ** 2
            seen, inside = ~np.isnan(error), at < (begin[:-1] + counts)[user]
            for i, own in ((0, seen & inside), (2, seen & ~inside)):
                found[i] += int(own.sum())
                found[i + 1] += float(error[own].sum())
        return tuple(found)

    return run


def _drawing(folder: str, cut: str, file: str, block: int, blocks: int, parts: int, rank: int):
    """Write one block's users in the order of their ids, and their starting factors: unit vectors of the normal numbers given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for p in range(parts):
            if os.path.exists(f"{folder}/users-ids-{p}"):
                ids, counts = np.fromfile(f"{folder}/users-ids-{p}", np.int32), np.fromfile(f"{folder}/users-count-{p}{cut}", np.int64)
                found.append(ids[(ids % blocks == block) & (counts > 0)])
        ids = np.sort(np.concatenate(found))
        token = uuid.uuid4().hex
        ids.tofile(f"{file}-ids-{block}.{token}")
        rest = np.empty(0, np.float32)
        with open(f"{file}-block-{block}.{token}", "wb") as out:
            for batch in batches:
                rest = np.r_[rest, batch.column(0).to_numpy().astype(np.float32)]
                whole = len(rest) // rank * rank
                x, rest = rest[:whole].reshape(-1, rank), rest[whole:]
                length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).astype(np.float32)
                (x * (np.float32(1) / length)[:, None]).tofile(out)
        for name in ("ids", "block"):
            os.replace(f"{file}-{name}-{block}.{token}", f"{file}-{name}-{block}")
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32())})

    return run


def _gathering(folder: str, cut: str, file: str, blocks: int, rank: int, starts: np.ndarray):
    """Copy the starting factors of a part's users from the blocks to the part's region."""

    def run(part: int) -> None:
        if not os.path.exists(f"{folder}/users-ids-{part}"):
            return
        ids = np.fromfile(f"{folder}/users-ids-{part}", np.int32)
        block_of = np.where(np.fromfile(f"{folder}/users-count-{part}{cut}", np.int64) > 0, ids % blocks, -1)
        x = np.full((len(ids), rank), np.nan, np.float32)
        for block in np.unique(block_of[block_of >= 0]):
            own = block_of == block
            drawn = np.memmap(f"{file}-block-{block}", np.float32, "r").reshape(-1, rank)
            x[own] = drawn[np.searchsorted(np.fromfile(f"{file}-ids-{block}", np.int32), ids[own])]
        with open(os.open(file, os.O_CREAT | os.O_WRONLY, 0o666), "wb") as out:
            out.seek(int(starts[part]) * rank * 4)
            out.write(x.tobytes())

    return run


def _solving(
    folder: str, cut: str, side: str, source: str, target: str, before: str | None, rank: int, reg: float, nonnegative: bool,
    starts: np.ndarray,
):
    """One half step of a part: least squares of its ids against the factors in ``source``, into the part's region of ``target``.

    ``before`` holds the side's factors of the iteration before: those that were zero there are the first guess. Ids without a
    rating in the cut get no numbers.
    """
    at_once, cells, eye = AT_ONCE, CELLS, np.arange(rank)

    def corner(a: np.ndarray, b: np.ndarray, free: np.ndarray) -> np.ndarray:
        """Smallest 1/2 x'ax - b'x over x >= 0, by exchange of the factors that violate a condition (Kim and Park).

        All are exchanged while their number falls, else, after three more trials, only the last one, which ends for sure.
        """
        out, at = np.zeros_like(b), np.arange(len(b))
        fewest, trials = np.full(len(b), rank + 1), np.full(len(b), 3)
        while True:
            masked = a * (free[:, None, :] & free[:, :, None])
            masked[:, eye, eye] += ~free
            x = np.linalg.solve(masked, (b * free)[..., None])[..., 0]
            slope = np.matmul(a, x[..., None])[..., 0] - b
            slack = 1e-12 * np.abs(b).max(axis=1, keepdims=True)
            bad = np.where(free, x < -1e-12, slope < -slack)
            n = bad.sum(axis=1)
            out[at] = x
            if not n.any():
                return np.maximum(out, 0)
            fewer = n < fewest
            whole, trials = fewer | (trials > 0), np.where(fewer, 3, trials - 1)
            last = eye == (rank - 1 - np.argmax(bad[:, ::-1], axis=1))[:, None]
            free = free ^ np.where(whole[:, None], bad, last)
            on = n > 0
            at, a, b, free, fewest, trials = at[on], a[on], b[on], free[on], np.minimum(fewest, n)[on], trials[on]

    def run(part: int) -> None:
        if not os.path.exists(f"{folder}/{side}-ids-{part}"):
            return
        begin = np.fromfile(f"{folder}/{side}-begin-{part}", np.int64)
        rows = np.asarray(np.memmap(f"{folder}/{side}-row-{part}", np.int32, "r"))
        ratings = np.asarray(np.memmap(f"{folder}/{side}-rating-{part}", np.float32, "r"))
        vectors = np.asarray(np.memmap(source, np.float32, "r")).reshape(-1, rank)
        counts = np.fromfile(f"{folder}/{side}-count-{part}{cut}", np.int64)
        first = int(starts[part])
        guess = None if before is None else np.asarray(np.memmap(before, np.float32, "r")).reshape(-1, rank)[first : first + len(counts)]
        out = np.full((len(counts), rank), np.nan, np.float32)
        by_count = np.argsort(counts, kind="stable")
        lo = int((counts == 0).sum())
        while lo < len(by_count):
            hi = min(lo + at_once, len(by_count))
            while hi > lo + 1 and (hi - lo) * counts[by_count[hi - 1]] > cells:
                hi = lo + (hi - lo) // 2
            who = by_count[lo:hi]
            a, b = np.zeros((len(who), rank, rank)), np.zeros((len(who), rank))
            for skip in range(0, int(counts[who[-1]]), cells):  # more than once only for an id on its own
                place = np.arange(skip, min(skip + cells, counts[who[-1]]))
                held = place < counts[who][:, None]
                at = np.minimum(begin[who][:, None] + place, len(rows) - 1)
                y = vectors[rows[at]].astype(np.float64)
                y[~held] = 0
                turned = y.transpose(0, 2, 1)
                a += np.matmul(turned, y)
                b += np.matmul(turned, ratings[at].astype(np.float64)[..., None])[..., 0]
            a[:, eye, eye] += reg * counts[who][:, None]
            if nonnegative:
                out[who] = corner(a, b, np.ones(b.shape, bool) if guess is None else guess[who] > 0)
            else:
                out[who] = np.linalg.solve(a, b[..., None])[..., 0]
            lo = hi
        with open(os.open(target, os.O_CREAT | os.O_WRONLY, 0o666), "wb") as file:
            file.seek(first * rank * 4)
            file.write(out.tobytes())

    return run


def _reading(folder: str, cut: str, side: str, file: str, rank: int, starts: np.ndarray):
    """The ids and factors of the parts whose numbers come in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in batch.column(0).to_pylist()):
            if os.path.exists(f"{folder}/{side}-ids-{part}"):
                ids = np.fromfile(f"{folder}/{side}-ids-{part}", np.int32)
                x = np.asarray(np.memmap(file, np.float32, "r")).reshape(-1, rank)[starts[part] : starts[part] + len(ids)]
                held = np.flatnonzero(np.fromfile(f"{folder}/{side}-count-{part}{cut}", np.int64))
                for lo in range(0, len(held), 16_384):
                    own = held[lo : lo + 16_384]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * rank), pa.array(x[own].ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[own]), lists], names=["id", "features"])

    return run


class LaidOut:
    """The ratings of one or more fits in both orders, and the factors these fits have come to.

    With a column ``at``, each id's ratings are in its order, so those below a bound come first: ``below`` gives the ratings of such a
    cut, for fits of its own, without laying them out again.

    ``folder`` is None where the ratings are left to Spark's ALS: where the shared folder is no path of the file system, and for
    rows that Spark's ALS refuses (nulls, ids beyond 32 bits) or that are not finite.
    """

    def __init__(self, triples: DataFrame, at: str | None = None):
        self.triples, self.spark, self.at, self.cut = triples, triples.sparkSession, at, ""
        ids = {side: F.expr(f"try_cast(`{name}` AS int)") for side, name in IDS.items()}
        rating = F.col("rating").cast("float")
        whole = [F.col(name).cast("double") == ids[side] for side, name in IDS.items()]
        fine = F.coalesce(whole[0] & whole[1] & (F.abs(rating) < float("inf")), F.lit(False))
        seen = triples.agg(F.count(F.lit(1)).alias("n"), F.count_if(fine).alias("n_fine")).first()
        self.n = seen["n"]
        self.folder = local_folder(self.spark) if 0 < self.n == seen["n_fine"] else None
        self._come_to: dict[tuple, tuple[int, str, str]] = {}
        if self.folder is None:
            return
        # no part of the model: each id's equations are summed by one task, in the order of the other ids
        self.parts = max(-(-self.n // RATINGS_PER_TASK), min(self.spark.sparkContext.defaultParallelism, -(-self.n // 20_000)))
        self.starts: dict[str, np.ndarray] = {}
        os.makedirs(self.folder)
        for side in IDS:
            dealt = triples.select(
                _part_of(ids[side], self.parts).alias("part"), ids[side].alias("id"), ids[OTHER[side]].alias("other"), rating.alias("rating"),
                (F.col(at) if at else F.lit(0.0)).cast("double").alias("place"),
            ).repartitionById(self.parts, "part").sortWithinPartitions("part", "id", "place", "other", "rating")
            rows = np.zeros(self.parts + 1, np.int64)
            for found in dealt.mapInArrow(_laying(self.folder, side), "part int, n_ids long").collect():  # one row per part
                rows[found["part"] + 1] = -(-found["n_ids"] // ROWS_OF_PAGES) * ROWS_OF_PAGES
            self.starts[side] = np.cumsum(rows)
        for side in IDS:
            self._each_part(_numbering(self.folder, side, self.parts, self.starts[OTHER[side]], SPREAD))
            for part in range(self.parts):
                self._forget(f"{self.folder}/{side}-other-{part}")

    def _each_part(self, run) -> None:
        self.spark.sparkContext.parallelize(range(self.parts), self.parts).foreach(run)

    def below(self, bound: float) -> LaidOut:
        """The ratings whose ``at`` is below ``bound``, on the same files."""
        part = copy(self)
        part.triples, part.cut, part._come_to = self.triples.where(F.col(self.at) < bound), f"-{bound}", {}
        if self.folder is None:
            part.n = part.triples.count()
        else:
            self._each_part(_cutting(self.folder, part.cut, bound))
            files = [f"{self.folder}/users-count-{p}{part.cut}" for p in range(self.parts)]
            part.n = sum(int(np.fromfile(file, np.int64).sum()) for file in files if os.path.exists(file))
        return part

    def errors(self, files: tuple[str, str], rank: int) -> tuple[int, float | None, int, float | None]:
        """How many ratings the factors in ``files`` predict and their RMSE: of those in this cut, and of all others laid out."""
        starts = list(enumerate(self.starts["users"][:-1].tolist()))
        each = self.spark.sparkContext.parallelize(starts, self.parts).map(_measuring(self.folder, self.cut, *files, rank)).collect()
        n, total, n_other, other = (sum(x) for x in zip(*each))  # one row per part
        return n, (total / n) ** 0.5 if n else None, n_other, (other / n_other) ** 0.5 if n_other else None

    def _new(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    @staticmethod
    def _forget(*files: str) -> None:
        for file in files:
            if os.path.exists(file):
                os.remove(file)

    def drop(self) -> None:
        """Delete the files, after the last fit."""
        if self.folder is not None:
            shutil.rmtree(self.folder, ignore_errors=True)

    def _drawn(self, als: ALS) -> str:
        """The starting factors of the users as Spark's ALS draws them: a stream of normal numbers per block, ids in order."""
        rank, blocks, file = als.getRank(), als.getNumUserBlocks(), self._new("drawn")
        sizes = np.zeros(blocks, np.int64)
        for part in range(self.parts):
            if os.path.exists(f"{self.folder}/users-ids-{part}"):
                held = np.fromfile(f"{self.folder}/users-count-{part}{self.cut}", np.int64) > 0
                sizes += np.bincount(np.fromfile(f"{self.folder}/users-ids-{part}", np.int32)[held] % blocks, minlength=blocks)
        seed = self.spark._jvm.org.apache.spark.util.random.XORShiftRandom(als.getSeed()).nextLong()

        def draw(block: int) -> None:
            # one partition, so its number, which randn adds to the seed, is 0
            normal = self.spark.range(0, int(sizes[block]) * rank, 1, 1).select(F.randn(_byteswap64(seed ^ block)))
            normal.mapInArrow(_drawing(self.folder, self.cut, file, block, blocks, self.parts, rank), "block int").collect()

        used = [block for block in range(blocks) if sizes[block]]
        with ThreadPool(min(len(used), 8)) as pool:
            pool.map(draw, used)
        self._each_part(_gathering(self.folder, self.cut, file, blocks, rank, self.starts["users"]))
        self._forget(*(f"{file}-{name}-{block}" for name in ("ids", "block") for block in used))
        return file

    def fit(self, als: ALS) -> ALSModel:
        """What ``als`` makes of the ratings; goes on from the longest shorter fit here that differs in its length only."""
        rank, last = als.getRank(), als.getMaxIter()
        key = rank, als.getRegParam(), als.getNonnegative(), als.getSeed(), als.getNumUserBlocks()
        done, users, items = self._come_to.get(key, (0, None, None))
        if done > last:
            done, users, items = 0, None, None
        kept = {users, items}  # the shorter fit's own, until this one is over
        if done == 0:
            users = self._drawn(als)
        solve = partial(_solving, self.folder, self.cut, rank=rank, reg=als.getRegParam(), nonnegative=als.getNonnegative())
        for step in range(done, last):
            items, old = self._new("items"), items
            self._each_part(solve("items", users, items, old, starts=self.starts["items"]))
            old, users, gone = users, self._new("users"), old
            # starting factors have no sign, so they are no guess
            self._each_part(solve("users", items, users, old if step else None, starts=self.starts["users"]))
            self._forget(*({gone, old} - kept - {None}))
        if done < last:
            self._come_to[key] = last, users, items
            self._forget(*(kept - {None}))
        return self._model(als, users, items)

    def _model(self, als: ALS, users: str, items: str) -> ALSModel:
        def table(side: str, file: str) -> DataFrame:
            parts = self.spark.range(0, self.parts, 1, self.parts)
            return parts.mapInArrow(_reading(self.folder, self.cut, side, file, als.getRank(), self.starts[side]), "id int, features array<float>")

        made = self.spark._jvm.org.apache.spark.ml.recommendation.ALSModel
        model = als._copyValues(ALSModel(made(als.uid, als.getRank(), table("users", users)._jdf, table("items", items)._jdf)))
        model.files = users, items
        return model


def _byteswap64(value: int) -> int:
    """``scala.util.hashing.byteswap64`` as a signed number."""
    factor, whole = 0x9E3775CD9E3775CD, (1 << 64) - 1
    swapped = int.from_bytes((value * factor & whole).to_bytes(8, "little"), "big") * factor & whole
    return swapped - (1 << 64) if swapped >> 63 else swapped
