"""Groups of documents with similar shingle sets: a metric-space join over pivots and Voronoi regions.

Jaccard distance is a metric, so pivots part the space exactly (``regions``). Most documents of a corpus,
though, share no shingle and are at distance 1 from each other and from every pivot, where no triangle helps.
So only sets that can be near are brought into one region. Two sets with similarity t share at least l of the
``n - ceil(t n) + l`` first shingles under any common order; l is a tenth of a set here, so one shared passage
is seldom enough. The order is by how often shingles of a hash cell occur, rare cells first; the cells' counts
are a table of fixed size over all documents, and errors in it cost time, never links. Shingles of hot cells count
as shared without being brought together, so no key holds more than a bounded share of the rows. The few sets that pass
are looked at whole: a set needs t n shingles that others of them have too, and only its rarest
``n - ceil(t n) + 1``, now by exact counts, join it with others. Sets so joined are a first region, and pivots,
windows and recursion do the rest. Equal sets are one class.

Identity of shingles rests on 64-bit hashes, that of sets on 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.llm import regions
from shelfsense.llm.common import components, shingle_set
from shelfsense.operators.spread import spread_join
from shelfsense.sources.session import small_side, stored, tune

WORDS = 5
NUM, DEN = 75, 100  # linked if DEN * |intersection| >= NUM * |union|
_CELL_BITS = 20
_CHUNKS = 64
HOT_CELL = 64


def _texts(batches: Iterator[pa.RecordBatch], column: int, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).to_pylist()


def _digest(bag: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(bag.tobytes())


def _least_shared(n: int) -> int:
    """Shared shingles to look for, for sets of ``n``."""
    return n // 10 + 1


def _described(words: int):
    """A row per document, and at a task's end its counts by hash cell, in chunks."""
    shift = np.uint64(64 - _CELL_BITS)
    names = ["id", "n", "digest", "chunk", "task", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros(1 << _CELL_BITS, np.int64), None
        for part, texts in _texts(batches, 1):
            bags = [shingle_set(t, words) for t in texts]
            total += np.bincount((np.concatenate(bags) >> shift).astype(np.int64), minlength=len(total))
            kind, rows = part.column(0).type, len(bags)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([len(b) for b in bags], pa.int64()), pa.array(map(_digest, bags), pa.binary()),
                    pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                ],
                names=names,
            )
        if kind is not None:
            chunks = pa.array([c.tobytes() for c in np.split(total, _CHUNKS)], pa.binary())
            task = pa.array([TaskContext.get().partitionId()] * _CHUNKS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(_CHUNKS, kind), pa.nulls(_CHUNKS, pa.int64()), pa.nulls(_CHUNKS, pa.binary()), pa.array(range(_CHUNKS), pa.int32()), task, chunks],
                names=names,
            )

    return run


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.int64) for b in rows.column("counts").to_pylist())
    return pa.table({
        "chunk": rows.column("chunk").slice(0, 1), "task": pa.array([0], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary()),
    })


def _cell_levels(counted: DataFrame) -> tuple[np.ndarray, int]:
    """For each of 2^20 hash cells the number of binary digits of its shingles' document count: 1 MB.

    Also the level above which a cell is hot: it has over HOT_CELL times the rows of a mean cell.
    """
    schema = "chunk int, task int, counts binary"
    part = F.pmod("task", F.lit(256))
    counted = counted.withColumn("part", part).groupBy("chunk", "part").applyInArrow(_added, schema)
    rows = counted.groupBy("chunk").applyInArrow(_added, schema).collect()  # _CHUNKS rows of fixed size
    if not rows:
        return np.zeros(1 << _CELL_BITS, np.uint8), 64
    total = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in sorted(rows)])
    hot = np.ceil(np.log2(max(HOT_CELL * total.mean(), HOT_CELL) + 1))
    return np.ceil(np.log2(total + 1)).astype(np.uint8), int(hot)


def _prefixes(levels, words: int, num: int, den: int):
    shift, low = np.uint64(64 - _CELL_BITS), np.uint64(8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, hot = levels.value
        for part, texts in _texts(batches, 1):
            at, digests, prefixes, in_hot = [], [], [], []
            for i, text in enumerate(texts):
                bag = shingle_set(text, words)
                digest = _digest(bag)
                cell = level[(bag >> shift).astype(np.int64)]
                rarity = cell.astype(np.uint64) << np.uint64(56) | (bag >> low)
                needed = len(bag) + (-num * len(bag) // den) + _least_shared(len(bag))  # n - ceil(t n) + l
                first = np.argsort(rarity, kind="stable")[:needed]
                cold = first[cell[first] <= hot]
                rows = [(bag[cold].view(np.int64), 0)]
                if len(cold) < len(first):
                    rows.append((np.zeros(1, np.int64), len(first) - len(cold)))
                for prefix, n_hot in rows:
                    at.append(i)
                    digests.append(digest)
                    prefixes.append(prefix)
                    in_hot.append(n_hot)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, prefixes)]), pa.int32()), pa.array(np.concatenate(prefixes), pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(at, pa.int64())), pa.array(digests, pa.binary()), lists, pa.array(in_hot, pa.int64())], names=["id", "digest", "prefix", "in_hot"]
            )

    return run


def _with_bags(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 1):
            rows = []
            for digest, text in zip(part.column(0).to_pylist(), texts):
                bag = shingle_set(text, words)
                if _digest(bag) == digest:  # else another row with the same id
                    rows.append((digest, bag.tobytes()))
            node, bags = zip(*rows) if rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.binary()), pa.array(bags, pa.binary())], names=["node", "bag"]
            )

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bags as lists of numbers."""
    for batch in batches:
        blobs = batch.column(1).to_pylist()
        ends = np.cumsum([0, *(len(b) // 8 for b in blobs)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(blobs), np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["short", "shingles"])


def _first_regions(bags: DataFrame, num: int, den: int) -> DataFrame:
    """``short, region`` of sets that share a necessary shingle under the order of exact counts, through others or not.

    A shingle may be in a third of the sets, so its rows are never brought together: counts and smallest names are
    aggregated and stored, so that both sides of the joins back come straight from a shuffle and a hot shingle is cut
    at run time. Names are 64-bit hashes; of two sets with one name neither is dropped, they only look at more.
    """
    listed = bags.dropDuplicates(["node"]).select(F.xxhash64("node").alias("short"), "bag").mapInArrow(_listed, "short long, shingles array<long>")
    shingles = listed.select("short", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    sets = stored(shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), "shared-shingles")
    own = Window.partitionBy("short")
    ranked = shingles.join(sets, "shingle").withColumn("live", F.count(F.lit(1)).over(own)).withColumn(
        "rank", F.row_number().over(own.orderBy("sets", "shingle")) + F.col("n") - F.col("live")
    )
    rarest = F.col("rank") <= F.col("n") - F.ceil(F.lit(num) * F.col("n") / den) + 1
    needed = stored(ranked.where(rarest).select("short", "shingle"), "necessary-shingles")
    first = needed.groupBy("shingle").agg(F.min("short").alias("head"), F.max("short").alias("last")).where("head < last")
    first = stored(first.select("shingle", "head"), "heads")
    heads = needed.join(first, "shingle").where("short <> head").select("short", "head").distinct()
    joined = stored(components(heads, "short", "head"), "first-regions")
    return joined.select(F.col("node").alias("short"), F.col("root").alias("region")).union(joined.select("root", "root").distinct())


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, num: int = NUM, den: int = DEN, **options
) -> DataFrame:
    """One row per document: the id, ``n_shingles``, and ``component_id``, the smallest id reachable by links.

    Two documents link when ``den * |intersection| >= num * |union|`` of their sets of ``words``-word shingles
    (fewer words are one shingle). Documents without words (or null) have no shingles and are linked with
    nothing: their component is their own id. Rows that repeat an id are documents of their own with that id;
    null ids are passed over when the smallest id is sought and stay null where nothing else is linked. Other
    columns are not read; an empty table gives an empty result.
    """
    spark = tune(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    described = stored(
        texts.mapInArrow(_described(words), f"id {kind}, n long, digest binary, chunk int, task int, counts binary"), "shingle-sets"
    )
    levels = spark.sparkContext.broadcast(_cell_levels(described.where("chunk IS NOT NULL").select("chunk", "task", "counts")))
    sets = described.where("chunk IS NULL").select("id", "n", "digest")
    filled = sets.where("n > 0")
    named = stored(filled.groupBy("digest").agg(F.min("id").alias("first_id"), F.first("n").alias("n")), "classes")

    # a row of the set that has the smallest id stands for all equal sets
    copies = spread_join(filled, named.drop("n"), ["digest"]).where("id <> first_id").select("id", "digest")
    # a shingle of a hot cell is taken as shared without a look at the others: it costs time, never links
    needed = (
        texts.mapInArrow(_prefixes(levels, words, num, den), f"id {kind}, digest binary, prefix array<long>, in_hot long")
        .join(small_side(copies), ["id", "digest"], "left_anti")
        .select("digest", F.explode("prefix").alias("shingle"), "in_hot")
        .select(F.xxhash64("digest").alias("short"), "shingle", "in_hot")
        .withColumn("shingle", F.when(F.col("in_hot") > 0, F.col("short")).otherwise(F.col("shingle")))
    )
    one = Window.partitionBy("shingle")  # of at most HOT_CELL times the rows of a mean cell

    ends = needed.withColumn("head", F.min("short").over(one)).withColumn("last", F.max("short").over(one))
    common = ends.where("in_hot > 0 OR head < last").select("short", F.greatest("in_hot", F.lit(1)).alias("shared"))
    size = named.groupBy(F.xxhash64("digest").alias("short")).agg(F.min("n").alias("n"))
    smallest_partner = F.ceil(F.lit(num) * F.col("n") / den)
    least = F.floor(smallest_partner / 10) + 1  # as _least_shared
    counts = common.groupBy("short").agg(F.sum("shared").alias("shared"))
    enough = counts.join(size, "short").where(F.col("shared") >= least).select("short")
    wanted = named.withColumn("short", F.xxhash64("digest")).join(enough, "short").select("digest", "first_id")
    bags = stored(
        texts.join(small_side(wanted), F.col("id").eqNullSafe(F.col("first_id"))).select("digest", "text")
        .mapInArrow(_with_bags(words), "node binary, bag binary"),
        "bags",
    )
    near = stored(bags.withColumn("short", F.xxhash64("node")).join(small_side(_first_regions(bags, num, den)), "short").select("region", "node", "bag"), "region-bags")
    linked = components(regions.links(near, num, den, **options))
    grouped = linked.select(F.col("node").alias("digest"), "root").union(
        linked.select(F.col("root").alias("digest"), "root").distinct()
    )
    grouped = stored(grouped.join(named.drop("n"), "digest"), "groups")
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("smallest"))
    by_set = named.join(grouped.select("digest", "root").join(smallest, "root").drop("root"), "digest", "left").select(
        "digest", F.coalesce("smallest", "first_id").alias("component_id")
    )
    by_set = stored(by_set, "components")
    rows = spread_join(filled.select("id", "n", "digest"), by_set, ["digest"]).select("id", "n", "component_id")
    alone = sets.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return rows.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents whose id is the smallest of their group; other columns are as they were.

    Rows that repeat an id share its fate. Rows with a null id stay only where no linked row has an id.
    """
    gone = (
        similar_groups(docs, id_col, text_col, **options)
        .where(~F.col(id_col).eqNullSafe(F.col("component_id")))
        .select(F.col(id_col).alias("_gone"))
        .distinct()
    )
    return docs.join(small_side(gone), F.col(id_col).eqNullSafe(F.col("_gone")), "left_anti")
