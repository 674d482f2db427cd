"""Repeated lines, found by probing sharded minimal perfect hash tables.

Lines are hashed to 128 bits and counted once per document. The lines at the threshold are dealt to shards of
bounded size; a shard is a minimal perfect hash over its lines with flat arrays of fingerprints, counts and
the document that keeps the line. Documents do not join lines: blocks of texts send each shard the distinct
hashes they hold, the shard probes its arrays, and the block gets back the few that are known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import block_count, mixed
from shelfsense.sources.session import stored

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_LINES = 1 << 16
_SPACE = " \t\n\x0b\x0c\r"  # fixed values: ASCII white space
_LOAD = 2  # slots per line and level of a hash table
_BLOCKS_A_TASK = 64


def line_hashes(text: str | None, min_chars: int) -> list[bytes | None]:
    """128 bits per line, None for lines whose key is short."""
    out: list[bytes | None] = []
    for line in (text or "").split("\n"):
        key = line.strip(_SPACE)
        long_enough = len(key) >= min_chars
        out.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()) if long_enough else None)
    return out


# --- minimal perfect hash ------------------------------------------------------------------------------------

def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        seeded = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ mixed(keys[:, 1] + np.uint64(level + 1))
        return (mixed(seeded) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of a minimal perfect hash over distinct 128-bit keys, an array of n x 2 numbers.

    Each level is a bit per slot: set where exactly one of the keys left falls. The others go on to the next.
    """
    levels = []
    while len(keys):
        size = _LOAD * len(keys)
        slot = _slots(keys, len(levels), size)
        single = np.bincount(slot, minlength=size) == 1
        levels.append(single)
        keys = keys[~single[slot]]
    return levels


def index(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The number of each key, from 0 without gaps; a key that was not built in gets any number, or -1."""
    out = np.full(len(keys), -1, np.int64)
    left, before = np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        slot = _slots(keys[left], level, len(bits))
        hit = bits[slot]
        out[left[hit]] = before + (np.cumsum(bits) - 1)[slot[hit]]
        left, before = left[~hit], before + int(bits.sum())
    return out


def _keys(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64).reshape(-1, 2)


# --- the jobs ---------------------------------------------------------------------------------------------

def _distinct_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [list({h for h in line_hashes(t, min_chars) if h}) for t in part.column(1).to_pylist()]
                owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), pa.array([h for f in found for h in f], pa.binary())], names=["id", "line"]
                )

    return run


def _tables(rows: pa.Table) -> pa.Table:
    keys = _keys(b"".join(rows.column("line").to_pylist()))
    levels = build(keys)
    place = index(levels, keys)
    ordered = np.argsort(place)  # the lines by their number
    arrays = {
        "prints": keys[ordered].tobytes(),
        "counts": rows.column("n").to_numpy()[ordered].tobytes(),
        "keepers": rows.column("keeper").to_numpy()[ordered].tobytes(),
    }
    return pa.table({
        "shard": rows.column("shard").slice(0, 1),
        "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int32())),
        "bits": pa.array([[np.packbits(x).tobytes() for x in levels]], pa.list_(pa.binary())),
        **{name: pa.array([value], pa.binary()) for name, value in arrays.items()},
    })


_TABLE = "shard int, sizes array<int>, bits array<binary>, prints binary, counts binary, keepers binary"


def shard_tables(lines: DataFrame, n_lines: int) -> DataFrame:
    """One row of arrays per shard of ``(line, n, keeper)``."""
    shards = n_lines // SHARD_LINES + 1
    dealt = lines.withColumn("shard", F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(_tables, _TABLE)


def _requests(min_chars: int):
    """Distinct long lines of a block, as one blob for each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, set] = {}
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(block, set()).update(h for h in line_hashes(text, min_chars) if h)
            blocks = [b for b, lines in found.items() for _ in lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array([h for lines in found.values() for h in lines], pa.binary())], names=["block", "line"]
            )

    return run


def _probe(min_docs: int):
    def run(asked: pa.Table, tables: pa.Table) -> pa.Table:
        blocks, lines, keepers = [], [], []
        if asked.num_rows and tables.num_rows:
            row = tables.slice(0, 1).to_pylist()[0]
            levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in zip(row["sizes"], row["bits"])]
            prints, counts = _keys(row["prints"]), np.frombuffer(row["counts"], np.int64)
            keeper = np.frombuffer(row["keepers"], np.int64)
            names = asked.column("line").to_pylist()
            keys = _keys(b"".join(names))
            at = index(levels, keys)
            known = (at >= 0) & (prints[at] == keys).all(1) & (counts[at] >= min_docs)
            hits = np.flatnonzero(known)
            blocks = asked.column("block").to_numpy()[hits].tolist()
            lines, keepers = [names[i] for i in hits], keeper[at[hits]].tolist()
        return pa.table({"block": pa.array(blocks, pa.int32()), "line": pa.array(lines, pa.binary()), "keeper": pa.array(keepers, pa.int64())})

    return run


def _rebuild(min_chars: int, text: str, names: list[str]):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        keeper = dict(zip(known.column("line").to_pylist(), known.column("keeper").to_pylist()))
        texts, n_lines, n_dropped = [], [], []
        for doc, value in zip(docs.column("_number").to_pylist(), docs.column(text).to_pylist()):
            lines = (value or "").split("\n")
            n_lines.append(len(lines))
            stay = lines
            if keeper:
                marks = line_hashes(value, min_chars)
                stay = [x for x, h in zip(lines, marks) if h is None or keeper.get(h, doc) == doc]
            n_dropped.append(len(lines) - len(stay))
            texts.append("\n".join(stay) if n_dropped[-1] else value)
        columns = {n: docs.column(n) for n in names} | {text: pa.array(texts, pa.string())}
        columns |= {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
        return pa.table(columns)

    return run


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The documents with lines that many of them hold left in one only.

    A line's key is the line without ASCII white space at its ends, A to Z in lower case. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents lose all their lines, except in the document
    with the largest id that holds the key; there all stay. All columns of ``docs`` are returned, the text
    changed, with ``n_lines`` (before) and ``n_dropped`` (columns of these names are replaced). A null or
    empty text is one empty line and comes back as it was. Ids must be whole numbers; a null id is smaller
    than all others. Each row is a document; rows that repeat an id keep a line together. A document that
    loses all lines has an empty text. An empty table gives an empty result.
    """
    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    plain = docs.select(number.alias("id"), F.col(text_col).alias("text"))
    counted = plain.mapInArrow(_distinct_lines(min_chars), "id long, line binary").groupBy("line").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")
    )
    repeated = stored(counted.where(F.col("n") >= min_docs), "repeated-lines")
    n_lines = repeated.count()
    shards = n_lines // SHARD_LINES + 1
    tables = stored(shard_tables(repeated, n_lines), "line-tables")

    blocks = block_count(docs, text_col)
    block = F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int")
    shard = F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int")
    parts = blocks // _BLOCKS_A_TASK + 1  # of each shard's requests, so a shard's task reads a bounded number of blocks
    asked = (
        docs.select(block.alias("block"), F.col(text_col).alias("text"))
        .mapInArrow(_requests(min_chars), "block int, line binary")
        .select(shard.alias("shard"), F.pmod("block", F.lit(parts)).alias("part"), "block", "line")
    )
    spread = tables.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    known = (
        asked.groupBy("shard", "part").cogroup(spread.groupBy("shard", "part"))
        .applyInArrow(_probe(min_docs), "block int, line binary, keeper long")
    )
    known = stored(known.distinct(), "known-lines")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    result = (
        docs.withColumn("_number", number).withColumn("_block", block).groupBy("_block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(_rebuild(min_chars, text_col, names), f"{schema}, n_lines long, n_dropped long")
    )
    return result
