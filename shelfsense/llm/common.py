"""What the operators share: words, shingles, sets, text blocks and connected components.

Identifiers of rows are compared as they are; a null identifier is the smallest. Texts are whole: no
operator reads a prefix.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.operators.spread import HOT_ROWS, spread_join
from shelfsense.sources.session import stored

# The constants of a public 64-bit finaliser and of a multiplicative rolling hash.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


# --- words and shingles, inside tasks -------------------------------------------------------------------

def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A to Z in lower case; bytes methods do exactly these two things."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * _MIX_A
    values = (values ^ (values >> np.uint64(29))) * _MIX_B
    return values ^ (values >> np.uint64(32))


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash for each run of ``size`` words, in order; fewer words are one run, none give none."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    return run_hashes([words[i : n - width + 1 + i] for i in range(width)])


def run_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """A hash for each row of adjoining words, given as columns of word hashes."""
    with np.errstate(over="ignore"):
        run = np.full(len(columns[0]), np.uint64(len(columns)))
        for words in columns:
            run = run * _STEP + words
        return mixed(run)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingles(hashes(words_of(text)), size))


# --- blocks of whole texts --------------------------------------------------------------------------------

def block_count(docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``block_bytes`` the texts fill; one pass, one number to the driver."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return int(total // block_bytes) + 1


# --- connected components ------------------------------------------------------------------------------------

def _with_minimum(edges: DataFrame, by: str, other: str, n: int) -> DataFrame:
    """Add ``m``, the smallest ``other`` of each ``by``; hubs are dealt out to several tasks."""
    least = edges.groupBy(by).agg(F.min(other).alias("m"))
    return edges.join(least, by) if n <= HOT_ROWS else spread_join(edges, stored(least, "least"), [by])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges: ``(node, root)`` for each node that is not its own root.

    Alternates large-star and small-star steps, so that no task ever holds a component. Every step is
    written to the shared folder. Loops, repeated edges and an empty table are fine; edges with a null
    end are ignored. The root is the smallest node.
    """
    ordered = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    current = stored(ordered.distinct(), "edges")
    sign = _signature(current)
    while sign[0]:
        both = current.union(current.select("v", "u"))
        large = _with_minimum(both, "u", "v", 2 * sign[0]).where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")
        )
        large = stored(large.distinct(), "large-star")
        small = _with_minimum(large, "u", "v", 2 * sign[0])
        small = small.select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")
        ).select("e.u", "e.v").where("u <> v")
        current = stored(small.distinct(), "small-star")
        before, sign = sign, _signature(current)
        if sign == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
