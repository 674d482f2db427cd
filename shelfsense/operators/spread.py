"""Joins of raw rows with one entry per key, when one key may hold a third of the rows.

Spark splits a hot key at run time only if both sides of the join arrive straight from a shuffle.
A side that was aggregated on the join key does not, so these joins deal out hot keys themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.sources.session import cut_lineage

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
NULL_PIECES = 1_000


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of more than ``hot_rows`` rows and the pieces to cut them into: ``(*keys, _pieces)``.

    A hot key also holds more than 1 in ``MAX_HOT_KEYS`` of all rows, so there are never more keys
    than that.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg(F.sum("_n") / MAX_HOT_KEYS).scalar()
    return (
        counts.withColumn("_limit", F.greatest(F.lit(float(hot_rows)), share))
        .where(F.col("_n") > F.col("_limit"))
        .select(*keys, F.ceil(F.col("_n") / F.col("_limit")).cast("int").alias("_pieces"))
    )


def spread_join(
    rows: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows.join(keyed, keys, how)`` with the rows of every hot key dealt to several tasks.

    Looking for hot keys is one pass over the key columns; without any, the join is a plain one.
    The entry of a hot key is repeated once per piece. The piece of a row follows from its values
    and its partition, so a task that is run again deals its rows the same way, and copies of one
    row are dealt out too.
    """
    found = cut_lineage(hot_keys(rows, keys, hot_rows))
    if found.isEmpty():
        return rows.join(keyed, list(keys), how)
    hot = F.broadcast(found)  # at most MAX_HOT_KEYS rows
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])  # matches nothing, so any piece will do
    spread = F.xxhash64(*rows.columns, F.spark_partition_id())
    dealt = rows.join(hot, list(keys), "left").withColumn(
        "_piece", F.pmod(spread, F.when(no_key, NULL_PIECES).otherwise(pieces)).cast("int")
    )
    repeated = keyed.join(hot, list(keys), "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), pieces - 1))
    )
    joined = dealt.drop("_pieces").join(repeated.drop("_pieces"), [*keys, "_piece"], how)
    return joined.drop("_piece")
