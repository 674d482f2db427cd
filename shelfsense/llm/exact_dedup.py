"""Exact duplicates with the frequent texts taken out before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.sources.session import cut_lineage, stored

# A digest with more than this share of the rows is frequent; so there are at most 1 / SUPPORT of them.
SUPPORT = 1e-3


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """Decide for every row which row of its group of equal texts stays.

    Returns one row per input row: the id, ``keep_id, group_size, kept, text_sha256``. The row with the
    most code points in the original text stays, then the one with the smallest id; a null id comes after
    all others. Of rows that agree in text and id one stays, the earliest as read. Null texts equal the
    empty text. An empty table gives an empty result; other columns are not read.

    Every pass but the first reads only digests. Misra-Gries counters (``freqItems``, one bounded counter
    table per task, merged) name every digest above ``support``; these are counted exactly, and the rows
    that stay, at most ``1 / support``, go to all tasks. Rows of frequent digests are then decided where
    they are read, and only the rest is shuffled, in groups below ``support`` of the rows.
    """
    text = F.col(text_col)
    rank = F.struct(
        (-F.char_length(F.coalesce(text, F.lit("")))).alias("shorter"),
        F.col(id_col).isNull().alias("no_id"),
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = stored(
        docs.select(rank.alias("rank"), F.sha2(normalised(text), 256).alias("digest"))
        .withColumn("short_digest", F.xxhash64("digest")),
        "digests",
    )
    counted = keyed.agg(F.count(F.lit(1))).first()[0]
    named = keyed.stat.freqItems(["short_digest"], support).select(
        F.explode("short_digest_freqItems").alias("short_digest")
    )
    winners = cut_lineage(
        keyed.join(F.broadcast(named), "short_digest", "left_semi")  # at most 1 / support names
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min("rank").alias("best"))
        .where(F.col("group_size") > support * counted)
    )
    frequent = keyed.join(F.broadcast(winners), "digest")  # fewer than 1 / support rows
    group = Window.partitionBy("digest")
    others = (
        keyed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("group_size", F.count(F.lit(1)).over(group))
        .withColumn("best", F.min("rank").over(group))
    )
    columns = ["rank", "best", "group_size", "digest"]
    return frequent.select(columns).union(others.select(columns)).select(
        F.col("rank.id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("rank.row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
