"""Fill gaps of a column from the nearest rows by several attributes of mixed kinds.

Rows are never paired with all others. Rows alike in every attribute become one profile with a count, and two profiles
meet only on a shared value that is among the rarest of both: profiles that agree on ``t`` of their ``c`` values agree
on one of the ``c - t + 1`` rarest (in any fixed order of values), so no neighbour is missed and the commonest
values, which would bring most rows together, join nothing. A profile with ``k`` rows like it in all values meets no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.operators.spread import spread_join
from shelfsense.sources.session import stored

FAR = 10  # the distance of a differing value, and the most that a step of a number counts


def _profiles(df: DataFrame, same: Sequence[str], steps: Mapping[str, float]) -> DataFrame:
    """Add ``_same`` (texts of the values) and ``_steps`` (whole steps of the numbers)."""
    values = F.array(*[F.col(c).cast("string") for c in same])
    numbers = [F.floor(F.nanvl(F.col(c).cast("double"), F.lit(None)) / float(w)).cast("long") for c, w in steps.items()]
    return df.withColumns({"_same": values, "_steps": F.array(*numbers).cast("array<long>")})


def _tokens(same: Column) -> Column:
    """Each value that is there, with the number of its attribute."""
    cells = F.transform(same, lambda value, i: F.struct(i.alias("attribute"), value.alias("value")))
    return F.filter(cells, lambda x: x.value.isNotNull())


def _rarest(profiles: DataFrame, frequency: DataFrame, least_shared: int, key: Sequence[str]) -> DataFrame:
    """``(*key, token, rarest)``: one row for each value that the profile may meet others on.

    ``rarest`` holds all of these in order, so that a pair can tell on which of them it meets first.
    """
    each = profiles.select(*key, F.explode(_tokens(F.col("_same"))).alias("token"))
    counted = spread_join(each, frequency, ["token"], "left")
    ordered = counted.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("all")
    )
    enough = F.greatest(F.size("all") - (least_shared - 1), F.lit(0))
    return ordered.select(*key, F.slice("all", 1, enough)["token"].alias("rarest")).select(
        *key, "rarest", F.explode("rarest").alias("token")
    )


def neighbour_votes(
    df: DataFrame, column: str, same: Sequence[str], steps: Mapping[str, float] | None = None, k: int = 5, least_shared: int = 2
) -> DataFrame:
    """``(_same, _steps, value, n_votes, distance)``: what the neighbours of each incomplete profile say.

    One row per profile of rows without ``column``: the value with most votes, how many rows voted for it, and
    the distance of the farthest voter. Profiles without a neighbour are left out.
    """
    steps = steps or {}
    if not 1 <= least_shared <= len(same):
        raise ValueError("least_shared lies between 1 and the number of attributes in same")
    rows = _profiles(df.select(F.col(column).alias("value"), *same, *[c for c in steps if c not in same]), same, steps)
    key = ["_same", "_steps"]
    known = stored(rows.where("value IS NOT NULL").groupBy(*key, "value").agg(F.count(F.lit(1)).alias("n")), "known")
    asking = stored(rows.where("value IS NULL").select(*key).distinct(), "asking")
    frequency = stored(
        known.groupBy("_same").agg(F.sum("n").alias("n"))
        .select(F.explode(_tokens(F.col("_same"))).alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n")),
        "frequency",
    )
    apart = sum((_step_between(i) for i in range(len(steps))), F.lit(0).cast("long"))
    voters = known.withColumnsRenamed({"_same": "_met", "_steps": "_met_steps"})
    # Rows alike in all values are nearer than FAR or tie with others; with k of them below FAR, no other row votes.
    whole = asking.where(~F.exists("_same", lambda value: value.isNull())).withColumnRenamed("_same", "_asked")
    near = stored(
        whole.join(voters, whole["_asked"] == voters["_met"]).withColumn("distance", apart).where(F.col("distance") < FAR)
        .groupBy("_asked", "_steps", "distance", "value").agg(F.sum("n").alias("n")),
        "near",
    )
    settled = near.groupBy("_asked", "_steps").agg(F.sum("n").alias("n")).where(F.col("n") >= k).select("_asked", "_steps")
    asked = stored(asking.withColumnRenamed("_same", "_asked").join(settled, ["_asked", "_steps"], "left_anti"), "asked")
    # Profiles meet by their values alone; steps and counts come in when it is known which values met.
    right = _rarest(known.select("_same").distinct(), frequency, least_shared, ["_same"])
    left = _rarest(asked.select(F.col("_asked").alias("_same")).distinct(), frequency, least_shared, ["_same"])
    met = left.withColumnsRenamed({"_same": "_asked", "rarest": "_asked_rarest"}).join(
        right.withColumnsRenamed({"_same": "_met", "rarest": "_met_rarest"}), "token"
    )
    first = F.filter("_asked_rarest", lambda x: F.array_contains("_met_rarest", x))[0]
    pairs = met.where(first == F.col("token")).select(
        "_asked", "_met",
        F.size(F.filter(F.zip_with("_asked", "_met", lambda a, b: a == b), lambda x: x)).alias("shared"),
    ).where(F.col("shared") >= least_shared)
    pairs = stored(pairs, "pairs")
    votes = (
        pairs.join(asked, "_asked").join(voters, "_met")
        .withColumn("distance", apart + FAR * (len(same) - F.col("shared")))
        .groupBy("_asked", "_steps", "distance", "value").agg(F.sum("n").alias("n"))
    )
    votes = votes.unionByName(near.join(settled, ["_asked", "_steps"], "left_semi"))
    return _winners(votes, k).withColumnRenamed("_asked", "_same")


def _step_between(i: int) -> Column:
    """Steps between two numbers, ``FAR`` at most and where one is missing."""
    a, b = F.get("_steps", F.lit(i)), F.get("_met_steps", F.lit(i))
    return F.coalesce(F.least(F.abs(a - b), F.when((a - b).isNotNull(), F.lit(FAR))), F.lit(FAR)).cast("long")


def _winners(votes: DataFrame, k: int) -> DataFrame:
    """Most votes among the rows as near as the k-th; of equal values the smaller."""
    key = ["_asked", "_steps"]
    rings = votes.groupBy(*key, "distance").agg(F.sum("n").alias("n"))
    nearer = F.sum("n").over(Window.partitionBy(*key).orderBy("distance")) - F.col("n")
    reach = rings.withColumn("_nearer", nearer).where(F.col("_nearer") < k).groupBy(*key).agg(F.max("distance").alias("_reach"))
    counted = votes.join(reach, key).where("distance <= _reach").groupBy(*key, "value").agg(
        F.sum("n").alias("n_votes"), F.max("distance").alias("distance")
    )
    best = Window.partitionBy(*key).orderBy(F.desc("n_votes"), "value")
    return counted.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")


def impute_by_neighbours(
    df: DataFrame, column: str, same: Sequence[str], steps: Mapping[str, float] | None = None, k: int = 5, least_shared: int = 2
) -> DataFrame:
    """Fill nulls of ``column`` with the usual value among the nearest rows that have one.

    ``same`` names attributes compared for equality, ``steps`` numbers and the width of a step. Only rows that agree
    on ``least_shared`` of ``same`` are neighbours. The distance is ``FAR`` for each attribute of ``same`` that
    differs or is missing on a side, plus the number of steps between the numbers, at most ``FAR`` each and ``FAR``
    where one is missing. All rows as near as the k-th nearest vote; of values with equal votes the smaller
    wins. Rows without a neighbour keep their null; all other columns and rows stay as they are.

    Rows alike in all attributes are one profile with a count, so a product that makes up a third of the table
    is one row of the join.
    """
    steps = steps or {}
    won = neighbour_votes(df, column, same, steps, k, least_shared).select("_same", "_steps", F.col("value").alias("_won"))
    rows = _profiles(df, same, steps)
    complete, gaps = rows.where(F.col(column).isNotNull()), rows.where(F.col(column).isNull())
    filled = spread_join(gaps, won, ["_same", "_steps"], "left").withColumn(column, F.col("_won").cast(df.schema[column].dataType))
    return complete.select(*df.columns).unionByName(filled.select(*df.columns))
