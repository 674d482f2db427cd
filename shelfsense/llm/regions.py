"""Exact links inside regions of a Jaccard space: pivots, Voronoi cells, windows, recursion.

Input rows are ``(region, node, bag)``: a bag holds the sorted distinct 64-bit hashes of a set. The result
joins any two nodes of a region whose sets are similar enough, through a chain of such links; it is a forest
per task and not every link, so a group of n near copies gives about n rows.

A region of more than a handful of sets is cut. A few of its sets become pivots, none linked to another; every
set measures its distance to each, in tasks that hold a part of the region and all its pivots. With links up to
distance e, a set within BALL of a pivot is a home row in the cell of its nearest pivot. Any partner of it lies,
by the triangle inequality, within BALL + e of that pivot and within 2e of the border,
``d(y, p_i) <= d(y, nearest) + 2e``; such rows are copied to the cell as window rows, which meet home rows only.
Sets beyond BALL of all pivots stay together and need no windows, as partners inside a ball find them there. A set
within e of a pivot is linked to it at once; sets linked to the same pivot need not meet each other, so they stay
home rows only where another pivot is near. Cells are cut again until the home rows fit; whatever the pivots
cannot part (many sets at about the same distance from each other) is compared in blocks, each block of home rows
with each block of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import hashes, mixed
from shelfsense.sources.session import cut_lineage, stored

# Work of one task, in hashes; a set counts ROW_WORK more than it has. Regions above PART_WORK are parted by pivots.
LEAF_WORK = 4_000_000
PART_WORK = 16_384
ROW_WORK = 512
PIVOTS = 8
LEVELS = 4
BALL = 0.5

_EDGES = "a binary, b binary"
_STEP = "region long, node binary, home boolean, bag binary, other binary"


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def forest(bags: list[np.ndarray], home: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links ``(i, j)`` that connect what is connected by pairs with at least one home end.

    Breadth-first from one pivot per component. Members look only at sets not reached yet, of fitting size,
    and inside the window that the distance to the component's pivot leaves.
    """
    n = len(bags)
    sizes = np.array([len(b) for b in bags], np.int64)
    flat = np.concatenate(bags) if n else np.empty(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    ranked = flat[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.empty(0, bool)
    listed = np.cumsum(new) - 1  # the posting list of each entry
    lists = np.empty(len(flat), np.int64)
    lists[order] = listed
    n_lists = int(listed[-1]) + 1 if len(listed) else 0
    length = np.bincount(listed, minlength=n_lists)
    start = np.cumsum(length) - length
    bound = np.r_[0, np.cumsum(sizes)]

    left = np.ones(n, bool)
    open_sets = indexed = n
    reach = (den - num) / den + 1e-9
    links: list[tuple[int, int]] = []
    for pivot in range(n):
        if not left[pivot]:
            continue
        left[pivot] = False
        open_sets -= 1
        queue, distance = [pivot], None
        while queue and open_sets:
            member = queue.pop()
            if open_sets < indexed // 2:  # forget sets that are placed
                stay = left[owner]
                owner, listed = owner[stay], listed[stay]
                length = np.bincount(listed, minlength=n_lists)
                start, indexed = np.cumsum(length) - length, open_sets
            size = sizes[member]
            fits = left & (den * sizes >= num * size) & (num * sizes <= den * size)
            if not home[member]:
                fits &= home
            if distance is not None:
                fits &= np.abs(distance - distance[member]) <= reach
            if not fits.any():
                continue
            own = lists[bound[member] : bound[member + 1]]
            shared = np.bincount(owner[_ranges(start[own], length[own])], minlength=n)
            union = sizes + size - shared
            if member == pivot:
                distance = 1 - shared / np.maximum(union, 1)
                distance[pivot] = 0
            found = np.flatnonzero(fits & (den * shared >= num * union))
            left[found] = False
            open_sets -= len(found)
            links += [(member, int(i)) for i in found]
            queue += found.tolist()
    return links


def _bags(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in column.to_pylist()]


def _leaf(num: int, den: int):
    def run(rows: pa.Table) -> pa.Table:
        part = rows.column("part").to_numpy()
        order = np.argsort(part, kind="stable")
        nodes, bags, home = rows.column("node").to_pylist(), _bags(rows.column("bag")), rows.column("home").to_pylist()
        a, b = [], []
        for group in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            once: dict[bytes, int] = {}
            at_home: list[bool] = []
            for i in group:
                k = once.setdefault(nodes[i], len(once))
                if k == len(at_home):
                    at_home.append(home[i])
                else:
                    at_home[k] |= home[i]
            if len(once) < 2 or not any(at_home):
                continue
            first = {nodes[i]: bags[i] for i in group}
            names = list(once)
            for i, j in forest([first[x] for x in names], np.array(at_home), num, den):
                a.append(names[i])
                b.append(names[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _shared_with(bags: list[np.ndarray], pivots: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(b) for b in bags], np.int64)
    flat = np.concatenate(bags)
    row = np.repeat(np.arange(len(bags)), sizes)
    return np.stack([np.bincount(row[np.isin(flat, p)], minlength=len(bags)) for p in pivots], 1)


def _cells(num: int, den: int):
    reach = (den - num) / den + 1e-9
    schema = pa.schema([
        ("region", pa.int64()), ("node", pa.binary()), ("home", pa.bool_()), ("bag", pa.binary()), ("other", pa.binary()),
    ])

    def run(rows: pa.Table, chosen: pa.Table) -> pa.Table:
        if rows.num_rows == 0:
            return schema.empty_table()
        region, nodes = rows.column("region")[0].as_py(), rows.column("node").to_pylist()
        blobs, home = rows.column("bag").to_pylist(), rows.column("home").to_pylist()
        pure = rows.column("pure")[0].as_py()
        named = dict(sorted(zip(chosen.column("node").to_pylist(), chosen.column("bag").to_pylist())))
        if not named:  # no pivot this time: the region stays as it is
            return pa.table([rows.column("region"), rows.column("node"), rows.column("home"), rows.column("bag"), pa.nulls(len(nodes), pa.binary())], schema=schema)
        names, pivots = list(named), [np.frombuffer(b, np.uint64) for b in named.values()]
        bags = [np.frombuffer(b, np.uint64) for b in blobs]
        sizes, pivot_sizes = np.array([len(b) for b in bags]), np.array([len(p) for p in pivots])
        shared = _shared_with(bags, pivots)
        union = sizes[:, None] + pivot_sizes - shared
        distance, linked = 1 - shared / np.maximum(union, 1), den * shared >= num * union

        between = _shared_with(pivots, pivots)
        near = den * between >= num * (pivot_sizes[:, None] + pivot_sizes - between)
        apart: list[int] = []
        for k in range(len(pivots)):
            if not near[k, apart].any():
                apart.append(k)
        names, distance, linked = [names[k] for k in apart], distance[:, apart], linked[:, apart]
        tag = mixed(hashes(names) ^ np.uint64(region & (2**64 - 1))).view(np.int64)

        nearest, least = distance.argmin(1), distance.min(1)
        inside = least <= BALL + 1e-9
        window = (distance <= least[:, None] + 2 * reach) & (distance <= BALL + reach)
        # rows linked to a pivot meet others only if a pivot they are not linked to is near
        stays = np.array(home) & ~(pure & linked.any(1) & ~(~linked & (distance <= 2 * reach)).any(1))
        out: list[tuple] = []
        for i, node in enumerate(nodes):
            for k in np.flatnonzero(linked[i]):
                if names[k] != node:
                    out.append((region, node, False, None, names[k]))
            if not inside[i]:
                out.append((region, node, home[i], blobs[i], None))
            for k in np.flatnonzero(window[i]):
                out.append((int(tag[k]), node, bool(stays[i] and inside[i] and k == nearest[i]), blobs[i], None))
        columns = zip(*out) if out else [[]] * 5
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _work():
    return F.octet_length("bag") / 8 + ROW_WORK


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("region").agg(
        F.sum(F.when(F.col("home"), _work()).otherwise(0.0)).alias("at_home"), F.sum(_work()).alias("work"),
        F.count_if("home").alias("homes"),
    )


def _split(rows: DataFrame, large: DataFrame, num: int, den: int, leaf_work: int, pivots: int, level: int) -> DataFrame:
    """One round of pivots for the large regions: links to pivots, and the rows of their cells."""
    blocks = F.ceil(F.col("work") / leaf_work).cast("int")
    sized = rows.join(large, "region").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    share = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1 << 30)) / (1 << 30)
    # about `pivots` per region, taken by hash, so no region is sorted; over four times as many is ever so unlikely
    chosen = sized.where(F.col("home") & (share < pivots / F.col("homes"))).select("region", "work", "node", "bag")
    chosen = chosen.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = sized.select("region", "block", "node", "home", "bag", (F.col("at_home") == F.col("work")).alias("pure"))
    return (
        dealt.groupBy("region", "block")
        .cogroup(chosen.select("region", "block", "node", "bag").toDF("region_p", "block_p", "node", "bag").groupBy("region_p", "block_p"))
        .applyInArrow(_cells(num, den), _STEP)
    )


def _compare(rows: DataFrame, num: int, den: int, leaf_work: int) -> DataFrame:
    """Links inside every region that is left, in blocks where it is large still."""
    sizes = stored(_sizes(rows), "region-sizes")
    total = sizes.agg(F.sum("work")).first()[0] or 0.0
    buckets = int(2 * total // leaf_work) + 1
    cut = sizes.where((F.col("homes") > 0) & (F.col("work") > leaf_work))
    half = leaf_work / 2
    whole = rows.join(cut.select("region"), "region", "left_anti").select(F.col("region").alias("part"), "node", "home", "bag")
    parts = [whole]
    if not cut.isEmpty():
        blocks = rows.join(cut.select("region", F.ceil(F.col("at_home") / half).cast("int").alias("nh"), F.ceil(F.col("work") / half).cast("int").alias("nw")), "region")
        spot = F.xxhash64("node")
        as_home = blocks.where("home").select(
            "region", "node", F.lit(True).alias("home"), "bag", F.pmod(spot, "nh").cast("int").alias("i"),
            F.explode(F.sequence(F.lit(0), F.col("nw") - 1)).alias("j"),
        )
        as_other = blocks.select(
            "region", "node", F.lit(False).alias("home"), "bag", F.explode(F.sequence(F.lit(0), F.col("nh") - 1)).alias("i"),
            F.pmod(spot, "nw").cast("int").alias("j"),
        )
        parts.append(as_home.union(as_other).select(F.xxhash64("region", "i", "j").alias("part"), "node", "home", "bag"))
    parted = reduce(DataFrame.union, parts).withColumn("bucket", F.pmod(F.xxhash64("part"), F.lit(buckets)).cast("int"))
    return parted.groupBy("bucket").applyInArrow(_leaf(num, den), _EDGES)


def links(
    rows: DataFrame, num: int = 75, den: int = 100, leaf_work: int = LEAF_WORK, pivots: int = PIVOTS, levels: int = LEVELS,
    part_work: int = PART_WORK,
) -> DataFrame:
    """``(a, b)``: links that connect all nodes of a region joined by sets with ``den * shared >= num * union``.

    ``rows`` must be a stored table. A node may be in several regions and may repeat in one. No row is
    dropped, however large a region is.
    """
    current = rows.select("region", "node", F.lit(True).alias("home"), "bag")
    found, part_work = [], min(part_work, leaf_work)
    before = None
    for level in range(levels):
        large = cut_lineage(_sizes(current).where((F.col("at_home") > part_work / 2) & (F.col("work") > part_work)))
        at_home = large.agg(F.sum("at_home")).first()[0] or 0.0
        if not at_home or (before is not None and at_home > 0.9 * before):
            break  # the pivots no longer part anything
        before = at_home
        step = stored(_split(current, large, num, den, leaf_work, pivots, level), "cells")
        found.append(step.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
        rest = current.join(large.select("region"), "region", "left_anti")
        current = rest.union(step.where("other IS NULL").drop("other"))
    found.append(_compare(current, num, den, leaf_work))
    return reduce(DataFrame.union, found)
