"""Links among sets that share buckets but are in different components, found block by block.

What is left after the hub rounds are groups whose members resemble each other without being similar enough. Every pair of
components there must be refuted, so pairs are neither written out nor given to a join. Members are laid into blocks of
bounded size instead, each member into one: first by a home, the most frequent bucket near it, then by component, large
components and large homes cut by a hash. Two blocks meet once, if a bucket holds members of both and not all of these are
one component; a task then counts the common items of all their members at once and puts out links only.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.llm.common import dropped, stored, workers_find_package
from casegauge.operators.spread import split_join, with_totals

BLOCK = 1 << 16  # items of a block, on the average at most; a longer set is a block of its own
CELLS = 1 << 19  # counts that a task holds at once: blocks of short sets have tens of thousands of members

TASKS = 1 << 12  # meetings are tiled if there are several times as many
TILE = 16  # blocks that move together, on the average at most
MOVED = 1 << 27  # items that are moved at once, or twice those of all blocks if that is more


def _placed(rest: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """`node`, `root`, `block` of every node. Blocks are made from totals alone: no bucket or component is gathered."""
    popular = with_totals(rest.select("bucket", "node", "root"), ["bucket"], held=F.count(F.lit(1)))
    nodes = popular.groupBy("node", "root").agg(F.max(F.struct("held", "bucket")).alias("best"))
    # Once along the buckets: members of a group whose own favourite is another bucket come home to the group's largest.
    around = split_join(rest.select("bucket", "node"), nodes.select("node", "best"), ["node"]).groupBy("bucket").agg(F.max("best").alias("best"))
    nodes = split_join(rest.select("bucket", "node", "root"), around, ["bucket"]).groupBy("node", "root").agg(F.max("best").getField("bucket").alias("home"))
    nodes = split_join(nodes, sizes, ["node"])
    own = with_totals(nodes, ["home", "root"], items=F.sum("n"))
    large = F.col("items") > block
    own = with_totals(own, ["home"], rest_items=F.sum(F.when(~large, F.col("n")).otherwise(F.lit(0))))
    cut = lambda key, total: F.pmod(F.xxhash64(key, F.lit(3)), F.ceil(total / F.lit(block)))
    part = F.when(F.col("n") > block, F.xxhash64("home", F.lit("long"), "node")).when(
        large, F.xxhash64("home", "root", cut("node", F.col("items")))).otherwise(
        F.xxhash64("home", F.lit("small"), cut("root", F.col("rest_items"))))
    return own.select("node", "root", part.alias("block"))


def _meetings(rest: DataFrame, placed: DataFrame) -> DataFrame:
    """Pairs of blocks `p` <= `q` that have to be compared."""
    at = split_join(rest.select("bucket", "node"), placed, ["node"])
    held = at.groupBy("bucket", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    side = lambda x: held.select("bucket", F.col("block").alias(x), F.col("low").alias(f"low_{x}"), F.col("high").alias(f"high_{x}"))
    several = (F.col("low_p") != F.col("high_p")) | (F.col("low_q") != F.col("high_q")) | (F.col("low_p") != F.col("low_q"))
    both = side("p").join(side("q"), "bucket").where((F.col("p") <= F.col("q")) & several)
    return both.select("p", "q").distinct()


def common_parts(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """How many items each left set shares with each right one, for some left sets at a time: the first of them, and their counts.
    Sets are sorted and free of repeats."""
    sizes = np.array([len(s) for s in right], np.int64)
    owner = np.repeat(np.arange(len(right)), sizes)
    items = np.concatenate([np.zeros(0, np.int64), *right])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    step = max(1, CELLS // max(1, len(right)))
    for first in range(0, len(left), step):
        some = left[first:first + step]
        out = np.zeros((len(some), len(right)), np.int64)
        for i, s in enumerate(some):
            low, high = np.searchsorted(items, s, "left"), np.searchsorted(items, s, "right")
            n = high - low
            low, n = low[n > 0], n[n > 0]
            if len(n):
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                out[i] = np.bincount(owner[at], minlength=len(right))
        yield first, out


def common_items(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> np.ndarray:
    """How many items each left set shares with each right one; sets are sorted and free of repeats."""
    return np.concatenate([np.zeros((0, len(right)), np.int64), *[out for _, out in common_parts(left, right)]])


def _tiled(meetings: DataFrame, tile: int) -> DataFrame:
    """The blocks that each meeting of two tiles `p`, `q` needs, with the blocks that each is compared with there. Blocks whose
    meetings begin with the same block, as all of a group do, are dealt into tiles of so many on the average."""
    both = meetings.select("p", "q").union(meetings.select(F.col("q").alias("p"), F.col("p").alias("q")))
    anchors = both.groupBy("p").agg(F.min("q").alias("anchor"))
    part = F.pmod(F.xxhash64("p", F.lit(5)), F.ceil(F.col("held") / F.lit(tile)))
    tiles = with_totals(anchors, ["anchor"], held=F.count(F.lit(1))).select("p", F.xxhash64("anchor", part).alias("tile"))
    of = lambda x: tiles.select(F.col("p").alias(x), F.col("tile").alias(f"tile_{x}"))
    met = split_join(split_join(meetings, of("p"), ["p"]), of("q"), ["q"])
    turned = F.col("tile_p") > F.col("tile_q")
    one, other = F.when(turned, F.col("q")).otherwise(F.col("p")), F.when(turned, F.col("p")).otherwise(F.col("q"))
    sides = F.array(F.struct(one.alias("block"), other.alias("other")), F.struct(other.alias("block"), F.lit(None).cast("long").alias("other")))
    rows = met.select(F.least("tile_p", "tile_q").alias("p"), F.greatest("tile_p", "tile_q").alias("q"), F.explode(sides).alias("side"))
    return rows.groupBy("p", "q", F.col("side.block").alias("block")).agg(F.collect_set("side.other").alias("others"))


def _compared(percent: int, items: Callable | None, linked: Callable | None) -> Callable[[pa.Table], pa.Table]:
    """The links between the members of two blocks (or within one), or of the blocks of two tiles that are compared with `others`."""
    def opened(held: pa.Array) -> tuple[np.ndarray, np.ndarray, list, list[np.ndarray], np.ndarray]:
        d = held.field("d")
        if items is not None:
            own = d.to_pylist()
            sets = [items(x) for x in own]
        else:
            offsets, flat = d.offsets.to_numpy(), d.values.to_numpy(zero_copy_only=False)
            own = sets = [np.sort(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        return held.field("node").to_numpy(), held.field("root").to_numpy(), own, sets, np.array([len(s) for s in sets], np.int64)

    def run(rows: pa.Table) -> pa.Table:
        name, members, ready = rows.column("block").to_pylist(), rows.column("members"), {}
        at = {x: k for k, x in enumerate(name)}
        met = [(rows.column("p")[0].as_py(), rows.column("q")[0].as_py())]
        if "others" in rows.column_names:
            met = [(x, y) for x, ys in zip(name, rows.column("others").to_pylist()) for y in ys]
        found, above = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], {}

        def block(x: int) -> tuple[np.ndarray, np.ndarray, list, list[np.ndarray], np.ndarray]:
            if x not in ready:
                ready[x] = opened(members.slice(at[x], 1).combine_chunks().flatten())
            return ready[x]

        for first, second in met:
            (a, root_a, own_a, left, size_a), (b, root_b, own_b, right, size_b) = block(first), block(second)
            for low, both in common_parts(left, right):
                here = slice(low, low + len(both))
                similar = 100 * both >= percent * (size_a[here, None] + size_b[None, :] - both)
                i, j = np.nonzero(similar & (root_a[here, None] != root_b[None, :]))
                if linked is not None:
                    i, j = (i[i + low < j], j[i + low < j]) if first == second else (i, j)
                    lacking = np.maximum(size_a[i + low], size_b[j]) - both[i, j]
                    some = linked(own_a, own_b, i + low, j, lacking, root_a, root_b, above)
                    i, j = i[some], j[some]
                found.append((a[i + low], b[j]))
        one, other = (np.concatenate(side) for side in zip(*found))
        return pa.table({"a": pa.array(np.maximum(one, other)), "b": pa.array(np.minimum(one, other))})

    return run


def block_links(rest: DataFrame, sets: DataFrame, percent: int, block: int | None = None, size: Column | None = None, items: Callable | None = None,
                linked: Callable | None = None) -> DataFrame:
    """The links `a` > `b` between nodes of different components that share a bucket.

    `rest` has `bucket`, `node`, `root`, `sets` has `node` and `d`, its distinct items, or what `items` makes them from (`size`
    is then their number at most, so that items need not be moved). `linked` says which of the pairs with `percent` of their items
    in common are links; it may leave out pairs that others connect, and is called for some members of a block at a time, with
    a dict for what it knows of the blocks of a tile. Two nodes of blocks that meet are
    compared whether they share a bucket or not: a link more is a link. A block is one row, whose size is bounded by `block`
    items or one set; a task holds two tiles of at most `TILE` blocks on the average, and counts for `CELLS` pairs or one member."""
    workers_find_package(rest.sparkSession)
    rest = rest.select("bucket", "node", "root")
    sizes = sets.select("node", (F.size("d") if size is None else size).cast("long").alias("n"))
    placed = stored(_placed(rest, sizes, block or BLOCK), "blocks")
    meetings = stored(_meetings(rest, placed), "meetings")
    tile = max(1, min(TILE, math.isqrt(meetings.count() // TASKS)))
    if tile == 1:
        needed = meetings.select("p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    else:
        needed = stored(_tiled(meetings, tile), "tiles")
    weights = stored(split_join(placed, sizes, ["node"]).groupBy("block").agg(F.sum("n").alias("n")), "weights")
    moved = split_join(needed.select("block"), weights, ["block"]).agg(F.sum("n")).first()[0] or 0
    turns = max(1, -(-moved // max(MOVED, 2 * (weights.agg(F.sum("n")).first()[0] or 0))))
    full = split_join(placed, sets, ["node"]).groupBy("block").agg(F.collect_list(F.struct("node", "root", "d")).alias("members"))
    full = full if turns == 1 else stored(full, "members")
    compared = lambda some: split_join(some, full, ["block"]).groupBy("p", "q").applyInArrow(_compared(percent, items, linked), "a long, b long")
    if turns == 1:
        return compared(needed).distinct()
    turn = F.pmod(F.xxhash64("p", "q", F.lit(7)), F.lit(turns))
    found = [stored(compared(needed.where(turn == k)), "links") for k in range(turns)]
    dropped(full)
    return functools.reduce(DataFrame.union, found).distinct()
