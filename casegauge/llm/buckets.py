"""Links among the members of shared buckets, without pairing the members of a bucket with each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.llm.common import dropped, passing, stored
from casegauge.llm.components import components
from casegauge.operators.spread import split_join

ROUNDS = 5
FIELD = 1 << 24  # bits, a power of two: 2 MB


def shared_buckets(placed: DataFrame) -> DataFrame:
    """The rows `bucket`, `node` of buckets with more than one node."""
    shared = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    return stored(split_join(placed, shared.select("bucket", F.lit(True).alias("kept")), ["bucket"]).drop("kept"), "buckets")


def content_field(wanted: DataFrame) -> bytes:
    """A bit for every value of `content` (modulo FIELD): FIELD / 8 bytes, however many there are. `in_field` tells values
    that may be among them from others that are not."""
    at = F.col("content").bitwiseAND(F.lit(FIELD - 1))
    rows = wanted.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63L as int))")).alias("bits"))
    out = np.zeros(FIELD // 64, np.int64)
    table = rows.toArrow()  # at most FIELD / 64 rows
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out.tobytes()


def in_field(field: bytes, content: np.ndarray) -> np.ndarray:
    """Which of the 64-bit numbers have their bit in the field."""
    at = content.view(np.uint64) & np.uint64(FIELD - 1)
    return (np.frombuffer(field, np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _held(field) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            bucket = keys.flatten().to_numpy(zero_copy_only=False)
            node = np.repeat(batch.column("node").to_numpy(), np.diff(keys.offsets.to_numpy()))
            at = np.flatnonzero(in_field(field.value, bucket))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(node[at])], ["bucket", "node"])
    return run


def shared_keys(nodes: DataFrame) -> DataFrame:
    """The rows `bucket`, `node` of keys that more than one node has, from rows `node`, `keys`. The keys of a node differ.

    Keys are counted first, and the shuffle files of that are given back. Then a bit field of bounded size, broadcast, tells most
    of the keys that only one node has from the others where these lie, so that they are not shuffled once more."""
    held = nodes.select(F.explode("keys").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("held"))
    shared = stored(held.where("held > 1").select("bucket"), "shared")
    field = nodes.sparkSession.sparkContext.broadcast(content_field(shared.select(F.col("bucket").alias("content"))))
    placed = nodes.mapInArrow(_held(field), "bucket long, node long")
    out = stored(split_join(placed, shared.select("bucket", F.lit(True).alias("kept")), ["bucket"]).drop("kept"), "buckets")
    dropped(shared)
    return out


def open_members(members: DataFrame, roots: DataFrame | None, turn: int) -> DataFrame:
    """The rows of buckets that hold several components, with the bucket's hub of this turn and its component. Hubs
    are drawn by a hash of node and turn, so the buckets of a group mostly share theirs."""
    if roots is None:
        known = members.select("bucket", "node", F.col("node").alias("root"))
    else:
        known = split_join(members.select("bucket", "node"), roots, ["node"], "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    draw = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "root"))
    several = known.groupBy("bucket").agg(draw.alias("hub"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    picked = several.select("bucket", F.col("hub.node").alias("hub"), F.col("hub.root").alias("hub_root"))
    return stored(split_join(known, picked, ["bucket"]), "open")


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links."""
    with passing(links.sparkSession) as keep:
        if roots is None:
            return keep(stored(components(links), "roots"))
        name = lambda one: roots.select(F.col("node").alias(one), F.col("root").alias("root_" + one))
        bridges = split_join(split_join(links, name("a"), ["a"], "left"), name("b"), ["b"], "left").select(
            F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        upper = stored(components(bridges).select(F.col("node").alias("root"), F.col("root").alias("top")), "upper")
        old = split_join(roots, upper, ["root"], "left").select("node", F.coalesce("top", "root").alias("root"))
        new = upper.select(F.col("root").alias("node"), F.col("top").alias("root")).join(roots.select("node"), "node", "left_anti")
        return keep(stored(old.union(new), "roots"))


def hub_rounds(members: DataFrame, traits: DataFrame, alike: Callable[[Column, Column], Column], confirmed: Callable[[DataFrame], DataFrame],
               rounds: int) -> tuple[DataFrame, DataFrame]:
    """The members of buckets that still hold several components after the rounds, with `root`, and all components found.

    In each round, members of buckets that hold several components are compared with their bucket's hub, unless they are
    in its component already; rounds end when one finds no link. So a bucket of copies costs one comparison each. Tables
    of a round are deleted as soon as the next ones are made from them."""
    side = lambda name, t: traits.select(F.col("node").alias(name), F.col("t").alias(t))
    roots = None
    given = members
    for turn in range(rounds):
        before, members = members, open_members(members, roots, turn)
        if before is not given:
            dropped(before)
        stars = members.where("root <> hub_root").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        tried = split_join(split_join(stars, side("a", "l"), ["a"]), side("b", "r"), ["b"]).where(alike(F.col("l"), F.col("r"))).select("a", "b")
        pairs = stored(tried, "pairs")
        links = stored(confirmed(pairs), "links")
        dropped(pairs)
        found = links.limit(1).count()
        if found or roots is None:
            old, roots = roots, merged(roots, links)
            if old is not None:
                dropped(old)
        dropped(links)
        if not found:
            break
    rest = open_members(members, roots, rounds)
    if members is not given:
        dropped(members)
    return rest, roots


def linked(members: DataFrame, traits: DataFrame, alike: Callable[[Column, Column], Column], confirmed: Callable[[DataFrame], DataFrame],
           rounds: int = ROUNDS) -> DataFrame:
    """`node`, `root` of every node that has a confirmed link to another.

    After the hub rounds, in buckets that still hold several components, the members of different ones are compared with
    each other. No link is lost: two members that are never compared are in one component. `traits` has `node` and a struct
    `t`; `alike` says from two such structs whether a comparison is worth while (for pairs it runs inside the join);
    `confirmed` returns those of the pairs `a`, `b` that are links."""
    rest, roots = hub_rounds(members, traits, alike, confirmed, rounds)
    rest = stored(rest.join(traits, "node").select("bucket", "node", "root", "t"), "rest")
    names = lambda x: {"node": x, "root": f"root_{x}", "t": f"t_{x}"}
    left, right = rest.withColumnsRenamed(names("a")), rest.withColumnsRenamed(names("b"))
    same = ((left.bucket == right.bucket) & (F.col("a") > F.col("b")) & (F.col("root_a") != F.col("root_b"))
            & alike(F.col("t_a"), F.col("t_b")))
    links = confirmed(stored(left.join(right, same).select("a", "b").distinct(), "pairs"))
    return merged(roots, stored(links, "links"))
