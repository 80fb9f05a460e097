"""Sets that differ in few items: how many others each one has, and what the differing items weigh.

Two sets are partners when they share an item and fewer than `limit` items belong to only one of them. Partners are
counted and weighed without writing a pair, in two disjoint cases by the sizes a and b of the sets (d = limit - 1):

* a + b <= d + 2. Sharing one item is enough, and a popular item makes partners of all small sets that hold it. They
  are counted by inclusion and exclusion over the subsets of a small set: the sets that meet A are those that hold some
  {x}, less those that hold some {x, y}, and so on. Both sets are small, so a set has a bounded number of subsets (98 for
  d = 9), and each subset's sets are counted once for all: the work grows with the sets, not with their pairs.
* a + b > d + 2. Partners share at least two items. Items are ordered from the rarest to the most frequent; of two sets
  that share at least o items, the first a - o + 1 and b - o + 1 have one in common (prefix filter). As o is at
  least 2, a set's most frequent item is never a join key. Sizes differ by d at most; a pair counts at its rarest
  common item only, and its two sums are added up in the task that finds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casegauge.operators.spread import split_join, with_totals
from casegauge.sources.tables import stored

LIMIT = 10
EXACT = "decimal(28,6)"  # weights are added as decimals: sums do not depend on the order of rows


def set_differences(members: DataFrame, key: str, item: str, weight: str, limit: int = LIMIT, partners: str = "partners",
                    differing: str = "differing") -> DataFrame:
    """One row per set with the number of its partners and the summed weight of the items in which they differ from it.

    `members` has the items of each set in long form; a repeated item counts once, with its largest weight (six decimals are
    kept; null weighs nothing). Rows without key or item are left out. An item's weight must be the same in every set. A set
    is held in one cell: items are entries of a dimension, such as regions. `limit` may be up to 16."""
    if not 1 <= limit <= 16:
        raise ValueError("limit must lie between 1 and 16")
    most = limit - 1
    sets = stored(_ordered_sets(members, key, item, weight), "sets")
    sums = _small_partners(sets, most).unionByName(_large_partners(sets, most)).groupBy("_set").agg(
        F.sum("_n").alias("_n"), F.sum("_w").alias("_w"))
    out = sets.join(sums, "_set", "left")
    return out.select(F.col("_set").alias(key), F.coalesce("_n", F.lit(0)).cast("long").alias(partners),
                      F.coalesce(F.col("_w").cast("double"), F.lit(0.0)).alias(differing))


def _ordered_sets(members: DataFrame, key: str, item: str, weight: str) -> DataFrame:
    """`_set`, `_items` (rarest first), `_weights` in the same order, `_size`, `_all` (weight of the set)."""
    rows = members.select(F.col(key).alias("_set"), F.col(item).alias("_item"), F.coalesce(F.col(weight).cast(EXACT), F.lit(0).cast(EXACT)).alias("_weight"))
    rows = rows.where(F.col("_set").isNotNull() & F.col("_item").isNotNull()).groupBy("_set", "_item").agg(F.max("_weight").alias("_weight"))
    seen = with_totals(rows, ["_item"], _sets=F.count(F.lit(1)))
    grouped = seen.groupBy("_set").agg(F.array_sort(F.collect_list(F.struct("_sets", "_item", "_weight"))).alias("_of"),
                                       F.sum("_weight").cast(EXACT).alias("_all"))
    return grouped.select("_set", F.col("_of._item").alias("_items"), F.col("_of._weight").alias("_weights"),
                          F.size("_of").alias("_size"), "_all")


def _sum(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0).cast(EXACT), lambda total, x: (total + x).cast(EXACT))


def _small_partners(sets: DataFrame, most: int) -> DataFrame:
    """Partners with which a set has at most `most` + 2 items together."""
    reach = F.lit(most + 2) - F.col("_size")  # the largest size of such a partner
    small = sets.where(F.col("_size") <= most + 1)
    masks = F.filter(F.sequence(F.lit(1), F.shiftleft(F.lit(1), most + 1) - 1),
                     lambda m: (m < F.expr("shiftleft(1, _size)")) & (F.bit_count(m) <= reach))
    subsets = small.select("_set", "_items", "_weights", "_size", "_all", F.explode(masks).alias("_mask"))
    chosen = lambda c: F.filter(c, lambda _, i: F.getbit(F.col("_mask"), i) == 1)
    subsets = subsets.select("_set", "_size", "_all", chosen("_items").alias("_subset"), chosen("_weights").alias("_chosen"))

    sizes = range(1, most + 2)
    holders = subsets.groupBy("_subset").agg(*[F.count_if(F.col("_size") <= s).alias(f"_n{s}") for s in sizes],
                                             *[F.sum(F.when(F.col("_size") <= s, F.col("_all"))).cast(EXACT).alias(f"_w{s}") for s in sizes])
    holders = holders.select("_subset", F.array(*[f"_n{s}" for s in sizes]).alias("_counts"), F.array(*[f"_w{s}" for s in sizes]).alias("_sums"))
    met = split_join(subsets, holders, ["_subset"])
    sign = F.when(F.size("_subset") % 2 == 1, F.lit(1)).otherwise(F.lit(-1))
    n = F.element_at("_counts", reach.cast("int"))
    w = F.coalesce(F.element_at("_sums", reach.cast("int")), F.lit(0).cast(EXACT))
    shared = F.when(F.size("_subset") == 1, F.element_at("_chosen", 1) * n).otherwise(F.lit(0))
    sums = met.groupBy("_set", "_size", "_all").agg(F.sum(sign * n).alias("_met"), F.sum(sign * w).alias("_theirs"), F.sum(shared).alias("_common"))
    itself = F.when(2 * F.col("_size") <= most + 2, F.lit(1)).otherwise(F.lit(0))  # a set meets itself, at no difference
    weight = F.col("_all") * F.col("_met") + F.col("_theirs") - 2 * F.col("_common")
    return sums.select("_set", (F.col("_met") - itself).alias("_n"), weight.cast(EXACT).alias("_w"))


def _large_partners(sets: DataFrame, most: int) -> DataFrame:
    """Partners with which a set has more than `most` + 2 items together."""
    overlap = lambda a, b: F.ceil((a + b - most) / 2)  # items that partners of these sizes share at least
    smallest = F.greatest(F.lit(most + 3) - F.col("_size"), F.col("_size") - most, F.lit(1))
    prefix = F.slice("_items", F.lit(1), F.greatest(F.col("_size") - overlap(F.col("_size"), smallest) + 1, F.lit(0)).cast("int"))
    placed = sets.where(F.col("_size") + F.col("_size") + most > most + 2).select("*", F.posexplode(prefix).alias("_at", "_token"))
    side = lambda p: placed.select(*[F.col(c).alias(p + c) for c in placed.columns])
    a, b = F.col("l_size"), F.col("r_size")
    near = (F.col("l_token") == F.col("r_token")) & (F.col("l_set") < F.col("r_set")) & (a + b > most + 2) & (F.abs(a - b) <= most)
    early = (F.col("l_at") <= a - overlap(a, b)) & (F.col("r_at") <= b - overlap(a, b))
    common = F.array_intersect("l_items", "r_items")
    pairs = side("l").join(side("r"), near & early).withColumn("_common", common)
    pairs = pairs.where((a + b - 2 * F.size("_common") <= most) & (F.get("_common", F.lit(0)) == F.col("l_token")))
    weights = F.filter("l_weights", lambda _, i: F.array_contains("_common", F.get("l_items", i)))
    weight = (F.col("l_all") + F.col("r_all") - 2 * _sum(weights)).cast(EXACT)
    both = pairs.select(weight.alias("_w"), F.explode(F.array("l_set", "r_set")).alias("_set"))
    return both.groupBy("_set").agg(F.count(F.lit(1)).alias("_n"), F.sum("_w").cast(EXACT).alias("_w"))
