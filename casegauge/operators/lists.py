"""List-valued results, in two plain forms.

A list cell is as large as its group. So a list is one cell only where a dimension bounds it: the regions of a
client, a rule or a cluster (at most the region dimension times its links) and the cases of a region (at most the
configured cases). Members without such a bound (clients, networks, measurements) stay in long form, one row per
item with the size of its group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casegauge.operators.spread import with_totals


def list_item(lists: dict[str, Column], order: Sequence[Column]) -> Column:
    """One item of parallel lists, with what it is ordered by in front."""
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *[c.cast("string").alias(f"v{i}") for i, c in enumerate(lists.values())])


def list_texts(items: Column, names: Sequence[str], sep: str = ":") -> list[Column]:
    """The joined strings of sorted items."""
    return [F.array_join(items.getField(f"v{i}"), sep).alias(name) for i, name in enumerate(names)]


def joined_lists(df: DataFrame, keys: Sequence[str], lists: dict[str, Column], order: Sequence[Column], sep: str = ":",
                 count_name: str = "items") -> DataFrame:
    """keys + count + one joined string per list, all in the given order; for lists that a dimension bounds.

    The caller passes one row per item (already distinct or aggregated)."""
    grouped = df.select(*keys, list_item(lists, order).alias("_item")).groupBy(*keys).agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    return grouped.select(*keys, F.size("_items").cast("long").alias(count_name), *list_texts(F.col("_items"), list(lists), sep))


def items_with_totals(df: DataFrame, keys: Sequence[str], count_name: str = "items") -> DataFrame:
    """The rows with the number of rows of their key (null is a key too). A hot key is counted on the map side, and its rows
    stay spread over tasks."""
    return with_totals(df, keys, **{count_name: F.count(F.lit(1))})


def first_items(df: DataFrame, keys: Sequence[str], item: str, n: int, name: str, sep: str = ":", count_name: str = "items") -> DataFrame:
    """keys + number of items + the first n items in one string. Each task keeps n items of a key before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(item))
    first = joined_lists(df.withColumn("_rank", rank).where(F.col("_rank") <= n), keys, {name: F.col(item)}, [F.col(item)], sep, "_n").drop("_n")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).join(first, list(keys))


def explode_list(df: DataFrame, keys: Sequence[str], text: str, item: str, sep: str = ":") -> DataFrame:
    """One row per item of a joined list."""
    return df.select(*keys, F.explode(F.split(F.col(text), sep)).alias(item))
