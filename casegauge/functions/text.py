"""Names, labels and lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casegauge.functions.metrics import as_col

ANY_NETWORK = "ANY"
EMPTY_LIST = "NULL"


def case_label(maprule="maprule", geoname="geoname", netname="netname") -> Column:
    """`MR_<rule>:GEO_<geo>:<network>`."""
    return F.concat(F.lit("MR_"), as_col(maprule).cast("string"), F.lit(":GEO_"), as_col(geoname),
                    F.lit(":"), as_col(netname))


def parse_case_name(name) -> dict[str, Column]:
    """Rule and geo from `<service>.<x>_<rule>.<...>_<geo>` style names (split on `.` and `_`)."""
    bits = F.split(as_col(name), r"[.]")
    rule = F.get(F.split(F.get(bits, F.lit(1)), "_"), F.lit(1))
    geo = F.get(F.split(F.get(bits, F.lit(2)), "_"), F.lit(1))
    return {"maprule": rule.try_cast("int"), "geoname": geo}


def default_network(network) -> Column:
    """An empty or missing network means the wildcard."""
    network = as_col(network)
    return F.when(network.isNull() | (F.length(network) == 0), F.lit(ANY_NETWORK)).otherwise(network)


def join_list(items, sep=":") -> Column:
    """Sink form of a list: joined, with the marker word for an empty or missing list."""
    items = as_col(items)
    text = F.array_join(F.transform(items, lambda x: x.cast("string")), sep)
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, text).otherwise(F.lit(EMPTY_LIST))


def truncate_list(text, n=5, sep=":") -> Column:
    """The first n items of a joined list."""
    return F.array_join(F.slice(F.split(as_col(text), sep), 1, n), sep)


def reference_label(name, rule_id) -> Column:
    """`<name part> [<id>]`, the name cut from its third letter up to the first dot."""
    name = as_col(name)
    dot = F.instr(name, ".")
    cut = F.substring(name, F.lit(3), F.greatest(dot - F.lit(3), F.lit(0)))
    return F.concat(cut, F.lit(" ["), as_col(rule_id).cast("string"), F.lit("]"))


def short_description(text, width=25) -> Column:
    """First characters of a text, with commas made safe for comma-separated sinks."""
    return F.replace(F.substring(as_col(text), 1, width), F.lit(","), F.lit(";"))
