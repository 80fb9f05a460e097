"""All registered queries."""

from casegauge.plans import (assignments, geography, joins, regions, scalars, storage, streams,  # noqa: F401
                             summaries, traffic)
from casegauge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
