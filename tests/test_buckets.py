"""Feeds that are bucketed alike join where they lie."""

import uuid

import pytest
from pyspark.testing import assertDataFrameEqual

from casegauge import CASE
from casegauge.operators import joins as J
from casegauge.plans.inputs import Inputs
from casegauge.plans.joins import FEEDS
from casegauge.sources.tables import write_bucketed

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def feeds(spark):
    x, mark = Inputs(spark, FOLDER), uuid.uuid4().hex[:8]
    sample = x.case_sample()
    names = {k: f"feed_{k}_{mark}" for k in (*FEEDS, "io")}
    for kind, name in names.items():
        write_bucketed(x.metric_feed(kind, sample), name, [*CASE, "ts"], 6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {k: spark.table(n) for k, n in names.items()}, {k: x.metric_feed(k, sample) for k in names}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for n in names.values():
        spark.sql(f"drop table {n}")


def test_five_bucketed_feeds_join_without_a_shuffle(spark, feeds):
    bucketed, plain = feeds
    joined = J.with_io_ratio(J.sample_join(*[bucketed[k] for k in FEEDS]), bucketed["io"])
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("SortMergeJoin") == 5 and text.count("Bucketed: true") == 6
    want = J.with_io_ratio(J.sample_join(*[plain[k] for k in FEEDS]), plain["io"])
    assert "Exchange" in want._jdf.queryExecution().executedPlan().toString()
    assertDataFrameEqual(joined, want)
