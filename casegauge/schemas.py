"""Declared schemas of the delimited tables that queries read."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

REGION_SAMPLE = StructType([
    StructField("maprule", IntegerType()),
    StructField("geoname", StringType()),
    StructField("netname", StringType()),
    StructField("region", LongType()),
    StructField("score", DoubleType()),
    StructField("nsd_demand", IntegerType()),
    StructField("eu_demand", IntegerType()),
    StructField("ra_load", LongType()),
    StructField("case_percent_pre_norm_load", DoubleType()),
    StructField("case_percent_load", DoubleType()),
    StructField("recorded_load_percentage", DoubleType()),
    StructField("datestamp", StringType()),
    StructField("hour", StringType()),
    StructField("ts", LongType()),
])
