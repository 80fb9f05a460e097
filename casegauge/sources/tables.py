"""Delimited tables, feeds and sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from casegauge.functions.text import default_network
from casegauge.session import stored


def read_table(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Partitioned delimited table with a declared schema. Partition columns named in the schema keep
    their declared type, so hour '05' stays a string."""
    return spark.read.schema(schema).option("sep", sep).option("header", False).csv(path)


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ingest_feed(spark: SparkSession, path: str, schema: StructType, key: str, sep: str = ",",
                leading: str = "_stamp") -> DataFrame:
    """Query output with banner lines above the data and a timestamp in front of every row.

    Files are split across tasks, so banner lines are told by their own text, not by position: empty lines, the
    header (the names of the columns after a first field) and rules of dashes. Everything else is data: a record with
    too many or too few fields or without a key is an error, as is a field that does not parse."""
    names = [leading, *schema.fieldNames()]
    n = len(names)
    line = F.trim("value")
    rule = F.regexp_replace(line, r"[-=+|\s]", "") == F.lit("")
    rule = rule | (F.regexp_replace(line, f"[-=+|\\s{re.escape(sep)}]", "") == F.lit("")) & line.rlike("[-=]")
    header = F.lower(F.regexp_replace(line, r"\s", "")).endswith(sep + sep.join(schema.fieldNames()).lower())
    raw = spark.read.text(path).where(~rule & ~header).select(F.split("value", sep, -1).alias("f"))
    whole = (F.size("f") == n) & (F.trim(F.get("f", F.lit(names.index(key)))) != F.lit(""))
    checked = raw.withColumn("f", F.when(whole, F.col("f")).otherwise(
        F.raise_error(F.concat(F.lit("ragged row or no key: "), F.array_join("f", sep)))))
    empty_as_null = lambda i: F.nullif(F.get("f", F.lit(i)), F.lit(""))
    return checked.select(*[empty_as_null(i + 1).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def strict_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any null. (Ragged rows fail earlier: read with mode FAILFAST or `ingest_feed`.)"""
    return df.na.drop("any")


def read_strict(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Ragged or unparsable rows fail the job; rows with any null are dropped."""
    return strict_rows(spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST").csv(path))


def tag_from_filename(df: DataFrame, pattern: str, names: Sequence[str], full_path: bool = False) -> DataFrame:
    """Columns from the groups of a pattern over the name (or path) of the file a row came from."""
    file = F.col("_metadata.file_path" if full_path else "_metadata.file_name")
    return df.select("*", *[F.regexp_extract(file, pattern, i + 1).alias(n) for i, n in enumerate(names)])


def split_fields(df: DataFrame, text: str, names: Sequence[str], network: str, header_word: str) -> DataFrame:
    """Records separated by blanks or bars. Header lines are dropped; a record that is one field
    short has no network, which is then the wildcard."""
    f = F.split(F.trim(F.regexp_replace(F.col(text), r"[| ]+", " ")), " ")
    n, at = len(names), list(names).index(network)
    rows = df.where(~F.col(text).contains(header_word)).select(*[c for c in df.columns if c != text], f.alias("_f"))
    full = F.size("_f") >= n
    cols = []
    for i, name in enumerate(names):
        if i == at:
            cols.append(F.when(full, default_network(F.get("_f", F.lit(i)))).otherwise(F.lit("ANY")).alias(name))
        elif i < at:
            cols.append(F.get("_f", F.lit(i)).alias(name))
        else:
            cols.append(F.when(full, F.get("_f", F.lit(i))).otherwise(F.get("_f", F.lit(i - 1))).alias(name))
    return rows.select(*[c for c in df.columns if c != text], *cols)


def overwrite_partition(df: DataFrame, path: str, parts: Sequence[str], format: str = "parquet", **options) -> None:
    """Replace exactly the partitions present in `df`; a rerun gives the same table.

    Rows are rebalanced by partition value: small partitions get one file each, and adaptive
    execution splits a large one into tasks of the advisory size."""
    (df.hint("rebalance", *parts).write.format(format).options(**options).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(path))


def append_partition(df: DataFrame, path: str, parts: Sequence[str], format: str = "parquet", **options) -> None:
    """Add rows as new files, rebalanced as in `overwrite_partition`; the commit protocol removes the output of
    failed attempts."""
    df.hint("rebalance", *parts).write.format(format).options(**options).mode("append").partitionBy(*parts).save(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False, parts: Sequence[str] = (),
                    mode: str = "errorifexists") -> None:
    writer = df.write.option("sep", sep).option("header", header).mode(mode)
    (writer.partitionBy(*parts) if parts else writer).csv(path)


def load_text_append(spark: SparkSession, source: str, schema: StructType | str, path: str, parts: Sequence[str],
                     sep: str = ",") -> None:
    """Bulk load of delimited files into a table."""
    append_partition(read_table(spark, source, schema, sep), path, parts)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table in which rows with the same keys lie in the same bucket, one file each and sorted: tables that are bucketed
    alike join on these keys without a shuffle or a sort. `buckets` is a property of the feed, chosen once for its
    largest size; a hot key makes a large bucket, so the keys should include the time."""
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(table))
