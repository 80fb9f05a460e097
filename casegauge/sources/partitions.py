"""Partitions by their folders: listed, chosen, dropped and added without reading data.

A partitioned table is a folder of folders named `column=value`. Their names say which partitions there are; the number of
folders is bounded by the calendar and the configured keys, not by the rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

NULL_NAME = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name that stands for null
COMMITS, STAGING = "_commits", "_staging"  # readers pass over names with an underscore


class Folder:
    """A table's folder, through the session's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.files = self.path().getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, pattern: str) -> list[str]:
        """Paths below the root that match, as `a/b/c`."""
        depth = pattern.count("/") + 1
        found = self.files.globStatus(self.path(pattern)) or []
        return ["/".join(status.getPath().toString().split("/")[-depth:]) for status in found]

    def exists(self, name: str) -> bool:
        return self.files.exists(self.path(name))

    def delete(self, name: str) -> None:
        if not name or ".." in name:
            raise ValueError("a name below the table's folder is needed")
        self.files.delete(self.path(name), True)

    def move(self, source: str, target: str) -> None:
        self.files.mkdirs(self.path(target).getParent())
        if not self.files.rename(self.path(source), self.path(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def write(self, name: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        draft = f"{name}.{uuid.uuid4().hex[:8]}.draft"
        out = self.files.create(self.path(draft), True)
        out.write(text.encode())
        out.close()
        self.move(draft, name)

    def read(self, name: str) -> str:
        stream = self.files.open(self.path(name))
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text


def partition_values(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """One row per partition of the table at `path` with its values, typed by `columns` (DDL of the partition columns in
    folder order), and `_folder`, its name below the table's folder. Only folder names are read."""
    fields = StructType.fromDDL(columns)
    names = fields.fieldNames()
    folder = Folder(spark, path)
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    rows = []
    for name in folder.names("/".join(f"{n}=*" for n in names)):
        values = [unescape(part.split("=", 1)[1]) for part in name.split("/")]
        rows.append((*[None if v == NULL_NAME else v for v in values], name))
    plain = StructType([StructField(n, StringType()) for n in [*names, "_folder"]])
    return spark.createDataFrame(rows, plain).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], "_folder")


def read_partitions(spark: SparkSession, path: str, schema: str | StructType, chosen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of some partitions, given by their values (a bounded list of folders). The values are literals, so no other
    folder is listed for reading."""
    known = [r for r in chosen.select(*columns).distinct().collect()]
    rows = spark.read.schema(schema).parquet(path)
    if not known:
        return rows.where(F.lit(False))
    if len(columns) == 1:
        values = [r[0] for r in known if r[0] is not None]
        found = F.col(columns[0]).isin(values) if values else F.lit(False)
        return rows.where(found | F.col(columns[0]).isNull() if len(values) < len(known) else found)
    one = lambda r: _all([F.col(c).eqNullSafe(F.lit(r[c])) for c in columns])
    return rows.where(_any([one(r) for r in known]))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def read_latest(spark: SparkSession, path: str, schema: str | StructType, columns: str, column: str,
                upto=None, strict: bool = False) -> DataFrame:
    """The rows of the newest partition by one of the partition columns, or of the newest at or before (strictly before)
    `upto`. It is found among folder names; a table without such a partition gives no rows."""
    parts = partition_values(spark, path, columns)
    if upto is not None:
        parts = parts.where(F.col(column) < upto if strict else F.col(column) <= upto)
    newest = parts.agg(F.max(column).alias(column)).where(F.col(column).isNotNull())
    return read_partitions(spark, path, schema, newest, [column])


def drop_partitions(spark: SparkSession, path: str, columns: str, expired: Column) -> list[str]:
    """Remove the folders of the partitions whose values meet the condition, and return their names. No data file is opened.
    Where the condition is null, the partition stays."""
    gone = [r["_folder"] for r in partition_values(spark, path, columns).where(expired).select("_folder").collect()]
    folder = Folder(spark, path)
    for name in sorted(gone):
        folder.delete(name)
    return sorted(gone)


def retain_partitions(spark: SparkSession, path: str, columns: str, column: str, now: int, ttl: int, inclusive: bool = True) -> list[str]:
    """Drop the partitions older than ttl; `inclusive` keeps one exactly at the limit."""
    limit = now - ttl
    return drop_partitions(spark, path, columns, F.col(column) < limit if inclusive else F.col(column) <= limit)


def append_once(df: DataFrame, path: str, parts: Sequence[str], key: str) -> bool:
    """Add rows to a partitioned table once for each `key` (a batch, a feed and hour): whether they were added now.

    Rows are written to a staging folder first, so a failing task leaves nothing in the table. Then a plan with the names of the
    new files is laid down, the files are moved to their partitions, and a marker ends the append. A key with a marker adds
    nothing again. An append that broke off between plan and marker is undone: at once if the move fails, else by the next
    append to the table (`undo_unfinished`). One append per table at a time."""
    if not key or set(key) & set("/\\*?[]{}") or key.startswith((".", "_")):
        raise ValueError("a key is a plain name")
    spark, folder = df.sparkSession, Folder(df.sparkSession, path)
    undo_unfinished(spark, path)
    if folder.exists(f"{COMMITS}/{key}.done"):
        return False
    staged = f"{STAGING}/{key}-{uuid.uuid4().hex[:8]}"
    try:
        df.hint("rebalance", *parts).write.partitionBy(*parts).parquet(f"{folder.root}/{staged}")
        depth = "/".join(["*"] * len(parts))
        files = [n for n in folder.names(f"{staged}/{depth}/part-*")]
        moves = [("/".join(n.split("/")[2:-1]), n.split("/")[-1]) for n in files]
        targets = [f"{where}/part-{key}-{name.removeprefix('part-')}" for where, name in moves]
        folder.write(f"{COMMITS}/{key}.plan", "\n".join(targets))
        try:
            for name, target in zip(files, targets):
                folder.move(name, target)
            folder.write(f"{COMMITS}/{key}.done", "\n".join(targets))
        except Exception:
            _undo(folder, key)
            raise
        folder.delete(f"{COMMITS}/{key}.plan")
    finally:
        folder.delete(staged)
    return True


def undo_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Take back the appends that have a plan and no marker, and what lies in the staging folder; the keys that were undone."""
    folder = Folder(spark, path)
    keys = [n.split("/")[-1].removesuffix(".plan") for n in folder.names(f"{COMMITS}/*.plan")]
    undone = []
    for key in keys:
        if folder.exists(f"{COMMITS}/{key}.done"):
            folder.delete(f"{COMMITS}/{key}.plan")
        else:
            _undo(folder, key)
            undone.append(key)
    for name in folder.names(f"{STAGING}/*"):
        folder.delete(name)
    return undone


def _undo(folder: Folder, key: str) -> None:
    for target in filter(None, folder.read(f"{COMMITS}/{key}.plan").split("\n")):
        folder.delete(target)
    folder.delete(f"{COMMITS}/{key}.plan")
