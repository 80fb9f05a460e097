"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_OWN: set[str] = set()
_PASSING: list[list[str]] = []  # the folders made within each `passing`, the innermost last

# What the operators rely on. The last entry makes an aggregation or window shuffle by all of its
# keys instead of reusing a coarser partitioning (say, that of a join on one of them): partial sums
# leave a hot key's task before they meet, and adaptive execution may split the join below.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "casegauge", master: str | None = None, **conf) -> SparkSession:
    """A session with the library's settings; `conf` adds to them or replaces them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's checkpoint folder, in a folder of this application that is
    deleted when the application ends.

    Only where the session names no such folder (local tests) a temporary one is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = root or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        if "root" not in _LOCAL:
            _LOCAL["root"] = tempfile.mkdtemp(prefix="casegauge-")
        root = _LOCAL["root"]
    path = f"{_own_folder(spark, root.rstrip('/'))}/{label}-{uuid.uuid4().hex[:12]}"
    if _PASSING:
        _PASSING[-1].append(path)
    return path


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the scratch folder and read back: for a result that several aggregations use, computed once and
    kept through the loss of executors. The shuffle files of the writing query are given back at its end."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    before = spark.conf.get(_TIDY, "false")
    spark.conf.set(_TIDY, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_TIDY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        _deleted(table.sparkSession, table._scratch)


def _deleted(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are stored while it holds are deleted at its end, so that they take no disk beside what follows, except
    those given to the function that it hands out. What leaves it otherwise must not read them any more."""
    made: list[str] = []
    kept: list[str] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table._scratch)
        return table

    _PASSING.append(made)
    try:
        yield keep
    finally:
        _PASSING.remove(made)
        for path in made:
            if path not in kept:
                _deleted(spark, path)
        if _PASSING:
            _PASSING[-1].extend(path for path in made if path in kept)


def _own_folder(spark: SparkSession, root: str) -> str:
    own = f"{root}/casegauge-{spark.sparkContext.applicationId}"
    if own not in _OWN:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWN.add(own)
    return own
