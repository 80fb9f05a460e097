"""Exact deduplication by sorting contents.

Rows are range-partitioned by the first bytes of their normalised text, a hash of all of it and their
identifier (Spark samples the splitters; the samples stay small however long the texts are), so a group of any
size is spread over as many partitions as it fills. Each partition is sorted externally, whole texts included,
and a text is then compared in full with its neighbour. Runs of equal texts get their smallest identifier and
their size; a run that touches the border of its partition (by first bytes and hash) is joined with the runs of
the same text in the other partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.llm.common import packed, stored, unpacked


HEAD = 64  # bytes of a text that take part in the choice of splitters


def normalised(text: Column) -> Column:
    """Each run of blanks, tabs and line ends as one space; null as an empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours; the texts of the runs at the first and the last key follow as rows
    of their own (`edge`)."""
    part = TaskContext.get().partitionId()
    run, last, schema = -1, None, None
    key, at_first, edges, tail = None, True, {}, {}  # tail: the runs of the current key

    def border(number: int, text: bytes) -> pa.RecordBatch:
        own = {"part": [part], "run": [number], "first": [False], "digest": [None], "edge": [text]}
        cols = [pa.array(own[f.name], f.type) if f.name in own else pa.nulls(1, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        norm, hashes = batch.column("norm"), batch.column("hash").to_pylist()
        starts = np.ones(n, bool)
        if n > 1:
            starts[1:] = pc.not_equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        texts = norm.to_pylist()
        starts[0] = last is None or texts[0] != last
        numbers = run + np.cumsum(starts)
        for i in np.flatnonzero(starts):
            if key is not None and hashes[i] != key:
                at_first, tail = False, {}
            key = hashes[i]
            tail[int(numbers[i])] = texts[i]
            if at_first:
                edges[int(numbers[i])] = texts[i]
        run, last = int(numbers[-1]), texts[-1]
        names = [c for c in batch.schema.names if c not in ("norm", "hash")]
        own = {"part": pa.array(np.full(n, part, np.int32)), "run": pa.array(numbers.astype(np.int64)), "first": pa.array(starts),
               "digest": pa.array([hashlib.sha256(t).hexdigest() for t in texts]), "edge": pa.nulls(n, pa.binary())}
        out = pa.RecordBatch.from_arrays([batch.column(c) for c in names] + list(own.values()), names + list(own))
        schema = out.schema
        yield out
    for number, text in (edges | tail).items():
        yield border(number, text)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Every row with `keep_id` (smallest identifier of the rows with an equal text), `group_size`,
    `kept` (true for exactly one row of each group) and `text_sha256` (of the normalised text).

    A null text counts as empty. A null identifier ranks behind all others; `keep_id` is null only
    where a group has no other. Of repeated rows (equal identifier and text) one stays. An empty table
    gives an empty result. `carry` names the columns passed on (None: all); a result column replaces
    an input column of its name."""
    rows = packed(docs, carry, id=docs[id_col], norm=normalised(docs[text_col]).cast("binary"))
    rows = rows.withColumn("head", F.substring("norm", 1, HEAD)).withColumn("hash", F.xxhash64("norm"))
    by_id = F.col("id").asc_nulls_last()
    order = [F.col("head").asc(), F.col("hash").asc(), by_id]
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    schema = rows.select("row", "id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("run"), F.lit(True).alias("first"),
                         F.lit("").alias("digest"), F.lit(b"").alias("edge")).schema
    for f in schema:
        f.nullable = True
    marked = stored(dealt.sortWithinPartitions("head", "hash", "norm", by_id).drop("head").mapInArrow(_runs, schema), "exact")

    data = marked.where(F.col("edge").isNull())
    runs = data.groupBy("part", "run").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    at = F.struct("part", "run")
    borders = marked.where(F.col("edge").isNotNull()).select("part", "run", "edge").join(runs, ["part", "run"])
    groups = borders.groupBy("edge").agg(F.min("low").alias("group_low"), F.sum("n").alias("group_n"), F.min(at).alias("head"))
    joined = borders.join(groups, "edge").select("part", "run", "group_low", "group_n", "head")
    whole = runs.join(joined, ["part", "run"], "left").select(
        "part", "run", F.coalesce("group_low", "low").alias("low"), F.coalesce("group_n", "n").alias("n"),
        (F.col("head").isNull() | (F.col("head") == at)).alias("leads"))
    out = data.join(whole, ["part", "run"])
    return unpacked(out, carry, docs.columns, keep_id=F.col("low"), group_size=F.col("n"), kept=F.col("first") & F.col("leads"),
                    text_sha256=F.col("digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input."""
    rows = docs.select(F.struct("*").alias("doc"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    return exact_groups(rows, "id", "text", carry=["doc"]).where("kept").select("doc.*")
