"""Removal of long passages that repeat across documents, over a compacted De Bruijn graph of word k-mers.

Windows of words are the edges of the graph. Consecutive windows that share their smallest k-mer (an
anchor) form one path, so a text becomes a few paths instead of a row for every window; equal windows have
equal anchors at equal places. Joins on the anchor find what repeats: a path that is the same wherever its
anchor stands (no branch) is settled as a whole by its first document; at a branch, only the paths of the
documents in which they first occur are opened into windows again. Positions in the source documents are
carried along, and the spans are cut out of the texts there.

A window is compared by a 64-bit hash of its words next to the 64-bit hash of its anchor.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.llm.common import Spans, WordHashes, as_signed, covered, mixed, packed, stored, text_bytes, texts_of, unpacked, with_columns

WINDOW = 50
ANCHOR = 16  # words of the k-mers among which a window's anchor is chosen
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _paths(size: int, anchor: int) -> Callable:
    """One row per path: anchor, hash of the path, its first window and its number of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        wide = size - anchor + 1  # k-mers in a window
        for batch in batches:
            doc, anchors, paths, starts, counts = [], [], [], [], []
            for i, text in enumerate(texts_of(batch, "text")):
                words = text.split()  # bytes: splits at the ASCII blanks only
                n = len(words) - size + 1
                if n <= 0:
                    continue
                spans = Spans(cache.of(words))
                mers = spans.windows(anchor)
                at = np.lib.stride_tricks.sliding_window_view(mers, wide).argmin(axis=1) + np.arange(n)
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                count = np.diff(np.append(first, n))
                place = at[first]
                whole = spans.between(first, first + count + size - 1)
                doc.append(np.full(len(first), i)), anchors.append(mers[place]), starts.append(first), counts.append(count)
                paths.append(mixed(whole + (place - first).astype(np.uint64)))
            if doc:
                join = lambda x, t: pa.array(np.concatenate(x).astype(t))
                at = pa.array(np.concatenate(doc))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), batch.column("content").take(at), pa.array(as_signed(np.concatenate(anchors))),
                     pa.array(as_signed(np.concatenate(paths))), join(starts, np.int32), join(counts, np.int32)],
                    ["id", "content", "anchor", "path", "start", "n"])
    return run


def _windows(size: int) -> Callable:
    """The windows of the listed paths of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for i, (text, paths) in enumerate(zip(texts_of(batch, "text"), batch.column("paths"))):
                spans = Spans(cache.of(text.split()))
                p = paths.values
                start, n = p.field("start").to_numpy(), p.field("n").to_numpy()
                at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = pa.array(np.full(len(at), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(row), batch.column("content").take(row), pa.array(as_signed(spans.between(at, at + size))),
                     pa.array(at.astype(np.int32))], ["id", "content", "window", "start"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, kept = [], [], []
        for text, spans in zip(texts_of(batch, "text"), batch.column("spans")):
            words = _WORD.findall(text)
            if spans.is_valid:
                p = spans.values
                out = covered(len(words), p.field("start").to_numpy(), p.field("end").to_numpy())
                left = [w for w, drop in zip(words, out) if not drop]
            else:
                left = words
            total.append(len(words)), gone.append(len(words) - len(left))
            kept.append(b" ".join(left).decode("utf-8", "replace"))
        yield with_columns(batch, ["text", "spans"], n_words=pa.array(total, pa.int64()), n_removed=pa.array(gone, pa.int64()),
                           kept_text=pa.array(kept, pa.string()))


def _before(low: Column, own: Column) -> Column:
    """Whether the identifier ranks before the row's own; null ranks behind all."""
    return low.isNotNull() & (own.isNull() | (low < own))


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, anchor: int = ANCHOR,
                    carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `n_words`, `n_removed` and `kept_text`: its words (runs of other than ASCII blanks), joined by one
    space, without those covered by a window of `size` words that also starts in a document with a smaller identifier.

    Windows are judged on the input. A null text has no words; texts shorter than a window stay whole. Rows that share
    an identifier do not remove anything from each other; a null identifier ranks behind all others, and rows with null
    identifiers do not remove anything from each other. An empty table gives an empty result. `carry` names the columns
    passed on (None: all); a result column replaces an input column of its name."""
    text = text_bytes(docs[text_col])
    rows = packed(docs, carry, id=docs[id_col], content=F.xxhash64(text), text=text)
    sources = rows.select("id", "content", "text")
    kinds = sources.select("id", "content", *[F.lit(0).cast(t).alias(c) for c, t in
                                              (("anchor", "long"), ("path", "long"), ("start", "int"), ("n", "int"))])
    paths = stored(sources.mapInArrow(_paths(size, anchor), kinds.schema), "paths")

    # anchors that stand in more than one document
    around = paths.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("all"), F.count("id").alias("named"),
                                         (F.min("path") != F.max("path")).alias("branch"))
    repeated = around.where((F.col("low") != F.col("high")) | ((F.col("named") > 0) & (F.col("named") < F.col("all")))).select("anchor", "branch")
    met = stored(paths.join(repeated, "anchor"), "repeats")
    owners = met.groupBy("anchor", "path").agg(F.min("id").alias("owner"))
    owned = stored(met.join(owners, ["anchor", "path"]), "owned")
    whole = owned.where(_before(F.col("owner"), F.col("id"))).select(
        "id", "content", "start", (F.col("start") + F.col("n") + size - 1).alias("end"))

    # branches: the windows of each path where it first occurs
    opened = (owned.where(F.col("branch") & F.col("owner").eqNullSafe(F.col("id"))).groupBy("id", "content")
              .agg(F.collect_list(F.struct("start", "n")).alias("paths")))  # bounded by the words of one text
    same = lambda a, b: (F.col(f"{a}.content") == F.col(f"{b}.content")) & F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id"))
    told = sources.alias("s").join(opened.alias("o"), same("s", "o")).select("s.id", "s.content", "s.text", "o.paths")
    windows = stored(told.mapInArrow(_windows(size), told.select("id", "content", F.lit(0).cast("long").alias("window"), F.lit(0).alias("start")).schema),
                     "windows")
    firsts = windows.groupBy("window").agg(F.min("id").alias("owner"), F.max("id").alias("high"), F.count("*").alias("all"), F.count("id").alias("named"))
    firsts = firsts.where((F.col("owner") != F.col("high")) | (F.col("named") < F.col("all"))).select("window", "owner")
    single = (windows.join(firsts, "window").where(_before(F.col("owner"), F.col("id")))
              .select("id", "content", "start", (F.col("start") + size).alias("end")))

    spans = stored(whole.union(single).groupBy("id", "content").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    joined = rows.alias("r").join(spans.alias("p"), same("r", "p"), "left").select("r.row", "r.text", "p.spans")
    schema = joined.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_text")).schema
    out = joined.mapInArrow(_cut, schema)
    return unpacked(out, carry, docs.columns, n_words=F.col("n_words"), n_removed=F.col("n_removed"), kept_text=F.col("kept_text"))
