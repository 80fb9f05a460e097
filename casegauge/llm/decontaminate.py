"""Benchmark decontamination with a broadcast set of benchmark windows.

Benchmark items are cut into windows of consecutive words and grouped by Spark into distinct windows
with the items that hold them. The windows go to the workers in blocks of a bounded number of bytes
(one block, unless the benchmark is large). Documents are scanned where they lie: window hashes are
looked up, hits are verified word by word, and one row per document comes out; no document is shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegauge.llm.common import Spans, WordHashes, covered, in_parts, packed, stored, text_bytes, texts_of, unpacked, with_columns

WINDOW = 10
BLOCK_BYTES = 32 << 20  # window bytes of a broadcast block, before Python's overhead
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return text.translate(_LETTERS).split()


def _cut(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, length, window = [], [], []
            for key, text in zip(batch.column("item").to_pylist(), texts_of(batch, "text")):
                w = words(text)
                k = min(size, len(w))
                for i in range(len(w) - k + 1 if k else 0):
                    item.append(key), length.append(k), window.append(b" ".join(w[i:i + k]))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(length, pa.int32()), pa.array(window, pa.binary())],
                                             ["item", "length", "window"])
    return run


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows with the items that hold them: one row for each `length` (in words), `window` and `item`."""
    items = packed(benchmark, [], item=F.coalesce(benchmark[id_col].cast("string"), F.lit("")), text=text_bytes(benchmark[text_col]))
    cut = items.select("item", "text").mapInArrow(_cut(size), "item string, length int, window binary")
    return cut.select("length", "window", "item").distinct()


class _Index:
    """Windows of one block by their hashes; made once in each worker."""

    def __init__(self, block: list[tuple[int, bytes, list[str]]]):
        self.hashes = WordHashes()
        self.windows: dict[int, dict[int, list[tuple[list[bytes], list[str]]]]] = defaultdict(lambda: defaultdict(list))
        for length, window, items in block:
            w = window.split(b" ")
            h = int(Spans(self.hashes.of(w)).windows(length)[0])
            self.windows[length][h].append((w, items))
        self.sorted = {k: np.sort(np.fromiter(v, np.uint64, len(v))) for k, v in self.windows.items()}

    def scan(self, w: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in a window, and the items whose windows occur."""
        n, found = len(w), set()
        start, end = [], []
        spans = Spans(self.hashes.of(w)) if n else None
        for k, known in self.sorted.items():
            if n < k:
                continue
            h = spans.windows(k)
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for i in np.flatnonzero(known[at] == h):
                for own, items in self.windows[k][int(h[i])]:
                    if w[i:i + k] == own:  # the hash only proposes
                        start.append(i), end.append(i + k)
                        found.update(items)
        return covered(n, np.array(start, int), np.array(end, int)), found


def _scan(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(shared.value)
        for batch in in_parts(batches):
            n, hits, items = [], [], []
            for text in texts_of(batch, "text"):
                w = words(text)
                hit, found = index.scan(w)
                n.append(len(w)), hits.append(hit if hit.any() else []), items.append(sorted(found))
            yield with_columns(batch, [], n_words=pa.array(n, pa.int64()), hits=pa.array(hits, pa.list_(pa.bool_())),
                               items=pa.array(items, pa.list_(pa.string())))
    return run


def _blocks(windows: DataFrame, block_bytes: int) -> Iterator[list]:
    """The windows in lists of bounded size, read partition by partition. A window of many items may be in several."""
    block: dict[tuple[int, bytes], list[str]] = {}
    used = 0
    listed = lambda: [(length, window, items) for (length, window), items in block.items()]
    for r in windows.toLocalIterator():
        key = (r.length, bytes(r.window))
        size = len(r.item) + 16 + (0 if key in block else len(r.window) + 64)
        if block and used + size > block_bytes:
            yield listed()
            block, used = {}, 0
        block.setdefault(key, []).append(r.item)
        used += size
    if block:
        yield listed()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `n_words`, `hits` (for each word, whether it lies in an occurrence of a benchmark
    window; an empty list if none does), `n_hit`, `items` (sorted identifiers, as strings, of the items
    with an occurring window), `n_items` and `contaminated`.

    A null text has no words. An item of fewer words than a window is one window, an item without words
    is none; a null item identifier is an empty string. With an empty benchmark nothing is hit. Repeated rows
    are judged one by one, and item identifiers that repeat count once. `carry` names the columns passed on
    (None: all); a result column replaces an input column of its name.

    One block of windows is broadcast at a time: while more follow, the rows with what was found so far are stored and the
    block is given up."""
    spark = docs.sparkSession
    found = [F.lit(0).cast("long").alias("n_words"), F.array(F.lit(True)).alias("hits"), F.array(F.lit("")).alias("items")]

    blocks = _blocks(benchmark_windows(benchmark, item_col, item_text, size), block_bytes)
    result, block = packed(docs, carry, text=text_bytes(docs[text_col])), next(blocks, [])
    while block is not None:
        shared = spark.sparkContext.broadcast(block)
        if "hits" in result.columns:
            result = result.withColumnsRenamed({"n_words": "old_n", "hits": "old_hits", "items": "old_items"})
        result = result.mapInArrow(_scan(shared), result.select("*", *found).schema)
        if "old_hits" in result.columns:
            result = result.select(
                "row", "text", "n_words",
                F.when(F.size("old_hits") == 0, F.col("hits")).when(F.size("hits") == 0, F.col("old_hits"))
                .otherwise(F.zip_with("old_hits", "hits", lambda a, b: a | b)).alias("hits"),
                F.array_sort(F.array_union("old_items", "items")).alias("items"))
        block = next(blocks, None)
        if block is not None:
            result = stored(result, "scanned")
            shared.destroy()
    n_hit = F.size(F.filter("hits", lambda x: x)).cast("long")
    return unpacked(result, carry, docs.columns, n_words=F.col("n_words"), hits=F.col("hits"), n_hit=n_hit, items=F.col("items"),
                    n_items=F.size("items").cast("long"), contaminated=n_hit > 0)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their hit words: from each hit run, the characters from its first to its last word go."""
    word = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
    for batch in in_parts(batches):
        out = []
        for text, hits in zip(texts_of(batch, "text"), batch.column("hits").to_pylist()):
            if hits:
                at = [m.span() for m in word.finditer(text)]
                parts, last, i = [], 0, 0
                while i < len(hits):
                    if hits[i]:
                        j = i
                        while j + 1 < len(hits) and hits[j + 1]:
                            j += 1
                        parts.append(text[last:at[i][0]])
                        last = at[j][1]
                        i = j
                    i += 1
                text = b"".join([*parts, text[last:]])
            out.append(text.decode("utf-8", "replace"))
        yield with_columns(batch, ["text", "hits"], clean=pa.array(out, pa.string()))


def without_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All rows, with the spans of benchmark windows taken out of their texts; other columns are as they were."""
    rows = docs.select(F.struct("*").alias("doc"), docs[text_col].alias("text"), F.lit(0).alias("id"))
    hit = contamination(rows, benchmark, "id", "text", carry=["doc", "text"], **options)
    cut = hit.select("doc", text_bytes(F.col("text")).alias("text"), "hits")
    schema = cut.select("doc", F.lit("").alias("clean")).schema
    return cut.mapInArrow(_without, schema).select(*[
        F.when(F.col("doc").getField(c).isNotNull(), F.col("clean")).alias(c) if c == text_col else F.col("doc").getField(c).alias(c)
        for c in docs.columns])


def without_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: float = 0.0, **options) -> DataFrame:
    """The rows of which at most a share of the words is hit, with the columns of the input."""
    rows = docs.select(F.struct("*").alias("doc"), docs[text_col].alias("text"), F.lit(0).alias("id"))
    hit = contamination(rows, benchmark, "id", "text", carry=["doc"], **options)
    return hit.where(F.col("n_hit") <= F.col("n_words") * share).select("doc.*")
