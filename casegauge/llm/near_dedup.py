"""Near-duplicates by MinHash.

Each text's set of word shingles gets the minima of many universal hash functions. Texts with equal sets are
one class. Bands of minima name buckets; classes that share a bucket are candidates. The candidates of a
bucket are not paired with each other: in a few rounds each is compared with a hub of the bucket, which joins
large groups of near copies with few comparisons each. Such a comparison first looks at one bit of each minimum, then
counts the full sets. Buckets that then still hold several components are compared block by block on the full sets
(`set_blocks`). Components come from alternating large-star and small-star steps.

Full sets are made once, for the classes that share a bucket: a bit field of bounded size, broadcast, tells most of their
texts from the others where these lie, so that the other texts are not shuffled.

The bands find a pair of similarity 0.75 with a probability of 1 - 1.3e-6, more similar ones almost surely,
and the bits drop such a pair with 2e-8; a link is only ever confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.llm.buckets import FIELD, content_field, hub_rounds, in_field, merged, shared_buckets
from casegauge.llm.common import Spans, WordHashes, as_signed, in_parts, mixed, packed, stored, text_bytes, texts_of, unpacked, with_columns
from casegauge.llm.set_blocks import block_links
from casegauge.operators.spread import split_join

SHINGLE = 5
ROWS, BANDS = 5, 50
BITS = 4  # longs that hold one bit of each minimum
PERCENT = 75
ROUNDS_OF_HUBS = 3


def shingles(text: bytes, cache: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of a text with fewer words, of its whole sequence."""
    words = text.lower().split()  # bytes: A-Z and the ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(Spans(cache.of(words)).windows(min(size, len(words))))


class Minima:
    """The universal hash functions a * x + b modulo 2**64, and what is kept of their minima."""

    def __init__(self, rows: int = ROWS, bands: int = BANDS, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = rows * bands
        draw = lambda: rng.integers(0, np.iinfo(np.uint64).max, n, np.uint64, endpoint=True)
        self.a, self.b = (draw() | np.uint64(1))[:, None], draw()[:, None]
        self.rows, self.bands = rows, bands
        self.fold = draw()[:rows] | np.uint64(1)
        self.number = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def of(self, x: np.ndarray, step: int = 1024) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(x), step):
            h = x[None, i:i + step] * self.a
            h += self.b
            np.minimum(low, h.min(axis=1), out=low)
        return low

    def buckets(self, low: np.ndarray) -> np.ndarray:
        return mixed((mixed(low).reshape(self.bands, self.rows) * self.fold).sum(axis=1, dtype=np.uint64) + self.number)

    def bits(self, low: np.ndarray) -> np.ndarray:
        ones = np.zeros(BITS * 64, np.uint8)
        ones[:len(low)] = (mixed(low) >> np.uint64(33)).astype(np.uint8) & 1
        return np.packbits(ones).view(np.uint64)


def _signatures(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, minima = WordHashes(), Minima()
        for batch in in_parts(batches):
            n, key, buckets, bits = [], [], [], []
            for text in texts_of(batch, "text"):
                s = shingles(text, cache, size)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(s):
                    low = minima.of(s)
                    buckets.append(as_signed(minima.buckets(low))), bits.append(as_signed(minima.bits(low)))
                else:
                    buckets.append(np.zeros(0, np.int64)), bits.append(np.zeros(0, np.int64))
            yield with_columns(batch, ["text"], n=pa.array(n, pa.int64()), key=pa.array(key, pa.binary()),
                               buckets=pa.array(buckets, pa.list_(pa.int64())), bits=pa.array(bits, pa.list_(pa.int64())))
    return run


def _sets(size: int, field) -> Callable:
    """The full sets of the texts whose content is in the field."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in in_parts(batches):
            batch = batch.filter(pa.array(in_field(field.value, batch.column("content").to_numpy(zero_copy_only=False))))
            sets = [as_signed(shingles(t, cache, size)) for t in texts_of(batch, "text")]
            yield with_columns(batch, ["text"], d=pa.array(sets, pa.list_(pa.int64())))
    return run


def _similar(percent: int) -> Callable[[Column, Column], Column]:
    """Two full sets are similar enough."""
    def check(l: Column, r: Column) -> Column:
        both = F.size(F.array_intersect(l, r))
        return both * 100 >= (F.size(l) + F.size(r) - both) * percent

    return check


def _alike(percent: int) -> Callable[[Column, Column], Column]:
    """Sizes and bits allow the wanted similarity. Of m bits a share of (1 + s) / 2 agrees; 5.5 deviations below
    that for a pair at the threshold is the bound."""
    share = (1 + percent / 100) / 2
    m = ROWS * BANDS
    bound = int(m * (1 - share) + 5.5 * (m * share * (1 - share)) ** 0.5) + 1

    def check(l: Column, r: Column) -> Column:
        bit = lambda t, i: F.get(t.getField("bits"), F.lit(i))
        differing = sum((F.bit_count(bit(l, i).bitwiseXOR(bit(r, i))) for i in range(BITS)), F.lit(0))
        n_l, n_r = l.getField("n"), r.getField("n")
        return (n_l * 100 >= n_r * percent) & (n_r * 100 >= n_l * percent) & (differing <= bound)

    return check


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT,
                carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `n_shingles` (size of its set), `component_id` (smallest identifier that it reaches over
    links, its own included) and `kept` (true for one row of each component).

    Rows are linked when 100 * |intersection| >= percent * |union| of their shingle sets. A text with fewer
    words than a shingle is one shingle; a null text, or one without words, has an empty set and is linked with
    nothing. A null identifier ranks behind all others. Repeated rows with words are one component, of which one row
    stays. An empty table gives an empty result. `carry` names the columns passed on (None: all); a result column
    replaces an input column of its name."""
    text = text_bytes(docs[text_col])
    rows = packed(docs, carry, id=docs[id_col], content=F.xxhash64(text), at=F.monotonically_increasing_id(), text=text)
    schema = rows.select("row", "id", "content", "at", F.lit(0).cast("long").alias("n"), F.lit(b"").alias("key"),
                         F.array(F.lit(0).cast("long")).alias("buckets"), F.array(F.lit(0).cast("long")).alias("bits")).schema
    signed = stored(rows.mapInArrow(_signatures(size), schema), "signed")

    first = F.struct(F.col("id").isNull().alias("none"), "id", "at", "content")
    nodes = stored(signed.where("n > 0").groupBy("key").agg(F.min(first).alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"),
                                                            F.first("buckets").alias("buckets"))
                   .withColumn("node", F.monotonically_increasing_id()), "classes")

    members = shared_buckets(nodes.select("node", F.explode("buckets").alias("bucket")))
    at = stored(split_join(nodes, members.groupBy("node").agg(F.count(F.lit(1)).alias("held")), ["node"])
                .select("node", F.col("first.id").alias("id"), F.col("first.content").alias("content")), "wanted")
    field = docs.sparkSession.sparkContext.broadcast(content_field(at))
    sources = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("content"), text.alias("text"))
    fields = sources.select("id", "content", F.array(F.lit(0).cast("long")).alias("d")).schema
    made = sources.mapInArrow(_sets(size, field), fields)
    texts = at.alias("w").join(made.alias("s"), (F.col("w.content") == F.col("s.content")) & F.col("w.id").eqNullSafe(F.col("s.id")))
    sets = stored(texts.groupBy("node").agg(F.first("d").alias("d")), "sets")
    similar = _similar(percent)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among candidate pairs whose sizes and bits have passed: their full sets are compared."""
        side = lambda one: sets.select(F.col("node").alias(one), F.col("d").alias("d_" + one))
        return split_join(split_join(pairs, side("a"), ["a"]), side("b"), ["b"]).where(similar(F.col("d_a"), F.col("d_b"))).select("a", "b")

    rest, roots = hub_rounds(members, nodes.select("node", F.struct("n", "bits").alias("t")), _alike(percent), confirmed, ROUNDS_OF_HUBS)
    roots = merged(roots, stored(block_links(rest, sets, percent), "links"))
    classes = nodes.select("node", "key", "first").join(roots, "node", "left").select("key", "first", F.coalesce("root", "node").alias("top"))
    heads = classes.groupBy("top").agg(F.min("first").alias("head"))
    named = split_join(classes, heads, ["top"]).select("key", F.col("head.id").alias("low"), F.col("head.at").alias("head_at"))
    out = signed.select("row", "id", "at", "n", "key").join(named, "key", "left")
    alone = F.col("n") == 0
    return unpacked(out, carry, docs.columns, n_shingles=F.col("n"), component_id=F.when(alone, F.col("id")).otherwise(F.col("low")),
                    kept=alone | (F.col("at") == F.col("head_at")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, with the columns of the input."""
    rows = docs.select(F.struct("*").alias("doc"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    return near_groups(rows, "id", "text", carry=["doc"], **options).where("kept").select("doc.*")
