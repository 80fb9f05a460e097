"""Vector codes: every vector as the numbers of the nearest codebook entries of its parts, in whole numbers throughout.

Codebooks come from Lloyd's rounds over members that stay where they are. A member is one part of one vector; members are
partitioned by (position, entry, salt), the owner of that piece of an entry. A round has three steps:

1. Owners add up their resident members; only one partial sum for each (position, entry) and task is shuffled, and the
   new codebook (positions x entries x width numbers, a bound set by parameters) is made from them.
2. Owners compare their members with the new entries of the position, and write them down again as staying or moving.
3. Only the moving members are shuffled, to their new owners; the staying ones are read where they lie.

The salt comes from the vector's identifier; its range grows with the number of vectors, so an entry that owns a third of
all members is spread over many tasks. Codes are made at the end where the vectors lie, with the last codebook broadcast.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegauge.llm.common import packed, stored, unpacked, with_columns
from casegauge.operators.spread import with_totals
from casegauge.session import scratch_dir

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
OWNED = 100_000  # vectors for each salt
SALTS = 16  # at least


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component of the rows. Squared distances of whole vectors must fit 64 bits: larger
    components raise."""
    out = np.floor(vectors.astype(np.float64) * scale)
    if out.size and np.abs(out).max() > (most := min(largest(out.shape[-1]), 2 ** 31 - 1)):
        raise ValueError(f"components beyond {most / scale:g} are not handled")
    return out.astype(np.int64)


def largest(dims: int) -> int:
    """The largest component for which the squared distance of two vectors stays below 2**63."""
    return math.isqrt((1 << 61) // max(1, dims))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest entry for rows of one position; the lower number of equal ones."""
    best, entry = np.full(len(parts), np.iinfo(np.int64).max), np.zeros(len(parts), np.int64)
    for i, e in enumerate(book):
        away = parts - e
        away *= away
        d = away.sum(axis=1)
        closer = d < best
        best[closer], entry[closer] = d[closer], i
    return entry, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column that has no nulls, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width) if len(column) else np.zeros((0, width))


def _placed(book: np.ndarray, dims: int, scale: int, salts: int) -> Callable:
    """One member for each part of a vector, at its first owner."""
    positions, _, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = whole_numbers(_matrix(batch.column("vector"), dims), scale).reshape(-1, positions, width)
            salt = np.asarray(batch.column("mark").to_numpy(zero_copy_only=False)) % salts
            for p in range(positions):
                entry, _ = nearest(parts[:, p], book[p])
                yield _members(np.full(len(parts), p), entry, salt, parts[:, p])
    return run


def _members(position, entry, salt, parts, moved=None) -> pa.RecordBatch:
    small = lambda x: pa.array(np.ascontiguousarray(x).astype(np.int32), pa.int32())
    columns = {"position": small(position), "entry": small(entry), "salt": small(salt)}
    columns |= {f"c{i}": small(parts[:, i]) for i in range(parts.shape[1])}
    if moved is not None:
        columns["moved"] = pa.array(moved)
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _judged(book: np.ndarray) -> Callable:
    """Members with their nearest entry now, and whether it is another one."""
    positions, _, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            position, old = take("position"), take("entry")
            parts = np.stack([take(f"c{i}") for i in range(width)], axis=1).astype(np.int64)
            entry = np.zeros(len(parts), np.int64)
            for p in np.unique(position):
                at = position == p
                entry[at], _ = nearest(parts[at], book[p])
            yield _members(position, entry, take("salt"), parts, entry != old)
    return run


def _coded(book: np.ndarray, dims: int, scale: int) -> Callable:
    positions, _, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = whole_numbers(_matrix(batch.column("vector"), dims), scale).reshape(-1, positions, width)
            codes, error = np.zeros((len(parts), positions), np.int64), np.zeros(len(parts), np.int64)
            for p in range(positions):
                codes[:, p], away = nearest(parts[:, p], book[p])
                error += away
            digits = max(2, (len(book[0]) - 1).bit_length() + 3 >> 2)
            text = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
            yield with_columns(batch, ["vector", "mark"], code=pa.array(text, pa.string()), error=pa.array(error, pa.int64()))
    return run


def usable(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and has neither null nor non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(vectors[vec_col].isNotNull() & ~F.exists(vectors[vec_col], bad))


def updated(book: np.ndarray, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> np.ndarray:
    """The codebook after a round: floor of the mean of an entry's parts; an entry without parts stays."""
    new = book.copy()
    for (position, entry), (count, total) in sums.items():
        new[position, entry] = [t // count for t in total]
    return new


def _sums(members: DataFrame, width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and sums of every entry that has members: at most positions x entries rows."""
    rows = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)])
    return {(r.position, r.entry): (r.n, [r[f"c{i}"] for i in range(width)]) for r in rows.collect()}


def _migrated(members: DataFrame, book: np.ndarray) -> DataFrame:
    """The members at their owners under a new codebook: those that keep their entry where they lie, the others after a
    shuffle."""
    spark = members.sparkSession
    path = scratch_dir(spark, "members")
    fields = ", ".join(f"{n} int" for n in members.columns)
    members.mapInArrow(_judged(book), f"{fields}, moved boolean").write.partitionBy("moved").parquet(path)
    both = spark.read.schema(f"{fields}, moved boolean").parquet(path)
    stay, move = (both.where(F.col("moved") == flag).drop("moved") for flag in (False, True))
    return stay.union(move.repartition("position", "entry", "salt"))


def codebooks(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
              rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Whole numbers by part, entry and position within the part; None without usable vectors.

    Each book begins with the parts of the vectors with the smallest identifiers (a null one comes last; of equal ones the
    smaller vector first), fewer entries if there are fewer vectors."""
    kept = usable(vectors, vec_col).select(vectors[id_col].alias("id"), vectors[vec_col].cast("array<double>").alias("vector"))
    size = F.size("vector")
    facts = kept.agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("low"), F.max(size).alias("high")).first()
    if not facts.n:
        return None
    if facts.low != facts.high or not facts.low or facts.low % parts:
        raise ValueError(f"vectors of {facts.low} to {facts.high} components cannot be cut into {parts} equal parts")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()  # bounded by the parameter
    seeds = whole_numbers(np.array([r.vector for r in first], np.float64), scale)
    book = seeds.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    width, salts = book.shape[2], max(SALTS, -(-facts.n // OWNED))

    rows = packed(vectors, [], id=vectors[id_col], vector=vectors[vec_col].cast("array<double>"))
    rows = usable(rows, "vector").select("vector", _mark())
    fields = ", ".join(["position int", "entry int", "salt int", *[f"c{i} int" for i in range(width)]])
    members = None
    for turn in range(rounds):
        if turn == 0:
            placed = rows.mapInArrow(_placed(book, facts.low, scale, salts), fields)
            members = stored(placed.repartition("position", "entry", "salt"), "owners")
        else:
            members = _migrated(members, book)
        book = updated(book, _sums(members, width))
    return book


def _mark():
    return F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 31)).alias("mark")


def book_digest(book: np.ndarray | None) -> str:
    """SHA-256 of all components by part, entry and position within the part, joined by commas."""
    return hashlib.sha256(",".join(map(str, [] if book is None else book.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, carry: Sequence[str] | None = None) -> DataFrame:
    """The usable rows with `code` (numbers of the nearest entries in part order, two hex digits each, more beyond 256 entries),
    `error` (squared distances to them, summed), `label_error` (errors summed over rows of the same label; null labels are one)
    and `codebooks_sha256`.

    Rows whose vector is null, or holds null or non-finite components, are dropped. Vectors must have one length that the
    parts divide, and components below 2**27 / scale: others raise. Repeated rows count as often as they stand. Ties go
    to the lower entry; an empty table gives an empty result. `carry` names the columns passed on (None: all); a result column
    replaces an input column of its name."""
    book = codebooks(vectors, id_col, vec_col, parts, entries, rounds, scale)
    rows = usable(packed(vectors, carry, label=vectors[label_col], vector=vectors[vec_col].cast("array<double>")), "vector")
    empty = np.zeros((parts, 1, 1), np.int64)
    schema = rows.select("row", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    dims = parts if book is None else book.shape[0] * book.shape[2]
    out = stored(rows.mapInArrow(_coded(empty if book is None else book, dims, scale), schema), "codes")
    out = with_totals(out, ["label"], label_error=F.sum("error"))
    return unpacked(out, carry, vectors.columns, code=F.col("code"), error=F.col("error"), label_error=F.col("label_error"),
                    codebooks_sha256=F.lit(book_digest(book)))
