"""Helpers shared by the operators: packed rows, hashed words, windows of words, digests."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.session import dropped, passing, stored

PART = 500  # rows that a worker handles at once
WORD_CACHE = 300_000  # entries of a worker's word cache; it is emptied when full
BASE = np.uint64(0x9E3779B97F4A7C15)


@contextlib.contextmanager
def small_batches(spark) -> Iterator[None]:
    """While it holds, workers of what is stored get batches of PART rows: a batch of texts lies in the executor and in the worker as a whole."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(PART))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def workers_find_package(spark) -> None:
    """Put the folder of this package on the Python path of workers that are started from here on (in local
    mode they otherwise look into the working directory; a cluster has the package installed)."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def packed(docs: DataFrame, carry: Sequence[str] | None, **parts: Column) -> DataFrame:
    """The columns that an operator needs under its own names, and those it passes on inside one
    struct `row`, so that no name of the input can clash with an internal one. `carry` names the
    columns to pass on (None: all)."""
    workers_find_package(docs.sparkSession)
    names = docs.columns if carry is None else list(carry)
    row = F.struct(*[docs[c] for c in names]) if names else F.struct(F.lit(0).alias("none"))
    return docs.select(row.alias("row"), *[c.alias(n) for n, c in parts.items()])


def unpacked(df: DataFrame, carry: Sequence[str] | None, columns: Sequence[str], **new: Column) -> DataFrame:
    """The passed-on columns with `new` ones; a new column replaces a passed-on one of its name."""
    names = list(columns) if carry is None else list(carry)
    kept = [F.col("row").getField(c).alias(c) for c in names if c.lower() not in {n.lower() for n in new}]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])


def text_bytes(text: Column) -> Column:
    """A text as UTF-8; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finishing step of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Hashes of spans of a sequence in constant time each: a polynomial over the word hashes
    modulo 2**64, from prefix sums. Equal sequences of words have equal hashes wherever they stand."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, hashes: np.ndarray, base: np.uint64 = BASE):
        n = len(hashes)
        up, down = self.powers(n + 1, base)
        self.down = down
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=self.sums[1:])

    @classmethod
    def powers(cls, n: int, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(int(base))
        if have is None or len(have[0]) < n:
            size = max(n, 4096)
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            have = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]))
                         for b in (base, inverse))
            cls._powers[int(base)] = have
        return have

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from start to end (not included), for arrays of positions."""
        length = (end - start).astype(np.uint64)
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + length * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, k: int) -> np.ndarray:
        """Hashes of all windows of k words."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        start = np.arange(n)
        return self.between(start, start + k)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n positions lie in one of the spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps[:n]) > 0


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = PART) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows: what a worker makes of a part is handed on before the next one. At the end, memory
    that is free is given back: workers live on and serve other operators."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def texts_of(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The values of a binary column one by one, null as empty."""
    for value in batch.column(name):
        yield value.as_py() or b""


def with_columns(batch: pa.RecordBatch, drop: Sequence[str], **new: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(new.values()), names + list(new))


def as_signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)
