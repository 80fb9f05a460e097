"""Fill-in-the-middle: a text cut at two points and put together in another order.

The bytes of a text are counted in blocks of a fixed size: units (code points, words or lines) that begin in a block, and
code points. Two Fenwick trees over the blocks hold the counts. A cut after k units is found by binary lifting: the descent
over the tree names the block in which unit k + 1 begins, and only that block is searched for the byte. The code points in
front of the cut come from the second tree and the part of the block before it.

Cuts and forms follow from the identifier alone, so a rerun or another partitioning gives the same rows. Tasks work on
Arrow batches where the documents lie; nothing is shuffled."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.llm.common import packed, text_bytes, texts_of, unpacked, with_columns

BLOCK = 4096  # bytes
# fixed values: the marks in front of prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # percent


class Fenwick:
    """Sums over leading blocks, and the search for the block in which a sum is passed."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        self.sums = np.concatenate([[0], counts]).astype(np.int64)
        for i in range(1, n + 1):
            up = i + (i & -i)
            if up <= n:
                self.sums[up] += self.sums[i]
        self.top = 1 << (n.bit_length() - 1) if n else 0

    def before(self, block: int) -> int:
        """Sum over the blocks in front of `block`."""
        total = 0
        while block:
            total += int(self.sums[block])
            block &= block - 1
        return total

    def holding(self, k: int) -> tuple[int, int]:
        """The block that holds item k (from 0), and the number of items in front of that block; the number of blocks if
        there are not so many."""
        at, left, step = 0, k, self.top
        while step:
            to = at + step
            if to < len(self.sums) and self.sums[to] <= left:
                at, left = to, left - int(self.sums[to])
            step >>= 1
        return at, k - left


def characters(text: np.ndarray) -> np.ndarray:
    """Where code points of UTF-8 begin."""
    return (text & 0xC0) != 0x80


def words(text: np.ndarray) -> np.ndarray:
    """Where words begin: a run of blanks belongs to the word in front of it, at the start of a text to the first word."""
    blank = (text == 0x20) | ((text >= 0x09) & (text <= 0x0D))
    starts = ~blank
    starts[1:] &= blank[:-1]
    if len(text) and blank[0]:
        first = int(np.argmax(starts))
        starts[first], starts[0] = False, True
    elif len(text):
        starts[0] = True
    return starts


def lines(text: np.ndarray) -> np.ndarray:
    """Where lines begin; a line ends with its line feed."""
    starts = np.zeros(len(text), bool)
    starts[:1] = True
    starts[1:] = text[:-1] == 0x0A
    return starts


UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"char": characters, "word": words, "line": lines}


class Cuts:
    """The places between the units of one text."""

    def __init__(self, text: bytes, unit: str = "char", block: int = BLOCK):
        self.text, self.block = np.frombuffer(text, np.uint8), block
        self.starts, self.points = UNITS[unit](self.text), characters(self.text)
        edges = np.arange(0, len(text), block)
        count = lambda flags: np.add.reduceat(flags.astype(np.int64), edges) if len(edges) else np.zeros(0, np.int64)
        units, points = count(self.starts), count(self.points)
        self.n = int(units.sum())
        self.units, self.code_points = Fenwick(units), Fenwick(points)

    def after(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first k units."""
        block, passed = self.units.holding(k)
        low = block * self.block
        if low >= len(self.text):
            return len(self.text), self.code_points.before(len(self.code_points.sums) - 1)
        inside = int(np.flatnonzero(self.starts[low:low + self.block])[k - passed])
        return low + inside, self.code_points.before(block) + int(np.count_nonzero(self.points[low:low + inside]))


def draws(key: object, seed: int = 1) -> list[int]:
    """Four numbers from the seed and an identifier (null: nothing after the colon)."""
    name = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(name[i:i + 8], 16) for i in range(0, 32, 8)]


def arranged(text: bytes, key: object, unit: str = "char", seed: int = 1, plain_from: int = PLAIN_FROM,
             spm_below: int = SPM_BELOW, block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle (none if plain), and the text in its new order."""
    cuts = Cuts(text, unit, block)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= plain_from:
        return cuts.n, "plain", None, None, text
    low, high = sorted((h1 % (cuts.n + 1), h2 % (cuts.n + 1)))
    (a, before), (b, upto) = cuts.after(low), cuts.after(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_below:
        return cuts.n, "spm", before, upto - before, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return cuts.n, "psm", before, upto - before, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def _arrange(unit: str, seed: int, plain_from: int, spm_below: int, block: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            rows = [arranged(t, k, unit, seed, plain_from, spm_below, block) for t, k in zip(texts_of(batch, "text"), keys)]
            n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
            yield with_columns(batch, ["text", "key"], n=pa.array(n, pa.int64()), form=pa.array(form, pa.string()),
                               prefix_chars=pa.array(prefix, pa.int64()), middle_chars=pa.array(middle, pa.int64()),
                               output=pa.array(output, pa.binary()))
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", seed: int = 1,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW, block: int = BLOCK,
                   carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `n` (units of its text), `form`, `prefix_chars`, `middle_chars` (code points; null if plain) and `output`.

    `unit` is char (code points), word or line. The form is plain (the text as it is) for an empty or null text, for one that
    holds a mark, and for a share of 100 - `plain_from` percent; of the others `spm_below` percent have the suffix first. Rows
    with the same identifier are cut by the same numbers; a null identifier is a key of its own. Repeated rows are arranged one
    by one; an empty table gives an empty result. `carry` names the columns passed on (None: all); a result column replaces
    an input column of its name."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")
    rows = packed(docs, carry, key=docs[id_col].cast("string"), text=text_bytes(docs[text_col]))
    number = F.lit(0).cast("long")
    schema = rows.select("row", number.alias("n"), F.lit("").alias("form"), number.alias("prefix_chars"), number.alias("middle_chars"),
                         F.lit(b"").alias("output")).schema
    for name in ("prefix_chars", "middle_chars"):
        schema[name].nullable = True
    out = rows.mapInArrow(_arrange(unit, seed, plain_from, spm_below, block), schema)
    return unpacked(out, carry, docs.columns, **{c: F.col(c) for c in ("n", "form", "prefix_chars", "middle_chars")},
                    output=F.decode("output", "utf-8"))


def restored(rows: DataFrame, output_col: str = "output", form_col: str = "form", name: str = "restored") -> DataFrame:
    """Every row with the text that its output was made from. A null output gives null."""
    marks = "|".join(m.decode() for m in (PREFIX, SUFFIX, MIDDLE))
    parts: Column = F.split(rows[output_col], marks, -1)
    psm = F.col("_form") == "psm"
    held = rows.select("*", rows[form_col].alias("_form"), F.when(rows[form_col] != "plain", parts).alias("_parts"))
    part = lambda first, second: F.get("_parts", F.when(psm, F.lit(first)).otherwise(F.lit(second)))
    text = F.concat(part(1, 2), part(3, 3), part(2, 1))
    return held.select(*[held[c] for c in rows.columns if c != name], F.when(F.col("_form") == "plain", held[output_col]).otherwise(text).alias(name))
