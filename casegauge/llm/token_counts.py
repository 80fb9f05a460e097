"""Token counts by a two-tier lookup on the map side.

The lengths (in tokens) of frequent pre-tokens are found once, on a bounded sample of documents, and
broadcast as a compact table of at most `table_size` entries. Every worker splits its texts into
pre-tokens and adds up lengths; what the table does not hold is encoded by the library and remembered in
a bounded cache. The table and the cache only save time: counts are the library's for any sample. No
pre-token of the corpus is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from casegauge.llm.common import packed, text_bytes, texts_of, unpacked, with_columns, workers_find_package

SAMPLE_ROWS = 5_000  # documents from which the frequent pre-tokens are taken
TABLE_SIZE = 20_000
CACHE = 200_000
LONGEST = 64  # characters of the longest pre-token that table and cache hold
# fixed value: the split pattern of byte-level vocabularies of this kind
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Lengths(dict):
    """Tokens of a pre-token: broadcast table first, then the library, with a bounded memory."""

    def __init__(self, table: dict[str, int], encode: Callable[[str], int]):
        super().__init__(table)
        self.table, self.encode = table, encode

    def __missing__(self, piece: str) -> int:
        n = self.encode(piece)
        if len(piece) <= LONGEST:
            if len(self) >= len(self.table) + CACHE:
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n


class Counting:
    """The tokenizer of a file with its split into pre-tokens."""

    _loaded: dict[str, Counting] = {}

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.split = regex.compile(PATTERN).findall
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    @classmethod
    def of(cls, path: str) -> Counting:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def plain(self, text: str) -> bool:
        """Whether the text holds no string of an added token: those the library itself must find."""
        return self.added is None or self.added.search(text) is None

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)


def _frequent(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting, seen = Counting.of(path), Counter()
        for batch in batches:
            for raw in texts_of(batch, "text"):
                seen.update(p for p in counting.split(raw.decode("utf-8", "replace")) if len(p) <= LONGEST)
        pairs = seen.most_common(TABLE_SIZE)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.string()), pa.array([n for _, n in pairs], pa.int64())],
                                         ["piece", "n"])
    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
                     table_size: int = TABLE_SIZE) -> dict[str, int]:
    """The tier that is broadcast: at most `table_size` pre-tokens with their lengths."""
    workers_find_package(docs.sparkSession)
    rows = docs.select(text_bytes(docs[text_col]).alias("text"))
    total = docs.count()
    if not total:
        return {}
    sample = rows.sample(min(1.0, sample_rows / total), seed=7)
    top = (sample.mapInArrow(_frequent(path), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(table_size).collect())  # bounded by table_size
    counting = Counting.of(path)
    return {r.piece: counting.whole(r.piece) for r in top if counting.plain(r.piece)}


def _count(path: str, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting.of(path)
        lengths = Lengths(shared.value, counting.whole)
        for batch in batches:
            tokens, size = [], []
            for raw in texts_of(batch, "text"):
                text = raw.decode("utf-8", "replace")
                tokens.append(sum(map(lengths.__getitem__, counting.split(text))) if counting.plain(text) else counting.whole(text))
                size.append(len(raw))
            yield with_columns(batch, ["text"], n_bytes=pa.array(size, pa.int64()), n_tokens=pa.array(tokens, pa.int64()))
    return run


def token_counts(docs: DataFrame, path: str, text_col: str = "text", limit: int = 512, sample_rows: int = SAMPLE_ROWS,
                 table_size: int = TABLE_SIZE, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `n_bytes` (UTF-8), `n_tokens` (as the byte-level tokenizer file at `path` gives them, without added
    begin or end, nothing truncated) and `over_limit`.

    Null and empty texts have no tokens. The string of an added token inside a text is that token. Repeated rows are
    counted one by one; an empty table gives an empty result. `carry` names the columns passed on (None: all); a
    result column replaces an input column of its name."""
    table = frequent_lengths(docs, path, text_col, sample_rows, table_size)
    rows = packed(docs, carry, text=text_bytes(docs[text_col]))
    schema = rows.select("row", F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens")).schema
    out = rows.mapInArrow(_count(path, docs.sparkSession.sparkContext.broadcast(table)), schema)
    return unpacked(out, carry, docs.columns, n_bytes=F.col("n_bytes"), n_tokens=F.col("n_tokens"),
                    over_limit=F.col("n_tokens") > limit)
