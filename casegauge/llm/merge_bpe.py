"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The symbols of a pre-token stand in the leaves' order; the leaf of a symbol holds the rank of its pair with the next
one. Every inner node holds the smaller of its two children, so the root names the leftmost pair of the lowest rank.
A merge changes at most three leaves (the pair before, the merged one, and the one that disappears), each mended on its
way to the root, until the root holds no pair: n log n steps for n symbols, however long the pre-token is.

Tasks work on Arrow batches where the documents lie: nothing is shuffled. A worker remembers the ids of words up to a
bound; memory is bounded by that, one batch and its longest text."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from casegauge.llm.common import in_parts, packed, text_bytes, texts_of, unpacked, with_columns

CACHE = 150_000  # entries in each half of a worker's memory
LONGEST = 64  # bytes of the longest word that is remembered
PAIR = 20  # bits of an id inside the key of a pair
# Printable characters up to U+017F: none of them combines with another one, and their classes and lower case are the same
# in every version of Unicode. Words made of them are split here, all others by the library's own normaliser and splitter.
SIMPLE = re.compile("[!-~¡-ſ]+").fullmatch


def _spelled_out(pattern: str) -> str:
    """A pattern whose classes of letters and numbers, which stand in brackets, are listed for the simple characters."""
    simple = [chr(c) for c in range(0x21, 0x180) if SIMPLE(chr(c))]
    for name in "LN":
        listed = "".join(re.escape(c) for c in simple if unicodedata.category(c)[0] == name)
        pattern = pattern.replace(rf"\p{{{name}}}", listed)
    return pattern


class MergeTree:
    """The merges of a vocabulary: ranks and results by pair of ids."""

    def __init__(self, vocab: dict[str, int], merges: Sequence[Sequence[str]]):
        if len(vocab) >= 1 << PAIR:
            raise ValueError(f"a vocabulary of {len(vocab)} entries is too large")
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for left, right in merges:
            pair = vocab[left] << PAIR | vocab[right]
            self.rank[pair] = len(self.made)  # of a pair listed twice the later rank holds, as in the library's table
            self.made.append(vocab[left + right])

    def merged(self, ids: list[int]) -> list[int]:
        """The symbols after all merges: always the leftmost pair of the lowest rank."""
        n, rank, made = len(ids), self.rank, self.made
        if n < 2:
            return ids
        bits = (n - 2).bit_length()
        size = 1 << bits
        none = (len(made) + 1) << bits
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = rank.get(ids[i] << PAIR | ids[i + 1])
            if r is not None:
                tree[size + i] = r << bits | i  # the position makes the leftmost of equal ranks the smallest
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        low, mask = tree[1], size - 1
        while low < none:
            i = low & mask
            gone = after[i]
            new = ids[i] = made[low >> bits]
            ids[gone] = -1
            end = after[i] = after[gone]
            x = y = z = size + i  # the leaves that change: of the pair before, of this one, and of the one that disappears
            if end < n:
                before[end] = i
                r = rank.get(new << PAIR | ids[end])
                tree[y] = none if r is None else r << bits | i
                z = size + gone
                tree[z] = none
            else:
                tree[y] = none
            first = before[i]
            if first >= 0:
                r = rank.get(ids[first] << PAIR | new)
                x = size + first
                tree[x] = none if r is None else r << bits | first
            while z > 1:  # mended together, level by level
                x >>= 1
                y >>= 1
                z >>= 1
                a, b = tree[2 * y], tree[2 * y + 1]
                tree[y] = a if a < b else b
                if x != y:
                    a, b = tree[2 * x], tree[2 * x + 1]
                    tree[x] = a if a < b else b
                if z != y:
                    a, b = tree[2 * z], tree[2 * z + 1]
                    tree[z] = a if a < b else b
            low = tree[1]
        return [i for i in ids if i >= 0]


class _Memory(dict):
    """Ids by word. When full it becomes the older half, from which words still in use come back."""

    def __init__(self, find: Callable):
        super().__init__()
        self.find, self.older = find, {}

    def __missing__(self, word):
        found = self.older.get(word)
        if found is None:
            found = self.find(word)
        if len(word) <= LONGEST:
            if len(self) >= CACHE:
                self.older = self.copy()
                self.clear()
            self[word] = found
        return found


def byte_characters() -> list[str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from
    U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class BytePairs:
    """A tokenizer file of byte-level BPE whose pre-tokens hold no blanks. Other kinds of files are refused."""

    _loaded: dict[str, BytePairs] = {}

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        model, split = spec["model"], self._split_of(spec.get("pre_tokenizer"))
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or not plain or split is None or not self._known(spec.get("normalizer")):
            raise ValueError(f"{path}: not a byte-level BPE file with pre-tokens free of blanks")
        if spec.get("post_processor") is not None or spec.get("decoder") is not None:
            raise ValueError(f"{path}: post-processors and decoders are not handled")
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        letters = byte_characters()
        self.inner, self.last = [vocab[c] for c in letters], [vocab[c + suffix] for c in letters]
        self.value = {c: b for b, c in enumerate(letters)}
        self.tree = MergeTree(vocab, [m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        self.parts = re.compile(_spelled_out(split)).findall
        self.normalise, self.pretokens = self.library.normalizer.normalize_str, self.library.pre_tokenizer.pre_tokenize_str
        added = self.library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError(f"{path}: added tokens with own matching rules are not handled")
        self.added = {t.content.encode(): i for i, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if added else None
        names = {i: t for t, i in vocab.items()} | {i: t.content for i, t in added.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.ids, self.words = _Memory(self._chunk), _Memory(self._word)

    @staticmethod
    def _split_of(spec: dict | None) -> str | None:
        """The pattern of pre-tokens, if it is followed by the byte level alone and finds no blanks."""
        steps = (spec or {}).get("pretokenizers", [])
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[1]["add_prefix_space"] or steps[1]["use_regex"]:
            return None
        pattern = steps[0]["pattern"].get("Regex")
        found = steps[0]["behavior"] == "Removed" and steps[0]["invert"] and pattern
        blank = found and any(re.search(r"\s", m) for m in regex.findall(pattern, "a b\n1  . \t'!\r\n\f\v x"))
        outside = found and r"\p" in re.sub(r"\[[^]]*\]", "", pattern)
        return pattern if found and not blank and not outside else None

    @staticmethod
    def _known(spec: dict | None) -> bool:
        steps = (spec or {}).get("normalizers", [])
        blanks = [s for s in steps if s["type"] == "Replace"]
        return [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and blanks[0]["pattern"] == {"Regex": r"\s+"} \
            and blanks[0]["content"] == " "

    @classmethod
    def of(cls, path: str) -> BytePairs:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _word(self, word: str) -> bytes:
        """Ids of a pre-token, given in plain characters."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return array("i", self.tree.merged(ids)).tobytes()

    def _chunk(self, raw: bytes) -> bytes:
        """Ids of a run without ASCII blanks. Pre-tokens hold no blanks and no step of the normaliser looks over one, so
        runs are encoded one by one."""
        text = raw.decode("utf-8", "replace")
        if SIMPLE(text):
            words = self.parts(text.lower())
        else:
            words = [bytes(map(self.value.__getitem__, w)).decode() for w, _ in self.pretokens(self.normalise(text))]
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: bytes) -> np.ndarray:
        if self.special is None or self.special.search(text) is None:
            return np.frombuffer(b"".join(map(self.ids.__getitem__, text.split())), np.int32)
        out = []
        for part in self.special.split(text):
            found = self.added.get(part)
            out.append(b"".join(map(self.ids.__getitem__, part.split())) if found is None else array("i", [found]).tobytes())
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Sequence[int]) -> str:
        """The tokens with blanks between them, as the library puts them together for a file without a decoder; ids that it does
        not know are passed over."""
        try:
            return " ".join(map(self.names.__getitem__, ids))
        except IndexError:
            return " ".join(self.names[i] for i in ids if i < len(self.names))


def lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *rows]), pa.int32()))


def _round_trip(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BytePairs.of(path)
        for batch in in_parts(batches):
            ids = [model.encode(raw) for raw in texts_of(batch, "text")]
            texts = [model.decode(i.tolist()) for i in ids]
            yield with_columns(batch, ["text"], ids=lists(ids), decoded=pa.array(texts, pa.string()))
    return run


def _decode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BytePairs.of(path)
        for batch in batches:
            texts = [model.decode([i for i in ids or [] if i is not None]) for ids in batch.column("ids").to_pylist()]
            yield with_columns(batch, ["ids"], decoded=pa.array(texts, pa.string()))
    return run


def encoded(docs: DataFrame, path: str, text_col: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `ids` (array of int, as the library encodes the whole text with the file at `path`, nothing added) and
    `decoded`, the text that the library makes from those ids, special tokens included.

    A null text counts as empty and has no ids; so has one of blanks. The string of an added token inside a text is that
    token. Repeated rows are encoded one by one; an empty table gives an empty result. `carry` names the columns passed on
    (None: all); a result column replaces an input column of its name."""
    rows = packed(docs, carry, text=text_bytes(docs[text_col]))
    schema = rows.select("row", F.array(F.lit(0)).alias("ids"), F.lit("").alias("decoded")).schema
    out = rows.mapInArrow(_round_trip(path), schema)
    return unpacked(out, carry, docs.columns, ids=F.col("ids"), decoded=F.col("decoded"))


def decoded(rows: DataFrame, path: str, ids_col: str = "ids", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `decoded`, the text of its ids; null ids make an empty text, null entries are passed over."""
    packs = packed(rows, carry, ids=rows[ids_col].cast("array<int>"))
    out = packs.mapInArrow(_decode(path), packs.select("row", F.lit("").alias("decoded")).schema)
    return unpacked(out, carry, rows.columns, decoded=F.col("decoded"))
