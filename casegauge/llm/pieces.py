"""SentencePiece encoding and decoding for merge-type (BPE) models.

A text is encoded exactly by backtracking: Aho-Corasick gives the longest piece at each position; a piece
may follow its predecessor only if re-merging the two would not have joined across their border; where
nothing fits, the encoder steps back, and a bitfield keeps the positions that have failed. Where no
piece holds a word mark behind another character, words are encoded one by one and remembered in a
bounded cache of the worker. Pieces that share one score (runs of word marks in some models) have no
merge order of their own: where one of them can occur, the word is merged step by step instead.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from casegauge.llm.common import in_parts, packed, text_bytes, texts_of, unpacked, with_columns

MARK = "▁"
CACHE = 350_000  # words in each half of a worker's memory
PAIR_CACHE = 300_000
LONGEST = 64  # characters of the longest word that the cache holds
BAD = "�"


class Merges:
    """The pieces of a model in the order of their merges, and how each one arises.

    Tokens are numbered by merge order: characters first, then pieces from the earliest merge on. Pieces of
    equal score are `tied` and left out of that order."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        shared = Counter(score for p, score, _ in pieces if len(p) > 1)
        longer = sorted((p for p in pieces if len(p[0]) > 1 and shared[p[1]] == 1), key=lambda p: -p[1])
        tied = sorted((p for p, score, _ in pieces if len(p) > 1 and shared[score] > 1), key=len)
        self.tied: list[str] = []  # those that hold no other
        for p in tied:
            if not any(q in p for q in self.tied):
                self.tied.append(p)
        self.score = {p: score for p, score, _ in pieces if len(p) > 1}
        self.own = {p: i for p, _, i in pieces}
        chars = sorted({c for p, _, _ in pieces for c in p})
        self.text: list[str] = []
        self.number: dict[str, int] = {}
        self.split: list[tuple[int, int] | None] = []
        self.pair: dict[tuple[int, int], int] = {}
        for c in chars:
            self._add(c, None)
        for p, _, _ in longer:
            for cut in range(1, len(p)):
                a, b = self.number.get(p[:cut]), self.number.get(p[cut:])
                if a is not None and b is not None and self.fit(a, b):
                    self.pair[a, b] = self._add(p, (a, b))
                    break
        self.shorter: list[int | None] = []
        for p in self.text:
            self.shorter.append(next((self.number[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.number), None))
        self.ids = [self.own.get(p, p) for p in self.text]
        self.length = [len(p) for p in self.text]
        self.fits = _Fits(self)
        self.automaton = ahocorasick.Automaton()
        for p, t in self.number.items():
            self.automaton.add_word(p, t)
        self.automaton.make_automaton()

    def _add(self, piece: str, split: tuple[int, int] | None) -> int:
        t = self.number[piece] = len(self.text)
        self.text.append(piece), self.split.append(split)
        return t

    def fit(self, left: int, right: int) -> bool:
        """Whether two neighbours stay apart: undo their merges from the latest on and see if the parts at the border
        would have merged before. Of equal merges the left one comes first."""
        latest = len(self.split) + 1
        while True:
            joined = self.pair.get((left, right))
            if joined is not None and joined < latest:
                return False
            undo_left = self.split[left] is not None and (left > right or self.split[right] is None)
            if undo_left:
                latest, left = left, self.split[left][1]
            elif self.split[right] is not None:
                latest, right = right + 1, self.split[right][0]
            else:
                return True

    def merged(self, text: str) -> list[str]:
        """Pieces by merging step by step: the best score first, of equal ones the left one."""
        n = len(text)
        part, left, right = list(text), list(range(-1, n - 1)), list(range(1, n + 1))
        queue: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            score = self.score.get(part[a] + part[b])
            if score is not None:
                heapq.heappush(queue, (-score, a, b, len(part[a]) + len(part[b])))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, a, b, size = heapq.heappop(queue)
            if not part[a] or not part[b] or len(part[a]) + len(part[b]) != size:
                continue
            part[a], part[b] = part[a] + part[b], ""
            right[a] = right[b]
            if right[b] < n:
                left[right[b]] = a
                offer(a, right[b])
            if left[a] >= 0:
                offer(left[a], a)
        return [p for p in part if p]

    def encode(self, text: str) -> list[int | str]:
        """Ids of the pieces of a text of known characters; a character that is no piece stands for itself."""
        for p in self.tied:
            if p in text:
                return [self.own.get(piece, piece) for piece in self.merged(text)]
        return [self.ids[t] for t in self._backtracked(text)]

    def _backtracked(self, text: str) -> list[int]:
        n, length, shorter, fits = len(text), self.length, self.shorter, self.fits
        longest = [0] * (n + 1)
        for end, t in self.automaton.iter(text):  # for a start, later ends are longer
            longest[end - length[t] + 1] = t
        open_ = bytearray(b"\x01") * (n + 1)  # cleared where no encoding goes on
        out: list[int] = []
        at, t, last = 0, longest[0], -1
        while at < n:
            end = at + length[t]
            if open_[end] and (last < 0 or fits[last, t]):
                out.append(t)
                at, last, t = end, t, longest[end]
            elif shorter[t] is not None:
                t = shorter[t]
            else:
                open_[at] = 0
                t = out.pop()
                at -= length[t]
                last = out[-1] if out else -1
        return out


class _Fits(dict):
    """Answers of `Merges.fit`, remembered up to a bound."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= PAIR_CACHE:
            self.clear()
        answer = self[pair] = self.merges.fit(*pair)
        return answer


class _Recent(dict):
    """Ids of words, as bytes. When full, it becomes the older half of the memory, from which words in use come back."""

    def __init__(self, ids: Callable[[str], list[int]]):
        super().__init__()
        self.ids, self.older = ids, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = array("i", self.ids(word)).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= CACHE:
                self.older = self.copy()
                self.clear()
            self[word] = found
        return found


class Pieces:
    """A model file: normalisation, encoding and decoding."""

    _loaded: dict[str, Pieces] = {}

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        kind = proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or any(p.type == kind.USER_DEFINED for p in model.pieces):
            raise ValueError("a merge-type model without user-defined pieces is needed")
        normal = [(p.piece, p.score, i) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
        self.merges = Merges(normal)
        spec = model.normalizer_spec
        self.prefix = spec.add_dummy_prefix
        self.simple = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces \
            and not model.trainer_spec.treat_whitespace_as_suffix
        self.end, self.unknown = self.library.eos_id(), self.library.unk_id()
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.known = set(self.merges.text) & {c for c in self.merges.text if len(c) == 1}
        self.bare = any(isinstance(i, str) for i in self.merges.ids)  # characters of pieces that are no pieces
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p, _, _ in normal)
        self.words = (lambda s: [s] if s else []) if crossing else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.raw = [p.piece.replace(MARK, " ").encode() if p.type == kind.NORMAL else b"" for p in model.pieces]
        for value, i in self.byte.items():
            self.raw[i] = bytes([value])
        self.raw[self.unknown] = model.trainer_spec.unk_surface.encode()
        self.silent = {i for i, r in enumerate(self.raw) if not r}  # control pieces; they part runs of byte pieces
        self.is_byte = {i for i in self.byte.values()}
        self.cache = _Recent(self._word)

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def normalised(self, text: str) -> str:
        if not self.simple:
            return self.library.normalize(text)
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def _others(self, text: str) -> list[int]:
        """Characters that are no pieces: their bytes, or one unknown piece for the run."""
        if self.byte:
            return [self.byte[b] for b in text.encode()]
        return [self.unknown] if text else []

    def _known(self, word: str) -> list[int]:
        """Ids of a word of characters that occur in pieces."""
        ids = self.merges.encode(word)
        if self.bare and any(isinstance(i, str) for i in ids):
            ids = [j for i in ids for j in (self._others(i) if isinstance(i, str) else (i,))]
        return ids

    def _word(self, word: str) -> list[int]:
        if self.known.issuperset(word):
            return self._known(word)
        ids: list[int] = []
        start = 0
        while start < len(word):
            stop = start
            known = word[start] in self.known
            while stop < len(word) and (word[stop] in self.known) == known:
                stop += 1
            ids += self._known(word[start:stop]) if known else self._others(word[start:stop])
            start = stop
        return ids

    def encode(self, text: str, end: bool = True) -> np.ndarray:
        ids = np.frombuffer(b"".join(map(self.cache.__getitem__, self.words(self.normalised(text)))), np.int32)
        return np.append(ids, np.int32(self.end)) if end else ids

    def decode(self, ids: list[int]) -> str:
        try:
            text = b"".join(map(self.raw.__getitem__, ids)).decode() if self.silent.isdisjoint(ids[1:-1]) else self._mended(ids)
        except UnicodeDecodeError:  # byte pieces that form no character
            text = self._mended(ids)
        return text[1:] if self.prefix and self._marked_first(ids) else text

    def _marked_first(self, ids: list[int]) -> bool:
        """Whether the first piece with a text begins with the word mark that encoding puts in front."""
        first = next((i for i in ids if self.raw[i]), None)
        return first is not None and first != self.unknown and first not in self.is_byte and self.raw[first].startswith(b" ")

    def _mended(self, ids: list[int]) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            i = 0
            while i < len(run):
                for k in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[i:i + k]).decode())
                        i += k
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append(BAD)
                    i += 1
            run.clear()

        for i in ids:
            if i in self.is_byte:
                run.extend(self.raw[i])
            else:
                flush()
                out.append(self.raw[i].decode())
        flush()
        return "".join(out)


def _round_trip(path: str, end: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces.of(path)
        for batch in in_parts(batches):
            ids, texts = [], []
            for raw in texts_of(batch, "text"):
                got = model.encode(raw.decode("utf-8", "replace"), end)
                ids.append(got)
                texts.append(model.decode(got.tolist()))
            yield with_columns(batch, ["text"], ids=lists(ids), decoded=pa.array(texts, pa.string()))
    return run


def lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _decode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces.of(path)
        for batch in batches:
            texts = [model.decode([i for i in ids or [] if i is not None]) for ids in batch.column("ids").to_pylist()]
            yield with_columns(batch, ["ids"], decoded=pa.array(texts, pa.string()))
    return run


def encoded(docs: DataFrame, path: str, text_col: str = "text", end: bool = True, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `ids` (array of int, as the library encodes the text with the model at `path`; the end id
    last if `end`) and `decoded`, the text made from those ids.

    A null text counts as empty: it has only the end id. Repeated rows are encoded one by one; an empty table gives
    an empty result. `carry` names the columns passed on (None: all); a result column replaces an input column of
    its name."""
    rows = packed(docs, carry, text=text_bytes(docs[text_col]))
    schema = rows.select("row", F.array(F.lit(0)).alias("ids"), F.lit("").alias("decoded")).schema
    out = rows.mapInArrow(_round_trip(path, end), schema)
    return unpacked(out, carry, docs.columns, ids=F.col("ids"), decoded=F.col("decoded"))


def decoded(rows: DataFrame, path: str, ids_col: str = "ids", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `decoded`, the text of its ids; null ids make an empty text, null entries are passed over."""
    packs = packed(rows, carry, ids=rows[ids_col].cast("array<int>"))
    out = packs.mapInArrow(_decode(path), packs.select("row", F.lit("").alias("decoded")).schema)
    return unpacked(out, carry, rows.columns, decoded=F.col("decoded"))


def ids_digest(ids) -> object:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(F.transform(ids, lambda i: i.cast("string")), " "), 256)
