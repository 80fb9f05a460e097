"""Quality and toxicity of documents by hierarchical empirical Bayes.

A logistic model over words, their beginnings and word shapes, fitted on labelled rows, gives each document's evidence. Sites
are hosts and, within them, paths. Grouped aggregation over all documents gives the expected number of good
(or toxic) documents of each site; host rates are shrunk toward the global rate and path rates toward their
host's, with strengths estimated from the spread of the rates (moments), so that sparse sites carry little
weight. A document's own share is taken out of its site before the site's rate becomes the prior of its
posterior.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from casegauge.llm.common import in_parts, packed, stored, text_bytes, texts_of, unpacked, with_columns, workers_find_package

PENALTY = 0.03  # of the absolute weights; divided by the root of the number of labels, as chance finds fall with it
MAX_LABELS = 20_000  # labelled rows that fit the model: those with the smallest hashes of their identifier
TRAIN_TASKS = 8  # each iteration sends the weights once per task
AT_ONCE = 60_000  # features that a fit takes as they are: vectors of half a megabyte; of more, those without a weight are kept out
HEADS = ("quality", "toxic")
LEVELS = (0.02, 0.1, 0.3)  # shares of the tokens
PREFIXES, TIMES = (5,), (2, 4)  # letters of a longer word's beginning, and how often it is met at least
WORD_CACHE = 50_000  # tokens, in each half of a memory
PASSAGE = 200  # tokens of a passage of a long text; passages overlap by half
_LETTERS = re.compile(r"[^\W\d_]+")
_RUNS = re.compile(r"(.)\1+", re.S)


_digest = xxhash.xxh64_intdigest


def _key(name: str) -> int:
    """A feature's key: 64 bits, so that no two features of a corpus share one."""
    return _digest(name.encode()) - (1 << 63)


def shape(token: str) -> str:
    """A token's look: letters as A or a, digits as 0, runs of the same sign as one with a plus."""
    look = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return _RUNS.sub(r"\1+", look)[:12].replace("A+a+", "a+").replace("Aa+", "a+")


def beginnings(words: Sequence[str]) -> list[str]:
    """The beginnings of longer words, by which forms of one word are known."""
    return [f"{k} {w[:k]}" for w in words for k in PREFIXES if len(w) > k]


class _Features(dict):
    """The keys of a token: one for each of its words, its look, and the beginnings of its words."""

    def __init__(self):
        super().__init__()
        self.levels: dict[str, list[int]] = {}
        self.repeats = [_key(f"r{level}") for level in LEVELS]

    def __missing__(self, token: str) -> tuple[tuple[int, ...], str, list[str]]:
        if len(self) >= WORD_CACHE:
            self.clear()
        words = _LETTERS.findall(token.lower())
        found = self[token] = (tuple(_key("w " + w) for w in words), shape(token), beginnings(words))
        return found

    def _look(self, look: str) -> list[int]:
        if len(self.levels) >= WORD_CACHE:
            self.levels.clear()
        found = self.levels[look] = [_key(x) for x in ("s " + look, *(f"s{level} {look}" for level in LEVELS))]
        return found

    def _met(self, tokens: list[str]) -> Counter:
        """How often beginnings are met: in a long text, in the passage that has most of each, so that a long text does not
        add up chance finds."""
        half = PASSAGE // 2
        if len(tokens) <= PASSAGE:
            return Counter(b for t in tokens for b in self[t][2])
        blocks = [Counter(b for t in tokens[i:i + half] for b in self[t][2]) for i in range(0, len(tokens), half)]
        most = Counter()
        for first, second in zip(blocks, blocks[1:]):
            most |= first + second
        return most

    def of(self, tokens: list[str]) -> set[int]:
        """Keys that a text switches on: its words, the looks of its tokens and how common they are, how often
        a token follows itself, and how often words begin alike."""
        keys: set[int] = set()
        looks: dict[str, int] = {}
        for token, times in Counter(tokens).items():
            words, look, _ = self[token]
            if words:
                keys.update(words)
            looks[look] = looks.get(look, 0) + times
        n = len(tokens)
        for look, k in looks.items():
            own = self.levels.get(look) or self._look(look)
            keys.add(own[0])
            keys.update(key for key, level in zip(own[1:], LEVELS) if k >= level * n)
        again = sum(map(str.__eq__, tokens, tokens[1:]))
        if again:
            keys.update(key for key, level in zip(self.repeats, LEVELS) if again >= level * n)
        keys.update(_key(f"b{times} {b}") for b, k in self._met(tokens).items() for times in TIMES if k >= times)
        return keys


class _Classes(dict):
    """Characters as the signs of a look, for str.translate."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        found = self[code] = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return found


class _Kinds(dict):
    """The kind of a token: which weighted words and beginnings it has, and which weighted look. Most tokens are of few kinds.

    When the memory is full it becomes the older half, from which tokens still in use come back. Kinds are numbered as they
    appear; `tidy`, between texts, forgets them all when there are too many."""

    def __init__(self, weights: dict[int, tuple[float, float]]):
        super().__init__()
        self.weights, self.classes, self.older = weights, _Classes(), {}
        self.hashes = {k + (1 << 63) for k in weights}  # as xxhash gives them
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.older, self.signs, self.places, self.numbers, self.begins, self.plain = {}, {}, {}, {}, {}, {}
        self.words: list[tuple[int, ...]] = []  # of a kind: keys
        self.looks: list[int] = []  # of a kind: place in look_weights, 0 for a look without weights
        self.starts: list[tuple[str, ...]] = []  # of a kind: beginnings with weights
        self.look_weights = [((0.0, 0.0),) * (1 + len(LEVELS))]

    def tidy(self) -> None:
        if max(len(self.words), len(self.signs), len(self.begins)) > WORD_CACHE:
            self.forget()

    def _look(self, signs: str) -> int:
        look = _RUNS.sub(r"\1+", signs)[:12].replace("A+a+", "a+").replace("Aa+", "a+")
        if look not in self.places:
            names = ["s " + look, *(f"s{level} {look}" for level in LEVELS)]
            rows = tuple(self.weights.get(_key(x), (0.0, 0.0)) for x in names)
            self.places[look] = 0
            if any(map(any, rows)):
                self.places[look] = len(self.look_weights)
                self.look_weights.append(rows)
        return self.places[look]

    def __missing__(self, token: str) -> int:
        kind = self.older.get(token)
        if kind is None:
            kind = self._kind(token)
        if len(self) >= WORD_CACHE:
            self.older = self.copy()
            self.clear()
        self[token] = kind
        return kind

    def _kind(self, token: str) -> int:
        signs = token.translate(self.classes)
        look = self.signs.get(signs)
        if look is None:
            look = self.signs[signs] = self._look(signs)
        low, begins, keys, starts = token.lower(), self.begins, None, None
        for word in (low,) if low.isalpha() else _LETTERS.findall(low):
            key = _digest("w " + word)
            if key in self.hashes:
                keys = {key - (1 << 63), *(keys or ())}
            for k in PREFIXES:
                if len(word) > k:
                    beginning = f"{k} {word[:k]}"
                    if begins[beginning] if beginning in begins else self.begin_weights(beginning):
                        starts = (*(starts or ()), beginning)
        if keys is None and starts is None:  # most tokens
            kind = self.plain.get(look)
            if kind is None:
                kind = self.plain[look] = self._number(((), look, ()))
            return kind
        return self._number((tuple(sorted(keys or ())), look, starts or ()))

    def begin_weights(self, beginning: str) -> tuple[tuple[float, float], ...]:
        found = self.begins.get(beginning)
        if found is None:
            rows = tuple(self.weights.get(_key(f"b{times} {beginning}"), (0.0, 0.0)) for times in TIMES)
            found = self.begins[beginning] = rows if any(map(any, rows)) else ()
        return found

    def _number(self, what: tuple[tuple[int, ...], int, tuple[str, ...]]) -> int:
        found = self.numbers.get(what)
        if found is None:
            found = self.numbers[what] = len(self.words)
            for listed, value in zip((self.words, self.looks, self.starts), what):
                listed.append(value)
        return found


class _Scorer:
    """The log odds of texts. A long text is as good as its passages on average, and as toxic as its worst passage
    (or the whole, if the signs are spread over it). A passage of half the length lies whole in one of them, as passages
    begin every half length.

    A text's tokens are looked up once. Passages are pairs of neighbouring half passages, so their counts are sums of
    two columns of a small table: kinds of tokens by half passages."""

    def __init__(self, weights: dict[str, tuple[dict[int, float], float]]):
        self.bias = np.array([weights[h][1] for h in HEADS])
        known = set().union(*(weights[h][0] for h in HEADS))
        self.weights = {k: tuple(weights[h][0].get(k, 0.0) for h in HEADS) for k in known}
        self.again = [self.weights.get(_key(f"r{level}"), (0.0, 0.0)) for level in LEVELS]
        self.kinds = _Kinds(self.weights)

    def _sums(self, counts: np.ndarray, kinds: list[int], sizes: np.ndarray, again: np.ndarray) -> np.ndarray:
        """Log odds by column: counts of kinds, tokens, and tokens that follow themselves. The last of several columns is the
        whole text, whose beginnings count as in the passage that has most of them."""
        out = np.repeat(self.bias[None, :], len(sizes), axis=0)
        met: dict[int, np.ndarray] = {}
        looks: dict[int, np.ndarray] = {}
        starts: dict[str, np.ndarray] = {}
        for row, kind in zip(counts, kinds):
            for word in self.kinds.words[kind]:
                met[word] = met[word] | (row > 0) if word in met else row > 0
            look = self.kinds.looks[kind]
            if look:
                looks[look] = looks[look] + row if look in looks else row
            for start in self.kinds.starts[kind]:
                starts[start] = starts[start] + row if start in starts else row
        for word in sorted(met):
            out += met[word][:, None] * np.array(self.weights[word])
        for look in sorted(looks):
            own, *levels = self.kinds.look_weights[look]
            out += (looks[look] > 0)[:, None] * np.array(own)
            for level, weight in zip(LEVELS, levels):
                out += (looks[look] >= level * sizes)[:, None] * np.array(weight)
        for start in sorted(starts):
            row = starts[start]
            if len(row) > 1:
                row = np.append(row[:-1], row[:-1].max())
            for times, weight in zip(TIMES, self.kinds.begin_weights(start)):
                out += (row >= times)[:, None] * np.array(weight)
        for level, weight in zip(LEVELS, self.again):
            out += ((again > 0) & (again >= level * sizes))[:, None] * np.array(weight)
        return out

    def evidence(self, text: str) -> tuple[float, float]:
        tokens, half = text.split(), PASSAGE // 2
        n = len(tokens)
        self.kinds.tidy()
        of = np.fromiter(map(self.kinds.__getitem__, tokens), np.int64, n)
        kinds, place = np.unique(of, return_inverse=True)
        same = np.fromiter(map(str.__eq__, tokens, tokens[1:]), bool, max(0, n - 1))
        listed = kinds.tolist()
        if n <= PASSAGE:
            whole = np.bincount(place, minlength=len(listed))[:, None]
            return tuple(self._sums(whole, listed, np.array([n]), np.array([same.sum()]))[0].tolist())
        blocks = -(-n // half)
        table = np.bincount(place * blocks + np.arange(n) // half, minlength=len(listed) * blocks).reshape(len(listed), blocks)
        starts = np.arange(0, n - half, half)
        ends = np.minimum(starts + PASSAGE, n)
        first = starts // half
        parts = table[:, first] + table[:, first + 1]
        before = np.concatenate([[0], np.cumsum(same)])
        again = before[ends - 1] - before[starts]
        # The whole text stands in the last column.
        sums = self._sums(np.concatenate([parts, table.sum(axis=1, keepdims=True)], axis=1), listed,
                          np.append(ends - starts, n), np.append(again, same.sum()))
        return float(sums[:-1, 0].mean()), float(sums[:, 1].max())


def _switches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = _Features()
    for batch in in_parts(batches):
        slots = [sorted(features.of(t.decode("utf-8", "replace").split())) for t in texts_of(batch, "text")]
        yield with_columns(batch, ["text"], slots=pa.array(slots, pa.list_(pa.int64())))


def _evidence(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in in_parts(batches):
            found = [scorer.evidence(t.decode("utf-8", "replace")) for t in texts_of(batch, "text")]
            yield with_columns(batch, ["text"], **{h: pa.array([f[i] for f in found], pa.float64()) for i, h in enumerate(HEADS)})
    return run


def _vectors(shared) -> Callable:
    """Sparse vectors over the positions of keys in a sorted list."""
    def vector(slots):
        known = shared.value
        keys = np.array(slots, np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        at = at[known[at] == keys] if len(known) else at[:0]
        return Vectors.sparse(max(1, len(known)), at.tolist(), [1.0] * len(at))
    return F.udf(vector, VectorUDT())


def _pulls(shared) -> Callable:
    """By how much the fitted heads miss each row's labels; 0 where a label does not count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            slots = batch.column("slots")
            flat, owner = slots.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), np.diff(slots.offsets.to_numpy()))
            out = {}
            for h, (keys, weights, bias) in shared.value.items():
                at = np.minimum(np.searchsorted(keys, flat), max(0, len(keys) - 1))
                met = keys[at] == flat if len(keys) else np.zeros(len(flat), bool)
                odds = bias + np.bincount(owner[met], weights[at[met]] if len(keys) else None, minlength=batch.num_rows)
                label = batch.column("y_" + h).to_numpy(zero_copy_only=False)
                out[h] = pa.array(np.where((label == 0) | (label == 1), 1 / (1 + np.exp(-np.clip(odds, -700, 700))) - label, 0.0))
            yield pa.RecordBatch.from_arrays([slots, *out.values()], ["slots", *out])
    return run


def _head(train: DataFrame, h: str, keys: np.ndarray, strength: float) -> tuple[dict[int, float], float]:
    """Weights (other than zero, by key) and bias of a head over some features."""
    shared = train.sparkSession.sparkContext.broadcast(keys)
    own = train.where(F.col("y_" + h).isin(0.0, 1.0)).select(F.col("y_" + h).alias("label"), _vectors(shared)("slots").alias("features"))
    model = LogisticRegression(maxIter=40, tol=1e-4, regParam=strength, elasticNetParam=1.0, standardization=False).fit(own)
    fitted = model.coefficients.toArray()
    return {int(keys[k]): float(fitted[k]) for k in np.flatnonzero(fitted[:len(keys)])}, float(model.intercept)


def _left_out(train: DataFrame, weights: dict[str, tuple[dict[int, float], float]], taken: dict[str, np.ndarray],
              bounds: dict[str, float]) -> dict[str, np.ndarray]:
    """The features by head that a fit without them gives no right to be zero: they are pulled by more than the penalty. Where
    there are any, those come with them that are pulled by nearly as much."""
    shown = {}
    for h in taken:
        keys = np.array(sorted(weights[h][0]), np.int64)
        shown[h] = (keys, np.array([weights[h][0][k] for k in keys.tolist()]), weights[h][1])
    missed = train.mapInArrow(_pulls(train.sparkSession.sparkContext.broadcast(shown)),
                              "slots array<long>, " + ", ".join(f"{h} double" for h in taken))
    pulls = missed.select(F.explode("slots").alias("key"), *taken).groupBy("key").agg(*[F.abs(F.sum(h)).alias(h) for h in taken])
    strong = functools.reduce(Column.__or__, [F.col(h) > 0.9 * bounds[h] for h in taken])
    rows = pulls.where(strong).toArrow()  # some hundreds: a fit that is done holds all others below
    key, more = rows.column("key").to_numpy(), {}
    for h in taken:
        pull, new = rows.column(h).to_numpy(), ~np.isin(key, taken[h])
        if (new & (pull > bounds[h])).any():
            more[h] = key[new & (pull > 0.9 * bounds[h])]
    return more


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labels: int = MAX_LABELS,
        penalty: float = PENALTY) -> dict[str, tuple[dict[int, float], float]]:
    """Weights (other than zero, by key) and bias of each head. At most `max_labels` labelled rows are used; a head without
    both outcomes among its labels is a constant.

    A feature of k among n rows moves the mean loss by less than k / n, so with k / n up to the penalty its weight is zero
    in the fit: only the others are numbered and handed to it. Where these are more than `AT_ONCE`, the fit begins with those
    that the labels alone pull by more than the penalty. Then every feature is held against it: a weight of zero is right where the rows together pull it by no
    more than the penalty. Features with a stronger pull join and the fit is made again, until there are none, so that it is the fit
    over all, without vectors over all on the driver."""
    spark = docs.sparkSession
    workers_find_package(spark)
    chosen = (labels.where(labels[id_col].isNotNull()).select(labels[id_col].alias("label_id"), *[labels[h].cast("double").alias("y_" + h) for h in HEADS])
              .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labels))
    rows = docs.select(docs[id_col].alias("id"), text_bytes(docs[text_col]).alias("text"))
    met = rows.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("text", *["y_" + h for h in HEADS])  # bounded by max_labels
    schema = met.select(*["y_" + h for h in HEADS], F.array(F.lit(0).cast("long")).alias("slots")).schema
    switched = stored(met.mapInArrow(_switches, schema), "training")
    train = switched.coalesce(TRAIN_TASKS)  # bounded by max_labels
    met_by = stored(switched.select("y_quality", "y_toxic", F.explode("slots").alias("key")).groupBy("key").agg(
        *[F.count(F.when(F.col("y_" + h).isin(0.0, 1.0), 1)).alias(h) for h in HEADS],
        *[F.count(F.when(F.col("y_" + h) == 1.0, 1)).alias("yes_" + h) for h in HEADS]), "features")
    weights, strengths, bounds, taken, todo = {}, {}, {}, {}, {}
    for h in HEADS:
        labelled = train.where(F.col("y_" + h).isin(0.0, 1.0))
        counts = {r.label: r.n for r in labelled.groupBy(F.col("y_" + h).alias("label")).agg(F.count("*").alias("n")).collect()}
        yes, no = counts.get(1.0, 0), counts.get(0.0, 0)
        if yes and no:
            strengths[h] = penalty / math.sqrt(yes + no)
            bounds[h] = strengths[h] * (yes + no)
            known = met_by.where(F.col(h) > bounds[h])
            if known.count() > AT_ONCE:
                known = known.where(F.abs(F.col("yes_" + h) - F.col(h) * (yes / (yes + no))) > bounds[h])
                taken[h] = np.zeros(0, np.int64)
            todo[h] = known.select("key").toArrow().column("key").to_numpy()
        else:
            weights[h] = ({}, math.log((yes + 1) / (no + 1)))
    while todo:
        for h, keys in todo.items():
            keys = np.sort(np.concatenate([taken[h], keys]) if h in taken else keys)
            weights[h] = _head(train, h, keys, strengths[h])
            taken |= {h: keys} if h in taken else {}
        todo = _left_out(switched, weights, taken, bounds) if taken else {}
    return weights


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (1.0 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x))))


def _logit(p: Column) -> Column:
    return F.ln(p / (F.lit(1.0) - p))


def _strength(groups: DataFrame, k: str, rate: Column) -> float:
    """How many documents the prior of a level counts for: from the spread of the groups' rates around the
    rates they are shrunk to, beyond what chance explains."""
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), rate))
    r = groups.where("n > 1").agg(
        F.sum(F.pow(F.col(k) - F.col("n") * p, 2) - F.col("n") * p * (1 - p)).alias("beyond"),
        F.sum(F.col("n") * (F.col("n") - 1) * p * (1 - p)).alias("most")).first()
    if r.most is None or r.most <= 0 or r.beyond is None or r.beyond <= 0:
        return 1e6  # the groups differ by chance alone
    share = min(max(r.beyond / r.most, 1e-6), 0.99)
    return (1 - share) / share


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None,
           path: Column | None = None, max_labels: int = MAX_LABELS, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `host`, `path`, the posterior probabilities `p_quality` and `p_toxic`, the priors of its site
    `site_quality` and `site_toxic`, the document's own log odds `evidence_quality` and `evidence_toxic`, and
    `rejected` (p_quality below one half, or p_toxic of one half or more).

    `host` and `path` default to the columns source and lang; null ones are sites of their own. A null text is empty. Labels
    that are null or not 0 or 1 do not count; labels of unknown documents are ignored; without usable labels all
    evidence is constant and nothing is rejected. Repeated rows count one by one; of a document labelled twice both
    labels are used. An empty table gives an empty
    result. `carry` names the columns passed on (None: all); a result column replaces an input column of its name."""
    spark = docs.sparkSession
    host = docs["source"] if host is None else host
    path = docs["lang"] if path is None else path
    weights = fit(docs, labels, id_col, text_col, max_labels)
    rows = packed(docs, carry, host=host.cast("string"), path=path.cast("string"), text=text_bytes(docs[text_col]))
    schema = rows.select("row", "host", "path", *[F.lit(0.0).alias(h) for h in HEADS]).schema
    scored = stored(rows.mapInArrow(_evidence(spark.sparkContext.broadcast(weights)), schema), "evidence")

    chance = {h: _sigmoid(F.col(h)) for h in HEADS}
    paths = stored(scored.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), *[F.sum(chance[h]).alias(h) for h in HEADS]), "sites")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(h).alias(h) for h in HEADS])
    all_ = hosts.agg(F.sum("n").alias("n"), *[F.sum(h).alias(h) for h in HEADS]).first()
    n = all_.n or 0.0
    base = {h: ((all_[h] or 0.0) + 0.5) / (n + 1.0) for h in HEADS}

    host_weight = {h: _strength(hosts, h, F.lit(base[h])) for h in HEADS}
    named = hosts.select(F.col("host").alias("h_host"), F.col("n").alias("h_n"), *[F.col(h).alias("h_" + h) for h in HEADS])
    sites = paths.join(named, F.col("host").eqNullSafe(F.col("h_host")))
    host_rate = {h: (F.col("h_" + h) + host_weight[h] * base[h]) / (F.col("h_n") + host_weight[h]) for h in HEADS}
    path_weight = {h: _strength(sites, h, host_rate[h]) for h in HEADS}
    told = sites.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), F.col("n").alias("s_n"), "h_n",
                        *["h_" + h for h in HEADS], *[F.col(h).alias("s_" + h) for h in HEADS])

    out = scored.join(told, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    site, posterior = {}, {}
    for h in HEADS:
        upper = (F.col("h_" + h) - chance[h] + host_weight[h] * base[h]) / (F.col("h_n") - 1 + host_weight[h])
        site[h] = (F.col("s_" + h) - chance[h] + path_weight[h] * upper) / (F.col("s_n") - 1 + path_weight[h])
        site[h] = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), site[h]))
        posterior[h] = _sigmoid(F.col(h) - math.log(base[h] / (1 - base[h])) + _logit(site[h]))
    rejected = F.lit(False)
    if weights["quality"][0]:
        rejected = rejected | (posterior["quality"] < 0.5)
    if weights["toxic"][0]:
        rejected = rejected | (posterior["toxic"] >= 0.5)
    return unpacked(out, carry, docs.columns, host=F.col("host"), path=F.col("path"),
                    **{f"p_{h}": posterior[h] for h in HEADS}, **{f"site_{h}": site[h] for h in HEADS},
                    **{f"evidence_{h}": F.col(h) for h in HEADS}, rejected=rejected)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None,
             path: Column | None = None, **options) -> DataFrame:
    """The rows that are not rejected, with the columns of the input."""
    site = (docs["source"] if host is None else host, docs["lang"] if path is None else path)
    rows = docs.select(F.struct("*").alias("doc"), docs[id_col].alias(id_col), docs[text_col].alias(text_col), site[0].alias("site_host"),
                       site[1].alias("site_path"))
    return judged(rows, labels, id_col, text_col, F.col("site_host"), F.col("site_path"), carry=["doc"], **options).where(
        "not rejected").select("doc.*")
