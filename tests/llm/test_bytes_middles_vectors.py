import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registered
from casegauge.llm import merge_bpe, middles, vector_codes

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "  two  blanks ", "a\nb\r\n\tc\x0b\x0cd", "é ü ß 日本語 🎉", "é å Ḁ̊", "İX ẞ ΣΣ ǅ",
       "\x00\x01 a\x1cb\x85c\xa0d e​f﻿", "don't we'll THEY'RE I'M 'TIS o'clock", "x<|endoftext|>y <|endoftext|><|startoftext|> <|ENDOFTEXT|> <|endoftext",
       "1234 5.6e-7 ½ ² ٣", "ﬁ ª µ º ſt ŉ", "한국어 각 각", "word " * 30_000, "x" * 20_000, "ab" * 5_000 + "é" * 3_000, "!!!...---???" * 50,
       "́start", "a ́b", "P.S.<P>", "<S>", "a<M>b"]


def scrambled(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh  EHTOINSRz\n.,'_0123éÉñ日🎉\t́ß") for _ in range(rng.randint(0, 80))) for _ in range(n)]


# --- BPE

def test_word_bpe_equals_the_library(spark, documents):
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    texts = [r.text for r in documents.collect()] + ODD + scrambled(600)
    rng = random.Random(4)
    texts += ["".join(library.id_to_token(rng.randrange(512, 49400)).replace("</w>", rng.choice(["", " "])) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = merge_bpe.encoded(df, WORDS).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False), repr((r.text or "")[:60])


def test_segment_tree_equals_plain_merging():
    tree = merge_bpe.BytePairs.of(WORDS).tree
    small = merge_bpe.MergeTree({c: i for i, c in enumerate(["a", "b", "aa", "ab", "aab", "aaaa", "ba"])},
                                [("a", "a"), ("aa", "aa"), ("a", "b"), ("aa", "b"), ("b", "a")])

    def plain(t, ids):
        ids = list(ids)
        while True:
            found = [(t.rank[k], i) for i in range(len(ids) - 1) if (k := ids[i] << merge_bpe.PAIR | ids[i + 1]) in t.rank]
            if not found:
                return ids
            r, i = min(found)
            ids[i:i + 2] = [t.made[r]]

    rng = random.Random(5)
    for n in [0, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 33, 150]:
        for _ in range(40):
            ids = [rng.choice([0, 1]) for _ in range(n)]
            assert small.merged(list(ids)) == plain(small, ids)
            ids = [rng.randrange(64, 100) for _ in range(n)]
            assert tree.merged(list(ids)) == plain(tree, ids)
    assert small.merged([0] * 7) == plain(small, [0] * 7)  # ties: the leftmost pair first


def test_word_bpe_edges(spark):
    df = spark.createDataFrame([(1, "same text", "k", 0), (1, "same text", "k", 0), (None, None, None, 1)], "doc_id long, text string, ids string, row int")
    out = merge_bpe.encoded(df, WORDS)
    assert out.columns == ["doc_id", "text", "row", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == 3 and sorted(len(r.ids) for r in rows) == [0, 2, 2]
    assert merge_bpe.encoded(df.limit(0), WORDS).count() == 0
    back = merge_bpe.decoded(spark.createDataFrame([([1, None, 49407],), (None,), ([],)], "ids array<int>"), WORDS, carry=[])
    assert sorted(r.decoded for r in back.collect()) == ["", "", '" <|endoftext|>']
    with pytest.raises(ValueError):
        merge_bpe.BytePairs(public_tokenizers.path("byte_bpe_50k.json"))


# --- fill in the middle

def brute_middle(key, text):
    text = text or ""
    name = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(name[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    if not n or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_middles_match_brute_force(spark, block):
    texts = list(enumerate(ODD + scrambled(300, 3) + ["a<", "<", "S>x", "<<P", "é" * 9000, "<P" * 40]))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = middles.restored(middles.fill_in_middle(df, block=block)).collect()
    assert len(rows) == len(texts) and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_middle(r.doc_id, r.text)
        assert r.restored == (r.text or "")


def test_middles_of_words_and_lines():
    rng = random.Random(2)
    cut = {"word": lambda t: __import__("re").findall(r"^[ \t-\r]*[^ \t-\r]*[ \t-\r]*|[^ \t-\r]+[ \t-\r]*", t) if t else [],
           "line": lambda t: t.splitlines(True) if "\r" not in t and "\x0b" not in t else None}
    for text in ["", "a", " ", "\n", "a b", "  a  b\n\nc ", "no end", "é\n日 本\n"] + ["".join(rng.choice("ab é\n") for _ in range(60)) for _ in range(60)]:
        for unit, units_of in cut.items():
            units = [u for u in units_of(text) if u]
            for block in (1, 5, 4096):
                cuts = middles.Cuts(text.encode(), unit, block)
                assert cuts.n == len(units), (unit, text)
                for k in range(cuts.n + 1):
                    head = "".join(units[:k])
                    assert cuts.after(k) == (len(head.encode()), len(head)), (unit, text, k)


def test_fenwick_sums_and_search():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 8, 13):
        counts = [rng.randrange(0, 4) for _ in range(n)]
        tree = middles.Fenwick(np.array(counts, np.int64))
        assert [tree.before(i) for i in range(n + 1)] == [sum(counts[:i]) for i in range(n + 1)]
        owners = [i for i, c in enumerate(counts) for _ in range(c)]
        for k, block in enumerate(owners):
            assert tree.holding(k) == (block, sum(counts[:block]))
        assert tree.holding(len(owners))[0] == n


def test_middles_edges(spark):
    df = spark.createDataFrame([(5, "same", "x"), (5, "same", "x"), (None, None, None), (None, "no id", "y")], "doc_id long, text string, form string")
    out = middles.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = out.collect()
    same = [tuple(r) for r in rows if r.doc_id == 5]
    assert len(same) == 2 and same[0] == same[1] and len(rows) == 4
    assert {r.text: r.restored for r in middles.restored(out).collect()} == {"same": "same", None: "", "no id": "no id"}
    assert middles.fill_in_middle(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        middles.fill_in_middle(df, unit="page")
    lines = middles.restored(middles.fill_in_middle(df, unit="line", plain_from=100, spm_below=100))
    assert {r.form for r in lines.collect() if r.text} == {"spm"}


# --- vector codes

def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: r[0])
    whole = [[int(np.floor(256 * np.float64(x))) for x in r[1]] for r in kept]
    w = len(whole[0]) // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for v in whole] for p in range(parts)]
    books = [[list(c) for c in cut[p][:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda p: [min(range(len(books[p])), key=lambda i: (away(c, books[p][i]), i)) for c in cut[p]]
    for _ in range(rounds):
        for p in range(parts):
            got = assign(p)
            for i in range(len(books[p])):
                mine = [c for c, g in zip(cut[p], got) if g == i]
                if mine:
                    books[p][i] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [assign(p) for p in range(parts)]
    out, sums = {}, {}
    for k, r in enumerate(kept):
        error = sum(away(cut[p][k], books[p][last[p][k]]) for p in range(parts))
        out[r[0]] = ["".join(f"{last[p][k]:02x}" for p in range(parts)), error, r[2]]
        sums[r[2]] = sums.get(r[2], 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: (c, e, sums[l], digest) for i, (c, e, l) in out.items()}


def random_vectors(n, seed, hot=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, 32)], int(rng.integers(0, 4)) if i % 7 else None) for i in rng.permutation(n)]
    rows = [(i, rows[0][1] if k < hot else v, l) for k, (i, v, l) in enumerate(rows)]
    return rows + [(n + 1, None, 1), (n + 2, [float("nan")] + [0.0] * 31, 1), (n + 3, [None] + [0.0] * 31, 2), (n + 4, [float("-inf")] * 32, None)]


@pytest.mark.parametrize("n, hot", [(300, 0), (240, 100), (20, 0), (1, 0)])
def test_vector_codes_match_brute_force(spark, n, hot):
    rows = random_vectors(n, n + hot, hot)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.vector_codes(df, carry=["vec_id"]).collect()}
    assert got == brute_codes(rows)


def test_more_rounds_and_other_shapes(spark):
    rows = random_vectors(150, 9)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    out = vector_codes.vector_codes(df, parts=4, entries=10, rounds=5)
    assert out.columns == ["vec_id", "embedding", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect()} == brute_codes(rows, 4, 10, 5)


def test_vector_edges(spark):
    v = [0.5] * 16
    df = spark.createDataFrame([(1, v, 7, "a"), (1, v, 7, "a"), (None, [-0.001] * 16, None, "b"), (3, None, 7, "c")],
                               "vec_id long, embedding array<double>, label int, code string")
    rows = vector_codes.vector_codes(df).collect()
    assert len(rows) == 3 and {r.error for r in rows} == {0} and {r.code for r in rows if r.vec_id == 1} == {"00" * 16}
    assert vector_codes.vector_codes(df.limit(0)).count() == 0 and vector_codes.vector_codes(df.where("label is null and vec_id = 3")).count() == 0
    for bad in ([(1, v, 1), (2, v + v, 1)], [(1, [1.0] * 17, 1)], [(1, [1e30] * 16, 1)]):
        with pytest.raises(Exception):
            vector_codes.vector_codes(spark.createDataFrame(bad, "vec_id long, embedding array<double>, label int")).collect()


def test_only_moving_members_are_shuffled(spark):
    """After the first placement a member that keeps its entry is read where it lies."""
    df = spark.createDataFrame(random_vectors(200, 1), "vec_id long, embedding array<float>, label int")
    book = vector_codes.codebooks(df, rounds=1)
    rows = vector_codes.packed(df, [], id=df["vec_id"], vector=df["embedding"].cast("array<double>"))
    rows = vector_codes.usable(rows, "vector").select("vector", vector_codes._mark())
    seeds = vector_codes.codebooks(df, rounds=0)
    fields = ", ".join(["position int", "entry int", "salt int", "c0 int", "c1 int"])
    members = rows.mapInArrow(vector_codes._placed(seeds, 32, 256, 16), fields)
    after = vector_codes._migrated(members, book)
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Union" in plan
    assert after.count() == members.count() == 200 * 16
    moved = members.mapInArrow(vector_codes._judged(book), fields + ", moved boolean").where(F.col("moved")).count()
    assert 0 < moved < 200 * 16


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_vector_codes"])
def test_queries_equal_their_sql(spark, name):
    import sys
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from oracle import compare
    assert compare(spark, SMALL, registered.queries()[name], registered.oracle_sql()[name]) == []
