import random

import plain
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casegauge.llm import decontaminate, line_dedup, pieces, substring_dedup, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  two  blanks ", "a\nb\r\n\tc", "▁mark ▁▁ x", "é ü ß 日本語 🎉", "<s></s><unk><0x0A>", "\x00\x01 a", "don't we'll",
       "x<|endoftext|>y <|endoftext|>", " " * 40 + "deep", "word " * 30_000, "x" * 20_000]


def mixed_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh  ehtoinsr\n.,'▁0123é日🎉\t") for _ in range(rng.randint(0, 80))) for _ in range(n)]


# --- benchmark decontamination

ITEMS = [(1, " ".join(f"b{i}" for i in range(14))), (2, "Short item"), (3, None), (4, "... !"), (2, "Short item"), (None, "nameless one"),
         (7, " ".join(f"b{i}" for i in range(4, 20)))]
TEXTS = [(1, "x y " + " ".join(f"B{i}" for i in range(12)) + " z"), (2, "a SHORT, item! and short item"), (3, None), (4, ""), (5, "b1 b2 b3 b4 b5 b6 b7 b8 b9"),
         (6, "nameless one"), (7, " ".join(f"b{i}." for i in range(20)) + " tail " * 5000), (8, "étude Short-item")]


def expected(texts, items):
    out = {}
    for i, t in texts:
        w, flags, found = plain.hit(t, [("" if k is None else k, v) for k, v in items])
        out[i] = (len(w), sum(flags), found)
    return out


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 150])
def test_contamination_matches_brute_force(spark, block):
    docs, items = spark.createDataFrame(TEXTS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs, items, block_bytes=block).collect()}
    assert got == expected(TEXTS, ITEMS)


def test_one_window_in_many_items(spark):
    """Items of a window are rows, whatever their number; blocks are scanned one after the other."""
    passage = " ".join(f"s{i}" for i in range(10))
    items = [(i, passage) for i in range(300)] + [(1000, passage + " tail"), (2000, "other words, that nobody has written so far in any of these texts")]
    texts = [(1, "in front " + passage + " and behind"), (1, "in front " + passage + " and behind"), (2, "s0 s1 s2"), (3, passage + " tail")]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").repartition(5)
    assert decontaminate.benchmark_windows(bench).groupBy("window").count().agg(F.max("count")).first()[0] == 301
    for block in (decontaminate.BLOCK_BYTES, 2_000, 100):
        rows = decontaminate.contamination(docs, bench, block_bytes=block).collect()
        got = sorted((r.doc_id, r.n_hit, r.n_items) for r in rows)
        assert got == [(1, 10, 301), (1, 10, 301), (2, 0, 0), (3, 11, 301)]
        assert next(r["items"] for r in rows if r.doc_id == 1) == sorted(map(str, [*range(300), 1000]))


def test_contamination_of_the_tables(spark, documents, benchmark_items):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in benchmark_items.collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(documents, benchmark_items).collect()}
    assert got == expected(docs, items)


def test_spans_and_documents_go(spark):
    docs = spark.createDataFrame([(1, "keep This SHORT item, here", 5), (2, "clean text", 6), (3, None, 7)], "doc_id long, text string, hits int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    cut = decontaminate.without_spans(docs, items)
    assert cut.columns == docs.columns
    assert {(r.doc_id, r.text, r.hits) for r in cut.collect()} == {(1, "keep This , here", 5), (2, "clean text", 6), (3, None, 7)}
    kept = decontaminate.without_documents(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3}
    assert decontaminate.without_spans(docs.limit(0), items).count() == 0
    assert {r.text for r in decontaminate.without_spans(docs, items.limit(0)).collect()} == {r.text for r in docs.collect()}


# --- SentencePiece pieces

def test_pieces_equal_the_library(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [r.text for r in documents.collect()] + ODD + mixed_texts(400)
    rng = random.Random(4)
    texts += ["".join(library.id_to_piece(rng.randrange(259, 32000)).replace("▁", " ") for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in pieces.encoded(df, MODEL).collect():
        ids = library.encode(r.text or "", add_eos=True)
        assert r.ids == ids and r.decoded == library.decode(ids), r.text[:50]


def test_backtracking_equals_plain_merging():
    merges = pieces.Pieces.of(MODEL).merges
    rng = random.Random(5)
    for _ in range(2000):
        word = "▁" + "".join(rng.choice("abeinorstéc") for _ in range(rng.randint(1, 25)))
        assert [merges.text[t] for t in merges._backtracked(word)] == merges.merged(word)


def test_decoding_any_ids_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(6)
    rows = [(i, [rng.choice([rng.randrange(3, 259), rng.randrange(32000), 0, 1, 2]) for _ in range(rng.randint(0, 9))]) for i in range(500)]
    df = spark.createDataFrame(rows + [(500, None)], "i long, ids array<int>")
    got = {r.i: r.decoded for r in pieces.decoded(df, MODEL).collect()}
    assert got == {i: library.decode(ids) for i, ids in rows} | {500: ""}


def test_pieces_clashing_names_and_empty_table(spark):
    df = spark.createDataFrame([("own", None), ("own", "a")], "ids string, text string")
    got = pieces.encoded(df, MODEL, end=False).orderBy("text").collect()
    assert got[0].asDict() == {"text": None, "ids": [], "decoded": ""} and got[1].decoded == "a"
    assert pieces.encoded(df.limit(0), MODEL).count() == 0


# --- token counts

def test_counts_equal_the_library(spark, documents):
    library = Tokenizer.from_file(BPE)
    texts = [r.text for r in documents.collect()] + ODD + mixed_texts(400, 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = token_counts.token_counts(df, BPE, sample_rows=50, table_size=100)
    for r in got.collect():
        text = r.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512), text[:50]


def test_split_equals_the_library_on_every_character():
    counting = token_counts.Counting.of(BPE)
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for i in range(0, len(chars), 97):
        text = "".join(chars[i:i + 97]) + " " + "".join(chars[i:i + 97:7])
        assert sum(counting.whole(p) for p in counting.split(text)) == counting.whole(text)


def test_counts_clashing_names_and_empty_table(spark):
    df = spark.createDataFrame([("own", "a b"), ("own", "a b"), (None, None)], "n_tokens string, text string")
    assert sorted(r.n_tokens for r in token_counts.token_counts(df, BPE).collect()) == [0, 2, 2]
    assert token_counts.token_counts(df.limit(0), BPE).count() == 0


# --- substring dedup

def repeat_rows(df, **options):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.repeats_removed(df, **options).collect()}


def test_repeats_match_brute_force_on_the_tables(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert repeat_rows(documents) == plain.repeats(rows)


@pytest.mark.parametrize("size,anchor", [(6, 3), (12, 5), (50, 16)])
def test_repeats_with_branches_and_low_entropy(spark, size, anchor):
    rng = random.Random(size)
    bank = [[rng.choice("ab") if rng.random() < 0.2 else f"w{rng.randrange(40)}" for _ in range(rng.randrange(size, 4 * size))] for _ in range(8)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(bank)
            a = rng.randrange(len(p))
            words += p[a:a + rng.randrange(1, len(p) + 1)] + [f"w{rng.randrange(40)}" for _ in range(rng.randrange(4))]
            if rng.random() < 0.2:
                words += ["la"] * (2 * size)
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert repeat_rows(df, size=size, anchor=anchor) == plain.repeats(rows, size)


def test_repeats_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(5, long, "x"), (5, long, "x"), (None, long, None), (None, "p " + long, None), (3, None, "y"), (4, "", "y"), (6, "q " + long + "\t end ", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = sorted(((r.doc_id or 99, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.repeats_removed(df).collect()))
    tail = [f"q v0", "end"]
    assert got == sorted([(5, 60, 0, long), (5, 60, 0, long), (99, 60, 60, ""), (99, 61, 60, "p"), (3, 0, 0, ""), (4, 0, 0, ""), (6, 61, 59, " ".join(tail))])
    assert substring_dedup.repeats_removed(df.limit(0)).count() == 0


# --- line dedup

def plain_words(line):
    """Letters in lower case, digits as 0, all else as blanks."""
    return "".join("0" if c.isdecimal() else c if c.isalnum() else " " for c in line.lower()).split()


def plain_lines(rows, similarity=0.9, linked=None):
    """All pairs of lines by edit similarity."""
    places, norms = [], []
    for i, t in sorted(rows):
        for k, line in enumerate((t or "").split("\n")):
            if plain_words(line):
                places.append((i, k)), norms.append(" ".join(plain_words(line)))
    groups = plain.Union()
    for b in range(len(places)):
        groups.find(b)
        for a in range(b):
            most = int((1 - similarity) * max(len(norms[a]), len(norms[b])) + 1e-9)
            if norms[a] == norms[b] or (abs(len(norms[a]) - len(norms[b])) <= most and plain.edits(norms[a], norms[b]) <= most):
                groups.join(a, b)
    gone = {places[x] for x in range(len(places)) if groups.find(x) != x}
    return {i: "\n".join(line for k, line in enumerate((t or "").split("\n")) if (i, k) not in gone) for i, t in rows}


def test_edit_distance_of_lines():
    rng = random.Random(6)
    for _ in range(400):
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(0, 40)))
        b = "".join(c for c in a if rng.random() < 0.9) if rng.random() < 0.5 else "".join(rng.choice("abé ") for _ in range(rng.randint(0, 40)))
        want = plain.edits(a, b)
        for most in (0, 1, 3, 10, 60):
            assert line_dedup.edit_distance(a, b, most) == min(want, most + 1)


def test_long_similar_lines_take_seconds():
    import time
    rng = random.Random(2)
    a = [rng.choice("abcdefgh ") for _ in range(97_000)]
    b = list(a)
    for at in rng.sample(range(97_000), 300):
        b[at] = "z"
    start = time.process_time()
    assert 0 < line_dedup.edit_distance("".join(a), "".join(b), 9_700) <= 300
    assert time.process_time() - start < 30


@pytest.mark.parametrize("words", [8, 12, 25, 50, 100])
def test_recall_of_changed_lines(spark, documents, words):
    """Lines of the tables' words with a word replaced, missing or added, or some letters changed, against plain edit
    similarity: at least nine of ten are found."""
    rng = random.Random(words)
    own = sorted({w for r in documents.limit(60).collect() for w in plain_words(r.text)})
    rows, similar = [], {}
    for i in range(160):
        change = ("replace", "delete", "insert", "letters")[i % 4]
        line = rng.sample(own, words)
        other, at = list(line), rng.randrange(words)
        if change == "replace":
            other[at] = rng.choice([w for w in own if len(w) <= 7])
        elif change == "delete":
            del other[at]
        elif change == "insert":
            other.insert(at, rng.choice(own))
        else:
            for k in rng.sample(range(words), max(1, words // 20)):
                other[k] = other[k][:-1] + "q"
        a, b = " ".join(line), " ".join(other)
        if plain.edits(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9):
            similar.setdefault(change, set()).add(2 * i + 1)
        rows += [(2 * i, a), (2 * i + 1, b)]
    found = {r.doc_id for r in line_dedup.lines_removed(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed = 1").collect()}
    assert found <= set().union(*similar.values()) and len(similar) == 4
    assert all(len(found & want) >= 0.9 * len(want) for want in similar.values())


def test_lines_match_brute_force(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice("alpha beta gamma delta omega sigma kappa theta".split()) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 40))) for _ in range(12)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(base)
            roll = rng.random()
            if roll < 0.3:
                line = line.upper() + "!"
            elif roll < 0.7:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("xyz") + line[at + 1:]
            lines.append(line)
        rows.append((i, "\n".join(lines + ["", "***"][:rng.randrange(3)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.kept_text for r in line_dedup.lines_removed(df).collect()}
    assert got == plain_lines(rows)
    near = [" ".join(f"word{k}" for k in range(80)), " ".join(f"word{k}" for k in range(80)).replace("word79", "ward79")]
    assert got and plain_lines([(0, near[0]), (1, near[1])])[0] == near[0]


def test_lines_odd_rows(spark):
    rows = [(2, "One line here\n\n---\nOne LINE, here", "x"), (2, "One line here\n\n---\nOne LINE, here", "x"), (None, "one line here\nother", None),
            (3, None, None), (4, "", None), (1, "one line here " * 20_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone string")
    got = line_dedup.lines_removed(df)
    assert got.columns == ["doc_id", "text", "gone", "n_lines", "n_removed", "kept_text"]
    seen = sorted((r.doc_id or 99, r.n_lines, r.n_removed, r.kept_text[:20]) for r in got.collect())
    assert seen == sorted([(2, 4, 1, "One line here\n\n---"), (2, 4, 1, "One line here\n\n---"), (99, 2, 1, "other"), (3, 0, 0, ""), (4, 0, 0, ""),
                           (1, 1, 0, ("one line here " * 2)[:20])])
    assert line_dedup.lines_removed(df.where(F.lit(False))).count() == 0


def test_a_line_with_one_changed_letter_is_found(spark):
    line = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300))
    df = spark.createDataFrame([(1, line), (2, line.replace("wordaa", "wordab", 1))], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup.lines_removed(df).collect()} == {1: 0, 2: 1}
