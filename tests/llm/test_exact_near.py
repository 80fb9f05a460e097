import random

import plain
import pytest

from casegauge.llm import components, exact_dedup, near_dedup

ODD = [(1, None), (2, ""), (3, " "), (4, "a  b\t\nc"), (5, "a b c"), (6, "A b c"), (7, " a b c"), (8, "x" * 200_000), (9, "x" * 200_000),
       (10, "x" * 199_999 + "y"), (11, "é  ü"), (12, "é ü"), (13, "a b c")]


def exact_rows(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_exact_groups_match_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert exact_rows(exact_dedup.exact_groups(documents, carry=["doc_id"])) == plain.exact(rows)


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_groups_odd_texts(spark, partitions):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    assert exact_rows(exact_dedup.exact_groups(df, carry=["doc_id"], partitions=partitions)) == plain.exact(ODD)


def test_exact_group_over_many_partitions(spark):
    """A third of all rows is one text: its runs meet over the borders of partitions."""
    rows = [(i, "same  text" if i % 3 == 0 else f"text {i // 5}") for i in range(3000)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup.exact_groups(df, carry=["doc_id"], partitions=16)
    assert exact_rows(got) == plain.exact(rows)


def test_exact_ties_nulls_and_clashing_names(spark):
    rows = [(1, "a", "k1"), (1, "a", "k1"), (None, "a", "k2"), (None, "b", None), (None, "b", None), (2, None, "z"), (3, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = exact_dedup.exact_groups(df).orderBy("text", "doc_id").collect()
    assert sorted(c for c in got[0].asDict()) == ["doc_id", "group_size", "keep_id", "kept", "text", "text_sha256"]
    kept = sorted((r.text or "", r.doc_id, r.keep_id, r.group_size) for r in got if r.kept and r.doc_id is not None)
    assert kept == [("", 2, 2, 2), ("a", 1, 1, 3)]
    assert [(r.keep_id, r.group_size) for r in got if r.text == "b"] == [(None, 2)] * 2
    stay = exact_dedup.exact_dedup(df)
    assert stay.columns == df.columns and stay.count() == 3
    assert {r.kept for r in stay.collect()} == {"k1", None, "z"}  # the input's own column comes through


def test_exact_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_groups(df).count() == 0
    assert exact_dedup.exact_dedup(df).count() == 0


def near_rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_near_groups_match_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert near_rows(near_dedup.near_groups(documents, carry=["doc_id"])) == plain.near(rows)


def copies(seed, groups, members, words):
    """Groups of texts that differ by a few words, chains among them, and texts that only share a passage."""
    rng = random.Random(seed)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, rows = new(20), []
    for g in range(groups):
        text = new(words)
        for _ in range(members):
            if rng.random() < 0.7:
                text = list(text)
                text[rng.randrange(words)] = new(1)[0]
            rows.append(" ".join(text))
        rows += [" ".join(new(15) + passage + new(5)) for _ in range(members)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_near_groups_with_chains_and_shared_passages(spark):
    rows = copies(5, 6, 12, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert near_rows(near_dedup.near_groups(df, carry=["doc_id"])) == plain.near(rows)


def test_near_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A B"), (6, "a b c d e"), (7, "a b c d e f"), (8, "w " * 50_000), (9, "w " * 40_000), (10, "a b c d e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_rows(near_dedup.near_groups(df, carry=["doc_id"])) == plain.near(rows)


def test_near_ties_nulls_and_clashing_names(spark):
    rows = [(1, "a b c", 1), (1, "a b c", 1), (None, "a b c", 2), (None, "x y", 3), (None, "x y", 3), (None, None, 4), (None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = near_dedup.near_groups(df).collect()
    assert sum(r.kept for r in got if r.text == "a b c") == 1 and {r.component_id for r in got if r.text == "a b c"} == {1}
    assert sum(r.kept for r in got if r.text == "x y") == 1 and {r.component_id for r in got if r.text == "x y"} == {None}
    assert all(r.kept for r in got if r.text is None)
    stay = near_dedup.near_dedup(df)
    assert stay.columns == df.columns and sorted(r.kept for r in stay.collect()) == [1, 3, 4, 4]
    assert near_dedup.near_groups(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    groups = plain.Union()
    for a, b in pairs:
        if a != b:
            groups.join(a, b)
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {x: groups.find(x) for x in list(groups) }


def test_components_without_edges(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components.components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0
