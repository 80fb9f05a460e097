import itertools
import random
import tracemalloc

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casegauge.llm import line_dedup, near_dedup, set_blocks


def test_common_items_equal_set_intersections():
    rng = random.Random(1)
    sets = [np.unique(np.array([rng.randrange(-40, 40) for _ in range(rng.randint(0, 60))], np.int64)) for _ in range(40)]
    got = set_blocks.common_items(sets[:15], sets[15:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[15:]] for a in sets[:15]]
    assert set_blocks.common_items([], sets).shape == (0, 40) and set_blocks.common_items(sets, []).shape == (40, 0)


def near_misses(n, seed=2, words=120, changed=(4, 12)):
    """Copies of one text with some words replaced: pairs of them lie on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for k in rng.sample(range(words), rng.randint(*changed)):
            text[k] = f"x{rng.randrange(10**6)}"
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize("block", [200, 1 << 16])
def test_blocks_find_every_link_between_components(spark, block):
    rng = random.Random(4)
    sets = {i: np.array(sorted(rng.sample(range(60), 20) if i % 4 else rng.sample(range(30), 25)), np.int64) for i in range(90)}
    sets[3] = np.arange(500, dtype=np.int64)  # longer than a small block
    roots = {i: (i if i % 3 else 0) for i in sets}
    placed = [(b, i, roots[i]) for i in sets for b in {i % 2, 7 + i % 3}]
    rest = spark.createDataFrame(placed, "bucket long, node long, root long").repartition(4)
    df = spark.createDataFrame([(i, s.tolist()) for i, s in sets.items()], "node long, d array<long>").repartition(4)
    got = {(r.a, r.b) for r in set_blocks.block_links(rest, df, 40, block).collect()}
    together = lambda i, j: i % 2 == j % 2 or i % 3 == j % 3
    want = {(j, i) for i, j in itertools.combinations(sorted(sets), 2) if roots[i] != roots[j]
            and 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 40 * (len(sets[i]) + len(sets[j]) - o)}
    assert {p for p in want if together(*p)} <= got <= want and len(want) > 50


@pytest.mark.parametrize("rounds", [1, 3])
def test_group_of_near_misses(spark, monkeypatch, rounds):
    """A large group in which most pairs lie just below the threshold; small blocks force many meetings."""
    monkeypatch.setattr(near_dedup, "ROUNDS_OF_HUBS", rounds)
    monkeypatch.setattr(set_blocks, "BLOCK", 2_000)
    rows = near_misses(160) + [(1000 + i, t) for i, t in near_misses(40, 5, 60, (0, 3))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(df, carry=["doc_id"]).collect()}
    want = plain.near(rows)
    assert got == want and len({c for _, c, _ in want.values()}) > 20


def test_pairs_of_a_group_are_not_written_out(spark):
    """Rows in and out of the joins of the last step grow with the blocks, not with the pairs of a group."""
    n = 400
    rest = spark.range(n).select(F.lit(1).cast("long").alias("bucket"), F.col("id").alias("node"), F.col("id").alias("root"))
    sizes = spark.range(n).select(F.col("id").alias("node"), F.lit(100).cast("long").alias("n"))
    placed = set_blocks._placed(rest, sizes, 4_000)
    blocks = placed.groupBy("block").count().collect()
    assert sum(b["count"] for b in blocks) == n and len(blocks) <= 10
    met = set_blocks._meetings(rest, placed).count()
    assert met == len(blocks) * (len(blocks) + 1) // 2


def test_content_field_tells_wanted_contents(spark):
    values = [0, 1, -1, 2 ** 62, -2 ** 63, 12345678901234]
    field = np.frombuffer(near_dedup.content_field(spark.createDataFrame([(v,) for v in values], "content long")), np.uint64)
    assert len(field) * 64 == near_dedup.FIELD
    held = lambda v: field[(v & (near_dedup.FIELD - 1)) >> 6] >> np.uint64(v & 63) & np.uint64(1)
    assert all(held(v) for v in values) and not held(5) and sum(bin(int(w)).count("1") for w in field) <= len(values)


def block_table(members, first=1, second=1):
    kind = pa.list_(pa.struct([("node", pa.int64()), ("root", pa.int64()), ("d", pa.list_(pa.int64()) if members and isinstance(members[0]["d"], list) else pa.string())]))
    return pa.table({"p": [first], "q": [second], "block": [first], "members": pa.array([members], kind)})


def test_blocks_of_short_sets_hold_few_counts_at_once():
    n = 3_000
    table = block_table([{"node": i, "root": i, "d": [i // 2, 10 ** 6 + i // 2]} for i in range(n)])
    run = set_blocks._compared(90, None, None)
    tracemalloc.start()
    got = run(table).to_pydict()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(zip(got["a"], got["b"])) == {(i + 1, i) for i in range(0, n, 2)}
    assert peak < 60e6  # all counts at once: 72 MB, and as much again for each step of the comparison


def test_lines_verified_part_by_part_keep_their_components(monkeypatch):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(6)]
    lines = [b[:k] + rng.choice("xyz") + b[k + 1:] for b in base for k in rng.sample(range(60), 8)]
    table = block_table([{"node": i, "root": i, "d": x} for i, x in enumerate(lines)])

    def groups(cells):
        monkeypatch.setattr(set_blocks, "CELLS", cells)
        above = list(range(len(lines)))
        got = set_blocks._compared(45, line_dedup.triples, line_dedup._linked(0.9))(table).to_pydict()
        for _ in lines:
            for a, b in zip(got["a"], got["b"]):
                above[a] = above[b] = min(above[a], above[b])
        return above, len(got["a"])

    assert groups(100) == groups(1 << 19) == ([i - i % 8 for i in range(48)], 42)


def test_meetings_are_tiled_and_compared_in_turns(spark, monkeypatch):
    """Where meetings are many, blocks that meet the same others move together, and not all at once; links are the same."""
    rng = random.Random(6)
    sets = {i: sorted(rng.sample(range(400), 60)) if i % 5 else sorted({*range(55), *rng.sample(range(55, 400), 5)}) for i in range(240)}
    rest = spark.createDataFrame([(0, i, i) for i in sets], "bucket long, node long, root long").repartition(4)
    df = spark.createDataFrame(list(sets.items()), "node long, d array<long>").repartition(4)
    held = {}

    def watched(rows, label, own=set_blocks.stored):
        out = own(rows, label)
        held.setdefault(label, []).append(out)
        return out

    monkeypatch.setattr(set_blocks, "stored", watched)
    links = lambda: {(r.a, r.b) for r in set_blocks.block_links(rest, df, 60, 600).collect()}
    plain = links()
    met = held["meetings"][0].count()
    monkeypatch.setattr(set_blocks, "TASKS", 1)
    monkeypatch.setattr(set_blocks, "TILE", 4)
    monkeypatch.setattr(set_blocks, "MOVED", 1)
    assert links() == plain and len(plain) > 500
    tiles = held["tiles"][0]
    assert tiles.count() * 3 < 2 * met  # blocks that are moved
    assert tiles.select(F.explode("others")).count() == met
    assert len(held["links"]) > 1 and tiles.groupBy("p", "q").count().agg(F.max("count")).first()[0] <= 24


def test_a_tile_pairs_each_two_blocks_once(spark):
    met = {(p, q) for p in range(40) for q in range(p, 40) if p % 3 == q % 3 or (p + q) % 7 == 0}
    rows = set_blocks._tiled(spark.createDataFrame(sorted(met), "p long, q long"), 4).collect()
    got = [(min(r.block, o), max(r.block, o)) for r in rows for o in r.others]
    assert len(got) == len(set(got)) and set(got) == met
    there = {(r.p, r.q, r.block) for r in rows}
    assert all((r.p, r.q, o) in there for r in rows for o in r.others)
