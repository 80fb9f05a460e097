import math
import random
import re
import string
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casegauge.llm import quality, queries, sharding
from casegauge.llm.main_text import main_text, main_texts

FOLDER = "/root/testdata/sf0.001"


# --- sharding

def check_shards(rows, texts, shards):
    assert len(rows) == len(texts)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(texts)
    for s in {r.shard for r in rows}:
        own = [r for r in rows if r.shard == s]
        assert 0 <= s < shards and sorted(r.slot for r in own) == list(range(len(own)))
    for r in rows:
        raw = (r.text or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw) and r.law == "key"
        assert r.grown_shard in (r.shard, shards)


@pytest.mark.parametrize("bucket", [1 << 24, 4000])
def test_every_row_gets_a_place(spark, documents, bucket):
    rows = sharding.sharded(documents, 8, bucket_bytes=bucket).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in documents.collect()], 8)
    assert len({r.shard for r in rows}) == 8
    moved = sum(r.shard != r.grown_shard for r in rows)
    assert 0 < moved < len(rows) / 3
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))] != sorted(r.doc_id for r in rows)


def test_identifier_and_shard_count_decide(spark, documents):
    one = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.sharded(documents.repartition(5), 8, bucket_bytes=5000).collect()}
    two = {r.doc_id: r.shard for r in sharding.sharded(documents.coalesce(1), 9).collect()}
    assert {k: v[1] for k, v in one.items()} == two


def test_a_repeated_identifier_is_spread_over_buckets(spark):
    df = spark.createDataFrame([(7 if i % 3 else i, "same text " * 10, "row") for i in range(3000)], "doc_id long, text string, shard string").repartition(3)
    placed = sharding.sharded(df, 4, bucket_bytes=3000)
    assert placed.columns == ["doc_id", "text", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check_shards(placed.collect(), [(r.doc_id, r.text) for r in df.collect()], 4)


def test_shards_of_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (None, None), (1, ""), (1, "x" * 300_000), (2, "é")], "doc_id long, text string")
    check_shards(sharding.sharded(df, 3, bucket_bytes=1000).collect(), [(r.doc_id, r.text) for r in df.collect()], 3)
    assert sharding.sharded(df.limit(0), 3).count() == 0
    sharding.write_shards(df, str(tmp_path / "out"), 3, bucket_bytes=1000)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_sharding_runs_no_python(spark):
    plan = queries.QUERIES["op1_sharding"](spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- main text

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>if (a<b) document.write("<p>no</p>")</script></head><body>
<header class="site"><h2>Site</h2></header><nav><ul><li><a href="#">Home</a><li><a>More, and more</a></ul></nav><div class="cookie-notice">We use cookies. Lots, really.</div>
%s<aside class="sidebar"><p>Related: a long text, with marks. And another, longer one, that goes on.</p></aside>
<section id="comments"><p>First! Great article, thanks.</p></section><form><p>Subscribe, please.</p><input></form><footer>&copy; us. All rights, reserved.</footer></body></html>"""
BODY = "<h1>A  title</h1><p>One &amp; two,\n three.<p>Caf&eacute; <b>bold</b>ness.<br><!-- no -->Next<ul><li>item <i>one</i><li>item two</ul><div class='ad'>Buy, now!</div><p>Last &#8212; word."
WANT = "A title\nOne & two, three.\nCafé boldness. Next\nitem one\nitem two\nLast — word."


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main class='page'>", "</main>"), ("<article>", ""), ("<div id='story'>", "</div>")])
def test_the_article_is_kept_whole(open_, close):
    assert main_text(PAGE % (open_ + BODY + close)) == WANT


@pytest.mark.parametrize("page", ["", "   ", "<html></html>", "<script>a</script>", "<nav>menu</nav>", "<!-- only", "<p"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_broken_markup_is_read_as_far_as_it_goes():
    assert main_text("<article><p>a < b and c > d, fine.<p class=\"x>lost</article>").startswith("a < b and c > d, fine.")
    assert main_text("just text, no tags.") == "just text, no tags."
    assert main_text("<article>" + "<div>" * 3000 + "deep text." + "</div>" * 3000) == "deep text."


@pytest.mark.parametrize("open_, close", [("<div class='content no-sidebar'>", "</div>"), ("<div class='layout has-sidebar'><article>", "</article></div>"),
                                          ("<div id='header'><article>", "</article></div>")])
def test_a_class_does_not_empty_the_page(open_, close):
    assert main_text(PAGE % (open_ + BODY + close)) == WANT


def test_a_class_on_most_of_the_text_does_not_count():
    lines = [f"Paragraph {k}, of a page whose wrapper is named like a part of it, goes on for a while." for k in range(8)]
    page = "<div class='page widget'>" + "".join(f"<p>{x}</p>" for x in lines) + "<div class='widget'>More, here.</div></div>"
    assert main_text(PAGE % page) == "\n".join(lines)


def test_only_whole_names_hint_at_furniture():
    parts = ["<div class='entry-header'><h1>A title, here.</h1></div>", "<div class='elementor-widget-container'><p>One text, first.</p></div>",
             "<div id='market-share-analysis'><p>Shares, in short.</p></div>", "<div class='notice-of-meeting'><p>We meet, at ten.</p></div>",
             "<p title='a hidden gem'>A gem, found.</p>", "<p data-x='class=ad'>No advert, this.</p>"]
    gone = ["<div class='cookie-notice'>Cookies, here.</div>", "<div class=ad>Buy, now!</div>", "<p hidden>Not, seen.</p>", "<div class='box widget-2'>More, here.</div>"]
    want = "A title, here.\nOne text, first.\nShares, in short.\nWe meet, at ten.\nA gem, found.\nNo advert, this."
    for around in ("<article>%s</article>", "<div class='content'>%s</div>"):
        assert main_text("<body>" + around % "".join(parts[:3] + gone + parts[3:]) + "</body>") == want
    assert main_text("<body><article><h1>Short, this.</h1><div class='ad'><p>A long advert, which goes on, and on, and on.</p></div></article></body>") == "Short, this."
    talk = "<div id='comments'>" + "<p>A long comment, which goes on, and on, and on.</p>" * 20 + "</div>"
    assert main_text("<body><article>" + "".join(parts) + "</article>" + talk + "</body>") == want


@pytest.mark.parametrize("name", ["comments-area", "comment-list", "share-buttons", "related-posts", "social-links", "newsletter-signup", "sidebar-left", "comments"])
def test_parts_of_an_article_that_are_not_its_text(name):
    beside = f"<div class='{name}'><p>Tweet this, now.</p><ul><li>First! A long comment, which goes on, and on.</li></ul></div>"
    for around in ("<article>%s</article>", "<div id='story'>%s</div>"):
        assert main_text(PAGE % (around % (BODY + beside))) == WANT


MENU = "".join(f"<{{0}}><a href='/{k}'>Topic {k}</a></{{0}}>" for k in range(6))
PROSE = [f"Sentence {k}, of a page without a wrapper, goes on for a while; it has marks, and more of them." for k in range(6)]


@pytest.mark.parametrize("menu", ["<ul>" + MENU.format("li") + "</ul>", MENU.format("div"), MENU.format("span"), "<p>" + MENU.format("b") + "</p>"])
def test_menus_on_pages_without_a_wrapper(menu):
    page = "<body>" + menu + "<h1>The title</h1>" + "".join(f"<p>{x}</p>" for x in PROSE) + "<p>Short.</p>" + menu + "</body>"
    assert main_text(page) == "\n".join(["The title", *PROSE, "Short."])


def test_the_scores_decide(monkeypatch):
    """With constant scores other elements, classes and links are taken."""
    pages = ["<body>" + "<ul>" + MENU.format("li") + "</ul>" + "".join(f"<p>{x}</p>" for x in PROSE) + "</body>",
             "<body><dl>" + "<dd>Label</dd>" * 30 + "</dl><div id='b'>" + "".join(f"<p>{x}</p>" for x in PROSE) + "</div><dl><dd>one</dd><dd>two</dd></dl></body>",
             "<body><div class='widget'>" + "".join(f"<p>{x}</p>" for x in PROSE) + "</div><table>" + "<tr><td>12</td><td>Cell</td></tr>" * 60 + "</table></body>"]
    scored = [main_text(p) for p in pages]
    assert all(t == "\n".join(PROSE) for t in scored)
    monkeypatch.setattr("casegauge.llm.main_text._scores", lambda nodes: __import__("numpy").ones(len(nodes)))
    assert all(main_text(p) != t for p, t in zip(pages, scored))


@pytest.mark.parametrize("open_", ["<font>x", "<div>x", "<center>x ", "<p><center><b>x", "<li>x", "<a href='#'>x", "<div class='ad'>x", "<article>x", "</p>x<u>", "<td>x"])
def test_time_grows_with_the_page(open_):
    import time
    start = time.process_time()
    main_text(open_ * 100_000)
    assert time.process_time() - start < 30


def test_pages_of_the_table(spark):
    """The tables' pages hold one article element of headings and paragraphs."""
    import html
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r.page_id: r for r in main_texts(pages, carry=["page_id", "url"]).collect()}
    for p in pages.collect():
        body = re.search("<article>(.*)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        text = "\n".join(b for b in blocks if b)
        assert got[p.page_id].text == text and got[p.page_id].n_chars == len(text)


def test_pages_with_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None, "own"), (1, None, "own"), (None, "<p>a, b.</p>", None)], "page_id long, html string, text string")
    got = main_texts(df)
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in got.collect()) == [("", 0), ("", 0), ("a, b.", 5)]
    assert main_texts(df.limit(0)).count() == 0


# --- quality classifier

def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    out = quality.judged(docs, labels.where(~half), carry=["doc_id"]).join(labels.where(half), "doc_id").collect()
    right = sum((r.p_quality >= 0.5) == (r.quality == 1) for r in out)
    assert right >= 0.97 * len(out)
    clean = [r for r in out if r.quality == 1 and r.toxic == 0]
    assert sum(r.rejected for r in clean) <= 0.01 * len(clean)
    toxic = [r for r in out if r.toxic == 1]
    assert len(toxic) >= 20 and sum(r.rejected for r in toxic) >= 0.9 * len(toxic)


def plain_evidence(text, weights):
    """Features of whole texts and of passages as sets, added up one by one."""
    features, tokens = quality._Features(), text.split()
    score = lambda part, h: weights[h][1] + sum(weights[h][0].get(k, 0.0) for k in features.of(part))
    if len(tokens) <= quality.PASSAGE:
        return score(tokens, "quality"), score(tokens, "toxic")
    step = quality.PASSAGE // 2
    parts = [tokens[i:i + quality.PASSAGE] for i in range(0, len(tokens) - step, step)]
    return sum(score(p, "quality") for p in parts) / len(parts), max([score(tokens, "toxic")] + [score(p, "toxic") for p in parts])


def test_scores_equal_plain_sums(spark, documents):
    rng = random.Random(7)
    texts = [r.text or "" for r in documents.collect()] + ["", " ", "a " * 450, "WOW!! " * 199, "x1 y2 " * 100 + "z", "é É ß 12 12 12"]
    tokens = sorted({t for x in texts for t in x.split()})
    names = [f"r{v}" for v in quality.LEVELS]
    for t in rng.sample(tokens, 1500):
        look = quality.shape(t)
        words = quality._LETTERS.findall(t.lower())
        names += [f"b{k} {b}" for b in quality.beginnings(words) for k in quality.TIMES if rng.random() < 0.5]
        names += ["w " + w for w in words] + ["s " + look] * (rng.random() < 0.3) + [f"s{v} {look}" for v in quality.LEVELS if rng.random() < 0.3]
    weights = {h: ({quality._key(n): rng.uniform(-1, 1) for n in names if rng.random() < 0.8}, rng.uniform(-1, 1)) for h in quality.HEADS}
    scorer = quality._Scorer(weights)
    for text in texts + [" ".join(rng.choices(tokens, k=rng.randint(150, 1300))) for _ in range(60)]:
        assert scorer.evidence(text) == pytest.approx(plain_evidence(text, weights), abs=1e-9)


def test_priors_equal_a_plain_computation(spark, documents, labels):
    """Rates and strengths of hosts and paths from the evidence, one document at a time."""
    rows = quality.judged(documents, labels).collect()
    p = {h: [1 / (1 + math.exp(-max(-30.0, min(30.0, r[f"evidence_{h}"])))) for r in rows] for h in quality.HEADS}
    for h in quality.HEADS:
        hosts, paths = {}, {}
        for r, x in zip(rows, p[h]):
            for group, key in ((hosts, r.host), (paths, (r.host, r.path))):
                group.setdefault(key, []).append(x)
        base = (sum(p[h]) + 0.5) / (len(rows) + 1)

        def strength(groups, toward):
            beyond = most = 0.0
            for k, xs in groups.items():
                n, rate = len(xs), min(1 - 1e-4, max(1e-4, toward(k)))
                if n > 1:
                    beyond += (sum(xs) - n * rate) ** 2 - n * rate * (1 - rate)
                    most += n * (n - 1) * rate * (1 - rate)
            if most <= 0 or beyond <= 0:
                return 1e6
            share = min(max(beyond / most, 1e-6), 0.99)
            return (1 - share) / share

        up = strength(hosts, lambda k: base)
        host_rate = lambda k: (sum(hosts[k]) + up * base) / (len(hosts[k]) + up)
        down = strength(paths, lambda k: host_rate(k[0]))
        for r, x in zip(rows, p[h]):
            at, own = hosts[r.host], paths[r.host, r.path]
            upper = (sum(at) - x + up * base) / (len(at) - 1 + up)
            site = min(1 - 1e-6, max(1e-6, (sum(own) - x + down * upper) / (len(own) - 1 + down)))
            odds = r[f"evidence_{h}"] - math.log(base / (1 - base)) + math.log(site / (1 - site))
            assert r[f"site_{h}"] == pytest.approx(site, rel=1e-6) and r[f"p_{h}"] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, odds)))), rel=1e-6, abs=1e-9)


def test_repeated_labels_and_rows(spark, documents, labels):
    """A label that stands twice counts twice in the fit; every row of the documents is judged."""
    out = quality.judged(documents.union(documents.limit(5)), labels.union(labels))
    assert out.count() == documents.count() + 5 and out.where("p_quality is null or p_toxic is null").count() == 0


def test_a_fit_takes_few_of_many_features(spark, monkeypatch):
    """Words that say nothing stay out of the fit, which is the one over all words."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(600):
        toxic, poor = i % 4 == 0, i % 8 < 2
        words = [f"w{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}" for _ in range(12)]
        words += ["sign"] * (toxic and i % 3 > 0) + ["mark"] * (poor and i % 5 > 0) + ["fine"] * (rng.random() < (0.2 if toxic else 0.5))
        docs.append((i, " ".join(words)))
        labels.append((i, int(not poor), int(toxic)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    widths, vectors = [], quality._vectors
    monkeypatch.setattr(quality, "_vectors", lambda shared: (widths.append(len(shared.value)), vectors(shared))[1])
    whole = quality.fit(docs, labels, penalty=0.3)
    all_, widths[:] = max(widths), []
    monkeypatch.setattr(quality, "AT_ONCE", 50, raising=False)
    got = quality.fit(docs, labels, penalty=0.3)
    assert whole["toxic"][0] and whole["quality"][0]
    assert max(widths) < all_ / 2
    for h in quality.HEADS:
        assert got[h][1] == pytest.approx(whole[h][1], abs=0.1)
        for key in got[h][0].keys() | whole[h][0].keys():
            assert got[h][0].get(key, 0.0) == pytest.approx(whole[h][0].get(key, 0.0), abs=0.1)


def test_features_that_a_fit_left_out_come_in(spark):
    """A feature is missed if the rows pull it by more than the penalty, beside the weights that there are."""
    rows = [(0.0, 1.0, [1, 3])] * 10 + [(0.0, 0.0, [2, 3])] * 10 + [(0.0, None, [4])] * 90
    train = spark.createDataFrame(rows, "y_quality double, y_toxic double, slots array<long>")
    none, some = {"toxic": ({}, 0.0)}, {"toxic": ({1: 9.0, 2: -9.0}, 0.0)}
    left = lambda weights, taken, bound: {h: sorted(k.tolist()) for h, k in quality._left_out(
        train, weights, {"toxic": quality.np.array(taken, quality.np.int64)}, {"toxic": bound}).items()}
    assert left(none, [], 4.0) == {"toxic": [1, 2]} and left(none, [1], 4.0) == {"toxic": [2]}
    assert left(none, [], 5.5) == {} and left(some, [1, 2], 0.1) == {}


def test_sites_are_shrunk(spark):
    """A sparse site's prior stays near the global rate; a large one's follows its documents."""
    good, bad = "clear plain words here", "BUY!! NOW!! CHEAP!!"
    rows = [(i, bad if i % 10 else good, "hot", "a") for i in range(600)] + [(1000 + i, good, "fine", "b") for i in range(600)] + [(5000, bad, "tiny", "c"), (5001, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], 0 if r[1] == bad else 1, 0) for r in rows if r[0] % 2] + [(9999, 1, 0), (1, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judged(docs, labels).collect()}
    assert len(got) == len(rows)
    assert got[1].site_quality < 0.2 and got[1001].site_quality > 0.9 and 0.2 < got[5000].site_quality < 0.95
    assert got[1].rejected and not got[1001].rejected and got[5000].rejected
    assert 0 <= got[5001].p_quality <= 1


def test_quality_without_labels_and_empty_tables(spark, documents, labels):
    kept = quality.accepted(documents, labels.limit(0))
    assert kept.columns == documents.columns and kept.count() == documents.count()
    assert quality.judged(documents.limit(0), labels).count() == 0
    extra = documents.limit(20).withColumn("host", F.lit("own")).withColumn("rejected", F.lit(None).cast("string"))
    assert quality.accepted(extra, labels.limit(0)).columns == extra.columns


def test_long_texts_are_judged_by_passage(spark):
    """A long clean text meets no toxic word by collision, and a toxic passage is not outvoted by what stands around it."""
    rng = random.Random(3)
    mild, vile = [f"mild{chr(97 + k)}" for k in range(26)], [f"vile{chr(97 + k)}" for k in range(20)]
    name = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    plain = lambda own, n=60: " ".join([name(rng.randrange(100_000)) for _ in range(n)] + rng.sample(own, 4))
    texts = [(plain(vile), 1) if i % 4 == 0 else (plain(mild), 0) for i in range(400)]
    clean = " ".join(name(k) for k in range(100_000, 300_000))
    part = " ".join([plain(mild) for _ in range(15)] + [plain(vile)] + [plain(mild) for _ in range(15)])
    rows = [(i, t, "a", "b") for i, (t, _) in enumerate(texts)] + [(1000, clean, "c", "d"), (1001, part, "e", "f"), (1002, " ".join(plain(mild) for _ in range(31)), "g", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 1, toxic) for i, (_, toxic) in enumerate(texts)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.evidence_toxic for r in quality.judged(docs, labels).where("doc_id >= 1000").collect()}
    assert got[1000] < 0 and got[1001] > 0 and got[1002] < 0


def test_new_words_take_one_hash_and_get_their_kinds(monkeypatch):
    """A word that is met first is hashed once, and its beginning is looked up among those met."""
    rng = random.Random(5)
    words = [f"{rng.choice(['begin', 'start', 'ÉTUDE'])}{rng.choice(string.ascii_lowercase)}{i}x{rng.choice(['', ',', '-wörter', '_q9'])}" for i in range(2_000)]
    weights = {quality._key(n): (0.5, -0.25) for n in ["w q", "w wörter", "b2 5 start", "s a+0x", *("w " + w.lower()[:6] for w in words[:20])]}
    kinds, calls = quality._Kinds(weights), []
    key = quality._key
    monkeypatch.setattr(quality, "_key", lambda name: calls.append(name) or key(name))
    got = [kinds[w] for w in words]
    assert len(calls) < 1_000, len(calls)
    for word, kind in zip(words, got):
        own = quality._LETTERS.findall(word.lower())
        assert kinds.words[kind] == tuple(sorted({key("w " + w) for w in own} & weights.keys()))
        assert kinds.starts[kind] == tuple(b for b in quality.beginnings(own) if b == "5 start")
