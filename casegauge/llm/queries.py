"""The registered queries of the numbered operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from casegauge.llm import (decontaminate, exact_dedup, line_dedup, main_text, merge_bpe, middles, near_dedup, pieces, quality, sharding,
                           substring_dedup, token_counts, vector_codes)
from casegauge.sources.tables import read_parquet as table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"), 8, carry=["doc_id", "text"]).drop("text")


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    hit = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), carry=["doc_id"])
    return hit.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      "contaminated")


@query
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"), carry=["doc_id"])


ORACLES["op6_exact_dedup"] = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') norm from documents)
select doc_id, min(doc_id) over w keep_id, count(*) over w group_size, doc_id = min(doc_id) over w kept, sha256(norm) text_sha256
from t window w as (partition by norm)"""

ORACLES["op4_decontaminate"] = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w from documents),
b as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w from benchmark),
bw as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') g from
    (select item_id, w, least(10, len(w)) k, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) i from b where len(w) > 0)),
ks as (select distinct k from bw),
dw as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') g from
    (select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) i from d, ks where len(w) >= k)),
hit as (select dw.doc_id, dw.i, dw.k, bw.item_id from dw join bw using (k, g)),
hw as (select doc_id, count(distinct p) n from (select doc_id, unnest(generate_series(i, i + k - 1)) p from hit) group by 1),
hi as (select doc_id, count(distinct item_id) n, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) s
    from hit group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(hw.n, 0) n_hit, coalesce(hi.n, 0) n_items, sha256(coalesce(hi.s, '')) items_sha256,
    coalesce(hw.n, 0) > 0 contaminated
from d left join hw using (doc_id) left join hi using (doc_id)"""


@query
def op2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    out = pieces.encoded(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), pieces.ids_digest("ids").alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id"])


@query
def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"), carry=["doc_id"])


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.repeats_removed(table(spark, folder, "documents"), carry=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op8_substring_dedup"] = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 49], ' ') g from
    (select doc_id, w, unnest(generate_series(1, len(w) - 49)) i from d where len(w) >= 50)),
low as (select g, min(doc_id) m from win group by 1),
gone as (select distinct doc_id, unnest(generate_series(i, i + 49)) p from win join low using (g) where m < doc_id),
cut as (select doc_id, list(p) p from gone group by 1),
kept as (select d.doc_id, len(w) n, coalesce(len(p), 0) r,
    array_to_string(case when p is null then w else list_filter(list_transform(w, lambda x, i: case when list_contains(p, i) then null else x end),
        lambda x: x is not null) end, ' ') t from d left join cut using (doc_id))
select doc_id, cast(n as bigint) n_words, cast(r as bigint) n_removed, sha256(t) kept_sha256 from kept"""


@query
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_texts(table(spark, folder, "pages"), carry=["page_id", "url"])


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    out = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"), carry=["doc_id"])
    return out.select("doc_id", "host", "path", *[F.round(c, 6).alias(c) for c in ("p_quality", "p_toxic", "site_quality", "site_toxic")],
                      "rejected")


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.lines_removed(table(spark, folder, "documents"), carry=["doc_id"])
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op11_merge_bpe(spark: SparkSession, folder: str) -> DataFrame:
    out = merge_bpe.encoded(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), pieces.ids_digest("ids").alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    out = middles.restored(middles.fill_in_middle(table(spark, folder, "documents"), carry=["doc_id"]))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("restored", 256).alias("restored_sha256"))


ORACLES["op12_fill_in_middle"] = r"""
with d as (select doc_id, coalesce(text, '') t, cast(length(coalesce(text, '')) as bigint) n, sha256('1:' || doc_id) h from documents),
k as (select *, cast('0x' || substr(h, 1, 8) as bigint) % (n + 1) a, cast('0x' || substr(h, 9, 8) as bigint) % (n + 1) b,
    cast('0x' || substr(h, 17, 8) as bigint) % 100 h3, cast('0x' || substr(h, 25, 8) as bigint) % 100 h4 from d),
f as (select *, least(a, b) p, greatest(a, b) - least(a, b) m, case when n = 0 or contains(t, '<P>') or contains(t, '<S>')
    or contains(t, '<M>') or h3 >= 90 then 'plain' when h4 < 20 then 'spm' else 'psm' end form from k),
c as (select *, substring(t, 1, p) x, substring(t, p + 1, m) y, substring(t, p + m + 1, n) z from f)
select doc_id, n, form, case when form <> 'plain' then p end prefix_chars, case when form <> 'plain' then m end middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y
        else '<S>' || z || '<P>' || x || '<M>' || y end) output_sha256, sha256(t) restored_sha256
from c"""


@query
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, folder, "embeddings"), carry=["vec_id"])


def _codes_sql(rounds: int = 2) -> str:
    """Two rounds and the last assignment, each a comparison of all parts with all entries of their position."""
    near = """select q.r, q.p, q.v, min_by(e.i, [sum_sq(q.v, e.v), e.i]) i, min(sum_sq(q.v, e.v)) d
        from q join {book} e using (p) group by q.r, q.p, q.v"""
    near = near.replace("sum_sq(q.v, e.v)", "list_sum(list_transform(list_zip(q.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))")
    steps, book = [], "b0"
    for turn in range(rounds):
        steps.append(f"""n{turn} as ({near.format(book=book)}),
s{turn} as (select p, i, list(cast(floor_div(t, c) as bigint) order by j) v from
    (select p, i, j, sum(v[j]) t, count(*) c from (select p, i, v, unnest(generate_series(1, len(v))) j from n{turn}) group by p, i, j) group by p, i),
b{turn + 1} as (select b.p, b.i, coalesce(s.v, b.v) v from {book} b left join s{turn} s on s.p = b.p and s.i = b.i)"""
                     .replace("floor_div(t, c)", "(t - ((t % c) + c) % c) // c"))
        book = f"b{turn + 1}"
    return f"""
with kept as (select row_number() over (order by vec_id) r, vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) w
    from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select r, p, w[p * (len(w) // 16) + 1:(p + 1) * (len(w) // 16)] v from (select r, w, unnest(generate_series(0, 15)) p from kept)),
b0 as (select p, r - 1 i, v from q where r <= 64),
{', '.join(steps)},
last as ({near.format(book=book)}),
codes as (select r, string_agg(printf('%02x', i), '' order by p) code, cast(sum(d) as bigint) error from last group by r),
book as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, i)) h from {book})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, h codebooks_sha256
from kept join codes using (r) cross join book"""


ORACLES["op13_vector_codes"] = _codes_sql()
