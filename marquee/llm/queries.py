"""Registered queries of this folder and their checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import cap_filters, decontamination, id_files, prefix_trie, whitening, kneser_ney, order_minhash, packing, page_difference, prefix_bpe, repeated_bytes, rule_ledger, url_model


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.judge_urls(table(spark, sf_dir, "pages"))


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.vector_links(table(spark, sf_dir, "embeddings"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.judged(table(spark, sf_dir, "documents"))


def op5_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_difference.extract(table(spark, sf_dir, "pages"))


def op6_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encode_decode(table(spark, sf_dir, "documents"))


def op7_elias_fano_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.round_trip(table(spark, sf_dir, "documents"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, then ``text``: what is left, and ``repeated``: whether any byte was removed."""
    return repeated_bytes.judged(table(spark, sf_dir, "documents"), with_text=True).withColumn("repeated", F.col("n_removed") > 0)


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.judged(table(spark, sf_dir, "documents"))


def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


def op13_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_url_model": op1_url_model,
    "op2_sum_of_squares_packing": op2_sum_of_squares_packing,
    "op3_cap_filters": op3_cap_filters,
    "op4_order_minhash": op4_order_minhash,
    "op5_page_difference": op5_page_difference,
    "op6_prefix_bpe": op6_prefix_bpe,
    "op7_elias_fano_ids": op7_elias_fano_ids,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_deep_shallow": op9_deep_shallow,
    "op10_rule_ledger": op10_rule_ledger,
    "op11_block_whitening": op11_block_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_aho_corasick": op13_aho_corasick,
}

ORACLES = {
    "op3_cap_filters": """
with recursive v as (
  select row_number() over () as r, vec_id, label, embedding,
    label is not null and embedding is not null and len(embedding) > 0
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0)) as sound
  from embeddings
),
n as (select r, label, list_transform(embedding, lambda x: x::double) as e from v where sound),
links as (
  select a.r as a, b.r as b from n as a join n as b
  on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98
),
reach as (
  select r as a, r as b from v
  union select reach.a, links.b from reach join links on links.a = reach.b
),
smallest as (select a, min(vec_id) as component_id from reach join v on v.r = reach.b group by a)
select v.vec_id, (select count(*) from links where links.a = v.r) as n_links, s.component_id,
  v.vec_id = s.component_id as kept
from v join smallest as s on s.a = v.r
""",
    "op10_rule_ledger": r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (
  select r, unnest(words) as word, generate_subscripts(words, 1) as i
  from (select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from d)
),
g as (
  select r, i, word as a, lead(word, 1) over p as b, lead(word, 2) over p as c
  from w window p as (partition by r order by i)
),
twice as (
  select r, a, b, c, list(i) as places from g where c is not null
  group by r, a, b, c having count(*) > 1
),
spots as (select r, unnest(places) as i from twice),
repeated as (
  select r, count(distinct i + k) as n from spots, (values (0), (1), (2)) as s(k) group by r
),
counted as (select r, count(*) as n, sum(length(word)) as chars from w group by r),
lines as (
  select r, count(*) as n, count(*) - count(distinct line) as dup
  from (select r, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
),
m as (
  select d.doc_id, coalesce(c.n, 0)::bigint as n_words, coalesce(c.chars, 0)::bigint as word_chars,
    (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(l.n, 0)::bigint as n_lines, coalesce(l.dup, 0)::bigint as n_dup_lines,
    coalesce(p.n, 0)::bigint as n_repeat_words
  from d left join counted c using (r) left join lines l using (r) left join repeated p using (r)
),
f as (
  select *, ((n_words < 50)::bigint | ((100 * n_repeat_words > 50 * n_words)::bigint << 1)
    | ((10 * n_symbols > n_words)::bigint << 2) | ((100 * n_dup_lines > 45 * n_lines)::bigint << 3)
    | ((word_chars < 2 * n_words)::bigint << 4) | ((word_chars > 15 * n_words)::bigint << 5)) as failures
  from m
)
select *, failures & 3 != 0 as base_failed, failures = 0 as kept from f
""",
    "op13_aho_corasick": r"""
with d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
b as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
),
win as (
  select distinct item_id, case when len(w) >= 10 then w[i:i + 9] else w end as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) as i from b where len(w) > 0)
),
ks as (select distinct len(win) as k from win),
g as (
  select r, k, p, w[p:p + k - 1] as gram
  from (select r, k, w, unnest(range(1, len(w) - k + 2)) as p from d join ks on len(d.w) >= ks.k)
),
m as (select g.r, g.p, g.k, win.item_id from g join win on win.win = g.gram),
h as (
  select r, count(distinct pos) as n
  from (select r, p + unnest(range(0, k)) as pos from (select distinct r, p, k from m))
  group by r
),
i as (
  select r, count(distinct item_id) as n, array_to_string(list_sort(list_distinct(list(item_id::varchar))), ',') as ids
  from m where item_id is not null group by r
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(i.n, 0)::bigint as n_items,
  sha256(coalesce(i.ids, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from d left join h using (r) left join i using (r)
""",
    "op12_prefix_trie": """
with o as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
  from conversations where conv_id is not null
),
l as (select c, count(*) as own_len from o group by c),
ids as (
  select c, c - c % 100 as b,
    xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(str_split(c::varchar, ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda crc, e: xor(xor(crc, e) >> 1, 3988292384 & -(xor(crc, e) & 1))), 4294967295) % 6 as h
  from l
),
t as (
  select ids.c, 0 as part, o.pos, o.role, o.text from ids join o on o.c = ids.b and o.pos < ids.h
  union all
  select o.c, 1 as part, o.pos, o.role, o.text from o join ids using (c) where o.pos >= ids.h
),
p as (select c, list({'r': role, 't': text} order by part, pos) as turns from t group by c),
conv as (select ids.c, p.turns from ids left join p using (c)),
m as (
  select c, d, coalesce(turns[1:d], []) as prefix, coalesce(len(turns), 0) = d as is_end
  from (select c, turns, unnest(range(0, coalesce(len(turns), 0) + 1)) as d from conv)
),
n as (
  select prefix, any_value(d) as depth, any_value(prefix[1:d - 1]) as parent_prefix, min(c) as conv_id, count(*) as n_convs,
    coalesce(array_to_string(list_sort(list(c) filter (where is_end)), ','), '') as ends,
    coalesce(length(any_value(prefix[d].t)), 0) as last_len
  from m group by prefix
),
ch as (select parent_prefix as prefix, count(*) as k from n where depth > 0 group by parent_prefix),
v as (select n.*, coalesce(ch.k, 0) as n_children from n left join ch using (prefix)),
sub as (
  select a.prefix, sum(case when b.n_children = 0 then 1 else 0 end) as n_leaves, sum((b.n_convs - 1) * b.last_len) as saved
  from v as a join v as b on b.depth >= a.depth and b.prefix[1:a.depth] = a.prefix
  group by a.prefix
)
select v.conv_id::bigint as conv_id, v.depth::bigint as depth, case when v.depth > 0 then par.conv_id end::bigint as parent_conv_id,
  v.n_convs::bigint as n_convs, v.n_children::bigint as n_children, sub.n_leaves::bigint as n_leaves, sub.saved::bigint as saved_tokens,
  sha256(v.ends) as ends_sha256
from v join sub using (prefix) left join v as par on par.prefix = v.parent_prefix and v.depth > 0
""",
}
