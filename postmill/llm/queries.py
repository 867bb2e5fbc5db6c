"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, jaccard, language, lm, mix, pages, phrases, quality, secrets, shard, suffixes, tiles, vectors
from .common import read


def op1_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op1(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.op2(read(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.op3(read(spark, sf_dir, "documents"))


def op4_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.op4(read(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.op5(read(spark, sf_dir, "documents"))


def op6_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.op6(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.op7(read(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op8(read(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op9(read(spark, sf_dir, "documents"))


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.op10(read(spark, sf_dir, "documents"))


def op11_phrase_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.op11(read(spark, sf_dir, "documents"))


def op12_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.op12(read(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.op13(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_machine,
        op2_adaptive_scan,
        op3_language_id,
        op4_bloom_lm,
        op5_mix_sources,
        op6_suffix_decontamination,
        op7_html_extraction,
        op8_secret_scan,
        op9_jaccard_join,
        op10_feistel_shards,
        op11_phrase_stripes,
        op12_embedding_tiles,
        op13_filter_audit,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op6_suffix_decontamination": rf"""
with docs as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
sized as (select item, w, least(10, len(w)) as size from items where len(w) > 0),
windows as (
  select distinct item, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as words
  from sized),
places as (
  select doc_id, size, unnest(range(1, len(w) - size + 2)) as p, w from docs, (select distinct size from windows)),
matches as (
  select doc_id, item, p, size from places join windows using (size) where array_to_string(w[p:p + size - 1], ' ') = words),
hits as (
  select doc_id, count(distinct hit) as n_hit from (select doc_id, unnest(range(p, p + size)) as hit from matches) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item from matches) group by doc_id)
select d.doc_id as doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join hits h on d.doc_id = h.doc_id left join found f on d.doc_id = f.doc_id""",
    "op9_jaccard_join": rf"""
with recursive docs as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(case
    when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from docs),
sizes as (select d.doc_id, count(s) as n from docs d left join shingles s on d.doc_id = s.doc_id group by d.doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as n_both from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select x, y from shared join sizes a on x = a.doc_id join sizes b on y = b.doc_id where 100 * n_both >= 75 * (a.n + b.n - n_both)),
reached as (
  select doc_id as x, doc_id as y from docs union select r.x, l.y from reached r join links l on r.y = l.x)
select doc_id, n as n_shingles, component_id from sizes join (select x, min(y) as component_id from reached group by x) on doc_id = x""",
    "op11_phrase_stripes": rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
runs as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
  from runs, (values (1), (2), (3)) sizes(size) where len(w) >= size),
f as (select lang, size, phrase, cast(count(*) as hugeint) as a from grams group by all),
totals as (select lang, sum(a) as n from f where size = 1 group by lang),
candidates as (select *, string_split(phrase, ' ') as w from f where size > 1 and a >= 10),
cuts as (
  select c.*, k, x.a as l, y.a as r, (1000000 * c.a * c.a) // (x.a * y.a) as score
  from (select *, unnest(range(1, size)) as k from candidates) c
  join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1:], ' ')),
best as (select *, row_number() over (partition by lang, phrase order by score, k) as nth from cuts),
inside as (
  select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, a from candidates where size = 3),
longest as (select lang, phrase, max(a) as longer from inside group by all),
ranked as (
  select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank
  from best b left join longest i on b.lang = i.lang and b.phrase = i.phrase
  where nth = 1 and 100 * coalesce(longer, 0) < 50 * a)
select r.lang as lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n,
  cast(score as bigint) as score
from ranked r join totals t on r.lang = t.lang where rank <= 2000""",
    "op12_embedding_tiles": """
with recursive doubled as (select vec_id, cast(embedding as double[]) as v from embeddings),
vectors as (
  select vec_id, v from doubled where len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as x, b.vec_id as y from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.9),
reached as (
  select vec_id as x, vec_id as y from embeddings union select r.x, l.y from reached r join links l on r.y = l.x),
roots as (select x, min(y) as component_id from reached group by x),
degrees as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join roots r on vec_id = r.x left join degrees d on vec_id = d.x""",
    "op13_filter_audit": r"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
split as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as first_id from texts),
judged as (
  select part, doc_id, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(first_id < doc_id, false)] as fails
  from split),
rows_of as (
  select part, fails, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic
  from judged d left join labels l on d.doc_id = l.doc_id),
counts as (select part, fails, good, toxic, count(*) as n from rows_of group by all),
f as (select unnest(range(1, 6)) as i),
orders as (
  select [a.i, b.i, c.i, d.i, e.i] as o from f a, f b, f c, f d, f e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps as (select o, unnest(range(1, 6)) as step from orders),
replayed as (
  select part, o, step, n, good, toxic, fails[o[step]] as here,
    len(list_filter(o[1:step - 1], lambda i: fails[i])) > 0 as gone, len(list_filter(fails, lambda x: x)) = 1 as alone
  from counts, steps),
summed as (
  select part, o, step,
    sum(case when not gone and not here then n else 0 end) as kept, sum(case when here and not gone then n else 0 end) as removed,
    sum(case when here and gone then n else 0 end) as redundant, sum(case when here and alone then n else 0 end) as unique_fails,
    sum(case when here and not gone and good then n else 0 end) as good_lost,
    sum(case when here and not gone and toxic then n else 0 end) as toxic_lost
  from replayed group by all)
select part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') as filter_order, cast(step as integer) as step,
  cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, o[step]) as bigint) as shapley
from summed""",
}
