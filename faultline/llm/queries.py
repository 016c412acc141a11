"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from faultline.llm import (cws, decontam, licenses, lm, merkle, mixing, ngram_join, pii, quality, secret_scan, suffix,
                           tokens, trie)
from faultline.llm.common import shared_path, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(tokens.VOCABULARY))
    return tokens.token_digest(spark, path)


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.cut_report(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), depth=5)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_report(table(spark, sf_dir, "documents"), width=3, percent=90)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proof_report(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.edit_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_token_output, op3_license_scans, op4_suffix_dedup, op5_pii, op6_decontamination, op7_lm_scoring,
    op8_ngram_join, op9_secret_scans, op10_mixing, op11_merkle_manifest,
    op12_conversation_trie, op13_document_fingerprints)}

OP1_SQL = r"""
with w as (
  select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from (select doc_id, coalesce(text, '') as t from documents)),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n
  from (select doc_id, i, array_to_string(w[i:i+7], ' ') as g
        from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from w))),
repeats as (
  select doc_id, count(distinct j) as n_repeat_words
  from (select doc_id, unnest(range(i, i + 8)) as j from windows where n > 1) group by doc_id),
facts as (
  select w.doc_id, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(length(t) - length(replace(t, '!', '')) as bigint) as n_shouts,
    cast(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as bigint) as n_stutters,
    cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from w left join repeats on w.doc_id = repeats.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 10 * n_symbols > n_words or 5 * n_shouts > n_words
    or word_chars > 25 * n_words or 2 * word_chars < 3 * n_words or 5 * n_stutters > n_words
    or (n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines)) as kept
from facts"""

OP8_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i+2], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
both_of as (
  select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.g = b.g and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id),
links as (
  select p.a, p.b from both_of p join n x on p.a = x.doc_id join n y on p.b = y.doc_id
  where 100 * p.i >= 90 * (x.n + y.n - p.i)),
e as (select a, b from links union all select b, a from links),
reach(a, b) as (
  select doc_id, doc_id from documents
  union
  select reach.a, e.b from reach join e on reach.b = e.a)
select r.a as doc_id, coalesce(n.n, 0) as n_shingles, r.component_id
from (select a, min(b) as component_id from reach group by a) r left join n on n.doc_id = r.a"""

# crc32 of a decimal id, bit by bit: a byte enters at every eighth step
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
    string_split({0}::varchar, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""

OP11_SQL = r"""
with recursive f as (
  select doc_id, source, {crc} % 2 = 0 and doc_id is not null as touched, text,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
  from documents),
h as (
  select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(case when touched then replace(text, chr(10), '') else text end) || ':' ||
                            case when touched then replace(text, chr(10), '') else text end, '-')) as tampered
  from f),
leaves as (
  select *, dense_rank() over (order by source nulls first) - 1 as t, count(*) over (partition by source) as n,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p
  from h),
nodes(t, level, p, n, h) as (
  select t, 0, p, n, leaf from leaves
  union all
  select t, level + 1, p // 3, max(n + 2) // 3, sha256(string_agg(h, '' order by p))
  from nodes where n > 1 group by t, level, p // 3),
subroots as (select t, h from nodes where n = 1),
tops(level, p, n, h) as (
  select 0, t, count(*) over (), h from subroots
  union all
  select level + 1, p // 3, max(n + 2) // 3, sha256(string_agg(h, '' order by p)) from tops where n > 1
  group by level, p // 3),
beside as (
  select a.t, a.level, a.p, coalesce(string_agg(b.h, '' order by b.p) filter (b.p < a.p), '') as l,
    coalesce(string_agg(b.h, '' order by b.p) filter (b.p > a.p), '') as r
  from nodes a join nodes b on a.t = b.t and a.level = b.level and a.p // 3 = b.p // 3 where a.n > 1 group by all),
above as (
  select a.level, a.p, coalesce(string_agg(b.h, '' order by b.p) filter (b.p < a.p), '') as l,
    coalesce(string_agg(b.h, '' order by b.p) filter (b.p > a.p), '') as r
  from tops a join tops b on a.level = b.level and a.p // 3 = b.p // 3 where a.n > 1 group by all),
folds(doc_id, leaf, t, level, p, n, h, proof) as (
  select doc_id, leaf, t, 0, p, n, tampered, '' from leaves
  union all
  select f.doc_id, f.leaf, f.t, f.level + 1, f.p // 3, (f.n + 2) // 3, sha256(b.l || f.h || b.r), f.proof || b.l || b.r
  from folds f join beside b on f.t = b.t and f.level = b.level and f.p = b.p),
climbs(doc_id, leaf, t, level, p, n, h, proof) as (
  select doc_id, leaf, t, 0, t, (select count(*) from subroots), h, proof from folds where n = 1
  union all
  select c.doc_id, c.leaf, c.t, c.level + 1, c.p // 3, (c.n + 2) // 3, sha256(a.l || c.h || a.r), c.proof || a.l || a.r
  from climbs c join above a on c.level = a.level and c.p = a.p)
select c.doc_id, c.leaf, s.h as subroot, r.h as root, sha256(c.proof) as proof_sha256, c.h as folded_root,
  c.h = r.h as verified, length(c.proof) // 64 as n_siblings
from climbs c join subroots s on c.t = s.t, (select h from tops where n = 1) r where c.n = 1""".replace(
    "{crc}", CRC32_SQL.format("doc_id"))

OP12_SQL = r"""
with t as (
  select conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as cell,
    length(coalesce(text, '')) as size, turn
  from conversations where conv_id is not null),
p as (select *, row_number() over (partition by conv_id order by turn nulls first, cell, size) - 1 as pos from t),
c as (select conv_id, {crc} % 6 as h from (select distinct conv_id from p)),
r as (
  select c.conv_id, 0 as part, pos, cell, size from c join p on p.conv_id = c.conv_id - c.conv_id % 100 and pos < h
  union all
  select c.conv_id, 1, pos, cell, size from c join p on p.conv_id = c.conv_id and pos >= h),
s as (
  select c.conv_id, coalesce(list(cell order by part, pos) filter (cell is not null), []) as cells,
    coalesce(list(size order by part, pos) filter (cell is not null), []) as sizes
  from c left join r on c.conv_id = r.conv_id group by c.conv_id),
m as (
  select conv_id, d, len(cells) as n, array_to_string(cells[1:d], '') as key, sizes[d] as size
  from (select *, unnest(range(0, len(cells) + 1)) as d from s)),
nodes as (
  select key, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs, coalesce(any_value(size), 0) as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d), '')) as ends_sha256
  from m group by key),
family as (
  select nodes.*, coalesce(k.n, 0) as n_children
  from nodes left join (select left(key, length(key) - 32) as up, count(*) as n from nodes where key <> '' group by 1) k
    on nodes.key = k.up),
sums as (
  select a.key, sum(case when b.n_children = 0 then 1 else 0 end)::bigint as n_leaves,
    sum((b.n_convs - 1) * b.size)::bigint as saved_tokens
  from family a join family b on starts_with(b.key, a.key) group by a.key)
select f.conv_id, f.depth::bigint as depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
  f.ends_sha256
from family f join sums on f.key = sums.key
  left join nodes u on f.key <> '' and u.key = left(f.key, length(f.key) - 32)""".replace(
    "{crc}", CRC32_SQL.format("conv_id"))

ORACLE: dict[str, str] = {"op1_quality_rules": OP1_SQL, "op8_ngram_join": OP8_SQL, "op11_merkle_manifest": OP11_SQL,
                          "op12_conversation_trie": OP12_SQL}
