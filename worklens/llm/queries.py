"""Registered queries of the subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import resources

from pyspark.sql import DataFrame, SparkSession

from worklens.llm import (alignment, ann, debruijn, jaccard, kneser_ney, packing, quality_rules, quoting,
                          sharding, toxicity, trie, viterbi, warc)
from worklens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    return str(resources.files("public_tokenizers") / name)


@register("op1_noisy_or_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_balanced_posting_lists")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@register("op3_cost_balanced_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


OP4_SQL = r"""
with recursive m as (
  select conv_id, turn::bigint as turn, min({'text': text, 'role': role}) as m
  from conversations where conv_id is not null and turn is not null group by all
  union all
  select conv_id, turn::bigint, {'text': text, 'role': role}
  from conversations where conv_id is null or turn is null
), p as (
  select conv_id, turn, m.role as role, list_transform(
    string_split(coalesce(m.text, ''), chr(10)), lambda x: {
      'level': length(regexp_replace(regexp_extract(x, '^[ \t]*((?:>[ \t]*)+)', 1), '[^>]', '', 'g')),
      'body': regexp_replace(x, '^[ \t]*((?:>[ \t]*)+)', '')}) as lines
  from m
), l as (
  select conv_id, turn, u.level as level,
         trim(regexp_replace(lower(u.body), '\s+', ' ', 'g')) as h
  from (select conv_id, turn, unnest(lines) as u from p
        where conv_id is not null and turn is not null)
), own as (select * from l where level = 0 and h <> ''),
q as (select * from l where level > 0 and h <> ''),
here as (select conv_id, h, min(turn) as here_turn from own group by all),
firsts as (select h, min({'c': conv_id, 't': turn}) as f from own group by h),
near as (
  select q.conv_id, q.turn, q.level, q.h,
         case when here_turn < q.turn then here_turn end as here_turn
  from q left join here using (conv_id, h)
), links as (
  select conv_id, turn, level, to_conv, to_turn, count(*) as n from (
    select conv_id, turn, level, conv_id as to_conv, here_turn as to_turn
    from near where here_turn is not null
    union all
    select conv_id, turn, level, f.c, f.t from near join firsts using (h)
    where here_turn is null and f.c <> conv_id
  ) group by all
), counted as (
  select conv_id, turn, sum(n)::bigint as n_linked from links group by all
), parents as (
  select conv_id, turn, max({'a': -level, 'b': n, 't': to_turn}).t as parent_turn
  from links where to_conv = conv_id group by all
), tree as (
  select conv_id, turn, parent_turn as up, 1::bigint as depth from parents
  union all
  select t.conv_id, t.turn, x.parent_turn, t.depth + 1
  from tree t join parents x on x.conv_id = t.conv_id and x.turn = t.up
), roots as (
  select conv_id, turn, max({'d': depth, 'r': up}) as top from tree group by all
)
select p.conv_id, p.turn, p.role, parents.parent_turn,
       coalesce(roots.top.r, p.turn) as root_turn, coalesce(roots.top.d, 0) as depth,
       len(list_filter(lines, lambda x: x.level > 0)) as n_quoted,
       coalesce(n_linked, 0) as n_linked,
       coalesce(list_max(list_transform(lines, lambda x: x.level)), 0) as max_level,
       trim(array_to_string(list_transform(list_filter(lines, lambda x: x.level = 0),
                                           lambda x: x.body), chr(10)), ' ') as text
from p left join counted using (conv_id, turn) left join parents using (conv_id, turn)
left join roots using (conv_id, turn)
"""


@register("op4_quotation_linking", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quoting.conversations(table(spark, sf_dir, "conversations"))


@register("op6_weak_supervision")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
with recursive d as (
  select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
         lpad(bin(('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint), 60, '0') as bits
  from documents
), deep as (
  select d.*, g.depth, substr(bits, 1, g.depth) as prefix
  from d, (select unnest(range(0, 61)) as depth) g
), sums as (
  select prefix, sum(n_bytes)::bigint as shard_bytes, count(*) as shard_docs
  from deep group by prefix
), best as (
  select a.doc_id, a.n_bytes, a.prefix as shard, a.depth::bigint as depth, s.shard_bytes,
         s.shard_docs, s.shard_bytes <= {sharding.SHARD_BYTES} as fits,
         row_number() over (partition by a.doc_id order by a.depth) as rank
  from deep a join sums s using (prefix)
  where s.shard_bytes <= {sharding.SHARD_BYTES} or s.shard_docs = 1
)
select doc_id, n_bytes, shard, depth, shard_bytes, shard_docs, fits from best where rank = 1
"""


@register("op7_extendible_hashing", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@register("op8_streaming_viterbi")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


#: A window is identified by its first word's position and its words joined by a space.
OP5_SQL = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') as words
  from documents
), d as (
  select doc_id, words, row_number() over () as r from w
), n as (
  select r, doc_id, p, md5(array_to_string(words[p:p + 49], ' ')) as h
  from (select r, doc_id, words, unnest(range(1, len(words) - 48)) as p from d
        where len(words) >= 50)
), f as (
  select h, min(doc_id) as first from n group by h
), gone as (
  select distinct r, p + o as pos
  from (select n.r, n.p from n join f using (h) where f.first < n.doc_id), range(0, 50) t(o)
), kept as (
  select d.r, d.doc_id, len(words)::bigint as n_words,
         list_filter(words, lambda x, i: not list_contains(coalesce(g.pos, []), i)) as words,
         len(coalesce(g.pos, []))::bigint as n_removed
  from d left join (select r, list(pos) as pos from gone group by r) g using (r)
)
select doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) as kept_sha256 from kept
"""


@register("op5_de_bruijn_compaction", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.removed(table(spark, sf_dir, "documents"))


@register("op10_kneser_ney_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_jaccard_metric_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"), k=3, percent=90)


@register("op11_pair_bitmaps")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"),
                                     tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


#: A table-free CRC-32 of the decimal id; a node's key is the text of its turns' digests.
OP12_SQL = r"""
with recursive t as (
  select conv_id, md5(length(r)::varchar || ':' || r || x) as digest, length(x)::bigint as chars,
         row_number() over (partition by conv_id order by turn nulls first,
                            md5(length(r)::varchar || ':' || r || x)) as n
  from (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x
        from conversations where conv_id is not null)
), crc as (
  select c, list_reduce(list_concat([4294967295::bigint], list_transform(
      range(1, length(c::varchar) + 1), lambda i: ascii(substr(c::varchar, i, 1))::bigint)),
    lambda a, x: list_reduce(list_concat([xor(a, x)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda b, y: xor(b >> 1, (b & 1) * 3988292384))) as r
  from (select distinct conv_id as c from t)
), convs as (
  select c, c - c % 100 as first, xor(r, 4294967295) % 6 as h from crc
), lens as (
  select conv_id as first, least(max(n), 5) as has from t group by conv_id
), full_convs as (
  select c, convs.first, h, least(h, coalesce(has, 0)) as cut from convs left join lens using (first)
), rebuilt as (
  select c, n as pos, digest, chars from full_convs f join t on t.conv_id = f.first and t.n <= f.h
  union all
  select c, n - h + cut, digest, chars from full_convs f join t on t.conv_id = f.c and t.n > f.h
), keyed as (
  select c, pos, chars, string_agg(digest, ',') over (
    partition by c order by pos rows between unbounded preceding and current row) as key
  from rebuilt
), rows as (
  select c, pos, chars, key from keyed
  union all
  select c, 0, 0, '' from full_convs
), nodes as (
  select pos as depth, key, min(c) as conv_id, count(*) as n_convs, min(chars) as chars
  from rows group by all
), lasts as (
  select c, max(pos) as depth from rows group by c
), ends as (
  select depth, key, string_agg(c::varchar, ',' order by c) as ids
  from lasts join rows using (c) where pos = depth group by all
), parents as (
  select n.conv_id, n.depth, p.conv_id as parent_conv_id
  from nodes n join rows r on r.c = n.conv_id and r.pos = n.depth - 1
  join nodes p on p.depth = r.pos and p.key = r.key
), kids as (
  select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from parents group by all
), own as (
  select n.*, p.parent_conv_id, coalesce(k.n_children, 0) as n_children
  from nodes n left join parents p using (conv_id, depth) left join kids k using (conv_id, depth)
), totals as (
  select a.pos as depth, a.key, sum((n_children = 0)::bigint) as n_leaves, sum((n_convs - 1) * o.chars) as saved
  from own o join rows a on a.c = o.conv_id and a.pos <= o.depth group by all
)
select o.conv_id, o.depth::bigint as depth, o.parent_conv_id, n_convs, n_children,
       n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from own o join totals using (depth, key) left join ends using (depth, key)
"""


@register("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as payload_bytes,
         sha1(coalesce(html, '')) as payload_digest
  from pages
), g as (
  select *, case when payload_bytes >= 1000 then max(page_id) over (partition by html) end as largest
  from p
), r as (
  select *, coalesce(largest is not null and page_id is distinct from largest, false) as again from g
)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
       case when again then largest end as refers_to
from r
"""


@register("op13_warc_archives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf_dir, "pages"))
