"""Acceptance queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from giftlink.llm import (chat_format, collocations, cotraining, hamming_topk, language_id, merkle_manifest,
                          order_minhash, packing, permutation_index, sentence_pieces, suffix_dedup, token_counts, url_filter)
from giftlink.llm.common import table
from pyspark.sql import functions as F

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


def op1_cotraining(spark, sf_dir):
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op3_hamming_topk(spark, sf_dir):
    codes = hamming_topk.sign_codes(table(spark, sf_dir, "embeddings"))
    return hamming_topk.search(codes, codes.where("vec_id % 100 = 0"))


def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op6_url_filter(spark, sf_dir):
    rules = spark.sql(f"select * from values {_RULE_VALUES} as t(host, path, verdict)")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op7_permutation_index(spark, sf_dir):
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op8_sentence_pieces(spark, sf_dir):
    out = sentence_pieces.round_trip(table(spark, sf_dir, "documents"))
    return out.select("doc_id", (F.octet_length("ids_le") / 4).cast("long").alias("n_ids"),
                      F.crc32("ids_le").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_chat_format(spark, sf_dir):
    return chat_format.rotate(table(spark, sf_dir, "conversations"))


def op10_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_rows")


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return merkle_manifest.Manifest(docs, merkle_manifest.tampered(docs)).check()


def op12_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    return language_id.Identifier(docs.where("not held_out")).predict(docs, "doc_id,held_out")


def op13_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_cotraining, op2_packing, op3_hamming_topk, op4_token_counts, op5_suffix_dedup,
                                   op6_url_filter, op7_permutation_index, op8_sentence_pieces,
                                   op9_chat_format, op10_order_minhash, op11_merkle_manifest, op12_language_id,
                                   op13_collocations)}

ORACLES = {
    "op3_hamming_topk": f"""
with v as (
  select vec_id, embedding as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
d as (
  select q.vec_id as query_id, v.vec_id,
         cast(len(list_filter(list_zip(q.e, v.e), lambda z: (z[1] > 0) <> (z[2] > 0))) as integer) as distance
  from v as q, v where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by distance, vec_id) as rank from d)
select query_id, cast(rank as integer) as rank, vec_id, distance from r where rank <= {hamming_topk.K}""",
    "op6_url_filter": f"""
with rules(rhost, rpath, v) as (values {_RULE_VALUES}),
cut as (
  select page_id, row_number() over () as row_no,
         case when url is null or position('://' in url) = 0 then ''
              else substring(url, position('://' in url) + 3) end as rest from pages),
u as (
  select page_id, row_no,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
fit as (
  select row_no, rhost || rpath as rule, v,
         row_number() over (partition by row_no order by length(rhost || rpath) desc, length(rhost) desc) as k
  from u join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict
from u left join fit on u.row_no = fit.row_no and k = 1""",
    "op9_chat_format": f"""
with t as (
  select conv_id, turn, coalesce(role, 'unknown') as role, replace(coalesce(text, ''), '<|', '< |') as clean, text,
         cast(floor(turn / {chat_format.TURNS_PER_PART}.0) as bigint) as part from conversations),
n as (
  select *, row_number() over (partition by conv_id, part
                               order by turn nulls first, role nulls first, text nulls first) as rn from t),
p as (select distinct conv_id as c2, role as perspective from t where role <> 'system'),
v as (
  select conv_id, perspective, part, cast(floor((rn - 1) / {chat_format.TURNS_PER_PART}.0) as bigint) as subpart, rn,
         case when role = 'system' then '<|im_start|>system' || chr(10)
              when role = perspective then '<|im_start|>assistant' || chr(10)
              else '<|im_start|>user name=' || replace(role, '<|', '< |') || chr(10) end as head,
         clean || '<|im_end|>' || chr(10) as body, role = perspective as own
  from n join p on conv_id is not distinct from c2),
o as (
  select *, sum(length(head) + length(body)) over (partition by conv_id, perspective, part, subpart order by rn) as e
  from v)
select conv_id, perspective, part, subpart, count(*) as n_turns,
       string_agg(head || body, '' order by rn) as rendered,
       coalesce(string_agg(cast(e - length(body) as varchar) || ':' || cast(e as varchar), ',' order by rn)
         filter (own), '') as loss_spans,
       sum(length(head) + length(body)) as n_chars,
       coalesce(sum(length(body)) filter (own), 0) as n_loss_chars
from o group by conv_id, perspective, part, subpart""",
    "op11_merkle_manifest": """
with recursive f as (
  select doc_id, lang,
         coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') as f1,
         coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as f2,
         coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as f3,
         coalesce(strlen(cast(n_chars + 1 as varchar)) || ':' || (n_chars + 1), '-') as f3_told,
         coalesce(strlen(text) || ':' || text, '-') as f4,
         -- CRC-32 of the digits: a byte is a number >= 0, each -1 shifts by a bit
         xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
           range(1, 1 + length(cast(doc_id as varchar))),
           lambda i: list_concat([ord(cast(doc_id as varchar)[i])::bigint], [-1, -1, -1, -1, -1, -1, -1, -1])))),
           lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end)) as crc
  from documents),
leaves as (
  select doc_id, lang, sha256(f1 || f2 || f3 || f4) as leaf,
         case when crc % 7 = 0 then sha256(f1 || f2 || f3_told || f4) end as told from f),
d as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by lang) as n from leaves),
lv as (
  select lang, 0 as l, pos, n, leaf as h from d
  union all
  select lang, l + 1, pos // 2, (n + 1) // 2, sha256(h || coalesce(nxt, '')) from (
    select *, lead(h) over (partition by lang order by pos) as nxt from lv where n > 1) where pos % 2 = 0),
subs as (
  select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n
  from lv where n = 1),
tv as (
  select 0 as l, pos, n, subroot as h from subs
  union all
  select l + 1, pos // 2, (n + 1) // 2, sha256(h || coalesce(nxt, '')) from (
    select *, lead(h) over (order by pos) as nxt from tv where n > 1) where pos % 2 = 0),
paths as (
  select d.lang, d.pos, own.l, case when (own.pos & 1) = 1 then 'L' else 'R' end || coalesce(sib.h, '') as s
  from d join lv as own on own.lang is not distinct from d.lang and own.n > 1 and own.pos = d.pos >> own.l
  left join lv as sib on sib.lang is not distinct from d.lang and sib.l = own.l and sib.pos = xor(own.pos, 1)
  union all
  select d.lang, d.pos, 1000 + own.l, case when (own.pos & 1) = 1 then 'L' else 'R' end || coalesce(sib.h, '')
  from d join subs on subs.lang is not distinct from d.lang
  join tv as own on own.n > 1 and own.pos = subs.pos >> own.l
  left join tv as sib on sib.l = own.l and sib.pos = xor(own.pos, 1)),
ways as (select lang, pos, list(s order by l) as way from paths group by lang, pos),
done as (
  select d.doc_id, d.leaf, subs.subroot, (select h from tv where n = 1) as root,
         sha256(coalesce(list_aggregate(list_transform(way, lambda x: x[2:]), 'string_agg', ''), '')) as proof_sha256,
         list_reduce(list_concat(['R' || coalesce(told, leaf)], coalesce(way, [])),
           lambda h, x: 'R' || case when x[1] = 'L' then sha256(x[2:] || h[2:]) else sha256(h[2:] || x[2:]) end)[2:]
           as folded_root
  from d join subs on subs.lang is not distinct from d.lang
  left join ways on ways.lang is not distinct from d.lang and ways.pos = d.pos)
select *, folded_root = root as verified from done""",
    "op13_collocations": f"""
with words as (
  select coalesce(lang, 'und') as lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')), '[ \\t]+'), lambda w: w <> '') as w from documents),
n as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
f as (
  select lang, k, phrase, count(*) as a from (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                                          lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
    from words, (values (1), (2), (3), (4)) as t(k) where len(w) >= k) group by lang, k, phrase
  having count(*) >= {collocations.SUPPORT}),
cand as (select *, string_split(phrase, ' ') as w from f where k > 1),
cuts as (
  select lang, phrase, k, a, c, array_to_string(w[:c], ' ') as lp, array_to_string(w[c + 1:], ' ') as rp
  from cand, (values (1), (2), (3)) as t(c) where c < k),
scored as (
  select cuts.*, x.a as l, y.a as r, cast((2000000::hugeint * cuts.a) // (x.a + y.a) as bigint) as score
  from cuts join f as x on x.lang = cuts.lang and x.phrase = lp join f as y on y.lang = cuts.lang and y.phrase = rp),
weakest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
inner_ as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(a) as longer
  from cand, (values (2), (3)) as t(m), (values (1), (2), (3)) as s(i) where m < k and i + m - 1 <= k group by 1, 2),
kept as (
  select weakest.* from weakest left join inner_ using (lang, phrase)
  where longer is null or 100::hugeint * longer < {collocations.EXPLAINED} * weakest.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= {collocations.TOP}""",
}
