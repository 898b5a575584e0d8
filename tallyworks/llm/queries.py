"""Registered queries of the corpus operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.packing import pack_documents

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = pack_documents(docs, _tokenizer(), keep_ids=False)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.near_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op3_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.shared import scratch_folder
    from tallyworks.llm.token_grammar import read_tokens, token_folder, write_tokens

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_folder(scratch_folder(spark))
    write_tokens(docs, path, _tokenizer())
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.learning import held_out
    from tallyworks.llm.toxicity import fit_toxicity, score_toxicity

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = _table(spark, sf_dir, "labels").filter(~held_out("doc_id", 4, 2))
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return _scored(scored, held_out("doc_id", 4, 2), "toxicity")


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with seeded dropout, and the digest of what they decode to."""
    import public_tokenizers

    from tallyworks.llm.merge_dropout import encode_and_decode

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), seed=1)
    return done.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), F.sha2("text", 256).alias("decoded_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.learning import held_out
    from tallyworks.llm.quality import fit_quality, score_quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0))
    scored = score_quality(docs, fit_quality(docs, labels))
    return _scored(scored, held_out("doc_id", 5, 0), "quality_score")


def _scored(scored: DataFrame, held: Column, score: str) -> DataFrame:
    return scored.select("doc_id", held.alias("held_out"), F.col(score).alias("score"), (F.col(score) >= 0.3).cast("int").alias("predicted"))


#: The rules that op5 applies.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.url_filters import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.fingerprints import compare_with_edits

    return compare_with_edits(_table(spark, sf_dir, "documents"), radius=3, every=50)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.quality_rules import quality_rules

    judged = quality_rules(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.substring_dedup import dedup_substrings

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_substrings(docs, window=13, keep_layout=False)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.mixing import mix_sources

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs, spans=False).select("doc_id", "size", "source_size", "target", "taken")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.conversation_trie import rebuilt_trie

    return rebuilt_trie(_table(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyworks.llm.importance import resample

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample(docs, _table(spark, sf_dir, "benchmark"), seed="7", percent=25)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_token_grammar": op3_token_grammar,
    "op4_toxicity": op4_toxicity,
    "op5_url_filters": op5_url_filters,
    "op6_simhash": op6_simhash,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_merge_dropout": op9_merge_dropout,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_source_mixing": op11_source_mixing,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_importance_resampling": op13_importance_resampling,
}

#: DuckDB SQL with the same rows, for the queries that SQL can express on whole tables.
SQL: dict[str, str] = {
    "op2_minhash_near_dedup": r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+', ' ', 'g'), ' '), lambda x: x <> '') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 3 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) end) as s from w),
x as (select doc_id, len(s) as n, unnest(s) as g from s),
p as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as k from x a join x b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p where 100 * k >= 85 * (na + nb - k)),
both_ways as (select a, b from e union all select b, a from e),
reach(a, c) as (select doc_id, doc_id from documents union select r.a, e.b from reach r join both_ways e on r.c = e.a),
c as (select a, min(c) as c from reach group by a)
select s.doc_id, len(s.s) as n_shingles, c.c as component_id, s.doc_id = c.c as kept from s join c on s.doc_id = c.a
""",
    "op5_url_filters": r"""
with recursive p as (select page_id, html,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
rules as (select * from (values ('allow', 'org', '/', 'org/'), ('block', 'example.org', '/es/', 'example.org/es/'),
  ('block', 'example.org', '/en/1', 'example.org/en/1'), ('allow', 'com', '/fr/', 'com/fr/'), ('block', 'com', '/de/', 'com/de/')) as t(v, h, s, rule)),
hits as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(v, length(rule)) as v from p join rules
  on (host = h or ends_with(host, '.' || h)) and starts_with(path, s) group by page_id),
j as (select p.*, rule, v from p left join hits using (page_id)),
raw as (select host as src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) as t from p where contains(html, '//')),
links as (select src, translate(coalesce(regexp_extract(case when starts_with(t, '//') then 'http:' || t else t end, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as dst from raw),
e as (select src, dst, count(*) as n from links where src <> '' and dst <> '' and src <> dst group by all),
f as (select 'allow' as v, src, dst, 0.85 * n / sum(n) over (partition by src) as w from e
  union all select 'block', dst, src, 0.85 * n / sum(n) over (partition by dst) from e),
s as (select v, host, 0.15 * count(*)::double as m from j where v is not null and host <> '' group by all),
r as (select 0 as k, v, host, m from s
  union all select any_value(x.k), x.v, x.host, sum(x.m) from (
    select k + 1 as k, r.v, f.dst as host, r.m * f.w as m from r join f on f.v = r.v and f.src = r.host where k < 24
    union all select q.k, s.v, s.host, s.m from s, (select distinct k + 1 as k from r where k < 24) q) x group by x.v, x.host),
d as (select host, sum(case when v = 'block' then m else 0 end) / sum(m) as share from r where k = 24 group by host)
select page_id, j.host, path, rule, coalesce(v, case when round(share, 9) > 0.5 then 'block' else 'allow' end) as verdict from j left join d on j.host = d.host
""",
    "op8_substring_dedup": r"""
with d as (select doc_id, coalesce(list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> ''), []::varchar[]) as w from documents),
p as (select doc_id, w, i, array_to_string(w[i:i+12], ' ') as s from d, unnest(range(1, len(w) - 11)) as t(i)),
f as (select s, min(doc_id) as m from p group by s),
r as (select distinct p.doc_id, p.i + k as j from p join f using (s), unnest(range(0, 13)) as u(k) where f.m < p.doc_id),
c as (select doc_id, count(*) as n, list(j) as js from r group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(c.n, 0) as n_removed,
 sha256(array_to_string(case when c.n is null then w else list_transform(list_filter(range(1, len(w) + 1), lambda j: not list_contains(c.js, j)), lambda j: w[j]) end, ' ')) as kept_sha256
from d left join c using (doc_id)
""",
    "op12_conversation_trie": r"""
with recursive bits as (select i as n, i::ubigint as c, 0 as k from range(256) as r(i)
  union all select n, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end, k + 1 from bits where k < 8),
crc as (select list(c order by n) as t from bits where k = 8),
own as (select conv_id, row_number() over (partition by conv_id order by turn nulls first) as p,
  struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) as t from conversations where conv_id is not null),
lengths as (select conv_id, max(p) as n from own group by conv_id),
convs as (select l.conv_id, l.conv_id - l.conv_id % 5 as base, xor(list_reduce(
  list_transform(string_split(l.conv_id::varchar, ''), lambda x: ascii(x)::ubigint),
  lambda a, x: xor(crc.t[((xor(a, x) & 255) + 1)::bigint], a >> 8), 4294967295::ubigint), 4294967295::ubigint)::bigint % 9 as h
  from lengths l, crc),
turns as (select c.conv_id, p, t from convs c join own o on o.conv_id = c.base where p <= h
  union all select c.conv_id, least(h, coalesce(b.n, 0)) + p - h, t from convs c join own o on o.conv_id = c.conv_id left join lengths b on b.conv_id = c.base where p > h),
seq as (select c.conv_id, coalesce(list(t order by p) filter (p is not null), []) as s from convs c left join turns using (conv_id) group by c.conv_id),
steps as (select conv_id, d, s[1:d] as prefix, d = len(s) as ends from seq, unnest(range(0, len(s) + 1)) as u(d)),
nodes as (select prefix, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
  coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '') as ended from steps group by prefix),
kids as (select prefix[1:depth - 1] as prefix, count(*) as n_children from nodes where depth > 0 group by 1),
valued as (select n.*, coalesce(n_children, 0) as n_children,
  case when depth > 0 then (n_convs - 1) * octet_length(encode(n.prefix[depth].x)) else 0 end as saved from nodes n left join kids k on k.prefix = n.prefix),
sums as (select v.prefix[1:d] as prefix, sum(saved)::bigint as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from valued v, unnest(range(0, depth + 1)) as u(d) group by 1)
select v.conv_id, depth, above.conv_id as parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(v.ended) as ends_sha256
from valued v join sums s on s.prefix = v.prefix left join (select prefix as up, conv_id from nodes) above on v.depth > 0 and above.up = v.prefix[1:v.depth - 1]
""",
    "op13_importance_resampling": r"""
with recursive bits as (select i as n, i::ubigint as c, 0 as k from range(256) as r(i)
  union all select n, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end, k + 1 from bits where k < 8),
crc as (select list(c order by n) as t from bits where k = 8),
texts as (select 0 as side, doc_id as id, text from documents union all select 1, item_id, text from benchmark),
w as (select side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from texts),
f as (select side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as g from w),
known as (select g, hex(encode(g)) as x from (select distinct g from f)),
b as (select g, (xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::ubigint),
  lambda a, y: xor(crc.t[((xor(a, y) & 255) + 1)::bigint], a >> 8), 4294967295::ubigint), 4294967295::ubigint) % 10000)::bigint as b from known, crc),
fb as (select side, id, b from f join b using (g)),
n as (select b, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from fb group by b),
total as (select sum(s)::double as ss, sum(t)::double as tt from n),
gain as (select b, floor(1000 * ln((t + 1.0::double) * (ss + 10000) / ((s + 1.0::double) * (tt + 10000))))::bigint as g from n, total),
weights as (select id, count(*) as n_features, sum(g) as g from fb join gain using (b) where side = 0 group by id),
scored as (select w.id as doc_id, len(w.w) as n_words, coalesce(n_features, 0) as n_features, coalesce(floor(g::double / n_features), 0)::bigint as weight
  from w left join weights on weights.id = w.id where side = 0),
drawn as (select *, weight + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::ubigint::double + 0.5) / 4294967296)))::bigint as score from scored),
ranked as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as r, sum((n_words >= 20)::int) over () as n from drawn)
select doc_id, n_features, weight, score, case when n_words >= 20 and r <= 25 * n // 100 then r end as rank from ranked
""",
}
