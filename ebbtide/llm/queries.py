"""The registered queries of these operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, embeddings, licenses, packing, pieces, pitman_yor, prefix_trie, quality, rules, secret_scan, sharding, simhash, spelling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: op1's shards.
SHARDS = 16


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_rendezvous_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 equal shards by their id, with their place in the shard, and their shard among 17."""
    placed = sharding.assign(table(spark, folder, "documents"), [1.0] * SHARDS)
    return sharding.with_slots(placed).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their quality score, learned from the labelled rows that aren't held out. A null or empty text gets the score of the bias; repeated rows a row each; without labels of both classes every score is their smoothed share."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op5_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their measures and verdicts. A null text has no words and fails; a null source is a host of its own; repeated rows get a row each; an empty table gives none."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return rules.judge(docs, keep_text=False).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op6_simhash_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their fingerprint and component. Null, empty and blank texts have fingerprint zero and link like any other; repeated rows and null ids get a row each, and no null names a component that has another id."""
    found = simhash.groups(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_subspace_join(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors with their links within their label and their component. Unusable vectors (null, zero, holding null or non-finite components, or without a label) link with nothing; rows of equal id get a row each; a null id is never kept."""
    return embeddings.groups(table(spark, folder, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


_RULE_SQL = {
    "symbols": "20 * n_symbols > word_chars",
    "repeats": "100 * n_repeat_words > 10 * n_words",
    "lines": "10 * n_dup_lines > n_words",
    "lengths": "(word_chars < 2 * n_words or word_chars > 15 * n_words)",
}
ORACLE["op5_host_rules"] = f"""
with d as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as t from documents),
w as (
  select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from d),
v as (
  select rid, i, array_to_string(list_slice(ws, i, i + 7), ' ') as g from (select rid, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)),
r as (
  select rid, count(distinct k) as n from (
    select rid, unnest(range(i, i + 8)) as k from (select rid, i, count(*) over (partition by rid, g) as c from v) where c > 1) group by rid),
m as (
  select w.rid, doc_id, source, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(r.n, 0)::bigint as n_repeat_words
  from w left join r on w.rid = r.rid),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m),
h as (select source, count(*) as docs, {', '.join(f'sum(({how})::int) as f_{k}' for k, how in _RULE_SQL.items())} from b group by source),
p as (select {', '.join(f'avg(f_{k} / docs) as m_{k}, var_pop(f_{k} / docs) as v_{k}' for k in _RULE_SQL)} from h),
s as (select {', '.join(f'm_{k}, case when v_{k} > 1e-9 then least(1000, greatest(1, m_{k} * (1 - m_{k}) / v_{k} - 1)) else 1000 end as s_{k}' for k in _RULE_SQL)} from p),
q as (select source, {', '.join(f'(f_{k} + s_{k} * m_{k}) / (docs + s_{k}) as rate_{k}' for k in _RULE_SQL)} from h, s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not ({' or '.join(f'({how}) and rate_{k} > 0.3' for k, how in _RULE_SQL.items())}) as kept
from b join q on b.source is not distinct from q.source
"""


@query
def op2_pitman_yor_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the base's and the model's log10 probability. A null or empty text is its end token; rows of equal id get a row each; with nothing to learn from every token has probability one."""
    return pitman_yor.score(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op9_window_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document in its window. A null or empty text is its end id; null ids come first and repeated rows are documents of their own; an empty table gives no piece."""
    return packing.pack(table(spark, folder, "documents"))


@query
def op10_addressable_codes(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as read back from the written codes. A null or empty text is its end id; null ids come first and repeated rows are documents of their own; an empty table gives no row."""
    return codes.read(spark, codes.write(table(spark, folder, "documents")))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every licence statement found in all documents, with its family. Null and empty texts have none; repeated rows are read each."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


@query
def op8_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded with dropout and decoded again. A null or empty text has no pieces; rows of equal id and text get equal ids."""
    return pieces.round_trip(table(spark, folder, "documents"))


@query
def op11_pivotal_grams(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word of all documents with its near words' number, its form and the form at the end of its path. Null and empty texts have no words; repeated rows count again; an empty table gives no row."""
    return spelling.variants(table(spark, folder, "documents"))


@query
def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the number of base matches of each kind, the digest of their places, and the places of all matches. Null and empty texts have none; repeated rows and null ids get a row each."""
    found = secret_scan.scan(table(spark, folder, "documents"))
    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in secret_scan.BASE]
    base = secret_scan.listed("found", secret_scan.BASE)
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secret_scan.listed("found").alias("spans"))


@query
def op13_truncation_peeling(spark: SparkSession, folder: str) -> DataFrame:
    """All distinct prefixes of the rebuilt conversations. Null role or text is empty; rows without a conversation are left out; every repeated row is a turn; equal turns are ordered by a hash of role and text; an empty table has no root."""
    return prefix_trie.trie(table(spark, folder, "conversations"))


# CRC-32 byte by byte, from a table that SQL builds; letters of the words are ASCII or U+00C0 to U+00FF (two bytes, the first C3).
_CRC_TABLE = "crc as (select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: case when c % 2 = 1 then xor(3988292384, c // 2) else c // 2 end)) as t)"


def _crc_sql(signs: str) -> str:
    ints = f"flatten(list_transform(string_split({signs}, ''), lambda s: case when unicode(s) < 128 then [unicode(s)::bigint] else [195::bigint, unicode(s)::bigint - 64] end))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295::bigint], {ints}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256)))"


ORACLE["op11_pivotal_grams"] = f"""
with recursive {_CRC_TABLE},
r0 as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents),
r1 as (select coalesce(doc_id::varchar, '') as k, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from r0 where length(run) >= 6 group by 1, 2),
r2 as (select run, n, {_crc_sql("k || ':' || run")} as h from r1, crc),
w as (
  select word, sum(n)::bigint as n from (
    select case when h % 199 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, n from r2)
  where length(word) >= 6 group by word having sum(n) >= 5),
d as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as cut from (select word, n, unnest(range(1, length(word) + 1)) as i from w)),
pairs as (
  select a.word, a.n, b.word as near, b.n as m from d a join d b on a.i = b.i and a.cut = b.cut and a.word <> b.word
  union select d.word, d.n, w.word, w.n from d join w on d.cut = w.word
  union select w.word, w.n, d.word, d.n from d join w on d.cut = w.word),
best as (select word, count(*) as n_near, max(m) as m, min(n) as n from pairs group by word),
forms as (select p.word, min(p.near) as form, p.m as form_n from pairs p join best using (word, m) where p.m >= 5 * p.n group by p.word, p.m),
path as (
  select word, form as goal, 1 as step from forms
  union all select path.word, forms.form, step + 1 from path join forms on path.goal = forms.word),
ends as (select word, arg_max(goal, step) as root from path group by word)
select w.word, form, coalesce(root, w.word) as root, w.n, coalesce(n_near, 0) as n_near, form_n
from w left join best using (word) left join forms using (word) left join ends using (word)
"""

ORACLE["op13_truncation_peeling"] = f"""
with {_CRC_TABLE},
src as (
  select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x, row_number() over (partition by conv_id order by turn nulls first) - 1 as pos
  from conversations where conv_id is not null),
lens as (select c, count(*) as own from src group by c),
ids as (
  select l.c, l.c - l.c % 5 as donor, h, least(h, coalesce(o.own, 0)) as taken
  from (select c, {_crc_sql("c::varchar")} % 9 as h from lens, crc) l left join lens o on o.c = l.c - l.c % 5),
turns as (
  select ids.c, pos + 1 as d, r, x from ids join src on src.c = donor where pos < taken
  union all select ids.c, taken + pos - h + 1, r, x from ids join src on src.c = ids.c where pos >= h),
full_paths as (select ids.c, coalesce(p, []) as p from ids left join (select c, list({{'r': r, 'x': x}} order by d) as p from turns group by c) using (c)),
cut as (select c, p as whole, p[1:d] as p, d from (select c, p, unnest(range(0, len(p) + 1)) as d from full_paths)),
nodes as (
  select d, p, min(c) as c, count(*) as n, string_agg(c::varchar, ',' order by c) filter (where len(whole) = d) as ends from cut group by d, p),
kids as (select d - 1 as d, p[1:d - 1] as p, count(*) as n_children from nodes where d > 0 group by 1, 2),
own as (
  select n.d, n.p, n.c, n.n, n.ends, coalesce(n_children, 0) as n_children, case when n.d > 0 then (n.n - 1) * octet_length(encode(n.p[n.d].x)) else 0 end as saved
  from nodes n left join kids k on n.d = k.d and n.p = k.p),
sums as (
  select a as d, p[1:a] as p, sum((n_children = 0)::int) as n_leaves, sum(saved) as saved_tokens
  from (select p, n_children, saved, unnest(range(0, d + 1)) as a from own) group by 1, 2)
select o.c as conv_id, o.d as depth, up.c as parent_conv_id, o.n as n_convs, o.n_children, s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(coalesce(o.ends, '')) as ends_sha256
from own o join sums s on o.d = s.d and o.p = s.p left join nodes up on up.d = o.d - 1 and up.p = o.p[1:o.d - 1]
"""
