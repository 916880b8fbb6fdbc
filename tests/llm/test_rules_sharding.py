import re
import zlib
from collections import Counter

import duckdb
import pytest

from ebbtide.llm import queries, rules, sharding

from llm_fixtures import awkward_documents, folder, sentence


def brute_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    many = {g for g, c in Counter(grams).items() if c > 1}
    covered = {k for i, g in enumerate(grams) if g in many for k in range(i, i + 8)}
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def test_measures_equal_brute_force(spark):
    got = rules.measures(awkward_documents(spark)).collect()
    assert len(got) == 45
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_measures(r.text)


def test_rates_shrink_and_clean_documents_stay(spark):
    bad = "### ### " * 4 + sentence(40, 9)
    docs = [(i, bad if i < 90 else sentence(40, i), "x" if i < 100 else "y") for i in range(300)] + [(900, bad, "tiny")]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert len(got) == 301
    assert all(got[i].kept for i in range(90, 300))
    assert not any(got[i].kept for i in range(90))
    assert 0 < got[900].rate_symbols < 1


def test_empty_table(spark):
    none = awkward_documents(spark).where("false")
    assert rules.judge(none).count() == 0
    assert sharding.with_slots(sharding.assign(none, [1.0] * 4)).count() == 0


def test_rules_equal_sql(spark):
    d = folder(spark, documents=awkward_documents(spark))
    got = queries.op5_host_rules(spark, d)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet/*.parquet'")
    rel = con.execute(queries.ORACLE["op5_host_rules"])
    names = [c[0] for c in rel.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, rel.fetchall()))


def test_shards(spark):
    d = folder(spark, documents=awkward_documents(spark))
    got = queries.op1_rendezvous_sharding(spark, d).collect()
    assert len(got) == 45
    for r in got:
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in awkward_documents(spark).collect())
    assert texts == Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_weights_and_moves(spark):
    keys = spark.range(20_000).selectExpr("id as doc_id", "cast(null as string) as text", "1 as shard_was")
    got = sharding.assign(keys, [1.0, 2.0, 1.0, 0.0]).groupBy("shard").count().collect()
    share = {r["shard"]: r["count"] / 20_000 for r in got}
    assert set(share) == {0, 1, 2} and abs(share[1] - 0.5) < 0.02
    moved = sharding.assign(keys, [1.0] * 9).where("shard <> grown_shard")
    assert moved.where("grown_shard <> 9").count() == 0 and abs(moved.count() / 20_000 - 0.1) < 0.01
    with pytest.raises(ValueError):
        sharding.assign(keys, [0.0])


def test_one_key_in_all_rows(spark):
    rows = spark.range(5_000).selectExpr("7L as doc_id", "'same' as text")
    got = sharding.with_slots(sharding.assign(rows, [1.0] * 4)).collect()
    assert sorted(r.slot for r in got) == list(range(5_000)) and len({r.shard for r in got}) == 1
