"""Columns called like those that operators make, and SimHash shards at any depth."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ebbtide.llm import packing, pieces, quality, rules, sharding, simhash
from ebbtide.llm.tiles import Forest

from llm_fixtures import awkward_documents, folder, sentence

NAMES = ("n_words", "kept", "score", "predicted", "_mark", "_row", "ids", "_w", "_cell", "_place", "shard", "fp", "component_id", "host_docs", "word_chars", "_salt", "decoded", "_stay", "_key")


def clashing(spark):
    return awkward_documents(spark).withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in NAMES})


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, stage):
    docs = clashing(spark)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(30)], "doc_id long, quality int")
    d = folder(spark, documents=docs, labels=labels)
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs, d)
    plain = dict(corpus_pipeline.STAGES)[stage](spark, awkward_documents(spark), d)
    assert got.columns == docs.columns and got.count() == plain.count() > 0
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r.doc_id) for r in plain.collect())
    for r in got.collect():
        assert all(r[c] == f"{c}:{'-' if r.doc_id is None else r.doc_id}" for c in NAMES)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs.where("false"), d).count() == 0


def test_operators_replace_columns_they_make_and_keep_the_rest(spark):
    docs, plain = clashing(spark), awkward_documents(spark)
    judged = rules.judge(docs)
    assert sorted(map(str, (tuple(r[c] for c in rules.MEASURES) + (r.kept,) for r in judged.collect()))) == sorted(map(str, (tuple(r[c] for c in rules.MEASURES) + (r.kept,) for r in rules.judge(plain).collect())))
    assert judged.columns.count("n_words") == 1 and judged.where("_w is null or _salt is null").count() == 0
    assert "text" not in rules.judge(docs, keep_text=False).columns
    model = quality.fit(__import__("pyarrow").array([sentence(30, 1), "junk junk"]), np.array([1, 0]))
    scored = quality.score(docs, model)
    assert scored.columns.count("score") == 1 and dict(scored.dtypes)["score"] == "double" and scored.where("ids is null").count() == 0
    slots = sharding.with_slots(sharding.assign(plain, [1.0] * 3).withColumn("_row", F.lit("x")).withColumn("_cell", F.lit("y")).withColumn("slot", F.lit("z")))
    assert slots.where("_row = 'x' and _cell = 'y'").count() == plain.count() and dict(slots.dtypes)["slot"] == "bigint"
    spelled = pieces.with_text(pieces.with_ids(docs, dropout=0.0))
    assert spelled.columns.count("ids") == spelled.columns.count("decoded") == 1 and spelled.where("coalesce(text, '') <> decoded").count() == 0
    assert simhash.groups(docs).count() == plain.count() and packing.pack(docs).count() > 0


def test_shards_of_any_depth_hold_every_near_pair_once(spark):
    rng = np.random.default_rng(21)
    x = rng.integers(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for _ in range(4):
        x = np.concatenate([x, x[:120] ^ (np.uint64(1) << rng.integers(0, 64, 120).astype(np.uint64))])
    x = np.unique(x)
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    i, j = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4, 1))
    near = {(int(a), int(b)) for a, b in zip(i, j)}
    at = {int(v): k for k, v in enumerate(x.view(np.int64))}
    for leading in (0, 1, 7, 16):
        rows = simhash.shards(fps, leading).collect()
        assert len(rows) <= len(x) * 4 * (1 + leading) and all(0 <= r.shard < 1 << 18 for r in rows)
        assert sum(r.own for r in rows) == 4 * len(x)
        meet: dict = {}
        for r in rows:
            meet.setdefault(r.shard, []).append((at[r.fp], r.own))
        met = {(min(a, b), max(a, b)) for side in meet.values() for a, own in side if own for b, _ in side if a != b}
        assert near <= met


@pytest.mark.parametrize("rows", [1, 10**9])
def test_links_with_the_most_and_the_fewest_shards(spark, monkeypatch, rows):
    rng = np.random.default_rng(22)
    x = np.unique(np.concatenate([rng.integers(0, 1 << 63, 150).astype(np.uint64)] + [np.uint64(7) ^ (np.uint64(1) << np.uint64(b)) for b in range(64)], axis=None))
    monkeypatch.setattr(simhash, "SHARD_ROWS", rows)
    want = Forest(len(x))
    want.add(*np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4))
    at = {int(v): k for k, v in enumerate(x.view(np.int64))}
    edges = simhash.links(spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")).collect()
    got = Forest(len(x))
    got.add(np.array([at[e.a] for e in edges], np.int64), np.array([at[e.b] for e in edges], np.int64))
    assert (got.label == want.label).all()
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 8)


def test_quarters_leave_few_pairs_to_compare():
    rng = np.random.default_rng(23)
    x = np.unique(rng.integers(0, 1 << 63, 30_000).astype(np.uint64))
    compared = simhash.near_links(x, np.arange(len(x)), None, 4, Forest(len(x)))
    assert compared < len(x) ** 2 / 500
    cluster = np.unique(np.array([sum(1 << int(b) for b in rng.choice(20, 4, replace=False)) for _ in range(4000)], np.uint64))
    one, want = Forest(len(cluster)), Forest(len(cluster))
    simhash.near_links(cluster, np.arange(len(cluster)), None, 4, one)
    want.add(*np.nonzero(np.bitwise_count(cluster[:, None] ^ cluster[None, :]) <= 4))
    assert (one.label == want.label).all()
