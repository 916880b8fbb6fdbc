import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ebbtide.llm import embeddings, graph, queries, simhash
from ebbtide.llm.tiles import Forest

from llm_fixtures import awkward_documents, folder, sentence


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(n, linked):
    at = list(range(n))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i, j in linked:
        a, b = root(i), root(j)
        at[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(3)
    e = rng.integers(0, 400, (260, 2)).tolist() + [[i, i + 1] for i in range(500, 600)] + [[700, i] for i in range(701, 900)] + [[5, 5]]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame([*e, [None, 3]], "a long, b long")).collect()}
    want = brute_components(900, e)
    assert got == {i: want[i] for i in {x for a, b in e if a != b for x in (a, b)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints(spark):
    d = folder(spark, documents=awkward_documents(spark))
    got = queries.op6_simhash_neighbours(spark, d).collect()
    texts = awkward_documents(spark).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(r.doc_id), f"{brute_fingerprint(r.text):016x}") for r in texts)
    fps = [(r.doc_id, int(r.fingerprint, 16)) for r in got]
    want = brute_components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i][1] ^ fps[j][1]).bit_count() <= 4])
    for i, r in enumerate(got):
        ids = [fps[j][0] for j in range(len(fps)) if want[j] == want[i] and fps[j][0] is not None]
        assert r.component_id == (min(ids) if ids else None)


@pytest.mark.parametrize("words", [199_980, 200_000, 200_020, 400_000])
def test_fingerprints_of_full_runs(words):
    texts = [sentence(20, i % 50) for i in range(words // 20 - 1)] + [sentence(20, 777)]
    got = simhash.fingerprints(pa.array([*texts, None, ""]))
    known = {t: brute_fingerprint(t) for t in set(texts)}
    assert got.tolist() == [*[known[t] for t in texts], 0, 0]
    assert simhash.fingerprints(pa.array([sentence(words, 3), sentence(9, 4)])).tolist() == [brute_fingerprint(sentence(words, 3)), brute_fingerprint(sentence(9, 4))]


def planted(rng, n, groups):
    x = [int(v) for v in rng.integers(0, 1 << 63, n)]
    for _ in range(groups):
        v = int(rng.integers(0, 1 << 63))
        for _ in range(12):
            x.append(v)
            for b in rng.choice(63, int(rng.integers(1, 6)), replace=False):
                v ^= 1 << int(b)
    return sorted(set(x))


def test_links_equal_brute_force(spark, monkeypatch):
    x = planted(np.random.default_rng(11), 3000, 40)
    v = np.array(x, np.uint64)
    i, j = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= 4)
    want = Forest(len(x))
    want.add(i, j)
    monkeypatch.setattr(simhash, "LEAF", 500)
    monkeypatch.setattr(simhash, "BLOCK", 700)
    monkeypatch.setattr(simhash, "SHARD_ROWS", 300)
    one = Forest(len(x))
    simhash.near_links(v, np.arange(len(x)), None, 4, one)
    assert (one.label == want.label).all()
    edges = simhash.links(spark.createDataFrame([(int(a),) for a in v.view(np.int64)], "fp long")).collect()
    at = {int(a): k for k, a in enumerate(v.view(np.int64))}
    got = Forest(len(x))
    got.add(np.array([at[e.a] for e in edges]), np.array([at[e.b] for e in edges]))
    assert (got.label == want.label).all()


def test_equal_and_near_texts_meet(spark):
    base = sentence(600, 1).split()
    near = " ".join([*base[:300], "changed", *base[301:]])
    docs = spark.createDataFrame([(9, " ".join(base)), (4, near), (5, " ".join(base)), (1, sentence(500, 8)[::-1])], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.groups(docs).collect()}
    assert got[9] == got[5] and got[1] == 1


def vectors(rng, dims=64):
    rows = []
    for k in range(60):
        c = rng.normal(size=dims)
        for _ in range(int(rng.integers(1, 14))):
            c = c + rng.normal(size=dims) * 0.12
            rows.append((len(rows), [float(np.float32(v)) for v in c], int(k % 3)))
    rows += [(len(rows) + i, rows[0][1], rows[0][2]) for i in range(40)]
    n = len(rows)
    rows += [(n, rows[0][1], None), (n + 1, None, 1), (n + 2, [0.0] * dims, 1), (n + 3, [float("nan")] + [1.0] * (dims - 1), 1), (n + 4, [None] + [1.0] * (dims - 1), 1), (n + 5, [1.0, 2.0], 1), (n + 6, [2.0, 4.0], 1), (n + 7, [], 1)]
    return rows


def brute_vectors(rows):
    def fit(r):
        return r[2] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
    linked = []
    for i, r in enumerate(rows):
        for j in range(i):
            s = rows[j]
            if fit(r) and fit(s) and r[2] == s[2] and len(r[1]) == len(s[1]):
                a, b = np.array(r[1]), np.array(s[1])
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    linked.append((i, j))
    n = np.bincount(np.array(linked).ravel(), minlength=len(rows)) if linked else np.zeros(len(rows), int)
    return n.tolist(), brute_components(len(rows), linked)


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "ROWS", 30)
    monkeypatch.setattr(embeddings, "TILE_ROWS", 40)
    rows = vectors(np.random.default_rng(5))
    n, c = brute_vectors(rows)
    assert max(n) > 20
    d = folder(spark, embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = sorted(tuple(r) for r in queries.op7_subspace_join(spark, d).collect())
    assert got == [(i, n[i], c[i], c[i] == i) for i in range(len(rows))]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.groups(none).count() == 0


def test_vectors_of_extreme_components_and_any_label(spark):
    """Very large and very small components link as their directions do; labels beyond int and of text; a null key is never kept."""
    rng = np.random.default_rng(31)
    v, w = rng.normal(size=8), rng.normal(size=8)
    scaled = [v, v * 1e200, v * 3e-200, v * 1e-308, w * 1e300, w * 7e-150, -v]
    for kind, label in (("long", 1 << 40), ("string", "first")):
        rows = [(i, [float(x) for x in u], label) for i, u in enumerate(scaled)] + [(None, [1.0] * 8, label), (90, [1.0] * 8, None)]
        got = {r.vec_id: r for r in embeddings.groups(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()}
        assert [got[i].component_id for i in range(7)] == [0, 0, 0, 0, 4, 4, 6] and [got[i].n_links for i in range(7)] == [3, 3, 3, 3, 1, 1, 0]
        assert not got[None].kept and got[90].kept
    none = embeddings.groups(spark.createDataFrame([(None, None, 1), (5, None, 1)], "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: r.kept for r in none} == {None: False, 5: True}
