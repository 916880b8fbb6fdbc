"""Neighbour joins against brute force, with copies and small blocks so every pruning step is used."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ebbtide.operators import neighbors, sampling


def brute(q, r, k, same):
    out = {}
    for i, v in q.items():
        d = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in r.items() if not (same and i == j))
        out[i] = d[:k]
    return out


def points(n=240, dim=3, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(np.concatenate([rng.normal(c, 0.4, (n // 4, dim)) for c in (0, 3, 6, 9)]), 2)
    x[: n // 3] = x[0]
    return {int(i): x[i] for i in range(len(x))}


def table(spark, pts):
    return spark.createDataFrame(pd.DataFrame({"id": list(pts), "v": [p.tolist() for p in pts.values()]}))


def check(got, want):
    mine = {}
    for r in got.collect():
        mine.setdefault(r.key, []).append((r.position, r.distance, r.neighbor))
    assert set(mine) == set(want)
    for k, near in want.items():
        have = sorted(mine[k])
        assert [h[2] for h in have] == [n for _, n in near], k
        assert np.allclose([h[1] for h in have], [d for d, _ in near])


def test_self_join_with_copies(spark):
    pts = points()
    df = table(spark, pts)
    check(neighbors.nearest_neighbors(df, df, "id", "v", 4, block_rows=16), brute(pts, pts, 4, True))


def test_two_tables(spark):
    a, b = points(120, 4, 1), points(200, 4, 2)
    check(neighbors.nearest_neighbors(table(spark, a), table(spark, b), "id", "v", 3, exclude_self=False, block_rows=20), brute(a, b, 3, False))


def test_fewer_references_than_k(spark):
    a = {1: np.array([0.0, 0.0]), 2: np.array([1.0, 0.0]), 3: np.array([5.0, 0.0])}
    check(neighbors.nearest_neighbors(table(spark, a), table(spark, a), "id", "v", 5), brute(a, a, 5, True))


def test_tomek_links(spark):
    pts = points(120, 2, 9)
    y = {i: int(i % 3 == 0) for i in pts}
    nn = {i: d[0][1] for i, d in brute(pts, pts, 1, True).items()}
    want = {(i, j) for i, j in nn.items() if i < j and nn[j] == i and y[i] != y[j]}
    df = table(spark, pts).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    got = {(r.key_a, r.key_b) for r in neighbors.tomek_links(df, "id", "y", "v", block_rows=16).collect()}
    assert got == want


def labelled(spark, n=90):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n).round(3), "b": rng.normal(size=n).round(3), "y": (np.arange(n) % 5 == 0).astype(int)})
    return pdf, spark.createDataFrame(pdf)


def test_smote_reaches_parity_on_segments(spark):
    pdf, df = labelled(spark)
    s = sampling.smote(df, "id", "y", ["a", "b"], k=3, block_rows=8).toPandas()
    assert len(s) == (pdf.y == 0).sum() - (pdf.y == 1).sum()
    counts = s.groupby("parent").size()
    assert counts.max() - counts.min() <= 1 and set(s.y) == {1}
    src = pdf.set_index("id")
    small = {i: src.loc[i, ["a", "b"]].to_numpy(float) for i in pdf.id[pdf.y == 1]}
    near = {i: {j for _, j in d} for i, d in brute(small, small, 3, True).items()}
    for r in s.itertuples():
        assert r.neighbor in near[r.parent] and 0 <= r.gap < 1
        want = small[r.parent] + r.gap * (small[r.neighbor] - small[r.parent])
        assert np.allclose([r.a, r.b], want)
    again = sampling.smote(df, "id", "y", ["a", "b"], k=3, block_rows=8).toPandas()
    assert s.sort_values(["parent", "round"]).reset_index(drop=True).equals(again.sort_values(["parent", "round"]).reset_index(drop=True))


def test_smote_tomek_against_brute_force(spark):
    _, df = labelled(spark)
    full = sampling.oversampled(df, "id", "y", ["a", "b"]).toPandas()
    pts = {r.row_id: np.array([r.a, r.b]) for r in full.itertuples()}
    y = dict(zip(full.row_id, full.y))
    nn = {i: d[0][1] for i, d in brute(pts, pts, 1, True).items()}
    gone = {i for i, j in nn.items() if nn[j] == i and y[i] != y[j]}
    left = {r.row_id for r in sampling.smote_tomek(df, "id", "y", ["a", "b"]).collect()}
    assert left == set(pts) - gone


def test_attribute_transfer(spark):
    real = spark.createDataFrame([(1, 0.0, "x"), (2, 10.0, "y")], "rid long, a double, grp string")
    made = spark.createDataFrame([(7, 1.0), (8, 9.0), (9, 5.0)], "sid long, a double")
    out = neighbors.transfer_attribute(made, real, "sid", "rid", ["a"], "grp")
    assert {r.sid: r.grp for r in out.collect()} == {7: "x", 8: "y", 9: "x"}


def test_clustered_data_is_pruned_in_cells_and_rings(spark):
    """Tight clusters along a line: a query's ring and its neighbours hold the answer, so most pairs are never computed."""
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal((10.0 * c, 0, 0), (0.5, 0.02, 0.02), (250, 3)) for c in range(12)])
    pts = {int(i): v for i, v in enumerate(x)}
    df = table(spark, pts).repartition(4)
    vectors = neighbors._vectors(df, "id", "v")
    index = neighbors.build_index(vectors, 4, block_rows=32)
    unique = vectors.select("v").distinct().select(neighbors._vector_id().alias("qid"), "v")
    pairs = neighbors.compared_pairs(index, neighbors.search_plan(index, unique, 32))
    assert pairs < 0.1 * len(pts) ** 2
    some = {i: pts[i] for i in range(0, len(pts), 37)}
    check(neighbors.nearest_neighbors(table(spark, some), df, "id", "v", 3, block_rows=32), brute(some, pts, 3, True))


def test_equal_radii_are_cut_into_parts(spark):
    """All references lie on one circle around the pivots' middle: rings can't tell them apart, parts of bounded size can."""
    angle = np.linspace(0, 2 * np.pi, 300, endpoint=False)
    pts = {int(i): np.array([np.cos(a), np.sin(a), 5.0]).round(6) for i, a in enumerate(angle)}
    df = table(spark, pts)
    check(neighbors.nearest_neighbors(df, df, "id", "v", 2, block_rows=8), brute(pts, pts, 2, True))


def test_one_feature_and_vectors_that_read_the_same_backwards(spark):
    pts = {i: np.array([float(i % 50)]) for i in range(200)}
    df = table(spark, pts)
    check(neighbors.nearest_neighbors(df, df, "id", "v", 3, block_rows=16), brute(pts, pts, 3, True))
    none = df.where("false")
    assert neighbors.nearest_neighbors(df, none, "id", "v").count() == 0 and neighbors.nearest_neighbors(none, df, "id", "v").count() == 0


def test_unprunable_vectors_meet_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(300, 24)) + 1000, 3)
    x[::7] = x[0]
    pts = {i: v for i, v in enumerate(x)}
    df = table(spark, pts)
    monkeypatch.setattr(neighbors, "TILE", (40, 70))
    monkeypatch.setattr(neighbors, "STEP", 500)
    index = neighbors.build_index(neighbors._vectors(df, "id", "v"), 4, 16)
    asked = neighbors._vectors(df, "id", "v").select(F.col("key").cast("string").alias("qid"), "v")
    assert neighbors.reached_share(index, neighbors.search_bounds(index, asked, 16)) > 0.5
    monkeypatch.setattr(neighbors, "_planned", None)  # blocks would hold a row per query and block
    check(neighbors.nearest_neighbors(df, df, "id", "v", 3, block_rows=16), brute(pts, pts, 3, True))


def test_matrix_products_lose_no_neighbour():
    rng = np.random.default_rng(3)
    b = np.repeat(rng.integers(0, 3, (200, 4)).astype(float) * 1e-7 + 1e6, 2, axis=0)  # ties, and distances far below the numbers' size
    a, keep = b[:50], 5
    seen = {}
    for row, c, dist in neighbors._closest(a, np.full(len(a), np.inf), b, keep):
        for r, j, d in zip(row.tolist(), c.tolist(), dist.tolist()):
            seen.setdefault(r, []).append((d, j))
    for r in range(len(a)):
        assert seen[r] == sorted((float(np.sqrt(((a[r] - w) ** 2).sum())), j) for j, w in enumerate(b))[:keep]
