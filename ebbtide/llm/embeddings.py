"""Near vectors by a subspace pigeonhole join.

Vectors are scaled to length one and turned by one fixed random rotation, then cut into blocks of a few dimensions. Cosine at least c
means a squared distance of at most 2 - 2c, so in at least one block the squared distance is at most that block's share of the
budget, in proportion to its dimensions. Each block is therefore range-joined on its own: cells over the block's first
coordinates, four radii wide, deal the vectors to tiles (a vector within one radius of the next cell goes there too), tiles are
split into bounded blocks of rows, and within them the whole block distance decides. The union of candidates is verified on the
full vectors in double precision. A pair counts in the first block whose budget it keeps, and in the tile where on each axis one
of the two is at home, so every link is counted exactly once. Copies of a vector are one row with a multiplicity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .graph import components
from .text import extended
from .tiles import Forest, block_pairs

COSINE = 0.98
#: Dimensions of a block.
BLOCK_DIM = 8
#: Width of a cell in radii.
WIDTH = 4
#: Rows of a tile's block.
ROWS = 4096
#: Room for rounding in the budget; the verification is exact.
SLACK = 1e-9
#: Distinct vectors of a tile for which the cells get one more axis.
TILE_ROWS = 2000


def rotation(dims: int, seed: int = 20) -> np.ndarray:
    """An orthogonal matrix that only the dimensions and the seed decide."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int) -> list[tuple[int, int]]:
    return [(lo, min(lo + BLOCK_DIM, dims)) for lo in range(0, dims, BLOCK_DIM)]


def _dense(column: pa.Array) -> np.ndarray:
    """The vectors in double precision, each halved or doubled until its largest component is near one: no digit changes, and squares stay in range."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    _, exponent = np.frexp(np.abs(x).max(1, keepdims=True))
    return np.ldexp(x, -exponent)


def tiled(classes: DataFrame, dims: int, cosine: float, axes: int) -> DataFrame:
    """(node, label, vector, mult, tile, home): every class in the tiles of each of its blocks; home has a bit for each axis on which the tile is its own."""
    turn, spans, budget = rotation(dims), blocks_of(dims), 2 - 2 * cosine + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _dense(b.column("vector"))
            y = (x / np.sqrt((x * x).sum(1, keepdims=True))) @ turn
            for k, (lo, hi) in enumerate(spans):
                radius = math.sqrt(budget * (hi - lo) / dims)
                at = np.arange(len(y))
                tile, home = np.full(len(y), k, np.int64), np.zeros(len(y), np.int64)
                for axis in range(min(axes, hi - lo)):
                    place = y[at, lo + axis] / (WIDTH * radius)
                    cell = np.floor(place).astype(np.int64)
                    over = np.flatnonzero(place + 1 / WIDTH >= cell + 1)
                    tile = np.concatenate([tile * 64 + cell + 32, tile[over] * 64 + cell[over] + 33])
                    home = np.concatenate([home | (1 << axis), home[over]])
                    at = np.concatenate([at, at[over]])
                rows = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(at), k, np.int32)), pa.array(tile), pa.array(home)], names=[*b.schema.names, "part", "tile", "home"])

    return classes.mapInArrow(run, extended(classes.schema.fields, part="int", tile="long", home="long"))


def _unit(dims: int, cosine: float, axes: int):
    turn, spans, budget = rotation(dims), blocks_of(dims), 2 - 2 * cosine + SLACK

    def run(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        x = _dense(unit.column("vector").chunk(0))
        node, mult, home = (unit.column(c).to_numpy() for c in ("node", "mult", "home"))
        part, lo, hi = (unit.column(c)[0].as_py() for c in ("part", "lo", "hi"))
        blk = unit.column("blk").to_numpy()
        length = np.sqrt((x * x).sum(1))
        y = (x / length[:, None]) @ turn
        full = (1 << min(axes, spans[part][1] - spans[part][0])) - 1
        own = y[:, spans[part][0]:spans[part][1]]
        limits = [budget * (b - a) / dims for a, b in spans]
        squares = (own * own).sum(1)
        forest, links = Forest(len(x)), np.zeros(len(x), np.int64)
        left = np.flatnonzero(blk == lo)
        right = np.flatnonzero(blk == hi)
        for s in range(0, len(left), 1024):
            for t in range(s if lo == hi else 0, len(right), 1024):
                p, q = left[s:s + 1024], right[t:t + 1024]
                near = squares[p][:, None] + squares[q][None, :] - 2 * (own[p] @ own[q].T) <= limits[part] + 1e-7
                i, j = np.nonzero(near)
                i, j = p[i], q[j]
                keep = (home[i] | home[j]) == full
                if lo == hi:
                    keep &= i < j
                i, j = i[keep], j[keep]
                for c in range(0, len(i), 200_000):
                    a, b = i[c:c + 200_000], j[c:c + 200_000]
                    gap = y[a] - y[b]
                    gap *= gap
                    ok = np.ones(len(a), bool)
                    for k in range(part + 1):
                        kept = gap[:, spans[k][0]:spans[k][1]].sum(1) <= limits[k]
                        ok &= kept if k == part else ~kept
                    a, b = a[ok], b[ok]
                    ok = (x[a] * x[b]).sum(1) / (length[a] * length[b]) >= cosine
                    a, b = a[ok], b[ok]
                    np.add.at(links, a, mult[b])
                    np.add.at(links, b, mult[a])
                    forest.add(a, b)
        a, b = forest.edges()
        some = np.flatnonzero(links)
        none = pa.nulls(len(some), pa.int64())
        return pa.table({
            "a": pa.concat_arrays([pa.array(node[a], pa.int64()), pa.array(node[some], pa.int64())]),
            "b": pa.concat_arrays([pa.array(node[b], pa.int64()), none]),
            "n": pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(links[some], pa.int64())]),
        })

    return run


def groups(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept): per row its direct links, and the smallest key it reaches.

    Rows link only within one label, of any type. A null key is never kept. A null label or vector, one of length zero, or null or non-finite components: no link.
    Vectors of different lengths never link. Rows of equal key are rows of their own.
    """
    base = rows.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    sane = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    base = staged(base.withColumns({"ok": F.coalesce(sane, F.lit(False)), "mark": F.xxhash64("label", "vector")}))
    good = base.where("ok")
    lengths = [r[0] for r in good.select(F.size("vector").alias("d")).distinct().orderBy("d").collect()]  # vector widths: a handful
    # One class per (label, vector), numbered as it is written; the smallest id names it.
    classes = staged(good.groupBy("label", "mark", "vector").agg(F.min("id").alias("node0"), F.count(F.lit(1)).alias("mult")).withColumn("node", F.monotonically_increasing_id()))
    edges = counts = None
    for d in lengths:
        mine = classes.where(F.size("vector") == d)
        n = mine.count()
        axes = max(1, min(BLOCK_DIM, math.ceil(math.log(max(n, 2) / TILE_ROWS, 2)) if n > TILE_ROWS else 1))
        spread = tiled(mine.select("node", "label", "vector", "mult"), d, cosine, axes)
        spread = spread.withColumn("unit", F.xxhash64("label", "part", "tile"))
        units = block_pairs(spread, "unit", "node", ROWS)
        got = staged(units.groupBy("label", "part", "tile", "lo", "hi").applyInArrow(_unit(d, cosine, axes), "a long, b long, n long"))
        e, c = got.where("b is not null").select("a", "b"), got.where("n is not null").select("a", "n")
        edges, counts = (e, c) if edges is None else (edges.unionByName(e), counts.unionByName(c))
    if edges is None:
        return base.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    found = components(edges)
    direct = counts.groupBy(F.col("a").alias("_a")).agg(F.sum("n").alias("linked"))
    at = classes.select("label", "mark", "vector", "node", "node0", "mult").join(direct, F.col("node") == F.col("_a"), "left")
    at = staged(at.join(found.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("label", "mark", "vector", "node0", (F.coalesce("linked", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "node").alias("root")))
    least = staged(at.groupBy(F.col("root").alias("_root")).agg(F.min("node0").alias("component_id")))
    named = staged(at.join(least, F.col("root") == F.col("_root")).select(F.col("label").alias("_l"), F.col("mark").alias("_m"), F.col("vector").alias("_v"), "n_links", "component_id"))
    on = (F.col("mark") == F.col("_m")) & (F.col("label") == F.col("_l")) & (F.col("vector") == F.col("_v")) & F.col("ok")
    out = base.join(named, on, "left").select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", F.col("id")).alias("component_id"))
    return out.select(F.col("id").alias(key), F.col("n_links").cast("long"), F.col("component_id").cast("long"), F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
