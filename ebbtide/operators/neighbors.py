"""Exact nearest-neighbour joins without pairing all rows.

Reference rows are assigned to the closest of a few pivot points, and inside a pivot's cell to rings by their distance from it: a block
is a ring, or a part of one that holds too many rows. A query first looks into the ring of its own cell that lies as far from the
pivot as it does itself; the k-th best distance there bounds its search. By the triangle inequality a block can hold a neighbour only if its ring
lies within that bound of the query's own distance from the pivot. Blocks that can are compared (bounded rows on both sides, NumPy inside the task)
and emit each query's k best only, so neither a group nor the output ever holds all pairs. Where the bounds leave more than half of all pairs
(vectors of many independent features), blocks save nothing: queries and references then meet in tiles, each row sent once per tile of the other side.

Pairs are first looked at by one matrix product; only those it can't tell from a neighbour, by a bound of its rounding, are computed exactly.

Copies are collapsed first: of identical reference vectors only the k + 1 smallest keys can ever be neighbours (Spark keeps that many per
task before it shuffles them), and identical queries share one search. Only pivots and a few numbers per pivot reach this process.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dbl
from ..session import staged
from .ordering import small_side

SLACK = 1e-9
#: Rows of a tile where nothing can be ruled out: queries, references.
TILE = (16_384, 65_536)
#: Pairs of one matrix product, and numbers of one exact step.
STEP = 4_000_000


def _vectors(df: DataFrame, key: str, features: Sequence[str] | str) -> DataFrame:
    """(key, v) rows; ``features`` is a list of columns or the name of one array column. Rows with a missing feature have no place and are set aside."""
    v = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[dbl(f) for f in features])
    rows = df.select(F.col(key).alias("key"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))
    return rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()))


def _vector_id() -> Column:
    """128 bits that stand for a vector: two 64-bit hashes, the second of another reading and with a number in front."""
    return F.concat_ws(":", F.xxhash64("v").cast("string"), F.xxhash64(F.lit(1), F.reverse("v")).cast("string"))


def _matrix(v: pa.Array | pa.ChunkedArray) -> np.ndarray:
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    if not len(v):
        return np.zeros((0, 1))
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, differences first: no cancellation, memory bounded by chunking the rows."""
    out = np.empty((len(a), len(b)))
    step = max(1, int(2_000_000 / max(1, b.size)))
    for i in range(0, len(a), step):
        d = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def _products(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, squared distances, their error at most per row) of slices of ``a``, by matrix products around the middle of ``b``."""
    with np.errstate(all="ignore"):
        middle = b.mean(axis=0)
        middle = np.where(np.isfinite(middle), middle, 0.0)
        b = b - middle
        size = np.einsum("ij,ij->i", b, b)
        rounding = 8 * (b.shape[1] + 8) * np.finfo(float).eps
        step = max(1, STEP // max(1, len(b)))
        for lo in range(0, len(a), step):
            part = a[lo:lo + step] - middle
            own = np.einsum("ij,ij->i", part, part)
            product = part @ b.T
            product *= -2
            product += size
            product += own[:, None]
            yield lo, product, rounding * (own + size.max())


def _closest(a: np.ndarray, limit: np.ndarray, b: np.ndarray, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of ``a``, rows of ``b``, distances) of each row's ``keep`` nearest within its limit, ties to the earlier row of ``b``; in slices, by row and distance."""
    for lo, squares, error in _products(a, b):
        with np.errstate(all="ignore"):
            cut = limit[lo:lo + len(squares)] ** 2 * (1 + SLACK) + error
        # What isn't a number is no proof of being far.
        held = ~(squares > cut[:, None])
        if keep < len(b) and np.count_nonzero(held) > 16 * keep * len(held):
            held &= ~(squares > (np.partition(squares, keep - 1, axis=1)[:, keep - 1] + 2 * error)[:, None])
        row, c = np.nonzero(held)
        dist = np.empty(len(row))
        step = max(1, STEP // b.shape[1])
        for at in range(0, len(row), step):
            d = a[lo + row[at:at + step]] - b[c[at:at + step]]
            dist[at:at + step] = np.sqrt(np.einsum("ij,ij->i", d, d))
        real = ~np.isnan(dist)
        row, c, dist = row[real], c[real], dist[real]
        order = np.lexsort((c, dist, row))
        row, c, dist = row[order], c[order], dist[order]
        ok = np.arange(len(row)) - np.searchsorted(row, row) < keep
        yield lo + row[ok], c[ok], dist[ok]


@dataclass(frozen=True)
class Pivots:
    """What tasks know of the index: a few numbers per pivot. ``inner`` are the smallest radii of each cell, ``owner`` their cells, ``sizes`` the cells' rows."""

    at: np.ndarray
    far: np.ndarray
    sizes: np.ndarray
    rings: np.ndarray
    inner: np.ndarray
    owner: np.ndarray
    keep: int

    def reach(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distances from the pivots, upper bound of the ``keep``-th neighbour's distance) of some queries."""
        d = _distances(vectors, self.at)
        bounds = d[:, self.owner] + self.inner[None, :]
        if bounds.shape[1] < self.keep:
            return d, np.full(len(d), np.inf)
        return d, np.partition(bounds, self.keep - 1, axis=1)[:, self.keep - 1]


@dataclass(frozen=True)
class Index:
    """Reference rows by pivot and ring. ``cells``: key, v, cell, ring, radius; ``blocks``: cell, ring, lo, hi, n_ref, parts."""

    cells: DataFrame
    blocks: DataFrame
    pivots: Pivots


def build_index(refs: DataFrame, keep: int, block_rows: int = 2048) -> Index | None:
    """The index of (key, v) rows, or None without rows; ``keep`` copies of equal vectors stay."""
    copies = Window.partitionBy("v").orderBy("key")
    reduced = staged(refs.withColumn("__c", F.row_number().over(copies)).where(F.col("__c") <= keep).select("key", "v"))
    n = reduced.count()
    if not n:
        return None
    # Pivots grow with the square root of the rows; cells that hold more than their share are cut into rings.
    picked = reduced.orderBy(F.xxhash64("v"), "key").limit(max(1, math.isqrt(n) // 4)).select("v").collect()
    pivots = np.unique(np.array([r["v"] for r in picked], dtype=float), axis=0)

    def to_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_matrix(batch.column(1)), pivots)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(d.min(axis=1))], ["key", "v", "cell", "radius"])

    kind = reduced.schema["key"].dataType.simpleString()
    cells = staged(reduced.mapInArrow(to_cell, f"key {kind}, v array<double>, cell int, radius double"))
    closest = F.row_number().over(Window.partitionBy("cell").orderBy("radius"))
    inner = cells.select("cell", "radius", closest.alias("__r")).where(F.col("__r") <= keep).groupBy("cell").agg(F.collect_list("radius").alias("near"))
    per_cell = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("far")).join(inner, "cell").collect()  # a row per pivot
    far, sizes, rings = np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64), np.ones(len(pivots), np.int64)
    for r in per_cell:
        far[r["cell"]], sizes[r["cell"]], rings[r["cell"]] = r["far"], r["n"], -(-r["n"] // block_rows)
    told = cells.sparkSession.createDataFrame([(r["cell"], r["far"], int(rings[r["cell"]])) for r in per_cell], "cell int, far double, rings long")
    ring = F.when(F.col("far") > 0, F.least(F.floor(F.col("radius") / F.col("far") * F.col("rings")), F.col("rings") - 1)).otherwise(0).cast("long")
    cells = cells.join(told, "cell").select("key", "v", "cell", ring.alias("ring"), "radius")
    blocks = cells.groupBy("cell", "ring").agg(F.min("radius").alias("lo"), F.max("radius").alias("hi"), F.count(F.lit(1)).alias("n_ref"))
    blocks = small_side(blocks.withColumn("parts", F.ceil(F.col("n_ref") / F.lit(block_rows)).cast("int")))
    owner = np.concatenate([np.full(len(r["near"]), r["cell"]) for r in per_cell])
    return Index(cells, blocks, Pivots(pivots, far, sizes, rings, np.concatenate([np.array(r["near"]) for r in per_cell]), owner, keep))


def _met(index: Index, queries: DataFrame, block_rows: int, best, schema: str, spread: bool = True) -> DataFrame:
    """``best`` of every (part of a block's queries, part of a block): queries (qid, v, bound, cell, ring) meet all parts of their block, or one of them."""
    asked = queries.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n_query"))
    sizes = small_side(index.blocks.join(asked, ["cell", "ring"]).select("cell", "ring", "parts", F.ceil(F.col("n_query") / F.lit(block_rows)).cast("int").alias("shares")))
    mine = F.pmod(F.xxhash64("qid"), F.col("shares")).cast("int").alias("share")
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)) if spread else F.pmod(F.xxhash64("qid", F.lit(1)), F.col("parts")).cast("int")
    left = queries.join(sizes, ["cell", "ring"]).select("qid", "v", "bound", "cell", "ring", mine, parts.alias("part"))
    right = index.cells.join(sizes, ["cell", "ring"]).select(
        "key", "v", "cell", "ring", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    on = ["cell", "ring", "part", "share"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(best, schema)


def _query_batches(pivots: Pivots, unique: DataFrame, schema: str, rows) -> DataFrame:
    """``rows(batch, distances from the pivots, bound)`` of the queries, in slices that keep the distance table small."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, 2_000_000 // max(1, len(pivots.inner)))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                yield rows(part, *pivots.reach(_matrix(part.column("v"))))

    return unique.mapInArrow(run, schema)


def search_bounds(index: Index, unique: DataFrame, block_rows: int = 2048) -> DataFrame:
    """(qid, v, bound): each query (qid, v) and how far off its ``keep``-th neighbour lies at most."""
    pivots = index.pivots
    keep, rings, far = pivots.keep, pivots.rings, pivots.far

    def home(part: pa.RecordBatch, d: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
        cell = np.where(far >= 0, d, np.inf).argmin(axis=1)
        own = d[np.arange(len(d)), cell]
        with np.errstate(divide="ignore", invalid="ignore"):
            ring = np.where(far[cell] > 0, np.minimum(own / far[cell] * rings[cell], rings[cell] - 1), 0)
        return pa.RecordBatch.from_arrays([part.column("qid"), part.column("v"), pa.array(cell.astype(np.int32)), pa.array(ring.astype(np.int64)), pa.array(bound)], ["qid", "v", "cell", "ring", "bound"])

    def kth(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows >= keep:
            limit = np.concatenate([np.sqrt(np.maximum(np.partition(squares, keep - 1, axis=1)[:, keep - 1] + error, 0)) for _, squares, error in _products(_matrix(a["v"]), _matrix(b["v"]))])
            return pa.table({"qid": a["qid"], "limit": pa.array(np.where(np.isnan(limit), np.inf, limit))})
        return pa.table({"qid": pa.array([], pa.string()), "limit": pa.array([], pa.float64())})

    at_home = staged(_query_batches(pivots, unique, "qid string, v array<double>, cell int, ring long, bound double", home))
    found = _met(index, at_home, block_rows, kth, "qid string, limit double", spread=False)
    return staged(at_home.join(found, "qid", "left").select("qid", "v", F.least("bound", F.coalesce("limit", "bound")).alias("bound")))


def _limits(part: pa.RecordBatch) -> np.ndarray:
    return part.column("bound").to_numpy(zero_copy_only=False) * (1 + SLACK) + SLACK


def reached_share(index: Index, bounded: DataFrame) -> float:
    """The share of all (query, reference) pairs that lies in cells within the queries' bounds."""
    pivots = index.pivots

    def count(part: pa.RecordBatch, d: np.ndarray, _: np.ndarray) -> pa.RecordBatch:
        near = d - pivots.far[None, :] <= _limits(part)[:, None]
        return pa.RecordBatch.from_arrays([pa.array([int((near @ pivots.sizes).sum())], pa.int64()), pa.array([len(d) * int(pivots.sizes.sum())], pa.int64())], ["pairs", "of"])

    got = _query_batches(pivots, bounded, "pairs long, of long", count).agg(F.sum("pairs"), F.sum("of")).first()
    return got[0] / got[1] if got[1] else 0.0


def search_plan(index: Index, unique: DataFrame, block_rows: int = 2048) -> DataFrame:
    """(qid, v, bound, cell, ring): the blocks that each query (qid, v) has to be compared with."""
    return _planned(index, search_bounds(index, unique, block_rows))


def _planned(index: Index, bounded: DataFrame) -> DataFrame:
    pivots = index.pivots

    def near(part: pa.RecordBatch, d: np.ndarray, _: np.ndarray) -> pa.RecordBatch:
        limit = _limits(part)
        row, cell = np.nonzero(d - pivots.far[None, :] <= limit[:, None])
        take = part.take(pa.array(row))
        return pa.RecordBatch.from_arrays([take.column("qid"), take.column("v"), take.column("bound"), pa.array(cell.astype(np.int32)), pa.array(d[row, cell]), pa.array(limit[row])], ["qid", "v", "bound", "cell", "away", "limit"])

    reached = _query_batches(pivots, bounded, "qid string, v array<double>, bound double, cell int, away double, limit double", near)
    rings_near = reached.join(index.blocks.select("cell", "ring", "lo", "hi"), "cell").where((F.col("away") - F.col("hi") <= F.col("limit")) & (F.col("lo") - F.col("away") <= F.col("limit")))
    return staged(rings_near.select("qid", "v", "bound", "cell", "ring"))


def _tiled(index: Index, bounded: DataFrame, best, schema: str, block_rows: int) -> DataFrame:
    """``best`` of every (tile of queries, tile of references)."""
    n = [bounded.count(), int(index.pivots.sizes.sum())]
    # Small tables in smaller tiles, so that there are some for every core.
    rows, across = [-(-m // max(1, min(most, max(block_rows, m // 8)))) for m, most in zip(n, TILE, strict=True)]
    left = bounded.select("qid", "v", "bound", F.pmod(F.xxhash64("qid"), F.lit(rows)).alias("row"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"))
    right = index.cells.select("key", "v", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row"), F.pmod(F.xxhash64("key"), F.lit(across)).alias("across"))
    right = right.withColumn("row", F.col("row").cast("long"))
    left = left.withColumn("across", F.col("across").cast("long"))
    # A task per tile, or a few of them: tiles are what is to be spread, not rows.
    parts = max(1, min(rows * across, 4096))
    left, right = (df.repartition(parts, "row", "across") for df in (left, right))
    return left.groupBy("row", "across").cogroup(right.groupBy("row", "across")).applyInArrow(best, schema)


def compared_pairs(index: Index, plan: DataFrame) -> int:
    """How many (query, reference) pairs the search computes."""
    return plan.join(index.blocks, ["cell", "ring"]).agg(F.sum("n_ref")).first()[0] or 0


def nearest_neighbors(queries: DataFrame, refs: DataFrame, key: str, features: Sequence[str] | str, k: int = 5,
                      exclude_self: bool = True, ref_key: str | None = None, block_rows: int = 2048) -> DataFrame:
    """(key, neighbor, distance, position): the k nearest reference rows of each query row.

    Ties go to the smaller neighbour key. With ``exclude_self`` both tables share
    one key space and a row is not its own neighbour.
    """
    q, r = _vectors(queries, key, features), _vectors(refs, ref_key or key, features)
    keep = k + 1 if exclude_self else k
    key_type = r.schema["key"].dataType
    index = build_index(r, keep, block_rows)
    if index is None:
        return q.select("key", F.lit(None).cast(key_type).alias("neighbor"), F.lit(0.0).alias("distance"),
                        F.lit(0).alias("position")).limit(0)

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        parts = []
        if a.num_rows and b.num_rows:
            b = b.sort_by("key")
            keys, qids = b["key"].combine_chunks(), a["qid"].combine_chunks()
            limit = a["bound"].to_numpy() * (1 + SLACK) + SLACK
            for row, c, dist in _closest(_matrix(a["v"]), limit, _matrix(b["v"]), keep):
                parts.append(pa.table({"qid": qids.take(pa.array(row)), "neighbor": keys.take(pa.array(c)), "distance": pa.array(dist)}))
        return pa.concat_tables(parts) if parts else pa.table({"qid": pa.array([], pa.string()), "neighbor": b["key"].slice(0, 0), "distance": pa.array([], pa.float64())})

    unique = q.select("v").distinct().select(_vector_id().alias("qid"), "v")
    bounded = search_bounds(index, unique, block_rows)
    schema = f"qid string, neighbor {key_type.simpleString()}, distance double"
    if reached_share(index, bounded) > 0.5:
        found = _tiled(index, bounded, compare, schema, block_rows)
    else:
        found = _met(index, _planned(index, bounded), block_rows, compare, schema)
    per_query = Window.partitionBy("qid").orderBy("distance", "neighbor")
    best = found.withColumn("__p", F.row_number().over(per_query)).where(F.col("__p") <= keep).drop("__p")
    out = q.select("key", _vector_id().alias("qid")).join(best, "qid")
    if exclude_self:
        out = out.where(F.col("key") != F.col("neighbor"))
    per_key = Window.partitionBy("key").orderBy("distance", "neighbor")
    return out.withColumn("position", F.row_number().over(per_key)).where(F.col("position") <= k).select(
        "key", "neighbor", "distance", "position")


def transfer_attribute(synthetic: DataFrame, real: DataFrame, key: str, real_key: str, features: Sequence[str] | str,
                       attribute: str, block_rows: int = 2048) -> DataFrame:
    """Each synthetic row takes an attribute from its nearest real row."""
    nn = nearest_neighbors(synthetic, real, key, features, 1, exclude_self=False, ref_key=real_key, block_rows=block_rows)
    return nn.join(real.select(F.col(real_key).alias("neighbor"), attribute), "neighbor").select(
        F.col("key").alias(key), "neighbor", "distance", attribute)


def tomek_links(df: DataFrame, key: str, label: str, features: Sequence[str] | str, block_rows: int = 2048) -> DataFrame:
    """Pairs of opposite classes that are each other's nearest neighbour (key_a < key_b)."""
    nn = staged(nearest_neighbors(df, df, key, features, 1, block_rows=block_rows).select("key", "neighbor", "distance"))
    side = df.select(F.col(key).alias("key"), F.col(label).alias("y"))
    mine = nn.join(side, "key")
    back = mine.select(F.col("key").alias("neighbor"), F.col("neighbor").alias("key"), F.col("y").alias("other_y"))
    return mine.join(back, ["key", "neighbor"]).where(
        (F.col("key") < F.col("neighbor")) & (F.col("y") != F.col("other_y"))).select(
        F.col("key").alias("key_a"), F.col("neighbor").alias("key_b"), "distance")
