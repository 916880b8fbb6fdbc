"""SimHash fingerprints, and their near pairs by vantage-point trees over quarters.

Fingerprints: one Arrow pass, no shuffle. Near pairs: a fingerprint is cut into four quarters of 16 bits. Two that differ in at most four bits differ in at
most one bit of some quarter, so each quarter is searched on its own, at radius one. Distinct fingerprints (equal ones are one) are dealt
to shards by the leading bits of the quarter; a neighbour beyond the border differs in one of those bits, so each
fingerprint also visits the shards with one of them flipped, the greater ones only: at most 4 x 9 rows on average, whatever the
number of rows. Within a shard (blocks of bounded size, see ``tiles``) a vantage-point tree over the quarter's distinct values finds the pairs of values within the
radius: at each node the distance to one vantage value orders both sides in rings, and by the triangle inequality a ring meets only rings within the
radius. Rows of a pair of values are compared exactly; where there are many, the remaining quarters are searched in the same way, at their share of
the radius. A shard hands out a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .graph import components
from .text import extended, raw, shielded, words
from .tiles import Forest, block_pairs

#: Texts that are taken apart at a time.
SLICE = 1000
SHINGLE = 4
RADIUS = 4
SEED = 42
#: Rows of a block of a shard; a unit of work holds two.
BLOCK = 16_384
#: Fingerprints at home in a shard, about; there are never more than 65,536 shards a quarter.
SHARD_ROWS = 16_384
#: Comparisons below which a tree node compares directly.
LEAF = 1 << 17
QUARTERS, BITS = 4, 16
#: Pairs of rows that are compared at a time.
STEP = 2_000_000


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text (null or without words: 0)."""
    flat, ends = words(texts, lower=True)
    data, starts = raw(flat)
    sizes = np.diff(starts)
    n = len(sizes)
    spaced = np.full(len(data) + n, 32, np.uint8)
    if n:
        keep = np.ones(len(spaced), bool)
        keep[starts[1:] + np.arange(n)] = False
        spaced[keep] = data
    begin = starts[:-1] + np.arange(n)
    memory = spaced.tobytes()
    out = np.zeros(len(ends) - 1, np.uint64)
    count = np.diff(ends)
    # Texts in runs of about 200,000 words, so that the bit matrix stays small; the last run ends with the last text.
    cuts = np.unique(np.append(np.searchsorted(np.cumsum(count), np.arange(0, n, 200_000)), len(count)))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        docs = np.arange(lo, hi)
        docs = docs[count[docs] > 0]
        if not len(docs):
            continue
        each = np.maximum(count[docs] - shingle + 1, 1)
        from_ = ends[docs]
        bounds = np.cumsum(each) - each
        first = np.repeat(from_ - bounds, each) + np.arange(int(each.sum()))
        last = np.minimum(first + shingle - 1, np.repeat(ends[docs + 1] - 1, each))
        s, e = begin[first], begin[last] + sizes[last]
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(memory[i:j], SEED) for i, j in zip(s.tolist(), e.tolist(), strict=True)), np.uint64, len(s))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bounds, axis=0, dtype=np.int32)
        out[docs] = np.packbits(2 * ones > each[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` without its text, plus the fingerprint as a signed 64-bit integer."""
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = extended(kept, **{name: "long"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                b = whole.slice(lo, SLICE)
                fp = fingerprints(b.column(b.schema.get_field_index(text))).view(np.int64)
                yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(f.name)) for f in kept], pa.array(fp)], names=[*[f.name for f in kept], name])

    return docs.mapInArrow(run, schema)


def vantage_pairs(x: np.ndarray, left: np.ndarray, right: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (i, j), i in ``left`` and j in ``right`` (or both in ``left``), whose x differ in at most ``radius`` bits. Within ``left``, pairs come in one or both orders."""
    todo = [(left, left if right is None else right, right is None, 0)]
    while todo:
        a, b, same, tries = todo.pop()
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) <= LEAF or tries > 2:
            for lo in range(0, len(a), 2048):
                for at in range(0, len(b), 2048):
                    p, q = a[lo:lo + 2048], b[at:at + 2048]
                    i, j = np.nonzero(np.bitwise_count(x[p][:, None] ^ x[q][None, :]) <= radius)
                    yield p[i], q[j]
            continue
        vantage = x[a[len(a) * (2 * tries + 1) // 7 % len(a)]]
        da = np.bitwise_count(x[a] ^ vantage).astype(np.int64)
        a, da = a[np.argsort(da, kind="stable")], np.sort(da)
        if same:
            b, db = a, da
        else:
            db = np.bitwise_count(x[b] ^ vantage).astype(np.int64)
            b, db = b[np.argsort(db, kind="stable")], np.sort(db)
        rings = np.unique(da)
        at_a, to_a = np.searchsorted(da, rings), np.searchsorted(da, rings, "right")
        low = rings + 1 if same else rings - radius
        at_b, to_b = np.searchsorted(db, low), np.searchsorted(db, rings + radius, "right")
        work = int(((to_a - at_a) * (to_b - at_b)).sum())
        stuck = work > 0.8 * len(a) * len(b) / (2 if same else 1)
        for i in range(len(rings)):
            own = a[at_a[i]:to_a[i]]
            todo.append((own, b[at_b[i]:to_b[i]], False, tries + 1 if stuck else 0))
            if same:
                todo.append((own, own, True, tries + 1 if stuck else 0))


def _by_value(x: np.ndarray, rows: np.ndarray, quarter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows sorted by their value of the quarter, distinct values, where each begins, how many rows it has)."""
    value = x[rows] >> np.uint64(BITS * quarter) & np.uint64((1 << BITS) - 1)
    order = np.argsort(value, kind="stable")
    values, start, count = np.unique(value[order], return_index=True, return_counts=True)
    return rows[order], values, start, count


def near_links(x: np.ndarray, left: np.ndarray, right: np.ndarray | None, radius: int, forest: Forest, first: int | None = None) -> int:
    """Link x[left] with x[right] (or x[left] among themselves) wherever at most ``radius`` bits differ; returns how many pairs of rows were compared.

    With ``first`` only pairs that keep that quarter's share of the radius are asked for.
    """
    every = tuple(range(QUARTERS))
    todo = [(left, left if right is None else right, right is None, every, every if first is None else (first,))]
    compared = 0
    while todo:
        a, b, same, rest, tried = todo.pop()
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) <= LEAF or not rest:
            for lo in range(0, len(a), 2048):
                for at in range(lo if same else 0, len(b), 2048):
                    p, q = a[lo:lo + 2048], b[at:at + 2048]
                    i, j = np.nonzero(np.bitwise_count(x[p][:, None] ^ x[q][None, :]) <= radius)
                    forest.add(p[i], q[j])
                    compared += len(p) * len(q)
            continue
        for quarter in tried:
            others = tuple(k for k in rest if k != quarter)
            a, va, at_a, n_a = _by_value(x, a, quarter)
            b, vb, at_b, n_b = (a, va, at_a, n_a) if same else _by_value(x, b, quarter)
            # Values of both sides as one array of numbered points for the tree.
            points = va if same else np.concatenate([va, vb])
            ones, twos = np.arange(len(va)), None if same else np.arange(len(va), len(points))
            found = list(vantage_pairs(points, ones, twos, radius // len(rest)))
            i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            if same:
                i, j = np.divmod(np.unique(np.minimum(i, j) * len(va) + np.maximum(i, j)), len(va))
            else:
                j = j - len(va)
            pairs = n_a[i] * n_b[j]
            for k in np.flatnonzero(pairs > LEAF):
                todo.append((a[at_a[i[k]]:at_a[i[k]] + n_a[i[k]]], b[at_b[j[k]]:at_b[j[k]] + n_b[j[k]]], same and i[k] == j[k], others, others))
            small = pairs <= LEAF
            i, j, pairs = i[small], j[small], pairs[small]
            compared += int(pairs.sum())
            ends = np.cumsum(pairs)
            lo = 0
            while lo < len(pairs):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + STEP, "right")))
                n = pairs[lo:hi]
                within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                width = np.repeat(n_b[j[lo:hi]], n)
                p, q = a[np.repeat(at_a[i[lo:hi]], n) + within // width], b[np.repeat(at_b[j[lo:hi]], n) + within % width]
                ok = np.bitwise_count(x[p] ^ x[q]) <= radius
                forest.add(p[ok], q[ok])
                lo = hi
    return compared


def shards(fps: DataFrame, leading: int) -> DataFrame:
    """(fp, shard, own): each fingerprint in its shard of every quarter (own), and as a visitor in the greater ones of which it differs in one leading bit.

    A shard is known by quarter and ``leading`` bits, at most 18 bits in all.
    """
    quarters = [F.shiftrightunsigned("fp", BITS * q).bitwiseAND(F.lit((1 << BITS) - 1)) for q in range(QUARTERS)]
    tops = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.shiftrightunsigned(v, BITS - leading).alias("top")) for q, v in enumerate(quarters)])
    homes = fps.select("fp", F.explode(tops).alias("e")).select("fp", "e.*")
    beyond = F.array(*[F.when(F.col("top").bitwiseAND(F.lit(1 << i)) == 0, F.col("top") + (1 << i)) for i in range(leading)]) if leading else F.array().cast("array<bigint>")
    every = homes.select("fp", "q", F.explode(F.array_compact(F.concat(F.array("top"), beyond))).alias("at"), "top")
    return every.select("fp", (F.col("q") * (1 << BITS) + F.col("at")).alias("shard"), (F.col("at") == F.col("top")).alias("own"))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) of a forest that spans the links of distinct fingerprints (column fp)."""
    if radius >= 2 * QUARTERS:
        raise ValueError(f"visits reach a radius below {2 * QUARTERS}")
    leading = min(BITS, max(0, math.ceil(math.log2(max(1, fps.count()) / SHARD_ROWS))))
    units = block_pairs(shards(fps, leading), "shard", "fp", BLOCK)

    def run(unit: pa.Table) -> pa.Table:
        x, own = unit.column("fp").to_numpy().view(np.uint64), unit.column("own").to_numpy(zero_copy_only=False)
        lo, hi, quarter = unit.column("lo")[0].as_py(), unit.column("hi")[0].as_py(), unit.column("shard")[0].as_py() >> BITS
        mine = unit.column("blk").to_numpy()
        forest = Forest(len(x))
        # Visitors meet only rows at home here; they meet each other where one of them is.
        if lo == hi:
            near_links(x, np.flatnonzero(own), None, radius, forest, quarter)
            near_links(x, np.flatnonzero(own), np.flatnonzero(~own), radius, forest, quarter)
        else:
            near_links(x, np.flatnonzero((mine == lo) & own), np.flatnonzero(mine == hi), radius, forest, quarter)
            near_links(x, np.flatnonzero((mine == lo) & ~own), np.flatnonzero((mine == hi) & own), radius, forest, quarter)
        a, b = forest.edges()
        x = x.view(np.int64)
        return pa.table({"a": x[a], "b": x[b]})

    return units.groupBy("shard", "lo", "hi").applyInArrow(run, "a long, b long")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id): each row's fingerprint and the smallest key reachable by links.

    Null texts have fingerprint 0. Rows of equal key are rows of their own; a null key never is a component's name unless all of its keys are null.
    """
    marked = staged(with_fingerprint(docs.select(key, text), text))
    first = staged(marked.groupBy("fp").agg(F.min(key).alias("first")))
    found = components(links(first.select("fp"), radius))
    at = staged(first.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("root")))
    least = staged(at.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component_id")))
    named = staged(at.join(least, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id"))
    return marked.join(named, F.col("fp") == F.col("_fp")).select(key, "fp", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of linked rows: the one of the smallest key (rows without a key only where a group has no other).

    Rows are told apart by 128 bits of key and text; of rows equal in both, any one stays, whatever their other columns hold.
    """
    inner, at = shielded(docs)
    key, text = at[key], at[text]
    mark = F.concat_ws(":", F.xxhash64(F.col(key), F.col(text)).cast("string"), F.xxhash64(F.lit(1), F.col(text), F.col(key)).cast("string"))
    marked = inner.select(mark.alias("_mark"), F.col(text).alias("_text"))
    found = groups(marked, "_mark", "_text", radius)
    owners = staged(inner.select(mark.alias("_m"), F.col(key).cast("long").alias("_k")).distinct())
    ranked = found.select("_mark", "component_id").distinct().join(owners, F.col("_mark") == F.col("_m"))
    first = staged(ranked.groupBy("component_id").agg(F.min(F.struct(F.col("_k").isNull().alias("none"), "_k", "_mark")).alias("best")).select(F.col("best._mark").alias("_stay")))
    kept = inner.withColumn("_mark", mark).join(first, F.col("_mark") == F.col("_stay"), "left_semi")
    return kept.dropDuplicates(["_mark"]).drop("_mark").toDF(*docs.columns)
