"""Isotonic regression over any number of distinct scores.

Adjacent violators are pooled inside range buckets, each a bounded group; the block lists that remain are far shorter, get new
borders between the old ones, and are pooled again, until no block lies above the next one. Pooling gives the same blocks in whatever order
it happens, so the borders steer the work only. No list of blocks reaches the driver: the fitted map is a table, applied by range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dbl, no_nan
from ..session import staged
from .ordering import ROWS_PER_BUCKET, bucket_index, range_borders

BLOCK = "lo double, hi double, s double, w double"


def pool(lo: Sequence[float], hi: Sequence[float], s: Sequence[float], w: Sequence[float]) -> tuple[list, list, list, list]:
    """Pool adjacent violators of blocks in ascending order; equal means become one block."""
    los, his, sums, weights = [], [], [], []
    for a, b, t, v in zip(lo, hi, s, w):
        while sums and sums[-1] * v >= t * weights[-1]:
            a, t, v = los.pop(), t + sums.pop(), v + weights.pop()
            his.pop()
        los.append(a)
        his.append(b)
        sums.append(t)
        weights.append(v)
    return los, his, sums, weights


def _pool_bucket(group: pa.Table) -> pa.Table:
    order = np.argsort(group["lo"].to_numpy(), kind="stable")
    out = pool(*(group[c].to_numpy()[order].tolist() for c in ("lo", "hi", "s", "w")))
    bucket = pa.array([group["bucket"][0].as_py()] * len(out[0]), pa.int32())
    return pa.table([bucket, *(pa.array(c, pa.float64()) for c in out)], names=["bucket", "lo", "hi", "s", "w"])


def fit(scored: DataFrame, label: str, p: str = "probability", weight: str | None = None, rows: int = ROWS_PER_BUCKET) -> DataFrame:
    """(lo, hi, value, weight) of each block: scores from lo to hi are fitted by the weighted mean of their labels; values rise from block to block.

    Equal scores are merged first. Rows whose score or label is NULL or NaN, or whose weight isn't positive, are left out; without rows there are no blocks.
    """
    x, y, v = no_nan(p), no_nan(label), dbl(weight) if weight else F.lit(1.0)
    kept = scored.select(x.alias("x"), y.alias("y"), v.alias("v")).where("x is not null and y is not null and v > 0")
    merged = kept.groupBy(F.col("x").alias("lo")).agg(F.sum(F.col("y") * F.col("v")).alias("s"), F.sum("v").alias("w"))
    blocks, turn = staged(merged.select("lo", F.col("lo").alias("hi"), "s", "w")), 0
    while True:
        parts = -(-blocks.count() // rows)
        borders = range_borders(blocks, ["lo"], 2 * parts)["lo"][turn % 2::2] if parts > 1 else []
        pooled = staged(blocks.withColumn("bucket", bucket_index(F.col("lo"), borders)).groupBy("bucket").applyInArrow(_pool_bucket, f"bucket int, {BLOCK}"))
        # The same comparison as in ``pool``, so that what it leaves apart isn't seen as a violation by rounding.
        ends = F.struct("s", "w")
        seams = pooled.groupBy("bucket").agg(F.min_by(ends, "lo").alias("first"), F.max_by(ends, "lo").alias("last"))
        before = F.lag("last").over(Window.partitionBy(F.lit(1)).orderBy("bucket"))  # one row per bucket
        blocks, turn = pooled.drop("bucket"), turn + 1
        if seams.select((before["s"] * F.col("first.w") >= F.col("first.s") * before["w"]).alias("bad")).where("bad").isEmpty():
            return blocks.select("lo", "hi", (F.col("s") / F.col("w")).alias("value"), F.col("w").alias("weight"))


def falls(blocks: DataFrame, rows: int = ROWS_PER_BUCKET) -> int:
    """How many blocks lie below the block before (0 for whatever ``fit`` returns)."""
    parts = -(-blocks.count() // rows)
    borders = range_borders(blocks, ["lo"], parts)["lo"] if parts > 1 else []
    lined = blocks.withColumn("bucket", bucket_index(F.col("lo"), borders))
    inside = lined.select((F.lag("value").over(Window.partitionBy("bucket").orderBy("lo")) > F.col("value")).alias("bad"))
    ends = lined.groupBy("bucket").agg(F.min_by("value", "lo").alias("first"), F.max_by("value", "lo").alias("last"))
    seams = ends.select((F.lag("last").over(Window.partitionBy(F.lit(1)).orderBy("bucket")) > F.col("first")).alias("bad"))
    return inside.unionByName(seams).where("bad").count()


def _carried(value: str, order: Sequence[Column], forward: bool) -> Column:
    """The nearest non-null value before (or after) a row inside its bucket.

    Both ways the frame only grows: a frame that ends with the bucket is walked anew for every row.
    """
    w = Window.partitionBy("bucket").orderBy(*[c.asc() if forward else c.desc() for c in order])
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0 if forward else -1))


def apply(df: DataFrame, blocks: DataFrame, p: str = "probability", name: str = "calibrated", rows: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` plus the fitted value: linear between blocks, constant below the first and above the last; NULL for NULL and NaN, or without blocks.

    Distinct scores meet the blocks in range buckets, with the nearest blocks of other buckets carried over; rows get their score's value by a join.
    """
    points = df.select(no_nan(p).alias("x")).where("x is not null").distinct()
    none = F.lit(None)
    shape = F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi"), F.col("value").alias("value"))
    # Blocks sort before a point of equal score.
    both = staged(blocks.select(F.col("lo").alias("x"), F.lit(0).alias("kind"), shape.alias("block")).unionByName(
        points.select("x", F.lit(1).alias("kind"), F.struct(none.cast("double").alias("lo"), none.cast("double").alias("hi"), none.cast("double").alias("value")).alias("block"))
        .withColumn("block", F.when(F.lit(False), F.col("block")))))
    parts = -(-both.count() // rows)
    borders = range_borders(both, ["x"], parts)["x"] if parts > 1 else []
    both = both.withColumn("bucket", bucket_index(F.col("x"), borders))
    ends = both.where("kind = 0").groupBy("bucket").agg(F.max_by("block", "x").alias("top"), F.min_by("block", "x").alias("low"))
    line, earlier = Window.partitionBy(F.lit(1)), (Window.unboundedPreceding, -1)  # one row per bucket
    every = both.select("bucket").distinct().join(ends, "bucket", "left").select(
        "bucket", F.last("top", ignorenulls=True).over(line.orderBy("bucket").rowsBetween(*earlier)).alias("under"),
        F.last("low", ignorenulls=True).over(line.orderBy(F.col("bucket").desc()).rowsBetween(*earlier)).alias("over"))
    order = [F.col("x"), F.col("kind")]
    near = both.withColumns({"below": _carried("block", order, True), "above": _carried("block", order, False)}).where("kind = 1").join(every, "bucket")
    near = near.select("x", F.coalesce("below", "under").alias("a"), F.coalesce("above", "over").alias("b"))
    x, a, b = F.col("x"), F.col("a"), F.col("b")
    between = a["value"] + (b["value"] - a["value"]) * (x - a["hi"]) / (b["lo"] - a["hi"])
    fitted = F.when(a.isNull(), b["value"]).when((x <= a["hi"]) | b.isNull(), a["value"]).otherwise(between)
    found = near.select(x.alias("__x"), fitted.alias(name))
    return df.join(found, no_nan(p) == F.col("__x"), "left").drop("__x")
