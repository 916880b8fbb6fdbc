"""What joins within tiles share: splitting large tiles into blocks, and components inside one block pair."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, tile: str, key: str, block_rows: int) -> DataFrame:
    """``rows`` dealt to units (tile, lo, hi), plus their own block (blk).

    A tile of n rows has g = ceil(n / block_rows) blocks by a hash of ``key``; each two blocks, and each block with
    itself, are one unit of at most about two blocks' rows, so no task holds a whole tile. A tile of one block is one unit.
    """
    large = rows.groupBy(F.col(tile).alias("_tile")).count().where(F.col("count") > block_rows)
    large = large.select("_tile", F.ceil(F.col("count") / block_rows).cast("int").alias("_g"))
    got = rows.join(large, F.col(tile) == F.col("_tile"), "left").withColumn("_g", F.coalesce("_g", F.lit(1))).drop("_tile")
    got = got.withColumn("blk", F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.col("_g")).cast("int"))
    got = got.withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
    return got.withColumns({"lo": F.least("blk", "_q"), "hi": F.greatest("blk", "_q")}).drop("_g", "_q")


class Forest:
    """Components of numbered nodes under edges that come in batches; memory for the nodes and one batch only."""

    def __init__(self, n: int):
        self.label = np.arange(n, dtype=np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            la, lb = label[a], label[b]
            open_ = la != lb
            if not open_.any():
                return
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                further = label[label]
                if (further == label).all():
                    break
                label[:] = further

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node that isn't its component's first, and that first."""
        rest = np.flatnonzero(self.label != np.arange(len(self.label)))
        return rest, self.label[rest]
