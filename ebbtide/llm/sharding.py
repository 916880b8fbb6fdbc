"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number from the key and its own name; the shard with the smallest
-ln(u) / weight takes the record. A further shard only takes records into itself, and a
record's shard depends on nothing but its key and the shard list. All of it is column
expressions: no shuffle. Only ``with_slots``, which numbers the rows of a shard, shuffles,
and it does so by (shard, bucket) cells, never by shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .text import shielded, unshielded

#: Rows for which one numbering cell of a shard is made.
CELL_ROWS = 20_000
#: Cells per shard at least, so that small tables spread as well.
MIN_CELLS = 64


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) that only the key and the shard's number decide; a null key draws as well."""
    top = F.shiftrightunsigned(F.xxhash64(F.lit(shard), F.coalesce(key.cast("string"), F.lit("\0null"))), 11)
    return (top.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard that takes the key; shards are numbered by their place in ``weights``, weight 0 takes nothing."""
    bids = [F.struct((-F.log(draw(key, i)) / F.lit(float(w))).alias("cost"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    if not bids:
        raise ValueError("a shard of positive weight is needed")
    return F.array_min(F.array(*bids))["shard"]


def with_slots(rows: DataFrame, shard: str = "shard", key: str = "doc_id", slot: str = "slot") -> DataFrame:
    """``rows`` plus each row's place in its shard, gapless from 0 (a column of that name is replaced).

    The rows are staged once with a row number that only serves to spread them, so that one key
    with a third of all rows still lands in many cells. Cell totals (one row per cell) give
    the offsets. An empty table stays empty; repeated rows get places of their own.
    """
    inner, names = shielded(rows)
    shard, key, kept = names[shard], names[key], {old: new for old, new in names.items() if old != slot}
    fixed = staged(inner.withColumn("_row", F.monotonically_increasing_id()))
    shards = fixed.agg(F.max(shard)).first()[0]
    cells = max(MIN_CELLS, fixed.count() // (CELL_ROWS * ((shards or 0) + 1)))
    fixed = fixed.withColumn("_cell", F.expr(f"pmod(xxhash64(`{key}`, _row), {cells})"))
    from pyspark.sql import Window

    totals = fixed.groupBy(F.col(shard).alias("_shard"), F.col("_cell").alias("_at")).count()
    before = totals.select("_shard", "_at", (F.sum("count").over(Window.partitionBy("_shard").orderBy("_at")) - F.col("count")).alias("_before"))
    numbered = fixed.withColumn("_place", F.row_number().over(Window.partitionBy(shard, "_cell").orderBy(key, "_row")) - 1)
    on = (F.col(shard) == F.col("_shard")) & (F.col("_cell") == F.col("_at"))
    return unshielded(numbered.join(before, on).withColumn(slot, (F.col("_before") + F.col("_place")).cast("long")), kept, [slot])


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", grown: Sequence[float] | None = None) -> DataFrame:
    """Each row's size, text checksum, shard, and the shard it would have under ``grown`` (one more shard of weight 1 by default).

    A null text has size 1 and the checksum of nothing (0). Other columns of ``docs`` are left out.
    """
    grown = list(weights) + [1.0] if grown is None else grown
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
