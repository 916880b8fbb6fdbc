"""Documents in id order, dealt to partitions of whole id ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes of a partition; more where there would be more partitions than this. Whoever reads them holds a block of them at a time.
PARTITION_BYTES = 24 << 20
MOST_PARTITIONS = 50_000


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) sorted by the key within and across partitions; null keys come first, equal keys stay in reading order and may span partitions."""
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    parts = max(1, -(-size // max(PARTITION_BYTES, size // MOST_PARTITIONS)))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("_tie", F.monotonically_increasing_id())
    return rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
