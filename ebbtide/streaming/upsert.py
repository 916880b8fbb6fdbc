"""A folder that holds the latest row of every key, fed by streams in update mode.

Layout: ``data/version=<batch>/bucket=<k>`` has rows, ``commits/version=<batch>`` says which version each bucket has after a batch. A
batch rewrites only the buckets that its keys fall into, and counts once its commit is written; readers follow the newest commit. A batch
that is run again starts from the commit before it and overwrites its own folders, so replays change nothing. What neither of the last
two commits names is deleted: a reader has until the batch after next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from ..sources.tables import drop_path, path_exists

#: Parts of the result that are rewritten separately. A folder keeps the number it was begun with.
BUCKETS = 16

Versions = dict[int, int]


def _commits(spark: SparkSession, out: str, before: int | None = None) -> dict[int, Versions]:
    """Commit number -> version of each bucket, of the commits before a batch; two are there as a rule, each a number per bucket."""
    if not path_exists(spark, f"{out}/commits"):
        return {}
    made = spark.read.schema("bucket int, at long, version long").parquet(f"{out}/commits")
    found: dict[int, Versions] = {}
    for r in made.where(F.col("version") < before if before is not None else F.lit(True)).collect():
        found.setdefault(r["version"], {})[r["bucket"]] = r["at"]
    return found


def _rows(spark: SparkSession, out: str, versions: Versions, schema: T.StructType) -> DataFrame:
    """The rows of these buckets' versions; the condition names partitions only, so no other folder is read."""
    wanted: Column = F.lit(False)
    for version in sorted(set(versions.values())):
        wanted = wanted | ((F.col("version") == version) & F.col("bucket").isin(*[b for b, v in versions.items() if v == version]))
    parts = [T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(f"{out}/data").where(wanted).drop("version", "bucket")


def read_latest(spark: SparkSession, out: str) -> DataFrame:
    """The newest committed row of every key; fails if nothing was committed yet."""
    made = _commits(spark, out)
    columns = spark.read.parquet(f"{out}/data").drop("version", "bucket").schema
    return _rows(spark, out, made[max(made)], columns)


def upsert(out: str, keys: Sequence[str] = (), buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls with the changed rows, at most one per key, and the batch's number.

    Without keys the result is a single row. NULL is a key value like any other. Columns may not be called version or bucket.
    """
    keys = list(keys)

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int") if keys else F.lit(0)
        changed = staged(batch.withColumn("bucket", place))
        touched = [r[0] for r in changed.select("bucket").distinct().collect()]  # numbers below ``buckets``
        if not touched:
            return
        made = _commits(spark, out, batch_id)
        last = made.pop(max(made)) if made else {}
        old = {b: v for b, v in last.items() if b in touched}
        rows = changed
        if old and keys:
            kept = _rows(spark, out, old, batch.schema).withColumn("bucket", place)
            same = [kept[k].eqNullSafe(changed[k]) for k in keys]
            rows = changed.unionByName(kept.join(changed, same, "left_anti"))
        # Rebalanced by bucket: small buckets share a task, a large one is split by size.
        parts = rows.withColumn("version", F.lit(batch_id).cast("long")).hint("rebalance", "bucket")
        parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "bucket").parquet(f"{out}/data")
        now = last | dict.fromkeys(touched, batch_id)
        commit = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(b).alias("bucket"), F.lit(v).cast("long").alias("at")) for b, v in now.items()])).alias("e"))
        commit.select("e.*", F.lit(batch_id).cast("long").alias("version")).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{out}/commits")
        for number, versions in made.items():
            for bucket, version in versions.items():
                if last.get(bucket) != version:
                    drop_path(spark, f"{out}/data/version={version}/bucket={bucket}")
            drop_path(spark, f"{out}/commits/version={number}")

    return save
