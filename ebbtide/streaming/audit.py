"""Structured Streaming over the scoring audit log.

Every function takes a streaming or a static DataFrame: the batch run of the
same code is the reference for what the stream must produce.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dbl, ratio
from ..operators.models import score
from ..sources.schemas import AUDIT
from .upsert import upsert

RETENTION = "90 days"
WEEK = "7 days"


def audit_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON-lines files as they arrive; unreadable lines come through with NULL fields (see ``readable``)."""
    reader = spark.readStream.schema(AUDIT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def readable(stream: DataFrame) -> DataFrame:
    return stream.where(F.col("timestamp").isNotNull())


def unreadable(stream: DataFrame) -> DataFrame:
    return stream.where(F.col("timestamp").isNull())


def near_miss(attribute: str, value: str, edge: float, margin: float = 0.05) -> Column:
    """A fairness flag: a row of the named group whose score passes the edge of its tier by less than the margin."""
    over = dbl("probability") - F.lit(edge)
    return (F.col(attribute) == value) & (over >= 0) & (over < margin)


def running_stats(stream: DataFrame, flagged: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Totals since the start, one row or one per group: count, mean score, HIGH count, fairness flags (rows that meet ``flagged``; 0 without a condition)."""
    flags = F.count_if(flagged) if flagged is not None else F.lit(0).cast("long")
    return stream.groupBy(*[F.col(c).alias(c.rsplit(".", 1)[-1]) for c in by]).agg(
        F.count(F.lit(1)).alias("prediction_count"), F.round(F.coalesce(F.avg(dbl("probability")), F.lit(0.0)), 4).alias("avg_probability"),
        F.count_if(F.col("risk_tier") == "HIGH").alias("high_risk_count"), flags.alias("fairness_flags_triggered"))


def windowed_stats(stream: DataFrame, width: str = WEEK, retention: str = RETENTION, ts: str = "timestamp") -> DataFrame:
    """Tumbling windows; rows later than the retention are dropped with their state."""
    return stream.withWatermark(ts, retention).groupBy(F.window(ts, width)).agg(
        F.count(F.lit(1)).alias("prediction_count"), F.avg(dbl("probability")).alias("avg_probability"),
        F.count_if(F.col("risk_tier") == "HIGH").alias("high_risk_count")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "prediction_count", "avg_probability", "high_risk_count")


def fairness_alerts(stream: DataFrame, attribute: str, threshold: float = 0.1, width: str = WEEK, retention: str = RETENTION,
                    ts: str = "timestamp", flagged: Column | None = None) -> DataFrame:
    """Per window the gap between group rates of HIGH scores, and whether it exceeds the threshold.

    Two chained aggregations (group rates, then their range), both bounded by the watermark.
    """
    hit = flagged if flagged is not None else F.col("risk_tier") == "HIGH"
    rates = stream.withWatermark(ts, retention).groupBy(F.window(ts, width), F.col(attribute).alias("group_value")).agg(
        F.count(F.lit(1)).alias("n"), ratio(F.count_if(hit), F.count(F.lit(1))).alias("rate"))
    return rates.groupBy(F.window(F.window_time("window"), width)).agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n_rows"), F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate")).select(
        F.col("window.start").alias("window_start"), "n_groups", "n_rows", "min_rate", "max_rate",
        (F.col("max_rate") - F.col("min_rate")).alias("gap"), ((F.col("max_rate") - F.col("min_rate")) > threshold).alias("alert"))


def score_stream(stream: DataFrame, model: Transformer, **kwargs) -> DataFrame:
    """Scoring is a row-wise plan, so the batch function serves streams unchanged."""
    return score(stream, model, **kwargs)


def drain(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", fmt: str = "parquet", keys: Sequence[str] | None = None) -> StreamingQuery:
    """Process what is available and stop. Append goes to a file sink; complete rewrites the result.

    Update mode hands out changed rows only; they are merged by ``keys`` (none for a single row) into a versioned folder, which
    ``upsert.read_latest`` reads. Without keys given it is refused, as a rewritten folder can't hold such a result.
    """
    if mode not in ("append", "complete") and (mode != "update" or keys is None):
        raise ValueError(f"drain can't keep the result of output mode {mode}")
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).outputMode(mode)
    if mode == "append":
        query = writer.format(fmt).option("path", out).start()
    else:
        query = writer.foreachBatch(upsert(out, keys) if mode == "update" else _rewrite(out, fmt)).start()
    query.awaitTermination()
    return query


def _rewrite(out: str, fmt: str) -> Callable[[DataFrame, int], None]:
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(out)
    return save
