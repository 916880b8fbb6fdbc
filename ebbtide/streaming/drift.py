"""Drift of a stream against a fixed baseline, per tumbling window.

The baseline is fitted once: quantile edges and counts per bin, a few numbers per feature. The stream then keeps one
counter per (window, feature, bin), and a second aggregation turns a window's histogram into its stability index
when the watermark closes it. State is bounded by open windows x features x bins, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dbl, no_nan, ratio
from ..operators.drift import DRIFT_THRESHOLD, _bin, baseline_edges, common_numeric
from .audit import RETENTION, WEEK


@dataclass(frozen=True)
class BaselineBins:
    """Edges of each feature's bins and the baseline's rows in them (bins + 1 and bins numbers per feature)."""

    edges: Mapping[str, Sequence[float]]
    counts: Mapping[str, Sequence[int]]
    open_ends: bool = False


def baseline_bins(base: DataFrame, cols: Sequence[str] | None = None, bins: int = 10, open_ends: bool = False) -> BaselineBins:
    """The fitted baseline; features without spread (fewer than two edges) have no bins and are left out."""
    cols = list(cols) if cols is not None else common_numeric(base, base)
    edges = {c: e for c, e in baseline_edges(base, cols, bins).items() if len(e) > 1}
    if not edges:
        return BaselineBins({}, {}, open_ends)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.when(no_nan(c).isNotNull(), _bin(dbl(c), e, open_ends)).alias("bin")) for c, e in edges.items()])
    seen = base.select(F.explode(cells).alias("e")).select("e.*").where("bin is not null").groupBy("feature", "bin").count().collect()
    counts = {c: [0] * (len(e) - 1) for c, e in edges.items()}
    for r in seen:
        counts[r["feature"]][r["bin"]] = r["count"]
    return BaselineBins(edges, counts, open_ends)


def windowed_psi(stream: DataFrame, baseline: BaselineBins, width: str = WEEK, retention: str = RETENTION, ts: str = "timestamp",
                 threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Population stability index per window and feature of a stream (or a static table, whose windows are all final).

    Same smoothing and bins as the batch ``psi``: NULL and NaN are skipped, values outside the baseline's range are reported as a share unless
    the baseline has open ends. A window without any value of a feature has no row for it. Rows later than the retention are dropped.
    """
    if not baseline.edges:
        raise ValueError("no feature of the baseline has any spread")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.when(no_nan(c).isNotNull(), _bin(dbl(c), e, baseline.open_ends)).alias("bin"))
                      for c, e in baseline.edges.items()])
    long = stream.withWatermark(ts, retention).select(F.col(ts).alias("__ts"), F.explode(cells).alias("e")).where("e.bin is not null")
    histogram = long.groupBy(F.window("__ts", width), F.col("e.feature").alias("feature"), F.col("e.bin").alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    # At most one entry per bin: the counts of a window and feature fit in one row.
    per = histogram.groupBy(F.window(F.window_time("window"), width), "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "cnt"))).alias("cells"),
        F.coalesce(F.sum(F.when(F.col("bin") >= 0, F.col("cnt"))), F.lit(0)).alias("n_current"), F.coalesce(F.sum(F.when(F.col("bin") < 0, F.col("cnt"))), F.lit(0)).alias("n_outside"))
    fitted = F.create_map(*[x for c, n in baseline.counts.items() for x in (F.lit(c), F.array(*[F.lit(int(i)).cast("long") for i in n]))])
    per = per.withColumn("base", F.element_at(fitted, F.col("feature"))).withColumn("n_bins", F.size("base").cast("long"))
    per = per.withColumn("n_base", F.aggregate("base", F.lit(0).cast("long"), lambda s, x: s + x))

    def term(expected, b):
        pe = (expected + 1) / (F.col("n_base") + F.col("n_bins")).cast("double")
        pc = (F.coalesce(F.element_at(F.col("cells"), b), F.lit(0)) + 1) / (F.col("n_current") + F.col("n_bins")).cast("double")
        return (pc - pe) * F.ln(pc / pe)

    psi = F.when(F.col("n_base") > 0, F.aggregate(F.transform("base", term), F.lit(0.0), lambda s, x: s + x)).otherwise(0.0)
    out = per.withColumn("psi", psi)
    return out.select(F.col("window.start").alias("window_start"), "feature", "n_current", "psi", ratio("n_outside", F.col("n_current") + F.col("n_outside")).alias("outside_share"),
                      F.when(F.col("psi") > threshold, "DRIFT").otherwise("OK").alias("status"))
