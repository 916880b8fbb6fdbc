"""Distribution drift between a baseline and a current table."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dbl, is_numeric, no_nan, ratio
from .evaluate import ks_by_feature
from .ordering import quantile_values

DRIFT_THRESHOLD = 0.20


def common_numeric(base: DataFrame, cur: DataFrame) -> list[str]:
    """Columns numeric in both tables, sorted."""
    kinds = {f.name: f.dataType for f in cur.schema.fields}
    return sorted(f.name for f in base.schema.fields
                  if is_numeric(f.dataType) and f.name in kinds and is_numeric(kinds[f.name]))


def baseline_edges(base: DataFrame, cols: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct baseline quantile edges per column (at most bins + 1 numbers each)."""
    fitted = quantile_values(base, cols, [i / bins for i in range(bins + 1)])
    return {c: sorted({e for e in edges if e is not None}) for c, edges in fitted.items()}


def _bin(x: Column, edges: Sequence[float], open_ends: bool) -> Column:
    """Left-closed bins, the last one closed on both sides; -1 outside (never with open ends)."""
    last = len(edges) - 2
    tree = _tree(x, edges[1:-1], 0, len(edges) - 2)
    if open_ends:
        return tree
    return F.when((x < F.lit(edges[0])) | (x > F.lit(edges[-1])), F.lit(-1)).otherwise(F.least(tree, F.lit(last)))


def _tree(x: Column, inner: Sequence[float], lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x >= F.lit(inner[mid]), _tree(x, inner, mid + 1, hi)).otherwise(_tree(x, inner, lo, mid))


def psi(base: DataFrame, cur: DataFrame, cols: Sequence[str] | None = None, bins: int = 10, open_ends: bool = False,
        edges: dict[str, list[float]] | None = None) -> DataFrame:
    """Population stability index per feature with +1 smoothing.

    By default values outside the baseline range are left out (their share is
    reported); ``open_ends`` counts them in the outer bins. Both tables shrink to
    (feature, bin) counts before anything is shuffled.
    """
    cols = list(cols) if cols is not None else common_numeric(base, cur)
    edges = edges if edges is not None else baseline_edges(base, cols, bins)
    binned = {c: e for c, e in edges.items() if len(e) > 1}

    def counts(df: DataFrame, side: int) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.when(no_nan(c).isNotNull(), _bin(dbl(c), e, open_ends)).alias("bin"))
                          for c, e in binned.items()])
        return (df.select(F.explode(cells).alias("e")).select("e.*", F.lit(side).alias("side"))
                .where(F.col("bin").isNotNull()))

    grid = [(c, b) for c, e in edges.items() for b in range(-1, max(len(e) - 1, 1))]
    frame = base.sparkSession.createDataFrame(pa.table({
        "feature": [c for c, _ in grid], "bin": pa.array([b for _, b in grid], pa.int32())}))
    if binned:
        seen = (counts(base, 0).unionByName(counts(cur, 1)).groupBy("feature", "bin")
                .agg(F.count_if(F.col("side") == 0).alias("e"), F.count_if(F.col("side") == 1).alias("a")))
        frame = frame.join(seen, ["feature", "bin"], "left")
    else:
        frame = frame.withColumns({"e": F.lit(0), "a": F.lit(0)})
    # From here on there are at most (bins + 1) rows per feature.
    per = Window.partitionBy("feature")
    inside = F.col("bin") >= 0
    cells = frame.select(
        "feature", "bin", F.coalesce("e", F.lit(0)).alias("e"), F.coalesce("a", F.lit(0)).alias("a")).withColumns({
            "n_base": F.sum(F.when(inside, F.col("e"))).over(per), "n_current": F.sum(F.when(inside, F.col("a"))).over(per),
            "n_bins": F.count_if(inside).over(per), "n_outside": F.sum(F.when(~inside, F.col("a"))).over(per)})
    pe = (F.col("e") + 1) / (F.col("n_base") + F.col("n_bins")).cast("double")
    pc = (F.col("a") + 1) / (F.col("n_current") + F.col("n_bins")).cast("double")
    empty = (F.col("n_base") == 0) | (F.col("n_current") + F.col("n_outside") == 0)
    term = F.when(inside & ~empty, (pc - pe) * F.ln(pc / pe)).otherwise(0.0)
    return cells.groupBy("feature").agg(
        F.sum(term).alias("psi"), F.max("n_bins").alias("n_bins"),
        F.max(ratio("n_outside", F.col("n_current") + F.col("n_outside"))).alias("outside_share"))


def drift_report(base: DataFrame, cur: DataFrame, cols: Sequence[str] | None = None, threshold: float = DRIFT_THRESHOLD,
                 bins: int = 10, open_ends: bool = False) -> DataFrame:
    """PSI of every common numeric feature with its status and the number of alerts."""
    p = psi(base, cur, cols, bins, open_ends)
    alerts = F.count_if(F.col("psi") > threshold).over(Window.partitionBy(F.lit(1)))  # one row per feature here
    return p.select("feature", "psi", "outside_share", F.when(F.col("psi") > threshold, "DRIFT").otherwise("OK").alias("status"),
                    alerts.alias("n_alerts")).orderBy("feature")


def drift_compare(base: DataFrame, cur: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Means, mean shift and KS per feature, all features in one job."""
    cols = list(cols) if cols is not None else common_numeric(base, cur)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), no_nan(c).alias("value")) for c in cols])

    def long(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.explode(cells).alias("e")).select("e.*", F.lit(side).alias("sample")).where(F.col("value").isNotNull())

    both = long(base, 1).unionByName(long(cur, 2))
    means = both.groupBy("feature").agg(F.avg(F.when(F.col("sample") == 1, F.col("value"))).alias("mean_base"),
                                        F.avg(F.when(F.col("sample") == 2, F.col("value"))).alias("mean_current"))
    ks = ks_by_feature(both, "value", "sample", by=["feature"])
    return means.join(ks, "feature").select(
        "feature", "mean_base", "mean_current", (F.col("mean_current") - F.col("mean_base")).alias("mean_shift"),
        ratio((F.col("mean_current") - F.col("mean_base")) * 100, F.abs("mean_base")).alias("mean_shift_pct"), "ks", "p_value", "different")
