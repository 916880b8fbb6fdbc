"""Profiling: the numbers behind the exploratory charts and tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dbl, no_nan, pearson, ratio, sample_skewness
from .clean import value_counts
from .ordering import quantile_values, quantiles, small_side
from .quality import wide_to_rows


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Class counts, label rate in percent, imbalance ratio and how severe the imbalance is."""
    n1 = F.count_if(F.col(label) == 1)
    n0 = F.count_if(F.col(label) == 0)
    one = df.agg(F.count(label).alias("n_total"), n0.alias("n_negative"), n1.alias("n_positive"))
    imbalance = F.col("n_negative") / F.greatest(F.col("n_positive"), F.lit(1)).cast("double")
    return one.select(
        "*", ratio(F.col("n_positive") * 100, "n_total").alias("rate_pct"), imbalance.alias("imbalance_ratio"),
    ).withColumn("severity", F.when(F.col("rate_pct") < 10, "severe").when(F.col("rate_pct") < 25, "moderate").otherwise("balanced"))


def category_frequency(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count and share of rows per value, most frequent first within each column."""
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return value_counts(df, cols).select(
        "feature", "value", F.col("n").alias("n_rows"), ratio(F.col("n") * 100, n).alias("pct")
    ).orderBy("feature", F.col("n_rows").desc(), "value")


def top_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The most frequent value of each column, ties to the smallest."""
    return (value_counts(df, cols).groupBy("feature")
            .agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("m"))
            .select("feature", F.col("m.value").alias("value"), (-F.col("m.k")).alias("n_rows")))


def rate_by_category(df: DataFrame, cols: Sequence[str], label: str, high: float = 0.3, mid: float = 0.2) -> DataFrame:
    """Label rate and size per category, the overall rate and a colour band."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    overall = df.agg(F.avg(dbl(label)).alias("r")).scalar()
    per = (df.select(dbl(label).alias("y"), F.explode(cells).alias("e")).where(F.col("e.value").isNotNull())
           .groupBy("e.feature", "e.value").agg(F.count("y").alias("n_rows"), F.avg("y").alias("label_rate")))
    return per.select("feature", "value", "n_rows", "label_rate", overall.alias("overall_rate"),
                      F.when(F.col("label_rate") > high, "high").when(F.col("label_rate") > mid, "medium")
                      .otherwise("low").alias("band")).orderBy("feature", F.col("label_rate").desc(), "value")


def extreme_categories(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Highest- and lowest-rate category per column."""
    per = rate_by_category(df, cols, label)
    worst = F.min(F.struct((-F.col("label_rate")).alias("k"), F.col("value")))
    best = F.min(F.struct(F.col("label_rate").alias("k"), F.col("value")))
    return per.groupBy("feature").agg(worst.alias("w"), best.alias("b")).select(
        "feature", F.col("w.value").alias("worst"), (-F.col("w.k")).alias("worst_rate"),
        F.col("b.value").alias("best"), F.col("b.k").alias("best_rate"))


def rate_by_flags(df: DataFrame, flags: Sequence[str], label: str) -> DataFrame:
    """Label rate for 0 and 1 of several flags in one result."""
    cells = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).cast("int").alias("value")) for c in flags])
    return (df.select(dbl(label).alias("y"), F.explode(cells).alias("e")).where(F.col("e.value").isNotNull())
            .groupBy("e.flag", "e.value").agg(F.count("y").alias("n_rows"), F.avg("y").alias("label_rate")))


def univariate_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, exact median, std, bias-corrected skew and its label."""
    medians = quantile_values(df, cols, [0.5])
    aggs = [a for i, c in enumerate(cols) for a in (
        F.avg(dbl(c)).alias(f"a{i}"), F.stddev_samp(dbl(c)).alias(f"s{i}"), sample_skewness(c).alias(f"k{i}"))]
    return wide_to_rows(df.agg(*aggs), [
        {"feature": F.lit(c), "mean": F.col(f"a{i}"), "median": F.lit(medians[c][0]).cast("double"), "std": F.col(f"s{i}"),
         "skew": F.col(f"k{i}"),
         "shape": F.when(F.col(f"k{i}") > 0.5, "right-skewed").when(F.col(f"k{i}") < -0.5, "left-skewed")
         .when(F.col(f"k{i}").isNotNull(), "symmetric")} for i, c in enumerate(cols)])


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins per column, last bin closed; empty bins are absent.

    A constant column gets one unit-wide range around its value.
    """
    row = df.agg(*[a for i, c in enumerate(cols) for a in (F.min(dbl(c)).alias(f"l{i}"), F.max(dbl(c)).alias(f"h{i}"))]).first()
    cells = []
    for i, c in enumerate(cols):
        lo, hi = row[f"l{i}"], row[f"h{i}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        width = (hi - lo) / bins
        cell = F.least(F.floor((dbl(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        cells.append(F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), cell).alias("bin"),
                              F.lit(lo).alias("lo"), F.lit(width).alias("width")))
    keys = list(by)
    return (df.select(*keys, F.explode(F.array(*cells)).alias("e")).where(F.col("e.bin").isNotNull())
            .groupBy(*keys, "e.feature", "e.bin", "e.lo", "e.width").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(*keys, "feature", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"), "n_rows"))


def density_by_group(df: DataFrame, column: str, group: str, bins: int = 30) -> DataFrame:
    """Histogram of a feature per protected group, divided by the group's total."""
    h = histogram(df, [column], bins, by=[group])
    totals = h.groupBy(group).agg(F.sum("n_rows").alias("__t"))
    return h.join(small_side(totals), group).withColumn("share", ratio("n_rows", "__t")).drop("__t")


def distribution_by_class(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Quartiles and whisker ends (most extreme values within 1.5 IQR) per class and column."""
    q = (quantiles(df, cols, [0.25, 0.5, 0.75], by=[label]).groupBy(label, "feature")
         .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]))
    box = small_side(q.select(label, "feature", "q1", "median", "q3"))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), dbl(c).alias("x")) for c in cols])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return (df.select(label, F.explode(cells).alias("e")).select(label, "e.*").where(F.col("x").isNotNull())
            .join(box, [label, "feature"])
            .groupBy(label, "feature", "q1", "median", "q3")
            .agg(F.min(F.when(F.col("x") >= F.col("q1") - reach, F.col("x"))).alias("whisker_low"),
                 F.max(F.when(F.col("x") <= F.col("q3") + reach, F.col("x"))).alias("whisker_high"),
                 F.count(F.lit(1)).alias("n_rows")))


def class_shift(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Median of both classes, their difference in percent of the negative class, and its direction.

    Without a positive reference median there is no percentage and no direction.
    """
    m = quantiles(df, cols, [0.5], by=[label])
    wide = m.groupBy("feature").agg(F.max(F.when(F.col(label) == 0, F.col("value"))).alias("median_0"),
                                    F.max(F.when(F.col(label) == 1, F.col("value"))).alias("median_1"))
    pct = F.when(F.col("median_0") > 0, ratio((F.col("median_1") - F.col("median_0")) * 100, "median_0"))
    return wide.withColumn("diff_pct", pct).withColumn(
        "direction", F.when(F.col("diff_pct") < 0, "lower").when(F.col("diff_pct") >= 0, "higher"))


#: Up to so many columns, all pairs are aggregates of one plan; beyond, products of blocks of columns. The results are the same.
FEW_COLUMNS = 12
#: Columns of a block; one scan for each block.
BLOCK_COLUMNS = 512


def correlation_matrix(df: DataFrame, cols: Sequence[str], block: int = BLOCK_COLUMNS) -> DataFrame:
    """Lower triangle of Pearson correlations over complete pairs; one scan for all pairs of up to ``block`` columns. NULL where a side doesn't vary."""
    if len(cols) > FEW_COLUMNS:
        return gram_correlations(df, cols, block)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    one = df.agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return wide_to_rows(one, [{"feature_a": F.lit(a), "feature_b": F.lit(b), "r": F.col(f"r{i}")}
                              for i, (a, b) in enumerate(pairs)])


def gram_correlations(df: DataFrame, cols: Sequence[str], block: int = BLOCK_COLUMNS) -> DataFrame:
    """The same for hundreds or thousands of columns: each task multiplies its rows' matrix with itself, block by block, and the products are added up.

    A pair counts the rows in which both are there, so the products with the mask of present values give each pair its own sums. Values are shifted by a
    rough mean first, so that squares don't cancel. A task holds six products of a block with all columns; adding up streams over the tasks' rows of a column.
    """
    cols, kinds = list(cols), ["n", "s", "ss", "t", "tt", "p"]
    values = df.select(*[no_nan(c).alias(f"c{i}") for i, c in enumerate(cols)])
    rough = values.limit(1000).agg(*[F.avg(c).alias(c) for c in values.columns]).first()
    shift = np.array([rough[i] or 0.0 for i in range(len(cols))])
    schema = "a int, " + ", ".join(f"{k} array<double>" for k in kinds)

    def products(lo: int, hi: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - shift
                there = ~np.isnan(x)
                x[~there], mask = 0.0, there.astype(float)
                a, m = x[:, lo:hi], mask[:, lo:hi]
                new = [m.T @ mask, a.T @ mask, (a * a).T @ mask, m.T @ x, m.T @ (x * x), a.T @ x]
                sums = new if sums is None else [old + more for old, more in zip(sums, new)]
            if sums is not None:
                lists = [pa.array(list(part), pa.list_(pa.float64())) for part in sums]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, hi, dtype=np.int32)), *lists], ["a", *kinds])

        return run

    parts = None
    for lo in range(0, len(cols), block):
        part = values.mapInArrow(products(lo, min(lo + block, len(cols))), schema)
        parts = part if parts is None else parts.unionByName(part)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = np.stack([batch.column(i + 1).flatten().to_numpy().reshape(batch.num_rows, -1) for i in range(len(kinds))], axis=1)
            for a, row in zip(batch.column(0).to_pylist(), rows):
                sums[a] = sums[a] + row if a in sums else row
        for a, (n, s, ss, t, tt, p) in sums.items():
            with np.errstate(divide="ignore", invalid="ignore"):
                va, vb = ss - s * s / n, tt - t * t / n
                r = (p - s * t / n) / np.sqrt(va * vb)
            # What rounding leaves of a constant's variance is no spread.
            r[~((va > 1e-13 * ss) & (vb > 1e-13 * tt))] = np.nan
            yield pa.RecordBatch.from_arrays([pa.array([cols[a]] * a, pa.string()), pa.array(cols[:a], pa.string()), pa.array(r[:a], from_pandas=True)], ["feature_a", "feature_b", "r"])

    return parts.repartition("a").mapInArrow(add, "feature_a string, feature_b string, r double")


def correlate_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson r of every column with one target column."""
    one = df.agg(*[pearson(c, target).alias(f"r{i}") for i, c in enumerate(cols)])
    return wide_to_rows(one, [{"feature": F.lit(c), "r": F.col(f"r{i}")} for i, c in enumerate(cols)])


def top_correlates(df: DataFrame, cols: Sequence[str], label: str, n: int = 5) -> DataFrame:
    """The columns most correlated with the label, by absolute value."""
    r = correlate_with(df, [c for c in cols if c != label], label).where(F.col("r").isNotNull())
    return r.withColumn("direction", F.when(F.col("r") > 0, "positive").otherwise("negative")).orderBy(
        F.abs("r").desc(), "feature").limit(n)


def collinear_pairs(df: DataFrame, cols: Sequence[str], label: str | None = None, threshold: float = 0.8) -> DataFrame:
    m = correlation_matrix(df, [c for c in cols if c != label])
    return m.where(F.abs("r") > threshold).orderBy(F.abs("r").desc(), "feature_a", "feature_b")


def group_gap(df: DataFrame, group: str, label: str) -> DataFrame:
    """Largest minus smallest label rate over the groups."""
    rates = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(dbl(label)).alias("r"))
    return rates.agg(F.count(F.lit(1)).alias("n_groups"), F.min("r").alias("min_rate"), F.max("r").alias("max_rate"),
                     (F.max("r") - F.min("r")).alias("gap"))


def comparison_metrics(df: DataFrame, label: str, tenure: str, revenue: str, group: str) -> DataFrame:
    """The five comparison metrics of one table as (metric, value) rows.

    One grouped aggregate feeds everything, so the table is scanned once.
    """
    per = df.groupBy(group).agg(
        F.count_if(F.col(label) == 1).alias("n1"), F.count(label).alias("ny"), F.sum(dbl(label)).alias("y"),
        F.count(tenure).alias("nt"), F.sum(dbl(tenure)).alias("t"),
        F.count(revenue).alias("nr"), F.sum(dbl(revenue)).alias("r"))
    rate = F.when(F.col(group).isNotNull(), ratio("y", "ny"))
    one = per.agg(ratio(F.sum("n1") * 100, F.sum("ny")).alias("share"), ratio(F.sum("y") * 100, F.sum("ny")).alias("rate"),
                  ratio(F.sum("t"), F.sum("nt")).alias("tenure"), ratio(F.sum("r"), F.sum("nr")).alias("revenue"),
                  ((F.max(rate) - F.min(rate)) * 100).alias("gap"))
    return wide_to_rows(one, [
        {"metric": F.lit(m), "value": F.col(c).cast("double")} for m, c in (
            ("label_rate_pct", "rate"), ("positive_share_pct", "share"), ("avg_tenure", "tenure"), ("avg_revenue", "revenue"),
            ("group_gap_pct", "gap"))])


def compare_datasets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two (metric, value) tables side by side."""
    return a.withColumnRenamed("value", "value_a").join(b.withColumnRenamed("value", "value_b"), "metric", "full")
