"""Evaluation of a scored table as plain aggregations.

Curves and rank statistics first reduce the table to one row per distinct
score and then use bucketed running sums, so no step orders all rows in one task.
``by`` evaluates many models or features in the same job.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dbl, no_nan, numeric_columns, ratio, ratio_or_zero
from .ordering import range_borders, rank_cut, running_sums
from .quality import wide_to_rows


def _hits(y: str, yhat: str) -> dict[str, Column]:
    pos, pred = F.col(y) == 1, F.col(yhat) == 1
    neg, rest = F.col(y) == 0, F.col(yhat) == 0
    return {"tn": F.count_if(neg & rest), "fp": F.count_if(neg & pred),
            "fn": F.count_if(pos & rest), "tp": F.count_if(pos & pred)}


def confusion(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _hits(y, yhat).items()])


def _scores(df: DataFrame, y: str, score: str, by: Sequence[str]) -> tuple[DataFrame, list[float]]:
    """(one row per (by, score) with positive and negative counts, range borders)."""
    src = df.select(*by, F.col(y).alias("__y"), no_nan(score).alias("score")).where(
        F.col("score").isNotNull() & F.col("__y").isNotNull())
    borders = range_borders(src, ["score"])["score"]
    grouped = src.groupBy(*by, "score").agg(F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") != 1).alias("neg"))
    return grouped, borders


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Mann-Whitney AUC with ties counted half; NULL when a class is absent."""
    grouped, borders = _scores(df, y, score, by)
    # Totals of both classes keep the bucket branch on the very same aggregate, so its shuffle is reused.
    ranked = running_sums(grouped, "score", {"neg": "neg_upto"}, borders, by, totals={"pos": "n_pos", "neg": "n_neg"})
    wins = F.sum(dbl("pos") * (dbl("neg_upto") - dbl("neg") * 0.5))
    sizes = F.coalesce(F.max("n_pos"), F.lit(0)), F.coalesce(F.max("n_neg"), F.lit(0))
    return ranked.groupBy(*by).agg(
        sizes[0].alias("n_pos"), sizes[1].alias("n_neg"),
        F.try_divide(wins, sizes[0].cast("double") * sizes[1].cast("double")).alias("roc_auc"))


def _cumulative(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    grouped, borders = _scores(df, y, score, by)
    return running_sums(grouped, "score", {"pos": "tp", "neg": "fp"}, borders, by, descending=True, totals={"pos": "n_pos", "neg": "n_neg"})


def roc_points(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the (0, 0) start with a NULL threshold."""
    cum = _cumulative(df, y, score, by)
    pts = cum.select(*by, F.col("score").alias("threshold"), ratio("fp", "n_neg").alias("fpr"), ratio("tp", "n_pos").alias("tpr"))
    start = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    zero = F.lit(0.0)
    return pts.unionByName(start.select(*by, F.lit(None).cast("double").alias("threshold"), zero.alias("fpr"), zero.alias("tpr")))


def pr_points(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the (recall 0, precision 1) end point."""
    cum = _cumulative(df, y, score, by)
    pts = cum.select(*by, F.col("score").alias("threshold"), ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
                     ratio("tp", "n_pos").alias("recall"))
    end = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    return pts.unionByName(end.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                                      F.lit(0.0).alias("recall")))


def pr_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid under the precision-recall curve, and the prevalence baseline.

    The preceding point of each row follows from its own counts (running sum
    minus own count), so no lag over the whole curve is needed.
    """
    cum = _cumulative(df, y, score, by)
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    here = ratio("tp", F.col("tp") + F.col("fp"))
    before = F.coalesce(ratio(before_tp, before_tp + before_fp), F.lit(1.0))
    area = ratio("pos", "n_pos") * (here + before) / 2
    return cum.groupBy(*by).agg(F.sum(area).alias("pr_auc"), ratio(F.max("n_pos"), F.max(F.col("n_pos") + F.col("n_neg"))).alias("prevalence"))


def calibration(df: DataFrame, y: str, p: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean score and fraction of positives in uniform bins (inner edges right-closed); empty bins absent."""
    b = F.least(F.greatest(F.ceil(dbl(p) * bins) - 1, F.lit(0)), F.lit(bins - 1)).alias("bin")
    return df.where(F.col(p).isNotNull()).groupBy(*by, b).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(dbl(p)).alias("mean_score"), F.avg(dbl(y)).alias("fraction_positive"))


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {"accuracy": ratio(tp + tn, tp + tn + fp + fn), "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn), "f1": ratio_or_zero(tp * 2, tp * 2 + fp + fn)}


def core_metrics(df: DataFrame, y: str, yhat: str, p: str | None = None, by: Sequence[str] = (), curve: bool = False) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 (0 when undefined), Brier score and ROC-AUC; with ``curve`` the PR-AUC as well."""
    aggs = [c.alias(n) for n, c in _hits(y, yhat).items()]
    if p:
        aggs.append(F.avg((dbl(p) - dbl(y)) * (dbl(p) - dbl(y))).alias("brier"))
    base = df.groupBy(*by).agg(*aggs)
    out = base.select("*", *[c.alias(n) for n, c in _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).items()])
    if not p:
        return out
    areas = [(roc_auc(df, y, p, by), "roc_auc"), *([(pr_auc(df, y, p, by), "pr_auc")] if curve else [])]
    for area, name in areas:
        out = out.join(area.select(*by, name), list(by), "left") if by else out.withColumn(name, area.select(name).scalar())
    return out


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Per-class precision, recall, F1 and support, accuracy, macro and weighted averages."""
    one = confusion(df, y, yhat)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    pos, neg = _rates(tp, fp, fn, tn), _rates(tn, fn, fp, tp)
    n1, n0 = tp + fn, tn + fp
    names = ["precision", "recall", "f1"]
    null = F.lit(None).cast("double")
    rows = [
        {"class": F.lit("0"), **{m: neg[m] for m in names}, "support": n0},
        {"class": F.lit("1"), **{m: pos[m] for m in names}, "support": n1},
        {"class": F.lit("accuracy"), "precision": null, "recall": null, "f1": pos["accuracy"], "support": n0 + n1},
        {"class": F.lit("macro avg"), **{m: (neg[m] + pos[m]) / 2 for m in names}, "support": n0 + n1},
        {"class": F.lit("weighted avg"), **{m: ratio(neg[m] * n0 + pos[m] * n1, n0 + n1) for m in names}, "support": n0 + n1},
    ]
    return wide_to_rows(one, rows)


def compare_models(df: DataFrame, model: str, y: str, yhat: str, p: str, sort: str = "recall") -> DataFrame:
    """One row of core metrics per model, best first."""
    return core_metrics(df, y, yhat, p, by=[model]).orderBy(F.col(sort).desc(), model)


def leakage_auc(df: DataFrame, cols: Sequence[str] | None, label: str, threshold: float = 0.95, min_rows: int = 50) -> DataFrame:
    """Direction-free single-feature AUC; columns above the threshold leak the label.

    A feature with too few rows or one class only gets no verdict row.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, [label])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), dbl(c).alias("value")) for c in cols])
    long = df.select(F.col(label).alias("__label"), F.explode(cells).alias("e")).select("__label", "e.*")
    auc = roc_auc(long, "__label", "value", by=["feature"])
    best = F.greatest(F.col("roc_auc"), 1 - F.col("roc_auc"))
    return auc.where((F.col("n_pos") + F.col("n_neg") >= min_rows) & F.col("roc_auc").isNotNull()).select(
        "feature", (F.col("n_pos") + F.col("n_neg")).alias("n_rows"), best.alias("auc"), (best > threshold).alias("leaks"))


def balancing_delta(metrics: DataFrame, model: str = "model", variant: str = "variant", balanced: str = "balanced") -> DataFrame:
    """Recall and F1 gained by balancing, per base model."""
    on = F.col(variant) == balanced

    def gain(m: str) -> Column:
        return F.max(F.when(on, F.col(m))) - F.max(F.when(~on, F.col(m)))

    return metrics.groupBy(model).agg(gain("recall").alias("delta_recall"), gain("f1").alias("delta_f1"))


def business_capture(metrics: DataFrame) -> DataFrame:
    """Detected and missed churners and false alarms implied by recall and precision."""
    n1 = F.col("tp") + F.col("fn")
    detected = F.bround(F.col("recall") * n1).cast("long")
    alarms = F.when(F.col("precision") > 0, F.bround(F.try_divide(detected.cast("double"), F.col("precision"))).cast("long") - detected)
    return metrics.withColumns({"n_positive": n1, "detected": detected, "false_alarms": alarms, "undetected": n1 - detected})


def top_decile_capture(df: DataFrame, key: str, y: str, p: str, share: float = 0.1, target: float = 0.7) -> DataFrame:
    """Share of the positives among the highest-scored ``share`` of rows, ties by key.

    Only the one rank where the top ends is looked up; of repeated rows (equal score and key) that it divides, the negative ones come first.
    """
    rows = df.select(F.col(key).alias("__k"), F.col(y).alias("__y"), (-dbl(p)).alias("__p"))
    positive = F.col("__y") == 1
    n = rows.agg(F.count(no_nan("__p")).alias("n")).first()["n"]
    top = math.ceil(n * share)
    if top:
        cut = rank_cut(rows, "__p", "__k", top)
        inside, last = cut.within(F.col("__p"), F.col("__k")), cut.at(F.col("__p"), F.col("__k"))
        negative = F.count_if(last & ~F.coalesce(positive, F.lit(False)))
        captured = F.count_if(inside & ~last & positive) + F.greatest(F.lit(0).cast("long"), F.count_if(last) - F.lit(cut.short) - negative)
    else:
        captured = F.lit(0).cast("long")
    return rows.agg(F.lit(top).cast("long").alias("n_top"), captured.alias("captured"), F.count_if(positive).alias("n_positive")).select(
        "*", ratio("captured", "n_positive").alias("capture_rate"),
        (ratio("captured", "n_positive") >= target).alias("meets_target"))


def accuracy_cost(metrics: DataFrame, baseline: str, model: str = "model") -> DataFrame:
    """Accuracy lost against the baseline model."""
    base = metrics.where(F.col(model) == baseline).agg(F.max("accuracy").alias("a")).scalar()
    return metrics.where(F.col(model) != baseline).select(model, "accuracy", (base - F.col("accuracy")).alias("accuracy_cost"))


# Release gates and documented targets (metric, direction, limit).
RELEASE_GATES = [("roc_auc", ">=", 0.80), ("recall", ">=", 0.65), ("f1", ">=", 0.60)]
TARGET_GATES = [("recall", ">=", 0.75), ("pr_auc", ">=", 0.60), ("brier", "<=", 0.15)]
DOCUMENTED_GATES = [("recall", ">=", 0.75), ("roc_auc", ">=", 0.80), ("f1", ">=", 0.65), ("pr_auc", ">=", 0.60), ("brier", "<=", 0.15)]


def quality_gates(metrics: DataFrame, gates: Sequence[tuple[str, str, float]] = RELEASE_GATES, keep: Sequence[str] = ()) -> DataFrame:
    """Pass or fail per gate (and per kept column, such as the model). A metric that isn't there has no value and doesn't pass."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(d).alias("direction"), F.lit(t).alias("gate"),
                               (dbl(m) if m in metrics.columns else F.lit(None).cast("double")).alias("value")) for m, d, t in gates])
    ok = F.when(F.col("direction") == ">=", F.col("value") >= F.col("gate")).otherwise(F.col("value") <= F.col("gate"))
    return metrics.select(*keep, F.explode(cells).alias("e")).select(*keep, "e.*").withColumn("passed", F.coalesce(ok, F.lit(False)))


def ks_by_feature(long: DataFrame, value: str, sample: str, by: Sequence[str] = ()) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and asymptotic p-value; ``sample`` is 1 or 2."""
    src = long.select(*by, no_nan(value).alias("x"), F.col(sample).alias("__s")).where(F.col("x").isNotNull())
    borders = range_borders(src, ["x"])["x"]
    counts = src.groupBy(*by, "x").agg(F.count_if(F.col("__s") == 1).alias("c1"), F.count_if(F.col("__s") == 2).alias("c2"))
    cum = running_sums(counts, "x", {"c1": "f1", "c2": "f2"}, borders, by, totals={"c1": "n1", "c2": "n2"})
    d = F.max(F.abs(ratio("f1", "n1") - ratio("f2", "n2")))
    out = cum.groupBy(*by).agg(d.alias("ks"), F.max("n1").alias("n1"), F.max("n2").alias("n2"))
    return out.withColumn("p_value", kolmogorov_p(F.col("ks"), F.col("n1"), F.col("n2"))).withColumn(
        "different", F.col("p_value") < 0.05)


def kolmogorov_p(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Two-sided asymptotic p-value from the alternating Kolmogorov series."""
    lam2 = d * d * (n1.cast("double") * n2.cast("double") / (n1 + n2).cast("double"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda acc, k: acc + F.when(
        k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * lam2))
    return F.when(lam2 < 0.04, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks_two_sample(df: DataFrame, column: str, group: str, g1=None, g2=None) -> DataFrame:
    """KS between two named groups; by default the two smallest group values."""
    if g1 is None or g2 is None:
        two = [r[0] for r in df.select(group).where(F.col(group).isNotNull()).distinct().orderBy(group).limit(2).collect()]
        if len(two) < 2:
            raise ValueError("need two groups")
        g1, g2 = two
    sample = F.when(F.col(group) == F.lit(g1), 1).when(F.col(group) == F.lit(g2), 2)
    return ks_by_feature(df.withColumn("__g", sample).where(F.col("__g").isNotNull()), column, "__g").select(
        F.lit(str(g1)).alias("group_1"), F.lit(str(g2)).alias("group_2"), "*")


def scoring_stats(df: DataFrame, p: str = "probability", tier: str = "risk_tier", by: Sequence[str] = ()) -> DataFrame:
    """Number of scored rows, mean score to four places, rows in the HIGH tier."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("prediction_count"),
                               F.round(F.coalesce(F.avg(dbl(p)), F.lit(0.0)), 4).alias("avg_probability"),
                               F.count_if(F.col(tier) == "HIGH").alias("high_risk_count"))


def tier_counts(df: DataFrame, tier: str = "risk_tier", order: Sequence[str] = ("Critical", "High", "Medium", "Low")) -> DataFrame:
    """Rows per tier in the given order, zeros included."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(tier) == t).alias(f"t{i}") for i, t in enumerate(order)])
    return wide_to_rows(one, [{"position": F.lit(i), "tier": F.lit(t), "n_rows": F.col(f"t{i}"),
                               "pct": ratio(F.col(f"t{i}") * 100, "n")} for i, t in enumerate(order)])


def scored_summary(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col(prediction) == 1).alias("n_predicted")).select(
        "*", ratio(F.col("n_predicted") * 100, "n_scored").alias("pct_predicted"))


def rank_importance(importances: DataFrame, n: int = 20, proxies: Sequence[str] = ()) -> DataFrame:
    """Most important features first, flagged when they are proxies of a protected attribute."""
    return importances.withColumn("is_proxy", F.col("feature").isin(*proxies) if proxies else F.lit(False)).orderBy(
        F.col("importance").desc(), "feature").limit(n)


def risk_report(df: DataFrame, key: str, p: str, keep: Sequence[str] = ()) -> DataFrame:
    """All scored rows, riskiest first (range-partitioned sort)."""
    return df.select(key, p, *keep).orderBy(F.col(p).desc(), key)


def top_n(df: DataFrame, order: str, n: int, key: str, descending: bool = True) -> DataFrame:
    return df.orderBy(F.col(order).desc() if descending else F.col(order).asc(), key).limit(n)


def highest_risk(df: DataFrame, key: str, p: str) -> DataFrame:
    """The single riskiest row, ties to the smallest key: a max over structs, not a sort."""
    rest = [c for c in df.columns if c not in (p, key)]
    return df.agg(F.min(F.struct((-dbl(p)).alias("k"), F.col(key), F.struct(p, *rest).alias("r"))).alias("m")).select(
        F.col(f"m.{key}").alias(key), *[F.col(f"m.r.{c}").alias(c) for c in [p, *rest]])


def top_signals(df: DataFrame, key: str, contributions: Mapping[str, Column] | Sequence[str], k: int = 3,
                strong: float = 0.5) -> DataFrame:
    """The k largest contributions of each row with direction and strength, as rows.

    Ties keep the order in which the contributions are listed. All per row: no shuffle.
    """
    items = contributions if isinstance(contributions, Mapping) else {c: F.col(c) for c in contributions}
    cells = F.array(*[F.struct((-F.abs(dbl(v))).alias("k"), F.lit(i).alias("i"), F.lit(n).alias("feature"), dbl(v).alias("value"))
                      for i, (n, v) in enumerate(items.items())])
    best = F.slice(F.array_sort(cells), 1, k)
    return df.select(key, F.posexplode(best).alias("pos", "e")).select(
        key, (F.col("pos") + 1).alias("position"), F.col("e.feature").alias("feature"), F.col("e.value").alias("value"),
        F.when(F.col("e.value") > 0, "INCREASES_CHURN").otherwise("DECREASES_CHURN").alias("impact"),
        F.when(F.abs("e.value") > strong, "HIGH").otherwise("MEDIUM").alias("strength"))
