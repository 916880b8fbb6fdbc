"""Group fairness: rates, gaps, verdicts, proxies and mitigation weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dbl, ratio
from .ordering import small_side
from .profile import correlate_with


def fairness_metrics(df: DataFrame, y: str, yhat: str, group: str, by: Sequence[str] = ()) -> DataFrame:
    """Parity measures between group 0 (unprivileged) and group 1 (privileged), unprivileged minus privileged.

    One conditional aggregate: the groups are never shuffled apart. A rate with
    an empty denominator is NULL.
    """
    def n(g: int, *conds: Column) -> Column:
        c = F.col(group) == g
        for x in conds:
            c = c & x
        return F.count_if(c)

    pos, neg = F.col(y) == 1, F.col(y) == 0
    hit, miss = F.col(yhat) == 1, F.col(yhat) == 0
    parts = {}
    for g, s in ((0, "u"), (1, "p")):
        parts |= {f"n_{s}": n(g), f"hit_{s}": n(g, hit), f"tp_{s}": n(g, pos, hit), f"fp_{s}": n(g, neg, hit),
                  f"fn_{s}": n(g, pos, miss), f"tn_{s}": n(g, neg, miss)}
    one = df.groupBy(*by).agg(*[c.alias(k) for k, c in parts.items()])

    def rates(s: str) -> dict[str, Column]:
        c = {k: F.col(f"{k}_{s}") for k in ("n", "hit", "tp", "fp", "fn", "tn")}
        return {"sel": ratio(c["hit"], c["n"]), "tpr": ratio(c["tp"], c["tp"] + c["fn"]), "fpr": ratio(c["fp"], c["fp"] + c["tn"]),
                "ppv": ratio(c["tp"], c["tp"] + c["fp"]), "for": ratio(c["fn"], c["fn"] + c["tn"])}

    u, p = rates("u"), rates("p")
    return one.select(
        *by, F.col("n_u").alias("n_unprivileged"), F.col("n_p").alias("n_privileged"),
        u["sel"].alias("rate_unprivileged"), p["sel"].alias("rate_privileged"),
        (u["sel"] - p["sel"]).alias("demographic_parity_diff"), ratio(u["sel"], p["sel"]).alias("disparate_impact"),
        (((u["fpr"] - p["fpr"]) + (u["tpr"] - p["tpr"])) * 0.5).alias("equalized_odds_diff"),
        (((u["ppv"] - p["ppv"]) + (u["for"] - p["for"])) * 0.5).alias("predictive_parity_diff"))


def fairness_by_attribute(df: DataFrame, y: str, yhat: str, groups: dict[str, Column]) -> DataFrame:
    """``fairness_metrics`` for several protected attributes in one job (name -> 0/1 group expression)."""
    cells = F.array(*[F.struct(F.lit(a).alias("attribute"), g.alias("__g")) for a, g in groups.items()])
    long = df.select(y, yhat, F.explode(cells).alias("e")).select(y, yhat, "e.*")
    return fairness_metrics(long, y, yhat, "__g", by=["attribute"])


def fairness_verdict(metrics: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Whether all three differences stay within the threshold, and the parity-only verdict."""
    def within(c: str) -> Column:
        return F.coalesce(F.abs(F.col(c)) <= threshold, F.lit(False))

    return metrics.withColumns({
        "demographic_parity_ok": within("demographic_parity_diff"),
        "equalized_odds_ok": within("equalized_odds_diff"),
        "predictive_parity_ok": within("predictive_parity_diff"),
        "is_fair": within("demographic_parity_diff") & within("equalized_odds_diff") & within("predictive_parity_diff"),
        "parity_only_ok": F.coalesce(F.abs(F.col("demographic_parity_diff")) < threshold, F.lit(False)),
    })


def proxy_features(df: DataFrame, cols: Sequence[str], group: str, threshold: float = 0.3) -> DataFrame:
    """Features whose correlation with the encoded group exceeds the threshold."""
    return correlate_with(df, cols, group).where(F.abs("r") > threshold)


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """n / (classes * n_c) per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    everything = Window.partitionBy(F.lit(1))  # one row per class by now
    return counts.withColumn("weight", ratio(F.sum("n_rows").over(everything), F.col("n_rows") * F.count(F.lit(1)).over(everything)))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Every row with the balanced weight of its class."""
    return df.join(small_side(class_weight_table(df, label).select(label, F.col("weight").alias(name))), label, "left").select(
        *df.columns, name)


def reweighing_table(df: DataFrame, group: str, label: str) -> DataFrame:
    """P(g) P(y) / P(g, y) for each observed combination."""
    cells = df.where(F.col(group).isNotNull() & F.col(label).isNotNull()).groupBy(group, label).agg(F.count(F.lit(1)).alias("n_gy"))
    # One row per combination by now, so the marginals are windows over a handful of rows.
    n, n_g, n_y = (F.sum("n_gy").over(Window.partitionBy(c)) for c in (F.lit(1), group, label))
    return cells.select(group, label, "n_gy", ratio(dbl(n_g) * dbl(n_y), n * F.col("n_gy")).alias("weight"))


def reweighing(df: DataFrame, group: str, label: str, name: str = "weight") -> DataFrame:
    """Every row with the weight that makes group and label independent."""
    table = reweighing_table(df, group, label).select(group, label, F.col("weight").alias(name))
    return df.join(small_side(table), [group, label], "left").select(*df.columns, name)
