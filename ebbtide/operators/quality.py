"""Schema checks and data-quality findings. Every finding table comes from one scan."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dbl, is_numeric, ratio


def wide_to_rows(one_row: DataFrame, entries: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one output row per entry (column name -> expression)."""
    cells = F.array(*[F.struct(*[v.alias(k) for k, v in e.items()]) for e in entries])
    return one_row.select(F.explode(cells).alias("e")).select("e.*")


def check_columns(columns: Sequence[str], expected: Sequence[str]) -> dict[str, list[str]]:
    """Columns the registry expects but the table lacks, and the reverse."""
    have, want = set(columns), set(expected)
    return {"missing": sorted(want - have), "extra": sorted(have - want)}


def check_types(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Violations per column for the kinds ``numeric``, ``binary_int`` and ``date_parseable``.

    All rules are counted in one pass over all rows; NULL never violates.
    """
    tests = {
        "numeric": lambda c: F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(),
        "binary_int": lambda c: F.col(c).isNotNull() & ~F.coalesce(F.col(c).try_cast("double").isin(0.0, 1.0), F.lit(False)),
        "date_parseable": lambda c: F.col(c).isNotNull() & F.try_to_timestamp(F.col(c).cast("string")).isNull(),
    }
    items = [(c, k) for c, k in rules.items() if c in df.columns]
    one = df.agg(*[F.count_if(tests[k](c)).alias(f"v{i}") for i, (c, k) in enumerate(items)])
    return wide_to_rows(one, [
        {"column_name": F.lit(c), "check_kind": F.lit(k), "violations": F.col(f"v{i}"),
         "passed": (F.col(f"v{i}") == 0)} for i, (c, k) in enumerate(items)])


def key_profile(df: DataFrame, key: str, approx: bool = False) -> DataFrame:
    """Rows, distinct keys, NULL keys and surplus rows per key."""
    if key not in df.columns:
        raise ValueError(f"join key {key!r} is missing")
    distinct = F.approx_count_distinct(key) if approx else F.count_distinct(key)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_distinct"),
        F.count_if(F.col(key).isNull()).alias("n_null"),
        (F.count(key) - distinct).alias("n_duplicate"))


def null_summary(df: DataFrame) -> DataFrame:
    """Cells, NULL cells and their share, plus how many columns have each type."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns[1:]), F.count_if(F.col(df.columns[0]).isNull()))
    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("null_cells"))
    return one.select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"), "null_cells",
        (F.try_divide(F.col("null_cells").cast("double"), F.col("n_rows") * len(df.columns)) * 100).alias("null_pct"),
        F.lit(sum(is_numeric(f.dataType) for f in df.schema.fields)).cast("long").alias("numeric_columns"),
        F.lit(kinds.count("string")).cast("long").alias("string_columns"))


def type_histogram(df: DataFrame) -> DataFrame:
    """(dtype, n_columns) for every type that a column has, from the schema alone."""
    kinds = Counter(f.dataType.simpleString() for f in df.schema.fields)
    return df.sparkSession.createDataFrame(sorted(kinds.items()), "dtype string, n_columns long")


def missing_report(df: DataFrame, alert_pct: float = 5.0) -> DataFrame:
    """Missing count and share per column, highest first, with an alert flag."""
    one = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    pct = [ratio(F.col(f"m{i}") * 100, "n") for i in range(len(df.columns))]
    return wide_to_rows(one, [
        {"column_name": F.lit(f.name), "missing_count": F.col(f"m{i}"), "missing_pct": pct[i],
         "dtype": F.lit(f.dataType.simpleString()), "alert": F.coalesce(pct[i] > alert_pct, F.lit(False))}
        for i, f in enumerate(df.schema.fields)]).orderBy(F.col("missing_pct").desc(), "column_name")


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """Share of NULLs per column on the driver: one number per column, for schema decisions."""
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"] / row["n"] if row["n"] else 0.0) for i, c in enumerate(cols)}


# The bounds a scoring row must meet (field, lowest, highest).
SCORING_BOUNDS = [
    ("tenure_months", 0, None),
    ("mrr", 0, None),
    ("seats_purchased", 1, None),
    ("feature_adoption_rate", 0, 1),
    ("days_since_last_activity", 0, None),
    ("support_tickets_count", 0, None),
    ("avg_resolution_days", 0, None),
    ("near_renewal", 0, 1),
    ("has_discount", 0, 1),
]
SCORING_STRINGS = ["plan_type", "customer_segment", "age_group", "region"]


def bound_rules(bounds: Sequence[tuple] = SCORING_BOUNDS, required: Sequence[str] = SCORING_STRINGS) -> dict[str, Column]:
    """Named predicates that hold for a valid row; a NULL field is invalid."""
    rules: dict[str, Column] = {}
    for field, lo, hi in bounds:
        if lo is not None:
            rules[f"{field}_ge_{lo}"] = F.col(field) >= lo
        if hi is not None:
            rules[f"{field}_le_{hi}"] = F.col(field) <= hi
    for field in required:
        rules[f"{field}_present"] = F.col(field).isNotNull()
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}


def validate_rows(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid rows, quarantined rows with the broken rules, violations per rule)."""
    rules = {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))
    every = None
    for ok in rules.values():
        every = ok if every is None else every & ok
    valid = df.where(every)
    quarantine = df.where(~every).withColumn("violations", broken)
    one = df.agg(*[F.count_if(~ok).alias(f"v{i}") for i, ok in enumerate(rules.values())])
    counts = wide_to_rows(one, [{"rule": F.lit(name), "violations": F.col(f"v{i}")} for i, name in enumerate(rules)])
    return valid, quarantine, counts


def require_columns(columns: Sequence[str], required: Sequence[str]) -> None:
    """Reject a scoring table that lacks a required column."""
    gone = [c for c in required if c not in columns]
    if gone:
        raise ValueError(f"missing required feature columns: {gone}")


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Row count and an order-insensitive content hash, stable across runs and partitionings.

    Each cell is written with its length (NULL: ``-``), so no two rows share a text; the four words of all rows' md5
    are summed, in parts that no row count overflows.
    """
    n_rows, *sums = row_hash_sums([F.col(c) for c in (cols or df.columns)])
    return df.agg(n_rows, *sums).select("n_rows", hash_text().alias("fingerprint"))


def row_hash_sums(cells: Sequence[Column]) -> list[Column]:
    """Aggregates that ``hash_text`` turns into a table's content hash.

    The digest's 16-bit parts are summed, as longs: sums of decimals cost more than the digest itself, and whole words would overflow at 2^31 rows.
    """
    texts = [c.cast("string") for c in cells]
    digest = F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))
    halves = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long") for i in range(2)]
    parts = [F.shiftrightunsigned(halves[i // 4], 48 - 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF).cast("long")) for i in range(8)]
    return [F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(p), F.lit(0)).alias(f"__w{i}") for i, p in enumerate(parts)]]


def hash_text() -> Column:
    part = [F.col(f"__w{i}").cast("decimal(20,0)") for i in range(8)]
    return F.concat_ws("-", *[(part[2 * i] * F.lit(65536).cast("decimal(5,0)") + part[2 * i + 1]).cast("decimal(38,0)").cast("string") for i in range(4)])


def table_summary(df: DataFrame, label: str, capped: Sequence[str] = ()) -> DataFrame:
    """Shape, label rate, column-type counts and number of capped columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(dbl(label)).alias("label_rate")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"), "label_rate",
        F.lit(sum(is_numeric(f.dataType) for f in df.schema.fields)).cast("long").alias("numeric_columns"),
        F.lit(sum(f.dataType.simpleString() == "string" for f in df.schema.fields)).cast("long").alias("string_columns"),
        F.lit(len(capped)).cast("long").alias("capped_columns"))


def outlier_columns(report: DataFrame) -> DataFrame:
    """Of an outlier report: columns looked at, columns in which something was capped, and values capped in all."""
    outside = F.col("n_below") + F.col("n_above")
    return report.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if(outside > 0).alias("outliers_capped"), F.coalesce(F.sum(outside), F.lit(0)).alias("values_capped"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min and max per column from one aggregate."""
    aggs = []
    for i, c in enumerate(cols):
        x = dbl(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
    return wide_to_rows(df.agg(*aggs), [
        {"column_name": F.lit(c), "n": F.col(f"n{i}"), "mean": F.col(f"a{i}"), "std": F.col(f"s{i}"),
         "min": F.col(f"l{i}"), "max": F.col(f"h{i}")} for i, c in enumerate(cols)])


def inspect_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows, label rate, NULL cells and rows that repeat an earlier row in full.

    Identical rows are pre-aggregated on all columns first, so copies never
    travel more than once per task.
    """
    nulls = sum((F.col(c).isNull().cast("long") for c in df.columns[1:]), F.col(df.columns[0]).isNull().cast("long"))
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return distinct.agg(
        F.sum("__n").alias("n_rows"),
        ratio(F.sum(dbl(label) * F.col("__n")), F.sum(F.when(F.col(label).isNotNull(), F.col("__n")))).alias("label_rate"),
        F.sum(nulls * F.col("__n")).alias("null_cells"),
        (F.sum("__n") - F.count(F.lit(1))).alias("duplicate_rows"))


def forbidden_columns(columns: Sequence[str], forbidden: Sequence[str]) -> list[str]:
    """Feature columns that are, or were encoded from, a forbidden column."""
    return [c for c in columns if any(c == f or c.startswith((f + "_", f + "__")) for f in forbidden)]


def split_overlap(df: DataFrame, key: str, split: str = "split",
                  names: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """Keys shared by each pair of splits; zero everywhere for a sound split."""
    flags = df.groupBy(key).agg(*[F.max((F.col(split) == n).cast("int")).alias(f"in_{n}") for n in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    one = flags.agg(*[F.count_if((F.col(f"in_{a}") == 1) & (F.col(f"in_{b}") == 1)).alias(f"p{i}")
                      for i, (a, b) in enumerate(pairs)])
    return wide_to_rows(one, [{"split_a": F.lit(a), "split_b": F.lit(b), "shared_keys": F.col(f"p{i}")}
                              for i, (a, b) in enumerate(pairs)])


def split_rates(df: DataFrame, label: str, split: str = "split", target: float | None = None,
                tolerance: float = 0.025) -> DataFrame:
    """Label rate per split against the target (default: the rate over all rows)."""
    per = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(dbl(label)).alias("__p"))
    goal = (F.lit(float(target)) if target is not None
            else per.agg(ratio(F.sum("__p"), F.sum("n_rows")).alias("t")).scalar())
    rate = ratio("__p", "n_rows")
    return per.select(split, "n_rows", rate.alias("label_rate"), (F.abs(rate - goal) < tolerance).alias("within_tolerance"))


def protected_completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values per protected attribute; these are flagged, never imputed."""
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    return wide_to_rows(one, [{"attribute": F.lit(c), "n_rows": F.col("n_rows"), "missing_count": F.col(f"m{i}"),
                               "complete": F.col(f"m{i}") == 0} for i, c in enumerate(cols)])
