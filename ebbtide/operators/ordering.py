"""Global order without a single-task window.

Prefix sums, ranks and exact quantiles need a total order over all rows. A
window without ``partitionBy`` would move the table into one task. Everything
here works in two levels instead: rows get a range bucket, bucket totals are a
small table whose running sum gives each bucket's offset, and the fine order is
only resolved inside a bucket.

Bucket borders come from a quantile sketch collected to the driver (one number
per ``ROWS_PER_BUCKET`` rows and column). They steer balance only; every result
is exact whatever the borders are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dbl, no_nan
from ..session import staged

ROWS_PER_BUCKET = 2_000_000
MIN_BUCKETS = 8
FIRST_SKETCH = 128
APPROX_ACCURACY = 10_000
#: Size of a quantile sketch (about 0.1 MB a column), and how far around a wanted rank its interval reaches, as a share of the
#: rows: about twice the sketch's error at 99 % confidence. Both steer the work only.
SKETCH_SIZE = 4096
MARGIN = 0.0015


def range_borders(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> dict[str, list[float]]:
    """Approximate equal-count borders per column; one pass, bounded result.

    The number of buckets grows with the row count, so a bucket stays near
    ``ROWS_PER_BUCKET`` rows at every size.
    """
    parts = buckets or FIRST_SKETCH
    probs = [i / parts for i in range(1, parts)]
    accuracy = max(2_000, 10 * parts)
    aggs = [F.percentile_approx(dbl(c), probs, accuracy).alias(c) for c in cols]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *aggs).first()
    n = row["__n"]
    want = buckets or max(MIN_BUCKETS, n // ROWS_PER_BUCKET)
    if want > parts:
        return range_borders(df, cols, want)
    out = {}
    for c in cols:
        borders = row[c] or []
        step = max(1, parts // want)
        out[c] = sorted({float(b) for b in borders[step - 1::step] if b == b})
    return out


def bucket_index(x: Column, borders: Sequence[float]) -> Column:
    """How many borders lie strictly below ``x`` (NULL for NULL).

    Few borders become a balanced CASE tree (code generated, log depth); many
    become a two-stage lookup in constant arrays.
    """
    borders = list(borders)
    if len(borders) <= 64:
        return F.when(x.isNotNull(), _case_tree(x, borders, 0, len(borders)))
    stride = max(2, int(len(borders) ** 0.5))
    coarse = borders[stride - 1::stride]
    fine = F.array(*[F.lit(b) for b in borders])
    start = F.size(F.filter(F.array(*[F.lit(b) for b in coarse]), lambda b: b < x)) * F.lit(stride)
    inside = F.size(F.filter(F.slice(fine, start + F.lit(1), F.lit(stride)), lambda b: b < x))
    return F.when(x.isNotNull(), start + inside)


def _case_tree(x: Column, borders: list[float], lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x > F.lit(borders[mid]), _case_tree(x, borders, mid + 1, hi)).otherwise(
        _case_tree(x, borders, lo, mid))


def running_sums(grouped: DataFrame, order: str, sums: Mapping[str, str], borders: Sequence[float],
                 by: Sequence[str] = (), descending: bool = False, totals: Mapping[str, str] | None = None) -> DataFrame:
    """Inclusive running sums of ``sums`` (source column -> output column) along ``order``.

    ``grouped`` holds one row per (by, order) value. Rows in the same bucket are
    summed by a window; whole earlier buckets arrive as an offset. ``totals``
    adds group totals, taken from the bucket table as well: a join on ``by``
    alone would pile each group's rows up in one task.
    """
    totals = dict(totals or {})
    by = list(by)
    b = grouped.withColumn("__bucket", bucket_index(dbl(order), borders))
    per_bucket = b.groupBy(*by, "__bucket").agg(*[F.sum(s).alias(f"__t_{s}") for s in {**sums, **totals}])
    bucket_key = F.col("__bucket").desc() if descending else F.col("__bucket").asc()
    earlier = Window.partitionBy(*by).orderBy(bucket_key).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *by, "__bucket",
        *[F.coalesce(F.sum(f"__t_{s}").over(earlier), F.lit(0)).alias(f"__o_{s}") for s in sums],
        *[F.sum(f"__t_{s}").over(Window.partitionBy(*by)).alias(name) for s, name in totals.items()])
    row_key = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, "__bucket").orderBy(row_key).rowsBetween(Window.unboundedPreceding, 0)
    joined = b.join(offsets, by + ["__bucket"])
    return joined.withColumns(
        {out: F.col(f"__o_{s}") + F.sum(s).over(inside) for s, out in sums.items()}
    ).drop("__bucket", *[f"__o_{s}" for s in sums])


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              approx: bool = False, margin: float = MARGIN, rows: int = ROWS_PER_BUCKET) -> DataFrame:
    """Quantiles with linear interpolation: one row per (by, feature, prob).

    Exact by default, without shuffling the table. A mergeable sketch per column gives each wanted rank an interval of
    values; a second scan counts what lies below and inside every interval, as one wide aggregate; where an interval isn't a single
    value, a third keeps the few values inside, counted by value before they move. The counts say whether an interval
    holds its ranks; if a sketch missed one, all intervals are widened. Rows without a group key are left out.
    ``approx=True`` returns the sketch's answer from a single scan.
    """
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    if approx:
        return _aggregated(df, cols, by, probs, lambda c: F.percentile_approx(c, probs, APPROX_ACCURACY))
    kept = df.where(F.expr(" and ".join(f"`{c}` is not null" for c in by))) if by else df
    # Named once, so that the comparisons below don't spell the cast out at every edge.
    kept = kept.select(*by, *[no_nan(c).alias(f"__x{i}") for i, c in enumerate(cols)])
    x = [F.col(f"__x{i}") for i in range(len(cols))]
    sketched = kept.groupBy(*by).agg(*[F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)).alias(f"__s{i}") for i, v in enumerate(x)])
    sketched = small_side(sketched)
    while True:
        slots, inside = _intervals(kept, sketched, x, probs, by, margin)
        if slots.where("rank_low < below or rank_high >= upto").isEmpty():
            break
        margin *= 8
    keys = [*by, "__i", "__j"]
    fraction = F.col("rank") - F.floor("rank")
    alone = slots.where("lo = hi").select(*keys, F.col("lo").alias("value"))
    found = alone.unionByName(_resolved(slots.where("lo < hi"), inside, by, fraction, rows)) if inside is not None else alone
    names, at = F.array(*[F.lit(c) for c in cols]), F.array(*[F.lit(p) for p in probs])
    return found.select(*by, names[F.col("__i")].alias("feature"), at[F.col("__j")].alias("prob"), "value")


def _intervals(kept: DataFrame, sketched: DataFrame, x: Sequence[Column], probs: Sequence[float], by: Sequence[str], margin: float) -> tuple[DataFrame, DataFrame | None]:
    """(slots: by, __i, __j, n, rank, rank_low, rank_high, lo, hi, below, upto; inside: by, __i, value, cnt, or None if no interval needs it).

    With groups each row meets its group's intervals.
    """
    reach = {side: F.array(*[F.lit(min(1.0, max(0.0, p + s * margin))) for p in probs]) for side, s in (("l", -1), ("h", 1))}
    sizes = [F.coalesce(F.kll_sketch_get_n_double(F.col(f"__s{i}")), F.lit(0)) for i in range(len(x))]
    fitted = [F.when(n > 0, F.kll_sketch_get_quantile_double(F.col(f"__s{i}"), ranks)).alias(f"__{side}{i}") for i, n in enumerate(sizes) for side, ranks in reach.items()]
    bounds = sketched.select(*by, *[n.alias(f"__n{i}") for i, n in enumerate(sizes)], *fitted)
    if not by:
        return _constant_intervals(kept, x, probs, bounds.first().asDict())
    pairs = [(i, j) for i in range(len(x)) for j in range(len(probs))]
    rows = kept.join(small_side(bounds), list(by))
    edge = lambda side, i, j: F.col(f"__{side}{i}")[j]
    counts = [a for i, j in pairs for a in (F.count_if(x[i] < edge("l", i, j)).alias(f"__b{i}_{j}"), F.count_if(x[i] <= edge("h", i, j)).alias(f"__u{i}_{j}"))]
    counted = rows.groupBy(*by).agg(*counts, *[F.any_value(f"__{c}{i}").alias(f"__{c}{i}") for i in range(len(x)) for c in "lhn"])
    cells = F.array(*[F.struct(F.lit(i).alias("__i"), F.lit(j).alias("__j"), F.col(f"__n{i}").cast("long").alias("n"), (F.lit(probs[j]) * (F.col(f"__n{i}") - 1)).alias("rank"),
                               edge("l", i, j).alias("lo"), edge("h", i, j).alias("hi"), F.col(f"__b{i}_{j}").alias("below"), F.col(f"__u{i}_{j}").alias("upto")) for i, j in pairs])
    slots = counted.select(*by, F.explode(cells).alias("e")).select(*by, "e.*").where("n > 0")
    slots = small_side(slots.select("*", F.floor("rank").alias("rank_low"), F.ceil("rank").alias("rank_high")))
    within: dict[int, Column] = {}
    for i, j in pairs:
        hit = (x[i] >= edge("l", i, j)) & (x[i] <= edge("h", i, j)) & (edge("l", i, j) < edge("h", i, j))
        within[i] = within[i] | hit if i in within else hit
    return slots, _inside(rows, x, within, by)


def _inside(rows: DataFrame, x: Sequence[Column], within: Mapping[int, Column], by: Sequence[str] = ()) -> DataFrame:
    """(by, __i, value, cnt): the values that meet their column's condition, counted before they move."""
    held = F.array_compact(F.array(*[F.when(hit, F.struct(F.lit(i).alias("__i"), x[i].alias("value"))) for i, hit in within.items()]))
    return rows.select(*by, F.explode(held).alias("e")).select(*by, "e.*").groupBy(*by, "__i", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _place(value: Column, marks: Sequence[Column], lo: int = 0, hi: int | None = None) -> Column:
    """2 i where a value lies between mark i - 1 and mark i, 2 i + 1 where it is mark i; marks ascend."""
    hi = len(marks) if hi is None else hi
    if lo == hi:
        return F.lit(2 * lo) if lo == len(marks) else F.when(value == marks[lo], 2 * lo + 1).otherwise(2 * lo)
    mid = (lo + hi) // 2
    return F.when(value > marks[mid], _place(value, marks, mid + 1, hi)).otherwise(_place(value, marks, lo, mid))


def _constant_intervals(kept: DataFrame, x: Sequence[Column], probs: Sequence[float], told: Mapping) -> tuple[DataFrame, DataFrame | None]:
    """The same without groups: all edges are numbers here, and each column's rows are counted by where they lie among its own edges."""
    marks, cells = {}, []
    for i in range(len(x)):
        if told[f"__n{i}"]:
            marks[i] = sorted({*told[f"__l{i}"], *told[f"__h{i}"]})
            at = F.when(x[i].isNotNull(), _place(x[i], [F.lit(m) for m in marks[i]]))
            cells.append(F.struct(F.lit(i).alias("i"), at.alias("at")))
    schema = "__i int, __j int, n long, rank double, rank_low long, rank_high long, lo double, hi double, below long, upto long"
    if not cells:  # nothing but NULL
        return kept.sparkSession.createDataFrame([], schema), None
    seen = kept.select(F.explode(F.array(*cells)).alias("e")).select("e.*").where("at is not null").groupBy("i", "at").count().collect()
    counts: dict[int, dict[int, int]] = {i: {} for i in marks}
    for r in seen:
        counts[r["i"]][r["at"]] = r["count"]
    slots, within = [], {}
    for i, edges in marks.items():
        held: set[int] = set()
        for j, p in enumerate(probs):
            lo, hi, n = told[f"__l{i}"][j], told[f"__h{i}"][j], told[f"__n{i}"]
            first, last = 2 * edges.index(lo) + 1, 2 * edges.index(hi) + 1
            rank = p * (n - 1)
            slots.append((i, j, n, rank, math.floor(rank), math.ceil(rank), lo, hi, sum(c for at, c in counts[i].items() if at < first), sum(c for at, c in counts[i].items() if at <= last)))
            if lo < hi:
                held |= set(range(first, last + 1))
        if held:
            within[i] = F.coalesce(_place(x[i], [F.lit(m) for m in edges]).isin(*sorted(held)) & x[i].isNotNull(), F.lit(False))
    return kept.sparkSession.createDataFrame(slots, schema), _inside(kept, x, within) if within else None


def _resolved(slots: DataFrame, inside: DataFrame, by: Sequence[str], fraction: Column, rows: int) -> DataFrame:
    """(by, __i, __j, value) of the intervals' ranks: their values are summed up by parts of an interval, then inside the one part that holds the rank."""
    keys = [*by, "__i", "__j"]
    met = staged(inside.join(slots, [*by, "__i"]).where("value >= lo and value <= hi").select(*keys, "value", "cnt", "below", "rank", "rank_low", "rank_high"))
    parts = -(-met.count() // rows)
    if parts > 1:
        cuts = small_side(met.groupBy(*keys).agg(F.percentile_approx("value", [k / parts for k in range(1, parts)], APPROX_ACCURACY).alias("__cuts")))
        met = met.join(cuts, keys).withColumn("__part", F.size(F.filter("__cuts", lambda c: c < F.col("value")))).drop("__cuts")
        totals = met.groupBy(*keys, "__part").agg(F.sum("cnt").alias("__t"))
        earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        totals = small_side(totals.select(*keys, "__part", "__t", F.coalesce(F.sum("__t").over(earlier), F.lit(0)).alias("__o")))
        met = met.join(totals, [*keys, "__part"]).withColumn("below", F.col("below") + F.col("__o"))
        met = met.where((F.col("rank_high") >= F.col("below")) & (F.col("rank_low") < F.col("below") + F.col("__t"))).drop("__t", "__o")
    else:
        met = met.withColumn("__part", F.lit(0))
    line = Window.partitionBy(*keys, "__part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = met.withColumn("__to", F.col("below") + F.sum("cnt").over(line)).withColumn("__from", F.col("__to") - F.col("cnt"))
    at = lambda r: F.max(F.when((F.col(r) >= F.col("__from")) & (F.col(r) < F.col("__to")), F.col("value")))
    lower, upper = F.col("__lower"), F.col("__upper")
    return placed.groupBy(*keys).agg(at("rank_low").alias("__lower"), at("rank_high").alias("__upper"), F.max(fraction).alias("__f")).select(
        *keys, (lower + (upper - lower) * F.col("__f")).alias("value"))


def _aggregated(df: DataFrame, cols: Sequence[str], by: Sequence[str], probs: Sequence[float],
                agg: Callable[[Column], Column]) -> DataFrame:
    """Array-valued aggregates, one per column, turned into quantiles and long rows."""
    wide = df.groupBy(*by).agg(*[agg(no_nan(c)).alias(f"__q{i}") for i, c in enumerate(cols)])
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(p).alias("prob"), F.col(f"__q{i}")[j].alias("value"))
        for i, c in enumerate(cols) for j, p in enumerate(probs)])
    return wide.select(*by, F.explode(cells).alias("e")).select(*by, "e.*").where(F.col("value").isNotNull())


def small_side(small: DataFrame) -> DataFrame:
    """An aggregated join side, written once.

    Its files' size is known when the join is planned, so Spark broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond; nothing reaches this process.
    """
    return staged(small)


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    approx: bool = False) -> dict[str, list[float | None]]:
    """Fitted quantiles per column, in the order of ``probs``.

    ``len(cols) * len(probs)`` numbers reach the driver, so whoever applies them
    works with constants: no join, no subquery, nothing to broadcast.
    """
    cols = list(cols)
    if not cols:
        return {}
    rows = {(r["feature"], r["prob"]): r["value"] for r in quantiles(df, cols, probs, approx=approx).collect()}
    return {c: [rows.get((c, float(p))) for p in probs] for c in cols}


def value_ranks(df: DataFrame, value: str, key: str, rank: str = "rank") -> DataFrame:
    """1-based rank over (value, key) for a key of any orderable type, NULL values unranked.

    Ties keep key order, rows without a key first. One value may hold a large
    share of the rows, so ties are ranked by key buckets as well, never as one group.
    """
    if isinstance(df.schema[key].dataType, T.NumericType):
        borders = range_borders(df, [value, key])
        bucket = bucket_index(dbl(key), borders[key])
    else:
        borders = range_borders(df, [value])
        bucket = _split_index(df, key)
    rows = df.withColumn("__kb", F.coalesce(bucket, F.lit(-1)))
    ranked, rest = rows.where(F.col(value).isNotNull()), rows.where(F.col(value).isNull())
    cells = ranked.groupBy(value, "__kb").agg(F.count(F.lit(1)).alias("__n"))
    counts = cells.groupBy(value).agg(F.sum("__n").alias("__n"))
    below = running_sums(counts, value, {"__n": "__upto"}, borders[value]).select(
        F.col(value).alias("__v"), (F.col("__upto") - F.col("__n")).alias("__below"))
    earlier = Window.partitionBy(value).orderBy("__kb").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cells.withColumn("__skip", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
              .join(below, F.col(value) == F.col("__v"))
              .select(F.col("__v"), F.col("__kb").alias("__k"), (F.col("__below") + F.col("__skip")).alias("__start")))
    inside = Window.partitionBy(value, "__kb").orderBy(key)
    out = (ranked.withColumn("__rn", F.row_number().over(inside))
           .join(starts, (F.col(value) == F.col("__v")) & (F.col("__kb") == F.col("__k")))
           .withColumn(rank, (F.col("__start") + F.col("__rn")).cast("long"))
           .drop("__v", "__k", "__kb", "__start", "__rn"))
    return out.unionByName(rest.drop("__kb").withColumn(rank, F.lit(None).cast("long")))


#: Split points of one narrowing step, and how many rows an interval may hold when its values are put in order.
SPLITS = 63
SELECT_ROWS = 50_000


def value_at(df: DataFrame, column: str, rank: int, rows: int = SELECT_ROWS) -> tuple[object, int]:
    """(value, rows below it) at a 0-based rank in ascending order, for a column of any orderable type without NULL.

    The table stays where it is. A few rows drawn anew in each step split the interval that holds the rank; the rows in each part are counted by one
    scan, and one part remains. A value that many rows share is a part of its own. What reaches the driver is split points and their counts.
    """
    part, kind, below = df.select(column), df.schema[column].dataType, 0
    while True:
        # Rows, not distinct values, are drawn: no row moves but the drawn ones.
        drawn = part.orderBy(F.xxhash64(F.col(column), F.monotonically_increasing_id())).limit(SPLITS)
        splits = sorted({r[0] for r in drawn.collect()})
        if not splits:
            raise ValueError(f"there is no rank {rank}")
        marks = [F.lit(x).cast(kind) for x in splits]

        counts = {r["at"]: r["count"] for r in part.groupBy(_place(F.col(column), marks).alias("at")).count().collect()}
        for at in sorted(counts):
            if below + counts[at] > rank:
                break
            below += counts[at]
        else:
            raise ValueError(f"there is no rank {rank}")
        if at % 2:
            return splits[at // 2], below
        if at // 2 > 0:
            part = part.where(F.col(column) > marks[at // 2 - 1])
        if at // 2 < len(marks):
            part = part.where(F.col(column) < marks[at // 2])
        if counts[at] <= rows:
            line = Window.partitionBy(F.lit(1)).orderBy(column)  # at most ``rows`` rows
            each = part.groupBy(column).agg(F.count(F.lit(1)).alias("__n")).select(column, "__n", F.sum("__n").over(line).alias("__to"))
            found = each.where(F.col("__to") > rank - below).orderBy(column).first()
            return found[0], below + found["__to"] - found["__n"]


@dataclass(frozen=True)
class RankCut:
    """Where a rank over (value, key) falls: rows below in value, or of equal value and up to the key, are the first ``rank``.

    ``short`` of the rows of equal value and key don't belong to them (0 unless such rows repeat).
    """

    value: object
    key: object
    rank: int
    short: int

    def within(self, value: Column, key: Column) -> Column:
        """Rows at or before the cut; NULL values never, NULL keys before all others."""
        first = key.isNull() if self.key is None else key.isNull() | (key <= F.lit(self.key))
        return F.coalesce((value < F.lit(self.value)) | ((value == F.lit(self.value)) & first), F.lit(False))

    def at(self, value: Column, key: Column) -> Column:
        return F.coalesce((value == F.lit(self.value)) & key.eqNullSafe(F.lit(self.key)), F.lit(False))


def rank_cut(df: DataFrame, value: str, key: str, rank: int, rows: int = SELECT_ROWS) -> RankCut:
    """The cut after the ``rank`` first rows (1-based) over (value, key); rows with a NULL or NaN value have no rank."""
    held = df.select(no_nan(value).alias("__v"), F.col(key).alias("__k")).where("__v is not null")
    v, below = value_at(held, "__v", rank - 1, rows)
    ties = held.where(F.col("__v") == F.lit(v)).select("__k")
    size = ties.agg(F.count(F.lit(1)).alias("n"), F.count("__k").alias("k")).first()
    without = size["n"] - size["k"]
    place = rank - 1 - below
    if place < without:
        return RankCut(v, None, rank, without - place - 1)
    k, before = value_at(ties.where("__k is not null"), "__k", place - without, rows)
    same = ties.where(F.col("__k") == F.lit(k).cast(df.schema[key].dataType)).count()
    return RankCut(v, k, rank, without + before + same - place - 1)


def _split_index(df: DataFrame, key: str) -> Column:
    """How many split points lie strictly below a key of any orderable type (NULL for NULL).

    Split points are the distinct keys of the smallest hashes, one per ``ROWS_PER_BUCKET`` rows.
    """
    want = max(MIN_BUCKETS, df.count() // ROWS_PER_BUCKET)
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    points = sorted(r[0] for r in keys.orderBy(F.xxhash64(key), key).limit(want).collect())
    if not points:
        return F.when(F.col(key).isNotNull(), F.lit(0))
    kind = df.schema[key].dataType
    splits = F.array(*[F.lit(p).cast(kind) for p in points])
    return F.when(F.col(key).isNotNull(), F.size(F.filter(splits, lambda s: s < F.col(key))))


def sorted_codes(distinct_values: DataFrame, value: str, by: Sequence[str] = (), code: str = "code") -> DataFrame:
    """0-based position of each distinct value in sorted (text) order, per ``by`` group.

    The values are sorted by range over as many tasks as they fill and numbered where they lie; counts per task, and the smallest
    number of each group, turn that into codes. Nothing but those counts meets in one place.
    """
    by = list(by)
    rows = distinct_values.withColumn("__text", F.col(value).cast("string"))
    order = [*by, "__text"]
    lined = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__line", F.monotonically_increasing_id()))
    part = F.shiftright("__line", 33)
    sizes = lined.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"), F.min("__line").alias("__first"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    offsets = sizes.select("__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__o"))
    numbered = lined.withColumn("__part", part).join(small_side(offsets), "__part").withColumn("__line", F.col("__line") + F.col("__o")).drop("__part", "__o", "__text")
    if not by:
        return numbered.withColumnRenamed("__line", code)
    first = small_side(numbered.groupBy(*by).agg(F.min("__line").alias("__0")))
    return numbered.join(first, by).withColumn(code, F.col("__line") - F.col("__0")).drop("__line", "__0")


#: Leading hexadecimal digits of a hash that make a bucket, at least: 4,096 buckets.
HASH_DIGITS = 3


def hash_digits(n_rows: int) -> int:
    """How many leading digits keep a bucket of evenly spread hashes below ``ROWS_PER_BUCKET`` rows, whatever the size."""
    digits = HASH_DIGITS
    while n_rows > ROWS_PER_BUCKET * 16**digits:
        digits += 1
    return digits


def hash_order(key: Column | str, seed: int) -> Column:
    """A repeatable pseudo-random sort key: md5 of the key and a seed (hex text)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", k.cast("string"), F.lit(str(seed))))


def hash_ranks(df: DataFrame, key: str, seed: int, by: Sequence[str] = (), rank: str = "rank",
               size: str = "n") -> DataFrame:
    """Rank of every row in md5 order within its ``by`` group, and the group size.

    Rows with a NULL group are left out, as in the other grouped operators. The
    hash is uniform, so its leading digits are ready-made even buckets, more of them
    the more rows there are: a class with most of the rows is spread over all of them.
    """
    by = list(by)
    rows = df.withColumn("__h", hash_order(key, seed)).withColumn("__bucket", F.substring("__h", 1, hash_digits(df.count())))
    cells = rows.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by)
    earlier = w.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*by, "__bucket",
                           F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"),
                           F.sum("__n").over(w).alias(size))
    inside = Window.partitionBy(*by, "__bucket").orderBy("__h", key)
    return (rows.join(offsets, by + ["__bucket"])
            .withColumn(rank, (F.col("__o") + F.row_number().over(inside)).cast("long"))
            .drop("__h", "__bucket", "__o"))


def hash_cuts(df: DataFrame, key: str, seed: int, by: str, cuts: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per ``by`` group with, for each of ``cuts``, the (hash, key) of the row whose rank it gives for the group's size.

    Rows are only counted by the leading digits of their hash; of a prefix that holds a wanted rank the
    keys are counted and ordered, no others move: repeated rows of a key are one row with a weight. Groups that are NULL, and ranks below 1, have no cut.
    """
    rows = df.where(F.col(by).isNotNull()).select(F.col(by).alias("__by"), F.col(key).alias("k"), hash_order(key, seed).alias("h"))
    rows = rows.withColumn("__bucket", F.substring("h", 1, hash_digits(rows.count())))
    cells = rows.groupBy("__by", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__by")
    earlier = w.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("__by", "__bucket", "__n", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"), F.sum("__n").over(w).alias("__size"))
    wanted = F.array(*[F.struct(F.lit(name).alias("cut"), rank(F.col("__size")).cast("long").alias("rank")) for name, rank in cuts.items()])
    at = offsets.withColumn("__w", F.explode(wanted)).where((F.col("__w.rank") > F.col("__o")) & (F.col("__w.rank") <= F.col("__o") + F.col("__n")))
    at = small_side(at.select("__by", "__bucket", F.col("__w.cut").alias("__cut"), (F.col("__w.rank") - F.col("__o")).alias("__place")))
    inside = Window.partitionBy("__by", "__bucket", "__cut").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, 0)
    keys = rows.join(at, ["__by", "__bucket"]).groupBy("__by", "__bucket", "__cut", "__place", "h", "k").agg(F.count(F.lit(1)).alias("__n"))
    found = keys.withColumn("__to", F.sum("__n").over(inside)).where((F.col("__place") <= F.col("__to")) & (F.col("__place") > F.col("__to") - F.col("__n")))
    picked = [F.max(F.when(F.col("__cut") == name, F.struct("h", "k"))).alias(name) for name in cuts]
    return found.groupBy("__by").agg(*picked)
