"""Splits, folds, samples and oversampling. All repeatable: randomness is md5(key, seed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dbl
from .neighbors import nearest_neighbors, tomek_links
from .ordering import hash_cuts, hash_order, hash_ranks, small_side


def stratified_split(df: DataFrame, key: str, label: str, test: float = 0.2, val: float = 0.0, seed: int = 42) -> DataFrame:
    """Adds ``split``: per class the first ceil(test * n) rows in hash order are test, then validation, then train.

    ``val`` is a share of what remains after the test cut (0.2 and 0.15 give 68/12/20). Rows without a label
    stay, with a NULL split. Only the rows around a cut are ordered; all others are compared with it where
    they are. Rows that share a key stay on one side.
    """
    def n_test(n: Column) -> Column:
        return F.ceil(n.cast("double") * F.lit(float(test)))

    def n_held(n: Column) -> Column:
        return n_test(n) + F.ceil((n - n_test(n)).cast("double") * F.lit(float(val)))

    cuts = small_side(hash_cuts(df, key, seed, label, {"__test": n_test, "__val": n_held}))
    place = F.struct(hash_order(key, seed).alias("h"), F.col(key).alias("k"))
    split = F.when(place <= F.col("__test"), "test").when(place <= F.col("__val"), "val").otherwise("train")
    return df.join(cuts, F.col(label) == F.col("__by"), "left").select(
        *df.columns, F.when(F.col(label).isNotNull(), split).alias("split"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A fixed-size sample: the n first rows in hash order."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in hash order (range-partitioned sort)."""
    return df.orderBy(hash_order(key, seed), key)


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` in 0..k-1 with every class dealt out evenly; rows without a label stay, with a NULL fold."""
    r = hash_ranks(df, key, seed, by=[label], rank="__rank", size="__n")
    dealt = r.withColumn("fold", ((F.col("__rank") - 1) % k).cast("int")).drop("__rank", "__n")
    return dealt.unionByName(df.where(F.col(label).isNull()).withColumn("fold", F.lit(None).cast("int")))


def union_segments(segments: Mapping[str, DataFrame], name: str = "segment") -> DataFrame:
    """Stack tables by column name, each row marked with its segment."""
    out = None
    for label, df in segments.items():
        part = df.withColumn(name, F.lit(label))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


ROUNDS_PER_STEP = 65_536


def _unit(*parts: Column) -> Column:
    """Repeatable number in [0, 1) from md5."""
    word = F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 8), 16, 10)
    return word.cast("double") / F.lit(4294967296.0)


def smote(df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5, seed: int = 42,
          minority: int = 1, block_rows: int = 2048) -> DataFrame:
    """Synthetic minority rows up to parity with the rest, between a row and one of its k neighbours.

    The quota is dealt out in hash order, so every minority row is a parent
    equally often (give or take one). Returns synthetic rows only: parent key,
    neighbour key, running number, gap, features, label.
    """
    rows = df.select(F.col(key).alias("parent"), F.col(label).alias("__y"), *[dbl(f).alias(f) for f in features])
    small = rows.where(F.col("__y") == minority)
    sizes = df.agg(F.count_if(F.col(label) == minority).alias("s"), F.count_if(F.col(label) != minority).alias("l")).first()
    need, n_small = max(sizes["l"] - sizes["s"], 0), sizes["s"]
    pairs = nearest_neighbors(small, small, "parent", features, k, block_rows=block_rows)
    lists = pairs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("position", "neighbor"))).alias("near"))
    parents = hash_ranks(small, "parent", seed, rank="__rank", size="__n").where(F.col("__rank") <= need)
    rounds = F.floor((F.lit(need) - F.col("__rank")) / F.lit(float(max(n_small, 1)))).cast("long")
    # Two steps of sequences: one parent may have as many rounds as there are rows, too many for one array.
    first = F.col("__step") * F.lit(ROUNDS_PER_STEP)
    drawn = (parents.join(lists, F.col("parent") == F.col("key"), "left").drop("key").withColumn("__rounds", rounds)
             .withColumn("__step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("__rounds") / ROUNDS_PER_STEP))))
             .withColumn("round", F.explode(F.sequence(first, F.least(F.col("__rounds"), first + F.lit(ROUNDS_PER_STEP - 1)))))
             .drop("__rounds", "__step"))
    pick = (F.floor(_unit(F.col("parent"), F.col("round"), F.lit(f"n{seed}")) * F.size("near")) + 1).cast("int")
    # A row without any neighbour (the only one of its class) is its own.
    drawn = drawn.withColumns({"neighbor": F.coalesce(F.element_at("near", pick)["neighbor"], F.col("parent")),
                               "gap": _unit(F.col("parent"), F.col("round"), F.lit(f"g{seed}"))})
    other = small.select(F.col("parent").alias("neighbor"), *[F.col(f).alias(f"__o_{f}") for f in features])
    moved = [(F.col(f) + F.col("gap") * (F.col(f"__o_{f}") - F.col(f))).alias(f) for f in features]
    return drawn.join(other, "neighbor").select("parent", "neighbor", "round", "gap", *moved, F.lit(minority).alias(label))


def oversampled(df: DataFrame, key: str, label: str, features: Sequence[str], **smote_args) -> DataFrame:
    """Original plus synthetic rows; ``row_id`` names the row, ``parent`` its real origin."""
    synth = smote(df, key, label, features, **smote_args)
    real = df.select(F.concat(F.lit("r:"), F.col(key).cast("string")).alias("row_id"), F.col(key).alias("parent"),
                     *[dbl(f).alias(f) for f in features], F.col(label))
    made = synth.select(F.concat(F.lit("s:"), F.col("parent").cast("string"), F.lit(":"), F.col("round").cast("string")).alias("row_id"),
                        "parent", *features, label)
    return real.unionByName(made.withColumn(label, F.col(label).cast(df.schema[label].dataType)))


def smote_tomek(df: DataFrame, key: str, label: str, features: Sequence[str], stage=None, block_rows: int = 2048,
                **smote_args) -> DataFrame:
    """Oversample, then drop both members of every Tomek link.

    ``stage`` (for example ``ebbtide.session.staged``) writes the oversampled
    table once, since the neighbour search reads it several times.
    """
    full = oversampled(df, key, label, features, block_rows=block_rows, **smote_args)
    full = stage(full) if stage else full
    links = tomek_links(full, "row_id", label, features, block_rows=block_rows)
    gone = links.select(F.explode(F.array("key_a", "key_b")).alias("row_id")).distinct()
    return full.join(gone, "row_id", "left_anti")
