"""Cases beyond the usual sizes and types: text and missing keys, ambiguous cells, constants, a single minority row."""

from pyspark.sql import functions as F

from ebbtide.operators import clean, encode, quality
from ebbtide.operators.evaluate import top_decile_capture
from ebbtide.operators.ordering import value_ranks
from ebbtide.operators.sampling import smote


def test_ranks_with_text_and_missing_keys(spark):
    rows = [(f"A-{i % 7}{i}" if i % 5 else None, float(i % 3)) for i in range(40)] + [("z", None)]
    got = value_ranks(spark.createDataFrame(rows, "k string, x double"), "x", "k").collect()
    assert len(got) == 41 and [r["rank"] for r in got if r.x is None] == [None]
    ordered = sorted((r for r in got if r.x is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ordered] == list(range(1, 41))
    keys = [(r.x, r.k is not None, r.k or "") for r in ordered]
    assert keys == sorted(keys)


def test_capture_over_text_keys(spark):
    df = spark.createDataFrame([(f"c{i:02}", i % 2, i / 20) for i in range(20)], "k string, y int, p double")
    r = top_decile_capture(df, "k", "y", "p").first()
    assert (r.n_top, r.captured, r.n_positive) == (2, 1, 10)


def test_fingerprint_tells_cells_apart(spark):
    a = spark.createDataFrame([("a|b", "c")], "x string, y string")
    b = spark.createDataFrame([("a", "b|c")], "x string, y string")
    c = spark.createDataFrame([("a|b", None)], "x string, y string")
    d = spark.createDataFrame([("a|b", "-")], "x string, y string")
    assert len({quality.table_fingerprint(t).first().fingerprint for t in (a, b, c, d)}) == 4
    assert quality.table_fingerprint(a.limit(0)).first().fingerprint == "0-0-0-0"


def test_outlier_report_of_columns_without_spread(spark):
    df = spark.createDataFrame([(1.0, float(i), None) for i in range(9)], "same double, x double, gone double")
    got = {r.column_name: r for r in clean.iqr_report(df, ["same", "x", "gone"]).collect()}
    assert (got["same"].q1, got["same"].n_below, got["same"].n_above, got["same"].capped_max) == (1.0, 0, 0, 1.0)
    assert got["gone"].q1 is None and got["gone"].n_below == 0 and got["x"].iqr == 4.0


def test_single_minority_row_is_copied_to_parity(spark):
    df = spark.createDataFrame([(i, int(i == 0), float(i), 1.0) for i in range(30)], "id long, y int, a double, b double")
    got = smote(df, "id", "y", ["a", "b"]).collect()
    assert len(got) == 28 and {(r.parent, r.neighbor, r.a, r.b) for r in got} == {(0, 0, 0.0, 1.0)}


def test_many_levels_as_positions(spark):
    df = spark.range(2500).select(F.format_string("v%04d", "id").alias("c"), F.when(F.col("id") % 2 == 0, "e").alias("d"))
    got = {r.c: r.slots for r in encode.one_hot_slots(df, ["c", "d"]).collect()}
    assert len(got) == 2500 and got["v0000"] == [0, 2500] and got["v2499"] == [2499]


def test_splits_keep_rows_without_label(spark):
    from ebbtide.operators import sampling

    data = spark.range(400).selectExpr("id", "case when id % 10 = 3 then null when id % 5 = 0 then 1 else 0 end y", "id extra")
    split = {(r.y, r.split): r.n for r in sampling.stratified_split(data, "id", "y", 0.2, 0.15).groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert split == {(None, None): 40, (1, "test"): 16, (1, "val"): 10, (1, "train"): 54, (0, "test"): 56, (0, "val"): 34, (0, "train"): 190}
    fold = sampling.stratified_folds(data, "id", "y", 4)
    assert fold.count() == 400 and fold.where("fold is null").count() == 40
    # Repeated rows stay on one side, tables without rows give none.
    twice = sampling.stratified_split(data.unionByName(data), "id", "y", 0.2, 0.15).groupBy("id").agg(F.count_distinct("split").alias("n"))
    assert twice.where("n > 1").count() == 0
    assert sampling.stratified_split(data.limit(0), "id", "y").count() == 0
