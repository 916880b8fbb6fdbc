import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbtide.operators import clean, quality, rollups


def small(spark):
    return spark.createDataFrame(
        [("A1", "x", None, 10.0, 0), ("A2", None, 5.0, 12.0, 1), ("A3", "y", 7.0, 11.0, 0), ("A4", "x", 9.0, 1000.0, 1), ("A5", "y", None, 9.0, 0)],
        "id string, cat string, amount double, spend double, flag int")


def test_columns_and_leakage(spark):
    found = quality.check_columns(["a", "b", "z"], ["a", "b", "c"])
    assert found == {"missing": ["c"], "extra": ["z"]}
    df = small(spark).withColumn("end_date", F.lit("x"))
    assert "end_date" not in clean.drop_leakage(df).columns
    assert quality.forbidden_columns(["Geography_France", "age", "Gender"], ["Geography", "Gender"]) == ["Geography_France", "Gender"]
    with pytest.raises(ValueError):
        quality.require_columns(["a"], ["a", "b"])
    with pytest.raises(ValueError):
        quality.key_profile(df, "nope")


def test_imputation_and_ties(spark):
    df = small(spark)
    out = {r.id: r for r in clean.impute_categorical(clean.impute_numeric(df, ["amount"]), ["cat"]).collect()}
    assert out["A1"].amount == 7.0 and out["A2"].cat == "x"
    assert clean.categorical_fill_fit(df.where("false"), ["cat"]) == {"cat": "Unknown"}
    assert clean.numeric_fill_fit(df, ["amount"], "zero") == {"amount": 0.0}
    log = {r.column_name: r for r in clean.imputation_log(df, ["amount", "spend"], ["cat"]).collect()}
    assert set(log) == {"amount", "cat"} and log["amount"].rows_filled == 2 and log["cat"].fill_text == "x"


def test_caps_skip_constant_columns_and_flags(spark):
    df = small(spark).withColumn("same", F.lit(3.0))
    fitted = clean.iqr_fit(df, ["spend", "same"])
    assert "same" not in fitted
    out = clean.iqr_winsorize(df, ["spend"], fitted=fitted)
    assert out.agg(F.max("spend")).first()[0] == fitted["spend"][3]
    assert [r.flag for r in out.orderBy("id").collect()] == [0, 1, 0, 1, 0]


def test_sparse_and_indicators(spark):
    df = small(spark).withColumn("empty", F.lit(None).cast("double"))
    assert clean.sparse_columns(df) == ["empty"]
    out = clean.missing_indicators(df, cols=["amount", "cat", "spend"])
    assert "is_missing_spend" not in out.columns
    assert [r.is_missing_amount for r in out.orderBy("id").collect()] == [1, 0, 0, 0, 1]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (2, "c", 1), (3, "d", None)], "k int, v string, t int")
    assert rows(clean.dedup_last(df, "k", ["t"]), "k") == [(1, "b", 2), (2, "c", 1), (3, "d", None)]
    assert quality.inspect_counts(df, "k").first().duplicate_rows == 1
    assert quality.key_profile(df, "k").first().n_duplicate == 2


def test_rules_and_quarantine(spark):
    df = spark.createDataFrame([(1, 5.0, "p"), (2, -1.0, None), (3, None, "q")], "id int, mrr double, plan string")
    rules = quality.bound_rules([("mrr", 0, None)], ["plan"])
    valid, bad, counts = quality.validate_rows(df, rules)
    assert [r.id for r in valid.collect()] == [1]
    assert {r.id: r.violations for r in bad.collect()} == {2: ["mrr_ge_0", "plan_present"], 3: ["mrr_ge_0"]}
    assert {r.rule: r.violations for r in counts.collect()} == {"mrr_ge_0": 2, "plan_present": 1}


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = small(spark)
    a = quality.table_fingerprint(df).first()
    assert a == quality.table_fingerprint(df.orderBy(F.desc("id")).repartition(3)).first()
    assert a != quality.table_fingerprint(df.withColumn("flag", 1 - F.col("flag"))).first()


def test_alignment_and_conversion(spark):
    df = small(spark)
    assert clean.align_features(df, ["spend", "new"], ["id"]).columns == ["id", "spend", "new"]
    text = spark.createDataFrame([("2024-01-05", "4"), ("rubbish", "x")], "join_date string, n string")
    out = clean.convert_types(text, ints=["n"]).collect()
    assert out[0].n == 4 and out[1].n is None and out[1].join_date is None
    kept = clean.feature_matrix(spark.createDataFrame([("a", "2024-01-01", 1.0, 2.0, 1)], "account_id string, last_date string, arr_amount double, mrr double, churn_flag int"))
    assert kept.columns == ["mrr", "churn_flag"]


def test_latest_row_and_stitching(spark):
    df = spark.createDataFrame([("a", 1, "2024-01-01", 5.0), ("a", 2, "2024-03-01", None), ("a", 3, None, 9.0), (None, 4, "2024-01-01", 1.0)],
                               "k string, id int, day string, x double")
    assert rows(rollups.latest_per_key(df, "k", "day", "id")) == [("a", 2, "2024-03-01", None)]
    assert rows(rollups.latest_per_key(df, "k", "day", "id", stitch=True).select("k", "x")) == [("a", 5.0)]


def test_rollup_null_rules(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0), (None, 1.0)], "k string, x double")
    got = {r.k: r for r in rollups.generic_rollup(df, "k", ["sum", "mean", "std"], "u_").collect()}
    assert set(got) == {"a", "b"} and got["a"].u_x_sum == 0.0 and got["a"].u_x_mean is None and got["b"].u_x_std is None


def test_fingerprint_sums_md5_words_without_decimals_per_row(spark):
    import hashlib

    cells = [(1, "ab"), (2, None), (-7, ""), (2**40, "é" * 50), *[(i, "x") for i in range(300)]]
    df = spark.createDataFrame(cells, "a long, b string")
    text = lambda c: "-" if c is None else f"{len(str(c))}:{c}"
    digests = [hashlib.md5("".join(text(c) for c in row).encode()).hexdigest() for row in cells]
    want = "-".join(str(sum(int(d[8 * i:8 * i + 8], 16) for d in digests)) for i in range(4))
    out = quality.table_fingerprint(df)
    assert tuple(out.first()) == (304, want)
    assert tuple(quality.table_fingerprint(df.limit(0)).first()) == (0, "0-0-0-0")
    summed = [e for e in quality.row_hash_sums([F.col("a"), F.col("b")])[1:]]
    assert not any("decimal" in t for _, t in df.agg(*summed).dtypes)
