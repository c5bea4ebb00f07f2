"""Quantiles, distinct values and running totals against numpy and pandas, on ties, nulls, one value, empty tables and skew."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrangle.operators import contracts, eda, evaluation
from quadrangle.operators.distincts import distinct_counts, distinct_values
from quadrangle.operators.quantiles import exact_quantiles
from quadrangle.operators.running import running


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(1)
    n = 5000
    cols = {
        "spread": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float), "skewed": np.exp(3 * rng.normal(size=n)),
        "mostly_one": np.where(rng.random(n) < 0.9, 7.0, rng.random(n)), "constant": np.full(n, -2.5), "signed_zero": np.where(rng.random(n) < 0.5, 0.0, -0.0),
    }
    frame = pd.DataFrame(cols)
    frame["holes"] = frame["spread"].where(rng.random(n) < 0.3)
    frame["one"] = pd.Series([4.0] + [None] * (n - 1))
    return frame, spark.createDataFrame(frame.replace({np.nan: None}), ", ".join(f"{c} double" for c in frame.columns)).repartition(7)


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_quantiles_equal_numpy(values, accuracy):
    """Also with a sketch so coarse that its cuts are far off."""
    frame, df = values
    qs = [0.0, 0.001, 0.25, 0.5, 0.7777, 0.9, 1.0]
    got = {(r["column"], r["q"]): r["value"] for r in exact_quantiles(df, list(frame.columns), qs, accuracy=accuracy).collect()}
    assert len(got) == len(frame.columns) * len(qs)
    for c in frame.columns:
        for q in qs:
            assert got[c, q] == pytest.approx(np.quantile(frame[c].dropna(), q), rel=1e-12, abs=1e-12), (c, q)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "x double, k int")
    assert [r["value"] for r in exact_quantiles(df, ["x", "k"], [0.5]).orderBy("column").collect()] == [1.0, None]
    assert [r["value"] for r in exact_quantiles(df.where("false"), ["x"], [0.1, 0.9]).collect()] == [None, None]
    with pytest.raises(ValueError):
        exact_quantiles(df, [], [0.5])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_aggregate_holds_values(values):
    text = plan(eda.describe_columns(values[1], ["spread", "ties"]))
    assert "percentile(" not in text and "median(" not in text and "percentile_approx" in text


def test_distinct_values(spark):
    df = spark.createDataFrame([(1, "a", 0.0, None, [1]), (2, "a", -0.0, None, [1]), (2, None, float("nan"), None, [2]), (None, "B", float("nan"), None, None)], "n int, s string, x double, none string, many array<int>").repartition(3)
    got = {(r["column"], r["value"]) for r in distinct_values(df).collect()}
    assert got == {("n", "1"), ("n", "2"), ("n", None), ("s", "a"), ("s", "B"), ("s", None), ("x", "0.0"), ("x", "NaN"), ("none", None), ("many", "[1]"), ("many", "[2]"), ("many", None)}
    assert {r["column"]: r["n_distinct"] for r in distinct_counts(df).collect()} == {"n": 2, "s": 2, "x": 2, "none": 0, "many": 2}
    assert {r["n_distinct"] for r in distinct_counts(df.where("false")).collect()} == {0}


def test_distinct_values_of_many_columns(spark):
    """226 columns, with a worker that forgets: no Expand, counts as by Spark's own aggregate."""
    df = spark.range(3000).select(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(k + 1)).alias(f"c{k}") for k in range(226)]).repartition(5)
    got = distinct_values(df, remembered=1000).groupBy("column").agg(F.count("value").alias("n"))
    want = df.agg(*[F.size(F.collect_set(c)).alias(c) for c in df.columns]).first().asDict()
    assert {r["column"]: r["n"] for r in got.collect()} == want
    for made in (contracts.profile(df), eda.single_value_columns(df), contracts.infer_contract(df)):
        assert "Expand" not in plan(made)
    assert [r["column"] for r in eda.single_value_columns(df).collect()] == ["c0"]


def test_limits_stop_early(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") > 500, F.col("id") % 3).alias("few"))
    sent = distinct_values(df.coalesce(1), limit=4)
    assert sent.where("column = 'id'").count() == 4 and sent.where("column = 'few'").count() == 4
    got = {r["column"]: r for r in contracts.infer_contract(df).collect()}
    assert (got["id"]["kind"], got["few"]["kind"], got["few"]["categories"], got["few"]["nullable"], got["id"]["nullable"]) == ("float64", "category", "0,1,2", True, False)


@pytest.mark.parametrize("parts", ["1", "3", "11"])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_of_groups(spark, parts, descending):
    """Groups of one row, of a third of all rows, and null; null values; ties by another column."""
    rng = np.random.default_rng(2)
    n = 2000
    frame = pd.DataFrame({"g": np.where(rng.random(n) < 0.35, "hot", rng.integers(0, 40, n).astype(str)), "s": np.round(rng.random(n), 2), "t": np.arange(n), "x": rng.integers(0, 9, n), "y": rng.random(n)})
    frame.loc[:30, "g"] = None
    rows = [(r.g, float(r.s), int(r.t), None if r.t % 11 == 0 else int(r.x), float(r.y)) for r in frame.itertuples()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "g string, s double, t long, x long, y double").repartition(4)
        got = {r["t"]: (r["sx"], r["sy"]) for r in running(df, "s", {"sx": "x", "sy": "y"}, by=["g"], descending=descending, ties=["t"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == n
    for g in {r[0] for r in rows}:
        x = y = 0
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1] if descending else r[1], r[2])):
            x, y = x + (r[3] or 0), y + r[4]
            assert got[r[2]][0] == x and got[r[2]][1] == pytest.approx(y)


def test_running_totals_of_no_rows(spark):
    assert running(spark.createDataFrame([], "s double, n long"), "s", {"m": "n"}).count() == 0


def scans(df) -> int:
    """Files' scans in the final plan that are not read from an exchange that another part made."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan parquet")


def test_one_scan_and_no_job_while_a_query_is_built(spark):
    pred = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select((F.col("o_orderkey") % 3 == 0).alias("target"), (F.col("o_custkey") / 1000).alias("pred_prob"), F.col("o_orderstatus").alias("split"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "queries are only built")
    try:
        made = [evaluation.roc_curve(pred), evaluation.roc_auc(pred), evaluation.precision_recall_curve(pred), evaluation.metrics_near_threshold(pred), eda.spearman(pred.withColumn("b", F.col("pred_prob") * 2), "pred_prob", "b")]
        assert len(tracker.getJobIdsForGroup("built")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [scans(m) for m in made] == [1] * 5
