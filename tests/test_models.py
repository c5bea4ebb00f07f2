"""What SQL can't say: fitted models, importances, ranged sums and p-values, against numpy and literals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrangle.functions import columns as C
from quadrangle.operators import evaluation, modeling
from quadrangle.operators.running import running
from quadrangle.sources import writers

FEATURES = ["x", "y"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=600), rng.normal(size=600)
    target = rng.random(600) < 1 / (1 + np.exp(-(2 * x + 0.1 * y)))
    return [(str(k), bool(t), None if k % 17 == 0 else float(a), float(b)) for k, (a, b, t) in enumerate(zip(x, y, target, strict=True))]


@pytest.fixture(scope="module")
def trained(spark, rows):
    d = modeling.random_split(spark.createDataFrame(rows, "student_id string, target boolean, x double, y double"))
    return d, *modeling.train_candidates(d, FEATURES)


def test_models_after_an_observed_write(spark, rows):
    """Writes that are counted leave something in the session that models must not carry along."""
    writers.write_table(spark.range(3).withColumnRenamed("id", "n"), writers.scratch_name("observed"))
    d = modeling.random_split(spark.createDataFrame(rows, "student_id string, target boolean, x double, y double"))
    metrics, models = modeling.train_candidates(d, FEATURES)
    assert metrics.count() == 6 and modeling.predict(models["logistic_regression"], d, FEATURES).count() == 600


def test_candidates_are_measured(trained):
    _, metrics, models = trained
    got = metrics.collect()
    assert {(r.model, r.split) for r in got} == {(m, s) for m in models for s in ("validate", "test")}
    assert all(r.roc_auc > 0.7 and r.accuracy > 0.6 for r in got)


def newton(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the same penalised loss, by numpy alone."""
    mean = np.nanmean(x, axis=0)
    x = np.where(np.isnan(x), mean, x)
    scale = x.std(axis=0)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    beta, penalty = np.zeros(z.shape[1]), np.array([0.0] + [ridge] * x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = beta + np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(penalty), z.T @ (y - p) - penalty * beta)
    return beta[1:] / scale, float(beta[0] - (beta[1:] / scale) @ mean)


@pytest.mark.parametrize("parts", [1, 5])
def test_logistic_fit_equals_numpy(spark, rows, parts):
    df = spark.createDataFrame(rows, "student_id string, target boolean, x double, y double").repartition(parts)
    got = modeling.fit_logistic(df, FEATURES)
    weights, intercept = newton(np.array([[np.nan if a is None else a, b] for _, _, a, b in rows]), np.array([float(t) for _, t, _, _ in rows]))
    assert np.allclose([got.weights[c] for c in FEATURES], weights, rtol=0, atol=1e-8) and abs(got.intercept - intercept) < 1e-8


def test_logistic_fit_of_separated_and_constant_features(spark):
    """A feature that separates the classes has a finite weight, a constant or empty one none; rows without a target don't count."""
    df = spark.createDataFrame([(float(k), k >= 30, 7.0, None) for k in range(60)] + [(1000.0, None, 7.0, None)], "x double, target boolean, same double, none double")
    got = modeling.fit_logistic(df, ["x", "same", "none"])
    weights, intercept = newton(np.arange(60.0)[:, None], (np.arange(60) >= 30).astype(float))
    assert got.weights["x"] == pytest.approx(weights[0], abs=1e-8) and got.weights["same"] == got.weights["none"] == 0
    assert got.intercept == pytest.approx(intercept, abs=1e-7)


def test_attributions_add_up(trained):
    d, _, models = trained
    m = models["logistic_regression"]
    p = {r.student_id: r.pred_prob for r in modeling.predict(m, d, FEATURES).collect()}
    got = modeling.linear_attributions(m, d).collect()
    base = {round(float(np.log(p[r.student_id] / (1 - p[r.student_id]))) - r.x - r.y, 6) for r in got}
    assert len(base) == 1  # the model's logit at the means


def area(score: np.ndarray, target: np.ndarray) -> float:
    pos, neg = score[target], score[~target]
    return float((pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean())


def test_permutation_importance_equals_numpy(spark):
    """The same moves of values, scored by numpy; five repeats of each feature."""
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=700), rng.normal(size=700)
    t = rng.random(700) < 1 / (1 + np.exp(-2 * x))
    df = spark.createDataFrame([(bool(c), float(a), float(b)) for a, b, c in zip(x, y, t, strict=True)], "target boolean, x double, y double")
    model = modeling.LinearModel({"x": 1.5, "y": -0.2}, {"x": 0.0, "y": 0.0}, 0.1)
    got = {r.feature: r for r in modeling.permutation_importance(model, df, FEATURES).collect()}
    order = df.orderBy(F.xxhash64("target", *FEATURES, F.lit(0)), "target", *FEATURES).toArrow()
    base = area(1.5 * x - 0.2 * y, t)
    drops = {f: [] for f in FEATURES}
    for variant, block in modeling.permuted(order, 0, FEATURES, 5, 0):
        s = 1.5 * block["x"].to_numpy() - 0.2 * block["y"].to_numpy()
        if variant >= 0:
            drops[FEATURES[variant // 5]].append(base - area(s, block["target"].to_numpy()))
    for f in FEATURES:
        assert len(drops[f]) == 5 and got[f].importance == pytest.approx(np.mean(drops[f]), abs=1e-12) and got[f].sd == pytest.approx(np.std(drops[f]), abs=1e-12)
    assert got["x"].importance > 0.2 > 0.01 > abs(got["y"].importance)


def test_permutation_in_blocks(spark):
    """Blocks of about 50 rows, a third of the rows equal: values stay in their blocks, and all rows are scored."""
    rows_ = [(k % 2 == 0, float(k % 7), 1.0) for k in range(400)] + [(True, 3.0, 2.0)] * 200
    df = spark.createDataFrame(rows_, "target boolean, x double, y double")
    model = modeling.LinearModel({"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 0.0}, 0.0)
    got = {r.feature: r for r in modeling.permutation_importance(model, df, FEATURES, repeats=2, block_rows=50).collect()}
    assert got["y"].importance == 0 and set(got) == {"x", "y"}


@pytest.mark.parametrize("parts", ["1", "7"])
def test_running_sums_of_distinct_scores(spark, parts):
    rng = np.random.default_rng(4)
    s = np.round(rng.random(3000), 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(float(v), 1) for v in s], "s double, n int").groupBy("s").agg(F.sum("n").alias("n"))
        up = {r.s: r.total for r in running(df, "s", {"total": "n"}).collect()}
        down = {r.s: r.total for r in running(df, "s", {"total": "n"}, descending=True).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert up == {v: int((s <= v).sum()) for v in set(s.tolist())}
    assert down == {v: int((s >= v).sum()) for v in set(s.tolist())}


def test_auc_and_average_precision(spark):
    rng = np.random.default_rng(5)
    p, t = np.round(rng.random(500), 2), rng.random(500) < 0.3
    df = spark.createDataFrame([(float(a), bool(b)) for a, b in zip(p, t, strict=True)], "pred_prob double, target boolean")
    pos, neg = p[t], p[~t]
    auc = ((pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()).item()
    assert evaluation.roc_auc(df).first().auc == pytest.approx(auc)
    ap = sum((p[t] == s).sum() / t.sum() * t[p >= s].mean() for s in np.unique(p))
    assert evaluation.average_precision(df).first().average_precision == pytest.approx(ap)


@pytest.mark.parametrize(("x", "p"), [(0.0, 0.5), (1.0, 0.841344746), (1.959963985, 0.975), (-2.5, 0.006209665), (4.0, 0.999968329)])
def test_normal_distribution(spark, x, p):
    assert spark.range(1).select(C.normal_cdf(F.lit(x)).alias("p")).first().p == pytest.approx(p, abs=2e-7)
