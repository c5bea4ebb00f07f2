"""Metrics of predictions: (target boolean, pred boolean, pred_prob double) rows, grouped or whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.operators.quantiles import quantile
from quadrangle.operators.running import running


def _count(cond: Column) -> Column:
    return F.count_if(cond).cast("double")


def classification_metrics(df: DataFrame, by: Sequence[str] = (), *, eps: float = 1e-15) -> DataFrame:
    """n, positives, prevalence, accuracy, precision, recall, f1, log loss; null where a denominator is 0."""
    t, p, s = F.col("target"), F.col("pred"), F.col("pred_prob")
    clipped = F.least(F.greatest(s, F.lit(eps)), F.lit(1 - eps))
    c = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(t).alias("n_positive"), _count(t & p).alias("tp"), _count(~t & p).alias("fp"), _count(t & ~p).alias("fn"), _count(~t & ~p).alias("tn"), F.avg(-F.when(t, F.log(clipped)).otherwise(F.log(1 - clipped))).alias("log_loss"),
    )
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    return c.select(
        *by, "n", "n_positive", ((tp + fn) / n).alias("prevalence"), ((tp + fp) / n).alias("pred_prevalence"), ((tp + tn) / n).alias("accuracy"), F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"), "log_loss",
    )


def format_metrics(df: DataFrame) -> DataFrame:
    return df.select(*[F.bround(c, 2).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


def sensitivity_top_q(df: DataFrame, q: float) -> DataFrame:
    limit = quantile(df, "pred_prob", q, "__q")  # one row
    hit = F.count_if(F.col("target") & (F.col("pred_prob") >= F.col("__q")))
    return df.join(F.broadcast(limit)).agg(F.try_divide(hit.cast("double"), F.count_if("target").cast("double")).alias("sensitivity"))


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Rates of true and false positives and negatives; 0 on an empty denominator."""
    t, p = F.col("target"), F.col("pred")
    c = df.agg(_count(t & p).alias("tp"), _count(~t & p).alias("fp"), _count(t & ~p).alias("fn"), _count(~t & ~p).alias("tn"))
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(a) + F.col(b)), F.lit(0.0))
    return c.select(rate("tp", "fn").alias("true_positive"), rate("fp", "tn").alias("false_positive"), rate("tn", "fp").alias("true_negative"), rate("fn", "tp").alias("false_negative"))


def _by_score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col("pred_prob").alias("s")).agg(F.count_if("target").alias("p"), F.count_if(~F.col("target")).alias("q"))


def _curve(counts: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Counts by score with tp and fp of all scores from theirs on, and the positives and negatives of all."""
    return running(counts, "s", {"tp": "p", "fp": "q"}, descending=True, ties=ties, whole={"total_p": "tp", "total_n": "fp"})


def roc_curve(df: DataFrame, decimals: int = 4) -> DataFrame:
    """threshold, tp, fp, tn, fn, tpr, fpr at the distinct scores, rounded; a rounded-up threshold can exclude its own score."""
    zero = F.lit(0).cast("long")
    point = F.struct(F.bround("s", decimals).alias("s"), zero.alias("p"), zero.alias("q"), F.lit(1).alias("mark"))
    both = _by_score(df).select(F.explode(F.array(F.struct("s", "p", "q", F.lit(0).alias("mark")), point)).alias("e")).select("e.*")
    j = _curve(both, ["mark"]).where("mark = 1").select("s", "tp", "fp", "total_p", "total_n").distinct()
    r = lambda a, b: F.bround(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), decimals)
    return j.select(F.col("s").alias("threshold"), "tp", "fp", (F.col("total_n") - F.col("fp")).alias("tn"), (F.col("total_p") - F.col("tp")).alias("fn"), r("tp", "total_p").alias("tpr"), r("fp", "total_n").alias("fpr"))


def precision_recall_curve(df: DataFrame) -> DataFrame:
    j = _curve(_by_score(df))
    return j.select(F.col("s").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide(F.col("tp").cast("double"), F.col("total_p").cast("double")).alias("recall"))


def average_precision(df: DataFrame) -> DataFrame:
    step = F.try_divide(F.col("p").cast("double"), F.col("total_p").cast("double"))  # the recall that this score adds
    return _curve(_by_score(df)).agg(F.sum(step * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("average_precision"))


def _area() -> Column:
    """Pairs that a group's scores order right, a tie counting half, of rows with p, q and tp of all scores from theirs on."""
    n = F.sum("p").cast("double") * F.sum("q").cast("double")
    return F.try_divide(F.sum(F.col("q") * (F.col("tp") - F.col("p") / 2)), n)


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return running(_by_score(df, by), "s", {"tp": "p"}, by=by, descending=True).groupBy(*by).agg(_area().alias("auc"))


def calibration_curve(df: DataFrame, by: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """bin, mean_predicted, fraction_positive, n; bins are right-closed between inner edges, empty ones are left out."""
    edge = sum(((F.col("pred_prob") > k / bins).cast("int") for k in range(1, bins)), F.lit(0))
    return df.groupBy(*by, edge.alias("bin")).agg(F.avg("pred_prob").alias("mean_predicted"), F.avg(F.col("target").cast("double")).alias("fraction_positive"), F.count("*").alias("n"))


def score_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    return df.groupBy(F.least(F.floor(F.col("pred_prob") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def metrics_near_threshold(df: DataFrame, threshold: float = 0.5, by: str = "split") -> DataFrame:
    """Per split the score nearest the threshold, with precision and recall there, and the AUC."""
    run = running(_by_score(df, [by]), "s", {"tp": "p", "fp": "q"}, by=[by], descending=True)
    near = F.min_by(F.struct("s", "tp", "fp"), F.struct(F.abs(F.col("s") - threshold), "s"))
    c = run.groupBy(by).agg(near.alias("at"), F.sum("p").alias("P"), _area().alias("auc"))
    return c.select(by, F.col("at.s").alias("threshold"), (F.col("at.tp") / (F.col("at.tp") + F.col("at.fp"))).alias("precision"), F.try_divide(F.col("at.tp").cast("double"), F.col("P").cast("double")).alias("recall"), "auc")


def support_score_bins(df: DataFrame, *, include_all: bool = False) -> DataFrame:
    """0.1-wide left-closed bins from 0.1 to 1.0: lower, upper, midpoint, n, pct of all rows. include_all adds [0, 0.1) and puts 1.0 in the last."""
    k = F.floor(F.col("pred_prob") * 10 + 1e-9).cast("int")
    if include_all:
        k = F.least(k, F.lit(9))
    n = df.groupBy(k.alias("k")).agg(F.count("*").alias("n"))
    n = n.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))
    if not include_all:
        n = n.where("k between 1 and 9")
    return n.select((F.col("k") / 10).alias("lower"), ((F.col("k") + 1) / 10).alias("upper"), ((F.col("k") + 0.5) / 10).alias("midpoint"), "n", "pct")


def split_summary(df: DataFrame, fractions: dict[str, float]) -> DataFrame:
    n = df.groupBy("split").agg(F.count("*").alias("students"))
    total = F.sum("students").over(Window.partitionBy())
    expected = F.lit(None).cast("double")
    for k, f in fractions.items():
        expected = F.when(F.col("split") == k, total * f).otherwise(expected)
    return n.select("split", "students", (100.0 * F.col("students") / total).alias("pct"), expected.alias("expected"))


def extreme_students(df: DataFrame) -> DataFrame:
    """Ids with the largest, the smallest, and the score nearest the median."""
    mid = quantile(df, "pred_prob", 0.5, "__m")  # one row
    pick = lambda d, name, *order: d.orderBy(*order, "student_id").limit(1).select(F.lit(name).alias("which"), "student_id", "pred_prob")
    near = pick(df.join(F.broadcast(mid)), "median", F.abs(F.col("pred_prob") - F.col("__m")))
    return pick(df, "max", F.desc("pred_prob")).unionByName(pick(df, "min", "pred_prob")).unionByName(near)
