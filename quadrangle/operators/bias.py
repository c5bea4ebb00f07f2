"""Fairness of predictions between subgroups: false negative rates, pairwise flags, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.functions.columns import normal_cdf
from quadrangle.operators.evaluation import classification_metrics

#: Normal quantile, thresholds of differences and of p, weights of flags.
Z = 1.959964
HIGH, MODERATE, LOW = 0.15, 0.1, 0.05
WEIGHTS = {"HIGH BIAS": 1.0, "MODERATE BIAS": 0.75, "LOW BIAS": 0.25}
MIN_SIZE = 30


def fnr_columns(fn: Column, tp: Column, scaled: bool = True) -> tuple[Column, Column, Column]:
    """False negative rate with its interval; denominators grow by ln(1 + P) if scaled; 0 without positives."""
    p = fn + tp
    d = p + F.log1p(p) if scaled else p
    fnr = F.when(p > 0, fn / d).otherwise(0.0)
    margin = F.when(p > 0, Z * F.sqrt(fnr * (1 - fnr) / d)).otherwise(0.0)
    return fnr, F.greatest(fnr - margin, F.lit(0.0)), F.least(fnr + margin, F.lit(1.0))


def subgroups(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row per row and group column: group, subgroup."""
    rest = [c for c in df.columns if c not in groups]
    return df.select(*rest, F.explode(F.array(*[F.struct(F.lit(g).alias("group"), F.col(g).cast("string").alias("subgroup")) for g in groups])).alias("__g")).select(*rest, "__g.group", "__g.subgroup")


def fnr_by_group(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    t, p = F.col("target"), F.col("pred")
    c = subgroups(df, groups).groupBy("split", "group", "subgroup").agg(F.count("*").alias("size"), F.count_if(t & ~p).cast("double").alias("fn"), F.count_if(t & p).cast("double").alias("tp"))
    fnr, low, high = fnr_columns(F.col("fn"), F.col("tp"))
    return c.select("split", "group", "subgroup", "size", (F.col("fn") + F.col("tp")).alias("positives"), fnr.alias("fnr"), low.alias("ci_low"), high.alias("ci_high"))


def group_metrics(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    return classification_metrics(subgroups(df, groups), ["split", "group", "subgroup"])


def z_test_p(f1: Column, f2: Column, n1: Column, n2: Column) -> Column:
    """Two-sided p of a difference of rates; null where either n is 30 or less."""
    se = F.sqrt(f1 * (1 - f1) / n1 + f2 * (1 - f2) / n2)
    z = F.try_divide(F.abs(f1 - f2), se)
    return F.when((n1 > MIN_SIZE) & (n2 > MIN_SIZE), 2 * (1 - normal_cdf(z)))


def join_pairs(rates: DataFrame) -> DataFrame:
    """Unordered pairs of subgroups within split and group, as 1 and 2; over the small table of rates."""
    a, b = rates.alias("a"), rates.alias("b")
    keys = (F.col("a.split") == F.col("b.split")) & (F.col("a.group") == F.col("b.group")) & (F.col("a.subgroup") < F.col("b.subgroup"))
    names = ["subgroup", "size", "positives", "fnr", "ci_low", "ci_high"]
    return a.join(b, keys).select("a.split", "a.group", *[F.col(f"{x}.{c}").alias(f"{c}_{k}") for k, x in ((1, "a"), (2, "b")) for c in names])


def ci_overlap() -> Column:
    return (F.col("ci_low_1") <= F.col("ci_high_2")) & (F.col("ci_low_2") <= F.col("ci_high_1"))


def bias_flags(rates: DataFrame, *, ratio: float = 0.15) -> DataFrame:
    """split, group, subgroups, diff, p, flag of each pair with both rates above 0; the larger rate comes first."""
    from pyspark.sql import Window

    total = F.sum("positives").over(Window.partitionBy("split", "group"))
    pairs = join_pairs(rates)
    totals = rates.select("split", "group", total.alias("__all")).distinct()
    pairs = pairs.join(totals, ["split", "group"]).where("fnr_1 > 0 and fnr_2 > 0")
    first = F.col("fnr_1") >= F.col("fnr_2")
    p = z_test_p(F.col("fnr_1"), F.col("fnr_2"), F.col("size_1").cast("double"), F.col("size_2").cast("double"))
    d = pairs.select("split", "group", F.when(first, F.col("subgroup_1")).otherwise(F.col("subgroup_2")).alias("higher"), F.when(first, F.col("subgroup_2")).otherwise(F.col("subgroup_1")).alias("lower"), F.abs(F.col("fnr_1") - F.col("fnr_2")).alias("diff"), p.alias("p"), ci_overlap().alias("ci_overlap"), F.least("positives_1", "positives_2").alias("__few"), F.least(F.lit(50), (F.col("__all") * ratio).cast("int")).alias("__need"))
    flag = (
        F.when(F.col("p").isNull() | (F.col("__few") < F.col("__need")), "INSUFFICIENT DATA").when((F.col("diff") < LOW) | (F.col("p") > 0.1), "NO BIAS")
        .when((F.col("diff") >= HIGH) & (F.col("p") <= 0.01), "HIGH BIAS").when((F.col("diff") >= MODERATE) & (F.col("p") <= 0.01), "MODERATE BIAS").otherwise("LOW BIAS")
    )
    return d.withColumn("flag", flag).drop("__few", "__need")


def bias_scores(flags: DataFrame) -> DataFrame:
    """Per split: weighted sum of differences, its mean over valid comparisons, the largest difference, counts."""
    w = F.lit(0.0)
    for k, v in WEIGHTS.items():
        w = F.when(F.col("flag") == k, F.lit(v)).otherwise(w)
    valid = F.col("flag") != "INSUFFICIENT DATA"
    c = flags.groupBy("split").agg(F.sum(F.when(valid, F.col("diff") * w).otherwise(0.0)).alias("score_sum"), F.count_if(valid).alias("n_valid"), F.max(F.when(valid, F.col("diff"))).alias("max_diff"), F.count_if(F.col("flag").isin(*WEIGHTS)).alias("n_flagged"))
    return c.select("split", "score_sum", F.try_divide(F.col("score_sum"), F.col("n_valid").cast("double")).alias("score_mean"), "max_diff", "n_valid", "n_flagged")


def disparity_summary(flags: DataFrame, split: str = "test") -> DataFrame:
    """Sentences about flagged pairs of a split, by group; differences as whole percents."""
    text = F.format_string("%s: %s is missed %d%% more often than %s", F.col("flag"), "higher", F.bround(F.col("diff") * 100, 0).cast("int"), "lower")
    rows = flags.where((F.col("split") == split) & F.col("flag").isin(*WEIGHTS))
    return rows.select("group", text.alias("t")).groupBy("group").agg(F.array_join(F.array_sort(F.collect_list("t")), "; ").alias("sentences"))


def group_threshold(df: DataFrame, group_col: str, group: str, custom: float, default: float = 0.5) -> DataFrame:
    limit = F.when(F.col(group_col) == group, F.lit(custom)).otherwise(F.lit(default))
    return df.withColumn("flagged", F.col("pred_prob") >= limit)


def bias_report(df: DataFrame, groups: Sequence[str]) -> dict[str, DataFrame]:
    rates = fnr_by_group(df, groups)
    flags = bias_flags(rates)
    return {"rates": rates, "metrics": group_metrics(df, groups), "flags": flags, "scores": bias_scores(flags), "summary": disparity_summary(flags)}
