"""Exact quantiles by selection: no aggregate and no task ever holds all values of a column.

A sketch gives cuts close around each wanted quantile. Values are counted
exactly between the cuts, and only those of the ranges that hold a wanted rank
are sorted. Should a sketch be wrong, a larger range is sorted; the result is
the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of the sketch; the cuts are twice its error away from the wanted quantile on each side.
ACCURACY = 10_000


def _range(x: Column, cuts: Column, n: int) -> Column:
    """How many cuts are below x: 0 up to the first cut, n beyond the last."""
    return sum((F.when(cuts[k] < x, 1).otherwise(0) for k in range(n)), F.lit(0))


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float], *, accuracy: int = ACCURACY) -> DataFrame:
    """(column, q, value) of numeric columns, interpolated between neighbours as `percentile` does; null where a column has no value.

    Nulls don't count; NaN is larger than all numbers. df is read three times:
    for the cuts, the counts, and the ranges that hold a wanted rank.
    """
    if not columns or not quantiles:
        raise ValueError("name columns and quantiles")
    qs = sorted(set(quantiles))
    around = [min(1.0, max(0.0, q + s * 2 / accuracy)) for q in qs for s in (-1, 1)]
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(columns)])
    xs = [F.col(f"x{k}") for k in range(len(columns))]

    cuts = rows.agg(*[F.array_sort(F.percentile_approx(x, around, accuracy)).alias(f"cuts{k}") for k, x in enumerate(xs)])
    n_ranges = len(around) + 1
    ranged = rows.join(F.broadcast(cuts)).select(*xs, *[F.when(x.isNotNull(), _range(x, F.col(f"cuts{k}"), len(around))).alias(f"r{k}") for k, x in enumerate(xs)])  # one row of cuts

    sizes = ranged.agg(*[F.array(*[F.count_if(F.col(f"r{k}") == r) for r in range(n_ranges)]).alias(f"n{k}") for k in range(len(columns))])
    wanted = sizes.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"n{k}").alias("n"), F.lit(q).alias("q")) for k in range(len(columns)) for q in qs])).alias("w")).select("w.*")
    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    wanted = wanted.withColumn("at", F.col("q") * (total - 1)).where(total > 0)
    wanted = wanted.select("k", "q", "at", "n", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"))
    before = F.transform(F.sequence(F.lit(0), F.lit(n_ranges)), lambda r: F.aggregate(F.slice("n", 1, r), F.lit(0).cast("long"), lambda a, x: a + x))
    wanted = wanted.withColumn("before", before).withColumn("r", F.size(F.filter("before", lambda b: b <= F.col("rank"))) - 1)
    wanted = wanted.select("k", "q", "at", "rank", "r", F.get("before", F.col("r")).alias("before"))  # two rows for each column and quantile

    needed = wanted.groupBy().agg(F.collect_set(F.col("k") * n_ranges + F.col("r")).alias("needed"))
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"r{k}").alias("r"), x.alias("x")) for k, x in enumerate(xs)])
    picked = ranged.join(F.broadcast(needed)).select(F.explode(F.filter(cells, lambda c: F.array_contains("needed", c["k"] * n_ranges + c["r"]))).alias("c")).select("c.*")
    values = picked.groupBy("k", "r", "x").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("k", "r").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    values = values.withColumn("upto", upto)
    found = values.join(F.broadcast(wanted), ["k", "r"]).where((F.col("before") + F.col("upto") > F.col("rank")) & (F.col("before") + F.col("upto") - F.col("n") <= F.col("rank")))
    ends = found.groupBy("k", "q", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    share = F.col("at") - F.floor("at")
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((1 - share) * F.col("low") + share * F.col("high"))
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).alias("column"), F.lit(q).alias("q")) for k, c in enumerate(columns) for q in qs])).alias("e")).select("e.*")
    return every.join(F.broadcast(ends.select("k", "q", value.alias("value"))), ["k", "q"], "left").select("column", "q", "value")


def quantile(df: DataFrame, column: str, q: float, out: str) -> DataFrame:
    """One row: the exact quantile of a column."""
    return exact_quantiles(df, [column], [q]).select(F.col("value").alias(out))
