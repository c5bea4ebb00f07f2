"""Populations: students by attribute, checkpoint terms, and comparisons of two tables."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.functions.columns import value_equals
from quadrangle.operators.quantiles import quantile


def _criteria(criteria: dict[str, object]) -> dict[str, Column]:
    if not criteria:
        raise ValueError("no criteria")
    return {c: F.coalesce(value_equals(F.col(c), v), F.lit(False)) for c, v in criteria.items()}


def _all(conds: Collection[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def select_students(df: DataFrame, *, student_id_cols: Sequence[str] = ("student_id",), **criteria) -> DataFrame:
    """Students that meet all criteria (a value, or a list of values; null meets none), with the criteria's columns of their first such row."""
    rows = df.where(_all(_criteria(criteria).values()))
    w = Window.partitionBy(*student_id_cols).orderBy(*criteria)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").select(*student_id_cols, *criteria)


def selection_report(df: DataFrame, *, student_id_col: str = "student_id", **criteria) -> DataFrame:
    """Distinct students that meet each criterion and all of them: criterion, students, pct. One scan."""
    conds = _criteria(criteria)
    counts = df.agg(F.countDistinct(student_id_col).alias("n"), *[F.countDistinct(F.when(c, F.col(student_id_col))).alias(f"k{i}") for i, c in enumerate([*conds.values(), _all(conds.values())])])
    rows = F.array(*[F.struct(F.lit(c).alias("criterion"), F.col(f"k{i}").alias("students")) for i, c in enumerate([*conds, "all"])])
    return counts.select("n", F.explode(rows).alias("r")).select("r.criterion", "r.students", (100.0 * F.col("r.students") / F.col("n")).alias("pct"))


def latest_term_population(student_terms: DataFrame, eligible: DataFrame, *, rank_col: str = "term_rank") -> DataFrame:
    """Rows of the latest term whose student is eligible."""
    last = student_terms.agg(F.max(rank_col).alias("__last"))  # one row
    now = student_terms.join(F.broadcast(last), F.col(rank_col) == F.col("__last")).drop("__last")
    return now.join(eligible.select("student_id"), "student_id", "left_semi")


def above_quantile(df: DataFrame, col: str, q: float) -> DataFrame:
    limit = quantile(df, col, q, "__q")  # one row
    return df.join(F.broadcast(limit), F.col(col) >= F.col("__q")).drop("__q")


def nth_terms(df: DataFrame, n: int, *, ids: Sequence[str] = ("student_id",), sort: Sequence[str] = ("term_rank",), exclude_pre_cohort: bool = True, exclude_non_core: bool = True, enrollment_year: int | None = None, year_col: str = "year_of_enrollment_at_cohort_inst") -> DataFrame:
    """The n-th row of each student from 0; negative n counts from the end. Rows with a null flag are excluded by it. enrollment_year filters what was picked."""
    rows = df
    if exclude_pre_cohort:
        rows = rows.where(~F.col("term_is_pre_cohort"))
    if exclude_non_core:
        rows = rows.where(F.col("term_is_core"))
    order = [F.asc(c) for c in sort] if n >= 0 else [F.desc(c) for c in sort]
    picked = rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*ids).orderBy(*order))).where(F.col("__rn") == (n + 1 if n >= 0 else -n)).drop("__rn")
    return picked if enrollment_year is None else picked.where(F.col(year_col) == enrollment_year)


def first_terms(df: DataFrame, **how) -> DataFrame:
    return nth_terms(df, 0, **({"exclude_pre_cohort": False, "exclude_non_core": False} | how))


def last_terms(df: DataFrame, **how) -> DataFrame:
    return nth_terms(df, -1, **({"exclude_pre_cohort": False, "exclude_non_core": False} | how))


def first_terms_at_credits(df: DataFrame, credits: float, *, credits_col: str = "cumsum_num_credits_earned", **how) -> DataFrame:
    return first_terms(df.where(F.col(credits_col) >= credits), **how)


def first_terms_in_cohort(df: DataFrame, **how) -> DataFrame:
    return first_terms(df, **({"exclude_pre_cohort": True} | how))


def last_terms_in_year(df: DataFrame, year: int, *, year_col: str = "year_of_enrollment_at_cohort_inst", **how) -> DataFrame:
    return last_terms(df.where(F.col(year_col) == year), **how)


def outer_indicator(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with _merge: both, left_only or right_only."""
    a, b = left.withColumn("__l", F.lit(True)), right.withColumn("__r", F.lit(True))
    mark = F.when(F.col("__l").isNull(), "right_only").when(F.col("__r").isNull(), "left_only").otherwise("both")
    return a.join(b, list(keys), "full").withColumn("_merge", mark).drop("__l", "__r")


def only_in_one(a: DataFrame, b: DataFrame, key: str, a_name: str, b_name: str) -> DataFrame:
    x = a.select(key).distinct().join(b, key, "left_anti").withColumn("only_in", F.lit(a_name))
    return x.unionByName(b.select(key).distinct().join(a, key, "left_anti").withColumn("only_in", F.lit(b_name)))


def update_from(df: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values of `new` where they are not null, else those of df; the keys of `new` must be unique."""
    cols = [c for c in new.columns if c not in keys and c in df.columns]
    j = df.join(new.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in cols]), list(keys), "left")
    return j.withColumns({c: F.coalesce(F.col(f"__new_{c}"), F.col(c)) for c in cols}).select(*df.columns)


def pivot_terms(df: DataFrame, values: Sequence[str], numbers: Sequence[int], *, ids: Sequence[str] = ("student_id",), number_col: str = "cumnum_terms_enrolled") -> DataFrame:
    """One row for each of ids: {value}_term_{n} of the row with that number, null where there is none. Of repeated numbers the smallest values are taken."""
    first = [F.min(F.struct(*values)).alias("v")]
    wide = df.groupBy(*ids).pivot(number_col, list(numbers)).agg(*first)
    return wide.select(*ids, *[F.col(f"`{n}`")[v].alias(f"{v}_term_{n}") for v in values for n in numbers])
