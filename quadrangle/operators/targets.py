"""Labels: which students can be labelled, and the labels themselves (true: the goal was missed)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Intensity to a number and its unit; "*" stands for every other intensity.
Limits = Mapping[str, tuple[float, str]]


def limit_terms(intensity: Column, limits: Limits, terms_in_year: int = 4) -> Column:
    """Allowed terms for an intensity; null for one that is not listed."""
    terms = {k: n * (terms_in_year if unit == "year" else 1) for k, (n, unit) in limits.items()}
    out = F.lit(terms["*"]) if "*" in terms else F.lit(None)
    for k, n in terms.items():
        if k != "*":
            out = F.when(intensity == k, F.lit(n)).otherwise(out)
    return out.cast("double")


def labelable_by_term(df: DataFrame, checkpoint: DataFrame, limits: Limits, *, max_term_rank: int | None = None, terms_in_year: int = 4, intensity_col: str = "student_term_enrollment_intensity", rank_col: str = "term_rank") -> DataFrame:
    """Students whose checkpoint leaves them the allowed terms before the data end. More than one checkpoint row of a student raises."""
    if checkpoint.groupBy("student_id").count().where("count > 1").limit(1).count():
        raise ValueError("a checkpoint must have one row per student")
    last = df.agg(F.max(rank_col).alias("__last")) if max_term_rank is None else df.sparkSession.range(1).select(F.lit(max_term_rank).alias("__last"))
    rows = checkpoint.join(F.broadcast(last))  # one row
    return rows.where(F.col(rank_col) + limit_terms(F.col(intensity_col), limits, terms_in_year) <= F.col("__last")).select("student_id").distinct()


def labelable_by_year(df: DataFrame, *, max_year: int | None = None) -> DataFrame:
    """Students whose cohort began before the last academic year."""
    starts = df.groupBy("student_id").agg(F.min(F.substring("cohort_id", 1, 4).cast("int")).alias("__start"))
    last = df.agg(F.max(F.substring("term_id", 1, 4).cast("int")).alias("__last")) if max_year is None else df.sparkSession.range(1).select(F.lit(max_year).alias("__last"))
    return starts.join(F.broadcast(last)).where("__start < __last").select("student_id")


def target_graduation(df: DataFrame, checkpoint: DataFrame, limits: Limits, *, years_col: str, terms_in_year: int = 4, intensity_col: str = "student_term_enrollment_intensity", year_col: str = "year_of_enrollment_at_cohort_inst", **how) -> DataFrame:
    """True: no degree within the allowed years. The intensity is the commonest of the terms up to the degree."""
    rows = df.where(F.col(years_col).isNull() | (F.col(year_col) <= F.col(years_col)))
    usual = rows.groupBy("student_id").agg(F.mode(intensity_col, True).alias("__intensity"))
    years = df.groupBy("student_id").agg(F.first(years_col, ignorenulls=True).alias("__years"))
    allowed = limit_terms(F.col("__intensity"), limits, terms_in_year) / terms_in_year
    missed = years.join(usual, "student_id", "left").select("student_id", (F.col("__years").isNull() | F.coalesce(F.col("__years") > allowed, F.lit(False))).alias("target"))
    return missed.join(labelable_by_term(df, checkpoint, limits, terms_in_year=terms_in_year, intensity_col=intensity_col, **how), "student_id")


def join_checkpoint_target(checkpoint: DataFrame, reached: DataFrame, *, rank_col: str = "term_rank", intensity_col: str = "student_term_enrollment_intensity") -> DataFrame:
    """Each checkpoint row with the rank of the student's target term, null if there is none."""
    return checkpoint.select("student_id", F.col(intensity_col).alias("intensity_ckpt"), F.col(rank_col).alias("rank_ckpt")).join(reached.select("student_id", F.col(rank_col).alias("rank_tgt")), "student_id", "left")


def target_credits(df: DataFrame, checkpoint: DataFrame, limits: Limits, *, min_credits: float, terms_in_year: int = 4, **how) -> DataFrame:
    """True: the credits were not reached within the allowed terms after the checkpoint."""
    from quadrangle.operators.selection import first_terms_at_credits

    j = join_checkpoint_target(checkpoint, first_terms_at_credits(df, min_credits))
    late = F.col("rank_tgt") - F.col("rank_ckpt") > limit_terms(F.col("intensity_ckpt"), limits, terms_in_year)
    missed = j.select("student_id", (F.col("rank_tgt").isNull() | F.coalesce(late, F.lit(False))).alias("target"))
    return missed.join(labelable_by_term(df, checkpoint, limits, terms_in_year=terms_in_year, **how), "student_id")


def target_retention(df: DataFrame, *, retention_col: str = "retention", max_year: int | None = None) -> DataFrame:
    """True: not retained. Students without a later year in the data, or without a value, have no label."""
    kept = df.groupBy("student_id").agg(F.first(retention_col, ignorenulls=True).alias("__kept")).where("__kept is not null")
    return kept.join(labelable_by_year(df, max_year=max_year), "student_id").select("student_id", (~F.col("__kept")).alias("target"))
