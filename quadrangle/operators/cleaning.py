"""Standard forms of the raw tables, and the guard against future information."""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)

#: Columns of the raw cohort table that features don't use.
COHORT_DROPS = [
    "attempted_dev_english_y_1",
    "attempted_dev_math_y_1",
    "attempted_gateway_english_year_1",
    "attempted_gateway_math_year_1",
    "attendance_status_term_1",
    "completed_dev_english_y_1",
    "completed_dev_math_y_1",
    "completed_gateway_english_year_1",
    "completed_gateway_math_year_1",
    "disability_status",
    "employment_status",
    "first_associates_or_certificate_at_other_institution_carnegie",
    "first_associates_or_certificate_at_other_institution_locale",
    "first_associates_or_certificate_at_other_institution_state",
    "first_bachelors_at_other_institution_carnegie",
    "first_bachelors_at_other_institution_locale",
    "first_bachelors_at_other_institution_state",
    "gateway_english_grade_y_1",
    "gateway_english_status",
    "gateway_math_grade_y_1",
    "gateway_math_status",
    "incarcerated_status",
    "military_status",
    "most_recent_associates_or_certificate_at_other_institution_carnegie",
    "most_recent_associates_or_certificate_at_other_institution_locale",
    "most_recent_associates_or_certificate_at_other_institution_state",
    "most_recent_bachelors_at_other_institution_carnegie",
    "most_recent_bachelors_at_other_institution_locale",
    "most_recent_bachelors_at_other_institution_state",
    "most_recent_last_enrollment_at_other_institution_carnegie",
    "most_recent_last_enrollment_at_other_institution_locale",
    "most_recent_last_enrollment_at_other_institution_state",
    "naspa_first_generation",
    "time_to_credential",
]
#: Columns that older cohort files lack.
COHORT_ADDS = {
    "first_year_to_associates_at_cohort_inst": "short",
    "first_year_to_associates_at_other_inst": "short",
    "first_year_to_certificate_at_cohort_inst": "short",
    "first_year_to_certificate_at_other_inst": "short",
    "years_to_latest_associates_at_cohort_inst": "short",
    "years_to_latest_associates_at_other_inst": "short",
    "years_to_latest_certificate_at_cohort_inst": "short",
    "years_to_latest_certificate_at_other_inst": "short",
}
#: Columns of the raw course table that features don't use.
COURSE_DROPS = [
    "cohort",
    "cohort_term",
    "core_competency_completed",
    "core_course_type",
    "course_name",
    "credential_engine_identifier",
    "enrollment_record_at_other_institution_s_carnegie_s",
    "enrollment_record_at_other_institution_s_locale_s",
    "enrollment_record_at_other_institution_s_state_s",
    "ethnicity",
    "gender",
    "race",
    "student_age",
]
#: Columns that must not be features: keys, inputs of other features, and outcomes.
LABELED_DROPS = [
    "academic_year",
    "cohort",
    "cohort_id",
    "cohort_start_dt",
    "course_ids",
    "course_subject_areas",
    "course_subjects",
    "first_year_to_associates_at_cohort_inst",
    "first_year_to_associates_at_other_inst",
    "first_year_to_associates_or_certificate_at_cohort_inst",
    "first_year_to_associates_or_certificate_at_other_inst",
    "first_year_to_bachelor_at_other_inst",
    "first_year_to_bachelors_at_cohort_inst",
    "institution_id",
    "min_student_term_rank",
    "min_student_term_rank_core",
    "min_student_term_rank_noncore",
    "pell_status_first_year",
    "persistence",
    "retention",
    "sections_num_students_completed",
    "sections_num_students_enrolled",
    "sections_num_students_passed",
    "term_id",
    "term_is_core",
    "term_is_noncore",
    "term_rank",
    "term_rank_core",
    "term_rank_noncore",
    "term_start_dt",
    "years_of_last_enrollment_at_cohort_institution",
    "years_of_last_enrollment_at_other_institution",
    "years_to_associates_or_certificate_at_cohort_inst",
    "years_to_associates_or_certificate_at_other_inst",
    "years_to_bachelor_at_other_inst",
    "years_to_bachelors_at_cohort_inst",
    "years_to_latest_associates_at_cohort_inst",
    "years_to_latest_associates_at_other_inst",
]


def drop_columns_safely(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        LOG.info("no such columns to drop: %s", missing)
    return df.drop(*columns)


def add_empty_columns(df: DataFrame, kinds: dict[str, str], values: dict[str, object] | None = None) -> DataFrame:
    """Typed constant columns (null by default) where there is none of that name."""
    return df.withColumns({c: F.lit((values or {}).get(c)).cast(k) for c, k in kinds.items() if c not in df.columns})


def drop_missing_identifiers(df: DataFrame) -> DataFrame:
    return df.where(F.col("course_prefix").isNotNull() & F.col("course_number").isNotNull())


def standardize_cohort(df: DataFrame) -> DataFrame:
    return add_empty_columns(drop_columns_safely(df, COHORT_DROPS), COHORT_ADDS)


def standardize_course(df: DataFrame) -> DataFrame:
    return add_empty_columns(drop_columns_safely(drop_missing_identifiers(df), COURSE_DROPS), {"term_program_of_study": "string"})


def null_future_values(df: DataFrame, *, credits_col: str = "cumsum_num_credits_earned", credits: int = 12, year_col: str = "year_of_enrollment_at_cohort_inst", terms_col: str = "cumnum_terms_enrolled") -> DataFrame:
    """Null what a student could not have by this term, by the columns' names, and drop LABELED_DROPS.

    A condition that is null masks too. A name that fits several rules is masked by each.
    """

    def keep(c: str) -> Column | None:
        conds = []
        if re.search(rf"in_{credits}_creds", c):
            conds.append(F.col(credits_col) >= credits)
        if re.match(r"first_year_to_certificate|years_to_latest_certificate", c):
            conds.append(F.col(c) < F.col(year_col))
        if m := re.search(r"_year_(\d)$", c):
            conds.append(F.col(year_col) > int(m[1]))
        if m := re.search(r"_term_(\d)$", c):
            conds.append(F.col(terms_col) >= int(m[1]))
        out = None
        for cond in conds:
            out = cond if out is None else out & cond
        return out

    kept = [c for c in df.columns if c not in LABELED_DROPS]
    return df.select(*[F.when(cond, F.col(c)).alias(c) if (cond := keep(c)) is not None else F.col(c) for c in kept])


def dedupe_renumber_courses(df: DataFrame, *, student_id_col: str = "student_id") -> DataFrame:
    """Rows that share the six keys of a course get "-1", "-2", ... after the number, most credits first; others stay."""
    from pyspark.sql import Window

    keys = [student_id_col, "academic_year", "academic_term", "course_prefix", "course_number", "section_id"]
    w = Window.partitionBy(*keys)
    rest = [c for c in df.columns if c not in keys and c != "number_of_credits_attempted"]
    place = F.row_number().over(w.orderBy(F.desc_nulls_last("number_of_credits_attempted"), *rest))
    number = F.when(F.count("*").over(w) > 1, F.concat(F.col("course_number"), F.lit("-"), place.cast("string"))).otherwise(F.col("course_number"))
    return df.withColumn("course_number", number)


def remove_pre_cohort_courses(course: DataFrame, cohort: DataFrame, *, student_id_col: str = "student_id") -> DataFrame:
    """Courses from the student's cohort term on; students without a cohort are dropped."""
    from quadrangle.functions.columns import term_ordinal

    starts = cohort.select(F.col(student_id_col).alias("__id"), F.col("cohort").alias("__cohort"), term_ordinal(F.col("cohort_term")).alias("__term"))
    j = course.join(starts, course[student_id_col] == starts["__id"], "left")
    later = (F.col("academic_year") > F.col("__cohort")) | ((F.col("academic_year") == F.col("__cohort")) & (term_ordinal(F.col("academic_term")) >= F.col("__term")))
    return j.where(later).drop("__id", "__cohort", "__term")
