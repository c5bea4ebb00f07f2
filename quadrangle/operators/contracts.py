"""Data contracts: one scan counts what fails, per check and column; nothing crashes on dirty values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.functions.names import normalize_columns
from quadrangle.operators.distincts import distinct_counts, distinct_values


@dataclass(frozen=True)
class Field:
    """A column of a contract. checks: name to arguments, of isin, ge, gt, le, in_range, str_length."""

    kind: str
    nullable: bool = True
    required: bool = True
    checks: dict = field(default_factory=dict)
    severity: str = "error"
    aliases: tuple[str, ...] = ()


#: Checks by name: the column, cast, and arguments give whether a value is right.
CHECKS = {
    "isin": lambda c, values: c.isin(list(values)),
    "ge": lambda c, low: c >= low,
    "gt": lambda c, low: c > low,
    "le": lambda c, high: c <= high,
    "in_range": lambda c, bounds: c.between(*bounds),
    "str_length": lambda c, bounds: F.length(c.cast("string")).between(*bounds),
}
_YEARS, _MONEY, _GPA, _CREDITS = {"in_range": (0, 8)}, {"ge": 0}, {"in_range": (0, 4)}, {"in_range": (0, 20)}
_TERMS, _YN, _PLACED = {"isin": ("FALL", "WINTER", "SPRING", "SUMMER")}, {"isin": ("Y", "N")}, {"isin": ("C", "N")}


#: The raw cohort contract, column by column in the order of the file.
COHORT: dict[str, Field] = {
    "student_id": Field("string", nullable=False),
    "institution_id": Field("string", nullable=False),
    "cohort": Field("string", nullable=False),
    "cohort_term": Field("string", nullable=False, checks=_TERMS),
    "enrollment_type": Field("string", nullable=False, checks={"isin": ("FIRST-TIME", "RE-ADMIT", "TRANSFER-IN")}),
    "enrollment_intensity_first_term": Field("string", checks={"isin": ("FULL-TIME", "PART-TIME")}),
    "math_placement": Field("string", checks=_PLACED),
    "english_placement": Field("string", checks=_PLACED),
    "dual_and_summer_enrollment": Field("string", checks={"isin": ("DE", "SE", "DS")}),
    "student_age": Field("string"),
    "race": Field("string"),
    "ethnicity": Field("string"),
    "gender": Field("string"),
    "first_gen": Field("string"),
    "pell_status_first_year": Field("string", checks=_YN),
    "attendance_status_term_1": Field("string"),
    "credential_type_sought_year_1": Field("string"),
    "program_of_study_term_1": Field("string"),
    "gpa_group_term_1": Field("float", checks=_GPA),
    "gpa_group_year_1": Field("float", checks=_GPA),
    "number_of_credits_attempted_year_1": Field("float", checks={"ge": 1}, severity="warning"),
    "number_of_credits_earned_year_1": Field("float", checks=_MONEY),
    "number_of_credits_attempted_year_2": Field("float", checks=_MONEY),
    "number_of_credits_earned_year_2": Field("float", checks=_MONEY),
    "number_of_credits_attempted_year_3": Field("float", checks=_MONEY),
    "number_of_credits_earned_year_3": Field("float", checks=_MONEY),
    "number_of_credits_attempted_year_4": Field("float", checks=_MONEY),
    "number_of_credits_earned_year_4": Field("float", checks=_MONEY),
    "gateway_math_status": Field("string", checks={"isin": ("R", "N")}),
    "gateway_english_status": Field("string", checks={"isin": ("R", "N")}),
    "attempted_gateway_math_year_1": Field("string", checks=_YN),
    "attempted_gateway_english_year_1": Field("string", checks=_YN),
    "completed_gateway_math_year_1": Field("string", checks={"isin": ("C", "D", "NA")}),
    "completed_gateway_english_year_1": Field("string", checks={"isin": ("C", "D", "NA")}),
    "gateway_math_grade_y_1": Field("string"),
    "gateway_english_grade_y_1": Field("string"),
    "attempted_dev_math_y_1": Field("string", checks={"isin": ("Y", "N", "NA")}),
    "attempted_dev_english_y_1": Field("string", checks={"isin": ("Y", "N", "NA")}),
    "completed_dev_math_y_1": Field("string", checks={"isin": ("Y", "N", "NA")}),
    "completed_dev_english_y_1": Field("string", checks={"isin": ("Y", "N", "NA")}),
    "retention": Field("boolean", nullable=False),
    "persistence": Field("boolean", nullable=False),
    "years_to_bachelors_at_cohort_inst": Field("short", checks=_YEARS),
    "years_to_associates_or_certificate_at_cohort_inst": Field("short", checks=_YEARS),
    "years_to_bachelor_at_other_inst": Field("short", checks=_YEARS),
    "years_to_associates_or_certificate_at_other_inst": Field("short", checks=_YEARS),
    "years_of_last_enrollment_at_cohort_institution": Field("int", nullable=False, checks=_YEARS),
    "years_of_last_enrollment_at_other_institution": Field("int", nullable=False, checks=_YEARS),
    "time_to_credential": Field("float"),
    "reading_placement": Field("string", required=False, checks=_PLACED),
    "special_program": Field("string", required=False),
    "naspa_first_generation": Field("string", required=False, checks={"isin": ("-1", "0", "1", "2", "3", "4", "5", "6")}),
    "incarcerated_status": Field("string", required=False, checks={"isin": ("Y", "P", "N")}),
    "military_status": Field("string", required=False, checks={"isin": ("0", "1", "2")}),
    "employment_status": Field("string", required=False, checks={"isin": ("-1", "0", "1", "2", "3", "4")}),
    "disability_status": Field("string", required=False, checks=_YN),
    "foreign_language_completion": Field("string", required=False),
    "first_year_to_bachelors_at_cohort_inst": Field("short", checks=_YEARS),
    "first_year_to_associates_or_certificate_at_cohort_inst": Field("short", checks=_YEARS),
    "first_year_to_bachelor_at_other_inst": Field("short", checks=_YEARS),
    "first_year_to_associates_or_certificate_at_other_inst": Field("short", checks=_YEARS),
    "program_of_study_year_1": Field("string"),
    "most_recent_bachelors_at_other_institution_state": Field("string"),
    "most_recent_associates_or_certificate_at_other_institution_state": Field("string"),
    "most_recent_last_enrollment_at_other_institution_state": Field("string"),
    "first_bachelors_at_other_institution_state": Field("string"),
    "first_associates_or_certificate_at_other_institution_state": Field("string"),
    "most_recent_bachelors_at_other_institution_carnegie": Field("string"),
    "most_recent_associates_or_certificate_at_other_institution_carnegie": Field("string"),
    "most_recent_last_enrollment_at_other_institution_carnegie": Field("string"),
    "first_bachelors_at_other_institution_carnegie": Field("string"),
    "first_associates_or_certificate_at_other_institution_carnegie": Field("string"),
    "most_recent_bachelors_at_other_institution_locale": Field("string"),
    "most_recent_associates_or_certificate_at_other_institution_locale": Field("string"),
    "most_recent_last_enrollment_at_other_institution_locale": Field("string"),
    "first_bachelors_at_other_institution_locale": Field("string"),
    "first_associates_or_certificate_at_other_institution_locale": Field("string"),
    "years_to_latest_associates_at_cohort_inst": Field("short", required=False, checks=_YEARS),
    "years_to_latest_certificate_at_cohort_inst": Field("short", required=False, checks=_YEARS),
    "years_to_latest_associates_at_other_inst": Field("short", required=False, checks=_YEARS),
    "years_to_latest_certificate_at_other_inst": Field("short", required=False, checks=_YEARS),
    "first_year_to_associates_at_cohort_inst": Field("short", required=False, checks=_YEARS),
    "first_year_to_certificate_at_cohort_inst": Field("short", required=False, checks=_YEARS),
    "first_year_to_associates_at_other_inst": Field("short", required=False, checks=_YEARS),
    "first_year_to_certificate_at_other_inst": Field("short", required=False, checks=_YEARS),
}
#: The raw course contract.
COURSE: dict[str, Field] = {
    "student_id": Field("string", nullable=False),
    "institution_id": Field("string", nullable=False),
    "student_age": Field("string"),
    "race": Field("string"),
    "ethnicity": Field("string"),
    "gender": Field("string"),
    "cohort": Field("string", nullable=False),
    "cohort_term": Field("string", nullable=False, checks=_TERMS),
    "academic_year": Field("string"),
    "academic_term": Field("string", checks=_TERMS),
    "course_prefix": Field("string"),
    "course_number": Field("string"),
    "section_id": Field("string"),
    "course_name": Field("string"),
    "course_cip": Field("string"),
    "course_type": Field("string", checks={"isin": ("CU", "CG", "CC", "CD", "EL", "AB", "GE", "NC", "O")}),
    "math_or_english_gateway": Field("string", checks={"isin": ("E", "M", "NA")}),
    "co_requisite_course": Field("string", checks=_YN),
    "course_begin_date": Field("timestamp"),
    "course_end_date": Field("timestamp"),
    "grade": Field("string"),
    "number_of_credits_attempted": Field("float", checks=_CREDITS),
    "number_of_credits_earned": Field("float", checks=_CREDITS),
    "delivery_method": Field("string", checks={"isin": ("F", "O", "H")}),
    "core_course": Field("string", checks=_YN),
    "core_course_type": Field("string"),
    "core_competency_completed": Field("string", checks=_YN),
    "enrolled_at_other_institution_s": Field("string", checks=_YN),
    "credential_engine_identifier": Field("string", required=False),
    "course_instructor_employment_status": Field("string", required=False, checks={"isin": ("PT", "FT")}),
    "course_instructor_rank": Field("string", required=False, checks={"isin": ("1", "2", "3", "4", "5", "6", "7")}),
    "enrollment_record_at_other_institution_s_state_s": Field("string"),
    "enrollment_record_at_other_institution_s_carnegie_s": Field("string"),
    "enrollment_record_at_other_institution_s_locale_s": Field("string"),
    "term_program_of_study": Field("string", required=False),
}
COURSE_KEY = ("student_id", "academic_year", "academic_term", "course_prefix", "course_number", "section_id")
#: Courses of a term that are counted, and those of optional columns.
COUNTED = [
    "passed", "completed", "enrolled_at_other_institution_s_y", "course_type_cc_cd", "course_type_cu", "course_type_cg", "course_type_cc",
    "course_type_cd", "course_type_el", "course_type_ab", "course_type_ge", "course_type_nc", "course_type_o", "delivery_method_f",
    "delivery_method_o", "delivery_method_h", "math_or_english_gateway_m", "math_or_english_gateway_e", "math_or_english_gateway_na",
    "co_requisite_course_y", "co_requisite_course_n", "course_instructor_employment_status_pt", "course_instructor_employment_status_ft",
    "course_instructor_rank_1", "course_instructor_rank_2", "course_instructor_rank_3", "course_instructor_rank_4", "course_instructor_rank_5",
    "course_instructor_rank_6", "course_instructor_rank_7", "course_level_1", "course_grade_a", "grade_is_failing_or_withdrawal",
    "grade_above_section_avg",
]
COUNTED_OPTIONAL = ["core_course_y", "core_course_n"]
#: The contract of student-terms. Columns of the cohort table keep its rules, but for the nulls named here.
STUDENT_TERM: dict[str, Field] = {
    "student_id": Field("string", nullable=False),
    "term_id": Field("string", nullable=False),
    "institution_id": Field("string", nullable=False),
    "academic_year": Field("string", nullable=False),
    "academic_term": Field("string", nullable=False, checks=_TERMS),
    "term_start_dt": Field("timestamp", nullable=False),
    "term_rank": Field("short", nullable=False),
    "term_in_peak_covid": Field("boolean", nullable=False),
    "term_rank_core": Field("short"),
    "term_is_core": Field("boolean", nullable=False),
    "num_courses": Field("short", nullable=False, checks=_MONEY),
    "num_credits_attempted": Field("float", nullable=False),
    "num_credits_earned": Field("float", nullable=False, checks=_MONEY),
    "course_id_nunique": Field("short"),
    "course_subject_nunique": Field("short"),
    "course_subject_area_nunique": Field("short"),
    "course_level_mean": Field("float"),
    "course_level_std": Field("float"),
    "course_grade_numeric_mean": Field("float"),
    "course_grade_numeric_std": Field("float"),
    "section_num_students_enrolled_mean": Field("float"),
    "section_num_students_enrolled_std": Field("float"),
    "sections_num_students_enrolled": Field("int", nullable=False),
    "sections_num_students_passed": Field("int", nullable=False),
    "sections_num_students_completed": Field("int", nullable=False),
    **{f"num_courses_{c}": Field("short", nullable=False) for c in COUNTED},
    **{f"num_courses_{c}": Field("short", nullable=False, required=False) for c in COUNTED_OPTIONAL},
    "cohort": Field("string", nullable=False),
    "cohort_term": Field("string", nullable=False, checks=_TERMS),
    "enrollment_type": Field("string", checks={"isin": ("FIRST-TIME", "RE-ADMIT", "TRANSFER-IN")}),
    "enrollment_intensity_first_term": Field("string", checks={"isin": ("FULL-TIME", "PART-TIME")}),
    "math_placement": Field("string", checks=_PLACED),
    "english_placement": Field("string", checks=_PLACED),
    "reading_placement": Field("string", checks=_PLACED),
    "dual_and_summer_enrollment": Field("string", checks={"isin": ("DE", "SE", "DS")}),
    "student_age": Field("string", nullable=False),
    "race": Field("string", nullable=False),
    "ethnicity": Field("string", nullable=False),
    "first_gen": Field("string", nullable=False),
    "pell_status_first_year": Field("string"),
    **{c: Field("string", required=False) for c in ("special_program", "naspa_first_generation", "incarcerated_status", "military_status", "employment_status", "disability_status", "foreign_language_completion")},
    "credential_type_sought_year_1": Field("string"),
    "program_of_study_term_1": Field("string"),
    "program_of_study_year_1": Field("string"),
    "gpa_group_term_1": Field("float", checks=_GPA),
    "gpa_group_year_1": Field("float", checks=_GPA),
    **{c: Field("float", checks=_MONEY) for c in ("number_of_credits_earned_year_1", "number_of_credits_attempted_year_2", "number_of_credits_earned_year_2", "number_of_credits_attempted_year_3", "number_of_credits_earned_year_3", "number_of_credits_attempted_year_4", "number_of_credits_earned_year_4")},
    "cohort_id": Field("string", nullable=False),
    "cohort_start_dt": Field("timestamp", nullable=False),
    "student_program_of_study_area_term_1": Field("string"),
    "student_program_of_study_area_year_1": Field("string"),
    "student_program_of_study_area_changed_term_1_to_year_1": Field("boolean"),
    "diff_gpa_term_1_to_year_1": Field("float"),
    **{f"frac_credits_earned_year_{y}": Field("float") for y in (1, 2, 3, 4)},
    "year_of_enrollment_at_cohort_inst": Field("short", nullable=False),
    "term_is_while_student_enrolled_at_other_inst": Field("boolean", nullable=False),
    "frac_credits_earned": Field("float"),
    "num_courses_diff_prev_term": Field("short"),
    "num_credits_earned_diff_prev_term": Field("float"),
    "course_grade_numeric_mean_diff_prev_term": Field("float"),
    "num_courses_diff_term_1_to_term_2": Field("short"),
    "num_credits_earned_diff_term_1_to_term_2": Field("float"),
    "course_grade_numeric_mean_diff_term_1_to_term_2": Field("float"),
    "student_term_enrollment_intensity": Field("string", nullable=False, checks={"isin": ("FULL-TIME", "PART-TIME")}),
    **{f"frac_courses_{c}": Field("float", nullable=False, checks={"in_range": (0, 1)}) for c in COUNTED},
    **{f"frac_courses_{c}": Field("float", nullable=False, required=False, checks={"in_range": (0, 1)}) for c in COUNTED_OPTIONAL},
}
LABELED: dict[str, Field] = {"student_id": Field("string", nullable=False), "target": Field("boolean", nullable=False), "split": Field("string", required=False, checks={"isin": ("train", "test", "validate")})}


def compile_contract(contract: dict[str, Field], columns: Sequence[str]) -> list[tuple[str, str, str, Column]]:
    """(check, column, severity, failed) for the columns that there are; a failed check is true, never null."""
    out = []
    for name, f in contract.items():
        if name not in columns:
            continue
        raw, cast = F.col(f"`{name}`"), F.col(f"`{name}`").try_cast(f.kind)
        out.append(("kind", name, "error", raw.isNotNull() & cast.isNull()))
        if not f.nullable:
            out.append(("not_null", name, "error", raw.isNull()))
        for check, args in f.checks.items():
            out.append((check, name, f.severity, F.coalesce(~CHECKS[check](cast, args), F.lit(False))))
    return out


def violations(df: DataFrame, contract: dict[str, Field], *, unique: Sequence[str] = (), extra: Sequence[tuple[str, str, str, Column]] = ()) -> DataFrame:
    """(check, column, severity, n_failed) of every check, of missing required columns, and of keys that repeat."""
    checks = [*compile_contract(contract, df.columns), *extra]
    missing = [c for c, f in contract.items() if f.required and c not in df.columns]
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(cond).alias(f"f{k}") for k, (*_, cond) in enumerate(checks)])
    rows = [F.struct(F.lit(a).alias("check"), F.lit(b).alias("column"), F.lit(s).alias("severity"), F.col(f"f{k}").alias("n_failed")) for k, (a, b, s, _) in enumerate(checks)]
    rows += [F.struct(F.lit("missing").alias("check"), F.lit(c).alias("column"), F.lit("error").alias("severity"), F.col("n").alias("n_failed")) for c in missing]
    out = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if unique:
        twice = repeated_keys(df, unique).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_failed"))
        out = out.unionByName(twice.select(F.lit("unique").alias("check"), F.lit(",".join(unique)).alias("column"), F.lit("error").alias("severity"), "n_failed"))
    return out


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def more_earned_than_attempted(earned: str = "number_of_credits_earned", attempted: str = "number_of_credits_attempted") -> Column:
    return F.coalesce(F.col(attempted) < F.col(earned), F.lit(False))


def validate_dataset(df: DataFrame, contract: dict[str, Field]) -> DataFrame:
    """One row: status, extra, missing_required, missing_optional, failed_required, failed_optional (comma-joined names).

    hard_error: extra or missing required columns, or a failed required column;
    passed_with_soft_errors: only optional columns are missing or failed.
    """
    df = normalize_columns(df)
    known = {a: c for c, f in contract.items() for a in (c, *f.aliases)}
    df = df.withColumnsRenamed({a: c for a, c in known.items() if a in df.columns and a != c})
    extra = sorted(set(df.columns) - set(contract))
    missing = {k: sorted(c for c, f in contract.items() if f.required == k and c not in df.columns) for k in (True, False)}
    failed = violations(df, {c: f for c, f in contract.items() if c in df.columns}).where("n_failed > 0 and severity = 'error'").select("column").distinct()
    required = [c for c, f in contract.items() if f.required]
    names = failed.agg(F.array_sort(F.collect_set(F.when(F.col("column").isin(required), F.col("column")))).alias("r"), F.array_sort(F.collect_set(F.when(~F.col("column").isin(required), F.col("column")))).alias("o"))
    hard = F.lit(bool(extra or missing[True])) | (F.size("r") > 0)
    soft = F.lit(bool(missing[False])) | (F.size("o") > 0)
    return names.select(
        F.when(hard, "hard_error").when(soft, "passed_with_soft_errors").otherwise("passed").alias("status"),
        F.lit(",".join(extra)).alias("extra"), F.lit(",".join(missing[True])).alias("missing_required"), F.lit(",".join(missing[False])).alias("missing_optional"),
        F.array_join("r", ",").alias("failed_required"), F.array_join("o", ",").alias("failed_optional"),
    )


def infer_contract(df: DataFrame, *, most: int = 10) -> DataFrame:
    """(column, kind, nullable, categories) of every column: 2 to `most` distinct values make a category; numbers are float64, at least 0.

    Tasks stop sending a column's values once they know more than `most`.
    """
    values = distinct_values(df, limit=most + 1)
    counts = values.groupBy("column").agg(F.count("value").alias("n"), F.bool_or(F.col("value").isNull()).alias("nullable"))
    few = values.join(F.broadcast(counts.where(F.col("n").between(2, most)).select("column")), "column")  # names of columns
    sets = few.groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("categories"))

    def kind(t: str) -> str:
        return "boolean" if t == "boolean" else "datetime64[ns]" if t in ("date", "timestamp") else "float64" if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal") else "string"

    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kind(t)).alias("plain")) for c, t in df.dtypes])).alias("e")).select("e.*")
    out = every.join(counts, "column", "left").join(sets, "column", "left")
    return out.select("column", F.when(F.col("categories").isNotNull(), "category").otherwise(F.col("plain")).alias("kind"), F.coalesce("nullable", F.lit(False)).alias("nullable"), "categories")


def profile(df: DataFrame) -> DataFrame:
    """(column, n, nulls, zeros, n_distinct, mean, sd, low, high) of every column, from one aggregate and one pass for distinct values."""
    rows = []
    for c, t in df.dtypes:
        x = F.col(f"`{c}`")
        number = t in ("tinyint", "smallint", "int", "bigint", "float", "double")
        v = x.cast("double") if number else F.lit(None).cast("double")
        rows.append((c, [F.count(x), F.count_if(x.isNull()), F.count_if(v == 0), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v)]))
    flat = df.agg(*[a.alias(f"a{i}_{j}") for i, (_, aggs) in enumerate(rows) for j, a in enumerate(aggs)])
    names = ["n", "nulls", "zeros", "mean", "sd", "low", "high"]
    out = [F.struct(F.lit(c).alias("column"), *[F.col(f"a{i}_{j}").alias(m) for j, m in enumerate(names)]) for i, (c, _) in enumerate(rows)]
    plain = flat.select(F.explode(F.array(*out)).alias("r")).select("r.*")
    return plain.join(distinct_counts(df), "column").select("column", "n", "nulls", "zeros", "n_distinct", "mean", "sd", "low", "high")


def anomalies(stats: DataFrame, limits: DataFrame, *, fail: bool = False) -> DataFrame:
    """Columns of `stats` outside limits (column, max_null_share, low, high), with a reason; raises on any if `fail`."""
    j = stats.join(F.broadcast(limits.withColumnsRenamed({"low": "l_low", "high": "l_high"})), "column")  # one row per declared column
    share = F.try_divide(F.col("nulls"), F.col("n") + F.col("nulls"))
    reason = F.when(share > F.col("max_null_share"), "too many nulls").when(F.col("low") < F.col("l_low"), "below range").when(F.col("high") > F.col("l_high"), "above range")
    out = j.select("column", reason.alias("reason")).where("reason is not null")
    if fail and (rows := out.limit(20).collect()):
        raise ValueError(f"anomalies: {[tuple(r) for r in rows]}")
    return out


def validate_output(df: DataFrame, *, id_col: str = "student_id", importances: Sequence[str] = ("shap_value_1", "shap_value_2")) -> DataFrame:
    """One row of counts over a scored table: rows, repeated ids, importances out of order, values that are "nan"."""
    falls = F.lit(False)
    for a, b in zip(importances, importances[1:], strict=False):
        falls = falls | F.coalesce(F.abs(F.col(a).try_cast("double")) < F.abs(F.col(b).try_cast("double")), F.lit(False))
    nan = F.lit(False)
    for c in df.columns:
        nan = nan | F.coalesce(F.lower(F.col(f"`{c}`").cast("string")) == "nan", F.lit(False))
    return df.agg(F.count("*").alias("n_rows"), (F.count(id_col) - F.countDistinct(id_col)).alias("repeated_ids"), F.count_if(falls).alias("out_of_order"), F.count_if(nan).alias("nan_rows"))
