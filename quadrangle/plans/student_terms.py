"""From cohort and course rows to one row per student and term.

One shuffle each by section and by student-term, and one by student that the
join and all windows share. Terms are a dimension of some tens of rows: ranked
once, broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.functions import columns as C
from quadrangle.functions.names import snake_case_columns
from quadrangle.operators.cleaning import standardize_cohort, standardize_course

#: Values of one-hot columns where the data model declares them.
DECLARED = {
    "course_type": ["CU", "CG", "CC", "CD", "EL", "AB", "GE", "NC", "O"],
    "delivery_method": ["F", "O", "H"],
    "math_or_english_gateway": ["M", "E", "NA"],
    "co_requisite_course": ["Y", "N"],
    "course_instructor_employment_status": ["PT", "FT"],
    "course_instructor_rank": ["1", "2", "3", "4", "5", "6", "7"],
    "course_level": [0, 1, 2, 3, 4, 5, 6, 7, 8, 9],
    "course_grade": ["A", "B", "C", "D", "F", "P", "I", "W", "M", "AUDIT", "OTHER"],
}


def student_features(cohort: DataFrame, first_term: str = "FALL") -> DataFrame:
    have = cohort.columns
    new: dict[str, Column] = {
        "cohort_id": C.year_term(F.col("cohort"), F.col("cohort_term")),
        "cohort_start_dt": C.year_term_date(C.year_term(F.col("cohort"), F.col("cohort_term")), "start", first_term),
        "student_program_of_study_area_term_1": C.short_cip(F.col("program_of_study_term_1")),
        "student_program_of_study_area_year_1": C.short_cip(F.col("program_of_study_year_1")),
        "student_program_of_study_changed_term_1_to_year_1": F.col("program_of_study_term_1") != F.col("program_of_study_year_1"),
        "student_program_of_study_area_changed_term_1_to_year_1": C.short_cip(F.col("program_of_study_term_1")) != C.short_cip(F.col("program_of_study_year_1")),
        "student_is_pell_recipient_first_year": C.pell_flag(F.col("pell_status_first_year")),
        "diff_gpa_term_1_to_year_1": F.col("gpa_group_year_1") - F.col("gpa_group_term_1"),
    }
    for y in range(1, 5):
        earned, tried = f"number_of_credits_earned_year_{y}", f"number_of_credits_attempted_year_{y}"
        if earned in have and tried in have:
            new[f"frac_credits_earned_year_{y}"] = C.fraction(F.col(earned), F.col(tried))
    return cohort.withColumns(new)


def course_features(course: DataFrame, *, min_passing_grade: float = C.MIN_PASSING_GRADE, level_pattern: str = C.COURSE_LEVEL) -> DataFrame:
    grade = F.col("grade")
    return course.withColumns(
        {
            "course_id": C.course_id(F.col("course_prefix"), F.col("course_number")),
            "course_subject_area": C.short_cip(F.col("course_cip")),
            "course_passed": C.course_passed(grade, min_passing_grade),
            "course_completed": C.course_completed(grade),
            "course_level": C.course_level(F.col("course_number"), level_pattern),
            "course_grade_numeric": C.grade_numeric(grade),
            "course_grade": C.grade_letter(grade),
        }
    )


def term_dimension(course: DataFrame, *, first_term: str = "FALL", core: Sequence[str] = C.CORE_TERMS, covid=C.PEAK_COVID) -> DataFrame:
    """One row per term that occurs, ranked from 0; core and other terms are ranked among themselves as well."""
    terms = course.select("academic_year", "academic_term").where("academic_year is not null and academic_term is not null").distinct()
    terms = terms.withColumns({"__ord": C.term_ordinal(F.col("academic_term")), "term_is_core": C.in_subset(F.col("academic_term"), core)})
    order = Window.orderBy("academic_year", "__ord")  # over tens of rows

    def rank(among: Column) -> Column:
        return F.when(among, F.sum(among.cast("int")).over(order) - 1).cast("int")

    yt = C.year_term(F.col("academic_year"), F.col("academic_term"))
    return terms.select(
        "academic_year", "academic_term", yt.alias("term_id"), C.year_term_date(yt, "start", first_term).alias("term_start_dt"),
        rank(F.lit(True)).alias("term_rank"), rank(F.col("term_is_core")).alias("term_rank_core"), rank(~F.col("term_is_core")).alias("term_rank_noncore"),
        C.in_pairs(F.col("academic_year"), F.col("academic_term"), covid).alias("term_in_peak_covid"), "term_is_core", (~F.col("term_is_core")).alias("term_is_noncore"),
    )


def name_terms(course: DataFrame) -> DataFrame:
    """Rows of a term, with term_id: all that rows need of the term dimension before they are aggregated."""
    return course.withColumn("term_id", C.year_term(F.col("academic_year"), F.col("academic_term"))).where("term_id is not null")


def join_term_attributes(student_terms: DataFrame, terms: DataFrame) -> DataFrame:
    """Student-terms with all columns of the term dimension, by term_id."""
    return student_terms.join(F.broadcast(terms), "term_id")


def join_term_dimension(course: DataFrame, terms: DataFrame) -> DataFrame:
    return course.join(F.broadcast(terms), ["academic_year", "academic_term"])


def section_parts() -> dict[str, Column]:
    """The aggregates of a section, to be taken by any keys: students enrolled, passed, completed, and their mean grade."""
    return {
        "num_students_enrolled": F.count("student_id"), "num_students_passed": F.count_if("course_passed"), "num_students_completed": F.count_if("course_completed"),
        "course_grade_numeric_mean": F.avg(F.col("course_grade_numeric").cast("double")),
    }


def section_features(course: DataFrame, keys: Sequence[str] = ("term_id", "course_id", "section_id")) -> DataFrame:
    rows = course.where(" and ".join(f"{k} is not null" for k in keys))
    return rows.groupBy(*keys).agg(*[x.alias(f"section_{name}") for name, x in section_parts().items()])


def with_section_features(course: DataFrame, keys: Sequence[str] = ("term_id", "course_id", "section_id")) -> DataFrame:
    """course with the features of each row's section, as join_section_features(course, section_features(course)) has them; course is read once, and shuffled once."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # Rows of no section are dealt by student, so that they are no one group.
    section = Window.partitionBy(*keys, F.when(~known, F.xxhash64("student_id")))
    return course.withColumns({f"section_{name}": F.when(known, x.over(section)) for name, x in section_parts().items()})


def join_section_features(course: DataFrame, sections: DataFrame, keys: Sequence[str] = ("term_id", "course_id", "section_id")) -> DataFrame:
    return course.join(sections, list(keys), "left")


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def dummy_aggs(course: DataFrame, values: dict[str, Sequence] = DECLARED) -> list[Column]:
    """num_courses_{column}_{value} for the declared values of the columns that there are."""
    return [F.count_if(F.col(c) == F.lit(v)).alias(f"num_courses_{c}_{v}".lower()) for c, vs in values.items() if c in course.columns for v in vs]


def value_aggs(course: DataFrame, wanted: Sequence[tuple[str, object]]) -> list[Column]:
    out = []
    for c, v in wanted:
        if c in course.columns:
            vs = list(v) if isinstance(v, (list, tuple)) else [v]
            out.append(F.count_if(F.col(c).isin(vs)).alias(f"num_courses_{c}_{'_'.join(map(str, vs))}".lower()))
    return out


def grade_aggs(min_passing_grade: float = C.MIN_PASSING_GRADE) -> list[Column]:
    number = F.col("course_grade_numeric")
    failing = F.col("grade").isin("F", "W") | ((number >= 0) & (number < min_passing_grade))
    return [
        F.count_if(F.coalesce(failing, F.lit(False))).alias("num_courses_grade_is_failing_or_withdrawal"),
        F.count_if(F.coalesce(number.cast("double") > F.col("section_course_grade_numeric_mean"), F.lit(False))).alias("num_courses_grade_above_section_avg"),
    ]


#: Lists of a student-term, and the column of courses that each collects.
TAKEN = {"course_ids": "course_id", "course_subjects": "course_cip", "course_subject_areas": "course_subject_area"}


def mark_first_taken(course: DataFrame, *, ids: Sequence[str] = ("student_id", "institution_id")) -> DataFrame:
    """course with __new_{list}: whether a row is the first of its student with this value, by term; null is a value too.

    All windows sort within one partitioning by the first of ids, which the
    aggregate by student and term and all that follows need no second exchange
    for; sorts compare the first of ids first, so it should differ most. Rows
    without a term are no first ones.
    """
    place = [F.col("academic_year"), C.term_ordinal(F.col("academic_term"))]
    known = F.col("term_id").isNotNull()
    rows = course.repartition(ids[0])
    return rows.withColumns({f"__new_{many}": known & (F.row_number().over(Window.partitionBy(*ids, known, one).orderBy(*place)) == 1) for many, one in TAKEN.items()})


def count_first_taken(df: DataFrame, ids: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """df with __new_{list}: how many values of its lists a row is the first to have among its student's rows (for rows whose courses are not at hand)."""
    keyed = df.withColumns({"__row": F.monotonically_increasing_id(), "__place": F.struct(*order)})
    values = F.flatten(F.array(*[F.transform(many, lambda x, m=many: F.struct(F.lit(m).alias("list"), x.cast("string").alias("value"))) for many in TAKEN]))
    each = keyed.select(*ids, "__place", "__row", F.explode(values).alias("v")).groupBy(*ids, "v").agg(F.min(F.struct("__place", "__row")).alias("first"))
    counts = each.groupBy(F.col("first.__row").alias("__row")).agg(*[F.count_if(F.col("v.list") == many).alias(f"__new_{many}") for many in TAKEN])
    return keyed.join(counts, "__row", "left").withColumns({f"__new_{many}": F.coalesce(f"__new_{many}", F.lit(0)) for many in TAKEN}).drop("__row", "__place")


def aggregate_student_terms(course: DataFrame, *, keys: Sequence[str] = ("student_id", "term_id"), min_passing_grade: float = C.MIN_PASSING_GRADE, key_areas: Sequence[str] = (), key_courses: Sequence[str] = ()) -> DataFrame:
    """One grouped aggregate for all features; rows with a null key are dropped."""
    passed = ["institution_id", "academic_year", "academic_term", "term_start_dt", "term_rank", "term_rank_core", "term_rank_noncore", "term_is_core", "term_is_noncore", "term_in_peak_covid", "term_program_of_study"]
    number = F.col("course_grade_numeric").cast("double")
    key_values = [("course_subject_area", a) for a in key_areas] + [("course_id", c) for c in key_courses]
    aggs = [
        *[F.first(c, ignorenulls=True).alias(c) for c in passed if c in course.columns],
        F.count("course_id").alias("num_courses"), F.count_if("course_passed").alias("num_courses_passed"), F.count_if("course_completed").alias("num_courses_completed"),
        _total("number_of_credits_attempted").alias("num_credits_attempted"), _total("number_of_credits_earned").alias("num_credits_earned"),
        F.collect_list(F.struct("course_id", "course_cip", "course_subject_area")).alias("__taken"),
        F.avg("course_level").alias("course_level_mean"), F.stddev_samp("course_level").alias("course_level_std"), F.avg(number).alias("course_grade_numeric_mean"), F.stddev_samp(number).alias("course_grade_numeric_std"),
        F.avg("section_num_students_enrolled").alias("section_num_students_enrolled_mean"), F.stddev_samp("section_num_students_enrolled").alias("section_num_students_enrolled_std"),
        *[_total(f"section_num_students_{x}").alias(f"sections_num_students_{x}") for x in ("enrolled", "passed", "completed")],
        *value_aggs(course, [("core_course", "Y"), ("course_type", ["CC", "CD"]), ("course_level", [0, 1]), ("enrolled_at_other_institution_s", "Y"), *key_values]),
        *dummy_aggs(course), *grade_aggs(min_passing_grade),
        *[F.count_if(f"__new_{many}").alias(f"__new_{many}") for many in TAKEN if f"__new_{many}" in course.columns],
    ]
    grouped = course.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(*aggs)
    # All values, nulls and repeats too, in a fixed order.
    grouped = grouped.withColumns({many: F.array_sort(F.col(f"__taken.{one}")) for many, one in TAKEN.items()}).drop("__taken")
    # From the lists: distinct counts among the aggregates would multiply every row before the shuffle.
    distinct = {f"{one}_nunique": F.size(F.array_distinct(F.array_compact(many))).cast("long") for one, many in (("course_id", "course_ids"), ("course_subject", "course_subjects"), ("course_subject_area", "course_subject_areas"))}
    grouped = grouped.withColumns(distinct)
    took = {c.replace("num_courses_", "took_", 1): F.col(c) >= 1 for c in grouped.columns if c.startswith(("num_courses_course_id", "num_courses_course_subject_area"))}
    return grouped.withColumns(took) if took else grouped


def join_student_terms(student_terms: DataFrame, students: DataFrame) -> DataFrame:
    """Rows meet by student alone, so that student-terms stay where they are; of these, those of one institution are joined."""
    a, b = student_terms.alias("a"), students.withColumnRenamed("institution_id", "__inst").alias("b")
    same = F.col("a.institution_id").between(F.col("b.__inst"), F.col("b.__inst"))  # an equality would be a key of the shuffle
    joined = a.join(b, (F.col("a.student_id") == F.col("b.student_id")) & same)
    first = ["institution_id", "student_id"]
    return joined.select(*[F.col(f"a.`{c}`") for c in [*first, *[c for c in student_terms.columns if c not in first]]], *[F.col(f"b.`{c}`") for c in students.columns if c not in first])


def student_term_features(df: DataFrame, *, full_time: float = C.FULL_TIME_CREDITS) -> DataFrame:
    return share_features(place_features(df, full_time=full_time))


def place_features(df: DataFrame, *, full_time: float = C.FULL_TIME_CREDITS) -> DataFrame:
    """Of student_term_features those that later steps need, without the shares of courses."""
    have = set(df.columns)
    first = {
        "year_of_enrollment_at_cohort_inst": C.year_of_enrollment(F.col("term_start_dt"), F.col("cohort_start_dt")),
        "term_is_pre_cohort": F.col("term_start_dt") < F.col("cohort_start_dt"),
        "frac_credits_earned": C.fraction(F.col("num_credits_earned"), F.col("num_credits_attempted")),
        "student_term_enrollment_intensity": C.enrollment_intensity(F.col("num_credits_attempted"), full_time),
        "num_courses_in_program_of_study_area_term_1": C.count_in_area(F.col("course_subject_areas"), F.col("student_program_of_study_area_term_1")),
        "num_courses_in_program_of_study_area_year_1": C.count_in_area(F.col("course_subject_areas"), F.col("student_program_of_study_area_year_1")),
    }
    if "num_courses_enrolled_at_other_institution_s_y" in have:
        first["term_is_while_student_enrolled_at_other_inst"] = F.col("num_courses_enrolled_at_other_institution_s_y") > 0
    if "term_program_of_study" in have:
        area = C.short_cip(F.col("term_program_of_study"))
        first |= {"term_program_of_study_area": area, "num_courses_in_term_program_of_study_area": C.count_in_area(F.col("course_subject_areas"), area)}
    df = df.withColumns(first)
    second = {}
    for inst in ("cohort", "other"):
        years = [f"{what}_certificate_at_{inst}_inst" for what in ("first_year_to", "years_to_latest")]
        if set(years) <= have:
            second[f"student_has_earned_certificate_at_{inst}_inst"] = C.before_year([F.col(y) for y in years], F.col("year_of_enrollment_at_cohort_inst"))
    for what, x in (("pass", "passed"), ("completion", "completed")):
        second[f"student_{what}_rate_above_sections_avg"] = _share_of_courses(f"num_courses_{x}") > _share_of_sections(x)
    return df.withColumns(second)


def _share_of_courses(c: str) -> Column:
    return C.guarded_fraction(F.col(c), F.col("num_courses"), c)


def _share_of_sections(x: str) -> Column:
    return C.guarded_fraction(F.col(f"sections_num_students_{x}"), F.col("sections_num_students_enrolled"), x)


def share_features(df: DataFrame, among: Sequence[str] | None = None) -> DataFrame:
    """df with the share of each of its numbers of courses (or of those among these columns), and of sections' students."""
    new = {c.replace("num_courses_", "frac_courses_", 1): _share_of_courses(c) for c in (df.columns if among is None else among) if c.startswith("num_courses_")}
    return df.withColumns(new | {f"frac_sections_students_{x}": _share_of_sections(x) for x in ("passed", "completed")})


def _windows(ids: Sequence[str], order: Sequence) -> tuple:
    part = Window.partitionBy(*ids)
    ordered = part.orderBy(*order)
    return part, ordered, ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)


#: Running aggregates of the cumulative block.
RUNNING = {
    "term_id": ("count",), "term_in_peak_covid": ("sum",), "term_is_core": ("sum",), "term_is_noncore": ("sum",), "term_is_while_student_enrolled_at_other_inst": ("sum",), "term_is_pre_cohort": ("sum",),
    "course_level_mean": ("mean", "min", "std"), "course_grade_numeric_mean": ("mean", "min", "std"), "num_courses": ("sum", "mean", "min"), "num_credits_attempted": ("sum", "mean", "min"), "num_credits_earned": ("sum", "mean", "min"),
    "student_pass_rate_above_sections_avg": ("sum",), "student_completion_rate_above_sections_avg": ("sum",),
}
RENAMED = {"cumcount_term_id": "cumnum_terms_enrolled", "cumsum_term_is_core": "cumnum_core_terms_enrolled", "cumsum_term_is_noncore": "cumnum_noncore_terms_enrolled"}
_FUNCTIONS = {"count": F.count, "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp}


def running_aggs(df: DataFrame, aggs: dict[str, Sequence[str]], over) -> dict[str, Column]:
    kinds = dict(df.dtypes)
    value = lambda c: F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)
    return {f"cum{f}_{c}": _FUNCTIONS[f](value(c)).over(over) for c, fs in aggs.items() if c in kinds for f in fs}


def cumulative_features(df: DataFrame, *, ids: Sequence[str] = ("student_id",), order: Sequence | None = None, credits: float = C.CREDIT_CHECK, max_term: int = 4) -> DataFrame:
    """Expanding aggregates, shares, unique and repeated courses, term differences: all over one partitioning by student.

    Rows of aggregate_student_terms(mark_first_taken(...)) know their first
    occurrences; for others they are counted from the lists.
    """
    order = order or [F.col("academic_year"), C.term_ordinal(F.col("academic_term"))]
    if f"__new_{next(iter(TAKEN))}" not in df.columns:
        df = count_first_taken(df, ids, order)
    part, ordered, running = _windows(ids, order)
    counts = [c for c in df.columns if c.startswith("num_courses_")]
    took = [c for c in df.columns if c.startswith("took_")]
    new = {RENAMED.get(k, k): v for k, v in running_aggs(df, RUNNING, running).items()}
    new |= {f"cumfrac_{c}": C.fraction(F.sum(c).over(running), F.sum("num_courses").over(running)) for c in counts}
    new |= {f"cummax_{c}": F.max(c).over(running) for c in took}
    for c in TAKEN:  # running sums of first occurrences
        unique = F.sum(f"__new_{c}").over(running)
        new |= {f"cumnum_unique_{c}": unique.cast("int"), f"cumnum_repeated_{c}": (F.sum(F.size(c)).over(running) - unique).cast("int")}
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # the same order: one operator for all
    new |= {f"min_student_{c}": F.min(c).over(whole) for c in ("term_rank", "term_rank_core", "term_rank_noncore")}
    diffs = [c for c in ("num_courses", "num_credits_earned", "course_grade_numeric_mean", "course_level_mean") if c in df.columns]
    new |= {f"{c}_diff_prev_term": F.col(c) - F.lag(c).over(ordered) for c in diffs}
    df = df.withColumns(new).drop(*[f"__new_{c}" for c in TAKEN])
    after = {f"cumfrac_{kind}terms_enrolled": C.fraction(F.when(F.col(rank).isNotNull(), F.col(f"cumnum_{kind}terms_enrolled")), F.col(rank) - F.col(f"min_student_{rank}") + 1) for kind, rank in (("", "term_rank"), ("core_", "term_rank_core"), ("noncore_", "term_rank_noncore"))}
    after |= {f"{c}_in_{credits:g}_creds": F.max(F.col(f"cummax_{c}") & (F.col("cumsum_num_credits_earned") <= credits)).over(part) for c in took}
    after |= {f"{c}_diff_term_{n - 1}_to_term_{n}": F.max(F.when(F.col("cumnum_terms_enrolled") == n, F.col(f"{c}_diff_prev_term"))).over(part) for c in diffs for n in range(2, max_term + 1)}
    return df.withColumns(after)


def student_term_dataset(cohort: DataFrame, course: DataFrame, *, min_passing_grade: float = C.MIN_PASSING_GRADE, full_time: float = C.FULL_TIME_CREDITS, level_pattern: str = C.COURSE_LEVEL, core: Sequence[str] = C.CORE_TERMS, covid=C.PEAK_COVID, first_term: str = "FALL", key_areas: Sequence[str] = (), key_courses: Sequence[str] = ()) -> DataFrame:
    students = student_features(standardize_cohort(cohort), first_term)
    rows = course_features(standardize_course(course), min_passing_grade=min_passing_grade, level_pattern=level_pattern)
    dimension = term_dimension(rows, first_term=first_term, core=core, covid=covid)
    rows = mark_first_taken(with_section_features(name_terms(rows)))
    terms = aggregate_student_terms(rows, min_passing_grade=min_passing_grade, key_areas=key_areas, key_courses=key_courses)
    terms = join_term_attributes(terms.drop("academic_year", "academic_term"), dimension)
    # Shares of courses come last: windows copy every column of their rows.
    joined = place_features(join_student_terms(terms, students), full_time=full_time)
    return snake_case_columns(share_features(cumulative_features(joined), joined.columns))
