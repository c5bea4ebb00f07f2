"""Registered queries: columns, filters, joins, aggregates and windows of the student-term plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.functions import columns as C
from quadrangle.functions import names
from quadrangle.operators import cleaning, selection
from quadrangle.plans import student_terms as S
from quadrangle.plans.oracle import CIP, LEVEL, LETTER, NUMERIC, ORD, PASSED, START, WHOLE
from quadrangle.plans.registry import Views, query

# --- one column over course or cohort rows -------------------------------------------------

#: name: (view, column, the same in SQL); lambdas because columns need a session.
SCALARS = {
    "upper_strings": ("course", lambda: C.upper_trim(F.concat(F.lit(" "), F.lower("course_prefix"))), "upper(trim(' '||lower(course_prefix)))"),
    "values_to_null": ("cohort", lambda: C.values_to_null(F.col("gender"), ["UK"]), "nullif(gender,'UK')"),
    "string_to_bool": ("course", lambda: C.string_to_bool(F.col("section_id")), "case section_id when '1' then true when '0' then false end"),
    "set_categories": ("course", lambda: C.in_categories(F.lower("delivery_method"), ["F", "O"]), "case when delivery_method in ('F','O') then delivery_method end"),
    "military_status_parse": ("course", lambda: C.military_status(F.col("grade")), "case when try_cast(grade as float) is not null and cast(trunc(cast(grade as float)) as int) in (0,1,2) then cast(cast(trunc(cast(grade as float)) as int) as varchar) end"),
    "zero_to_null": ("course", lambda: C.zero_to_null(F.col("l_linenumber") % 3), "nullif(l_linenumber%3,0)"),
    "year_term": ("course", lambda: C.year_term(F.col("academic_year"), F.col("academic_term")), "academic_year||' '||academic_term"),
    "year_term_date": ("course", lambda: C.year_term_date(C.year_term(F.col("academic_year"), F.col("academic_term"))), START.format(y="academic_year", t="academic_term")),
    "term_ordinal": ("course", lambda: C.term_ordinal(F.col("academic_term")), ORD.format(t="academic_term")),
    "course_id": ("course", lambda: C.course_id(F.col("course_prefix"), F.col("course_number")), "course_prefix||course_number"),
    "short_cip": ("course", lambda: C.short_cip(F.col("course_cip")), CIP.format(c="course_cip")),
    "course_passed": ("course", lambda: C.course_passed(F.col("grade")), PASSED),
    "course_completed": ("course", lambda: C.course_completed(F.col("grade")), "coalesce(grade not in ('I','W'), true)"),
    "course_level": ("course", lambda: C.course_level(F.col("course_number")), LEVEL),
    "course_grade_numeric": ("course", lambda: C.grade_numeric(F.col("grade")), f"r({NUMERIC})"),
    "course_grade_letter": ("course", lambda: C.grade_letter(F.col("grade")), LETTER),
    "program_changed": ("cohort", lambda: F.col("program_of_study_term_1") != F.col("program_of_study_year_1"), "program_of_study_term_1<>program_of_study_year_1"),
    "pell_flag": ("cohort", lambda: C.pell_flag(F.col("pell_status_first_year")), "case pell_status_first_year when 'Y' then true when 'N' then false end"),
    "gpa_diff": ("cohort", lambda: F.col("gpa_group_year_1") - F.col("gpa_group_term_1"), "r(gpa_group_year_1-gpa_group_term_1)"),
    "frac_credits": ("course", lambda: C.fraction(F.col("number_of_credits_earned"), F.col("number_of_credits_attempted")), "r(number_of_credits_earned/nullif(number_of_credits_attempted,0))"),
    "term_in_peak_covid": ("course", lambda: C.in_pairs(F.col("academic_year"), F.col("academic_term"), [("1999-00", "FALL"), ("2000-01", "SPRING")]), "(academic_year||' '||academic_term) in ('1999-00 FALL','2000-01 SPRING')"),
    "term_in_subset": ("course", lambda: C.in_subset(F.col("academic_term"), C.CORE_TERMS), "coalesce(academic_term in ('FALL','SPRING'),false)"),
    "value_equals": ("course", lambda: C.value_equals(F.col("delivery_method"), ["F", "H"]), "delivery_method in ('F','H')"),
}
for _name, (_view, _column, _text) in SCALARS.items():
    query(_name, f"select student_id, {_text} as value from v_{_view}")(lambda v, view=_view, column=_column: getattr(v, view)().select("student_id", column().alias("value")))

#: The same over student-term rows, from the plan's own columns.
TERM_COLUMNS = {
    "year_of_enrollment": ["year_of_enrollment_at_cohort_inst"],
    "term_is_pre_cohort": ["term_is_pre_cohort"],
    "enrollment_intensity": ["student_term_enrollment_intensity"],
    "frac_courses": ["frac_courses_passed"],
    "frac_sections": ["frac_sections_students_passed"],
}
for _name, _cols in TERM_COLUMNS.items():
    query(_name, f"select student_id, term_id, {', '.join(f'r({c}) as {c}' if c.startswith('frac') else c for c in _cols)} from stj")(lambda v, cols=_cols: v.stj().select("student_id", "term_id", *cols))


@query("above_section_rate", "select student_id, term_id, frac_courses_passed>frac_sections_students_passed as above from stj")
def _(v: Views) -> DataFrame:
    return v.stj().select("student_id", "term_id", F.col("student_pass_rate_above_sections_avg").alias("above"))


@query("earned_certificate", "select student_id, term_id, coalesce(first_year_to_bachelors_at_cohort_inst<year_of_enrollment_at_cohort_inst,false) as earned from stj")
def _(v: Views) -> DataFrame:
    return v.stj().select("student_id", "term_id", C.before_year([F.col("first_year_to_bachelors_at_cohort_inst")], F.col("year_of_enrollment_at_cohort_inst")).alias("earned"))


@query("enrolled_elsewhere", "select student_id, term_id, num_courses_delivery_method_o>0 as elsewhere from st")
def _(v: Views) -> DataFrame:
    return v.st().select("student_id", "term_id", (F.col("num_courses_delivery_method_o") > 0).alias("elsewhere"))


@query("courses_in_study_area", "select student_id, term_id, len(list_filter(course_subject_areas, lambda x: x=coalesce(area_term_1,'-1'))) as n from stj")
def _(v: Views) -> DataFrame:
    return v.stj().select("student_id", "term_id", F.col("num_courses_in_program_of_study_area_term_1").alias("n"))


@query("took_course_flags", "select student_id, term_id, took_course_subject_area_13 as took from st")
def _(v: Views) -> DataFrame:
    return v.st().select("student_id", "term_id", F.col("took_course_subject_area_13").alias("took"))


@query("student_features", "select student_id, cohort_id, cohort_start_dt, area_term_1, area_year_1, pell, r(diff_gpa) as diff_gpa from stu")
def _(v: Views) -> DataFrame:
    return v.students().select("student_id", "cohort_id", "cohort_start_dt", F.col("student_program_of_study_area_term_1").alias("area_term_1"), F.col("student_program_of_study_area_year_1").alias("area_year_1"), F.col("student_is_pell_recipient_first_year").alias("pell"), F.col("diff_gpa_term_1_to_year_1").alias("diff_gpa"))


@query("course_features", "select student_id, course_id, course_subject_area, course_passed, course_completed, course_level, r(course_grade_numeric) as course_grade_numeric, course_grade from crs")
def _(v: Views) -> DataFrame:
    return v.crs().select("student_id", "course_id", "course_subject_area", "course_passed", "course_completed", "course_level", "course_grade_numeric", "course_grade")


@query("student_term_features", "select student_id, term_id, year_of_enrollment_at_cohort_inst, term_is_pre_cohort, r(frac_credits_earned) as frac_credits_earned, student_term_enrollment_intensity, r(frac_courses_passed) as frac_courses_passed, r(frac_sections_students_passed) as frac_sections_students_passed from stj")
def _(v: Views) -> DataFrame:
    return v.stj().select("student_id", "term_id", "year_of_enrollment_at_cohort_inst", "term_is_pre_cohort", "frac_credits_earned", "student_term_enrollment_intensity", "frac_courses_passed", "frac_sections_students_passed")


@query("parse_dates", "select o_orderkey, cast(o_orderdate as date) as d from orders")
def _(v: Views) -> DataFrame:
    return v.table("orders").select("o_orderkey", C.parse_date(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd").cast("date").alias("d"))


# --- names and fixed lists of columns ------------------------------------------------------


@query("snake_case_columns", 'select c_custkey as customer_key, c_mktsegment as market_segment_0_1 from customer')
def _(v: Views) -> DataFrame:
    return names.snake_case_columns(v.table("customer").select(F.col("c_custkey").alias("CustomerKey"), F.col("c_mktsegment").alias("market_segment_0|1")))


@query("normalize_columns", "select c_custkey as customer_key, c_mktsegment as market_segment from customer")
def _(v: Views) -> DataFrame:
    return names.normalize_columns(v.table("customer").select(F.col("c_custkey").alias(" Customer Key "), F.col("c_mktsegment").alias("Market-Segment")))


@query("rename_mangled_columns", "select student_id, grade as gateway_math_grade_y_1, section_id as section from v_course")
def _(v: Views) -> DataFrame:
    return names.rename_mangled_columns(v.course().select("student_id", F.col("grade").alias("gatewaymathgradey_1"), "section_id"), {"section_id": "section"})


@query("rename_student_id", "select cast(c_custkey as varchar) as student_id from customer")
def _(v: Views) -> DataFrame:
    return names.rename_student_id(v.table("customer").select(F.col("c_custkey").alias("student_guid")))


@query("drop_columns_safely", "select student_id, grade from v_course")
def _(v: Views) -> DataFrame:
    return cleaning.drop_columns_safely(v.course().select("student_id", "grade", "section_id"), ["section_id", "not_there"])


@query("add_empty_columns", "select student_id, grade, cast(null as varchar) as term_program_of_study, 0 as extra from v_course")
def _(v: Views) -> DataFrame:
    return cleaning.add_empty_columns(v.course().select("student_id", "grade"), {"grade": "string", "term_program_of_study": "string", "extra": "int"}, {"extra": 0})


@query("standardize_cohort", f"select *, {', '.join(f'cast(null as smallint) as {c}' for c in cleaning.COHORT_ADDS)} from v_cohort".replace("select *", "select student_id, cohort, cohort_term"))
def _(v: Views) -> DataFrame:
    return cleaning.standardize_cohort(v.cohort().select("student_id", "cohort", "cohort_term", F.lit("x").alias("gateway_math_status")))


@query("standardize_course", "select student_id, course_prefix, course_number, cast(null as varchar) as term_program_of_study from v_course where course_prefix is not null and course_number is not null")
def _(v: Views) -> DataFrame:
    return cleaning.standardize_course(v.course().select("student_id", "course_prefix", "course_number", F.lit("x").alias("course_name")))


@query("null_future_values", "select student_id, term_id, case when cumsum_num_credits_earned>=12 then cummax_took end as took_in_12_creds, case when year_of_enrollment_at_cohort_inst>1 then gpa_group_year_1 end as gpa_group_year_1, case when cumnum_terms_enrolled>=1 then gpa_group_term_1 end as gpa_group_term_1, first_year_to_certificate_x from (select *, case when first_year_to_bachelors_at_cohort_inst<year_of_enrollment_at_cohort_inst then first_year_to_bachelors_at_cohort_inst end first_year_to_certificate_x from cum)".replace("gpa_group_year_1 end as", "r(gpa_group_year_1) end as").replace("gpa_group_term_1 end as", "r(gpa_group_term_1) end as"))
def _(v: Views) -> DataFrame:
    d = v.cum().withColumn("took_in_12_creds", F.col("cummax_took_course_subject_area_13")).withColumn("first_year_to_certificate_x", F.col("first_year_to_bachelors_at_cohort_inst"))
    masked = cleaning.null_future_values(d.withColumn("key", F.col("term_id")))
    return masked.select("student_id", F.col("key").alias("term_id"), "took_in_12_creds", "gpa_group_year_1", "gpa_group_term_1", "first_year_to_certificate_x")


# --- filters --------------------------------------------------------------------------------


@query("drop_missing_identifiers", "select student_id, course_prefix, course_number from v_course where course_prefix is not null and course_number is not null")
def _(v: Views) -> DataFrame:
    return cleaning.drop_missing_identifiers(v.course()).select("student_id", "course_prefix", "course_number")


@query("remove_pre_cohort_courses", f"select c.student_id, c.academic_year, c.academic_term, c.course_prefix from v_course c left join v_cohort h on c.student_id=h.student_id where academic_year>cohort or (academic_year=cohort and {ORD.format(t='academic_term')}>={ORD.format(t='cohort_term')})")
def _(v: Views) -> DataFrame:
    return cleaning.remove_pre_cohort_courses(v.course(), v.cohort()).select("student_id", "academic_year", "academic_term", "course_prefix")


@query("select_students", "select student_id, enrollment_type, gender from v_cohort where enrollment_type='FIRST-TIME' and gender in ('M','F')")
def _(v: Views) -> DataFrame:
    return selection.select_students(v.cohort(), enrollment_type="FIRST-TIME", gender=["M", "F"])


@query("selection_report", """with t as (select count(distinct student_id) n, count(distinct case when enrollment_type='FIRST-TIME' then student_id end) a, count(distinct case when gender in ('M','F') then student_id end) b, count(distinct case when enrollment_type='FIRST-TIME' and gender in ('M','F') then student_id end) c from v_cohort)
    select 'enrollment_type' as criterion, a as students, r(100.0*a/n) as pct from t union all select 'gender', b, r(100.0*b/n) from t union all select 'all', c, r(100.0*c/n) from t""".replace("with t as (", "select * from (with t as (").replace("from t union all select 'gender'", "from t union all select 'gender'") + ")")
def _(v: Views) -> DataFrame:
    return selection.selection_report(v.cohort(), enrollment_type="FIRST-TIME", gender=["M", "F"])


@query("filter_checkpoint_flags", "select student_id, term_id from stj where not term_is_pre_cohort and term_is_core")
def _(v: Views) -> DataFrame:
    return v.stj().where(~F.col("term_is_pre_cohort")).where("term_is_core").select("student_id", "term_id")


@query("latest_term_population", "select student_id, term_id from stj where term_rank=(select max(term_rank) from stj) and enrollment_type='FIRST-TIME'")
def _(v: Views) -> DataFrame:
    return selection.latest_term_population(v.stj(), selection.select_students(v.cohort(), enrollment_type="FIRST-TIME")).select("student_id", "term_id")


@query("filter_split", "select student_id, split from v_pred where split='train'")
def _(v: Views) -> DataFrame:
    return v.pred().where("split = 'train'").select("student_id", "split")


@query("high_risk_filter", "select student_id, r(pred_prob) as pred_prob from v_pred where pred_prob>=(select quantile_cont(pred_prob,0.9) from v_pred)")
def _(v: Views) -> DataFrame:
    return selection.above_quantile(v.pred(), "pred_prob", 0.9).select("student_id", "pred_prob")


# --- joins ----------------------------------------------------------------------------------


@query("join_student_terms", "select student_id, term_id, cohort_id, num_courses from stj")
def _(v: Views) -> DataFrame:
    return S.join_student_terms(v.st(), v.students()).select("student_id", "term_id", "cohort_id", "num_courses")


@query("join_term_dimension", "select student_id, course_id, term_id, term_rank from ct")
def _(v: Views) -> DataFrame:
    return v.ct().select("student_id", "course_id", "term_id", "term_rank")


@query("join_section_features", "select student_id, course_id, section_id, section_num_students_enrolled, r(section_course_grade_numeric_mean) as section_mean from cs")
def _(v: Views) -> DataFrame:
    return v.cs().select("student_id", "course_id", "section_id", "section_num_students_enrolled", F.col("section_course_grade_numeric_mean").alias("section_mean"))


@query("join_many", "select student_id, term_id, num_courses, num_courses_course_grade_a, num_courses_course_level_0_1, num_courses_grade_above_section_avg from st")
def _(v: Views) -> DataFrame:
    return v.st().select("student_id", "term_id", "num_courses", "num_courses_course_grade_a", "num_courses_course_level_0_1", "num_courses_grade_above_section_avg")


@query("join_outer_indicator", """select case when a.id is not null and b.id is not null then 'both' when a.id is not null then 'left_only' else 'right_only' end as _merge, count(*) as n
    from (select distinct student_id id from v_cohort where enrollment_type<>'RE-ADMIT') a full join (select distinct student_id id from v_course where delivery_method='F') b on a.id=b.id group by 1""")
def _(v: Views) -> DataFrame:
    return selection.outer_indicator(v.cohort().where("enrollment_type <> 'RE-ADMIT'").select("student_id").distinct(), v.course().where("delivery_method = 'F'").select("student_id").distinct(), ["student_id"]).groupBy("_merge").agg(F.count("*").alias("n"))


@query("join_semi_students", "select student_id from v_cohort where student_id in (select student_id from v_course where delivery_method='F')")
def _(v: Views) -> DataFrame:
    return v.cohort().join(v.course().where("delivery_method = 'F'"), "student_id", "left_semi").select("student_id")


@query("join_anti_students", "select distinct student_id, 'cohort' as only_in from v_cohort where student_id not in (select student_id from v_course where delivery_method='F') union all select distinct student_id, 'course' from v_course where delivery_method='F' and student_id not in (select student_id from v_cohort)")
def _(v: Views) -> DataFrame:
    a, b = v.cohort().select("student_id"), v.course().where("delivery_method = 'F'").select("student_id")
    return selection.only_in_one(a, b, "student_id", "cohort", "course")


@query("join_update", "select c.student_id, coalesce(case when h.gender<>'UK' then h.gender end, c.race) as race from v_cohort c left join v_cohort h on c.student_id=h.student_id")
def _(v: Views) -> DataFrame:
    new = v.cohort().select("student_id", C.values_to_null(F.col("gender"), ["UK"]).alias("race"))
    return selection.update_from(v.cohort().select("student_id", "race"), new, ["student_id"])


@query("join_scores", "select c.student_id, c.enrollment_type, r(p.pred_prob) as pred_prob from v_cohort c left join v_pred p on c.student_id=p.student_id")
def _(v: Views) -> DataFrame:
    return v.cohort().select("student_id", "enrollment_type").join(v.pred().select("student_id", "pred_prob"), "student_id", "left")


# --- aggregates -----------------------------------------------------------------------------

#: name: columns of the student-term aggregate, checked against the same step in SQL.
AGGREGATES = {
    "agg_student_term": ["num_courses", "num_courses_passed", "num_courses_completed", "num_credits_attempted", "num_credits_earned", "course_id_nunique", "course_level_mean", "course_grade_numeric_std", "num_courses_core_course_y", "num_courses_grade_is_failing_or_withdrawal"],
    "agg_passthrough": ["institution_id", "academic_year", "academic_term", "term_start_dt", "term_rank", "term_rank_core", "term_rank_noncore", "term_is_core", "term_is_noncore", "term_in_peak_covid"],
    "agg_num_courses": ["num_courses"],
    "agg_num_passed": ["num_courses_passed"],
    "agg_num_completed": ["num_courses_completed"],
    "agg_credits_attempted": ["num_credits_attempted"],
    "agg_credits_earned": ["num_credits_earned"],
    "agg_nunique": ["course_id_nunique", "course_subject_nunique", "course_subject_area_nunique"],
    "agg_level_stats": ["course_level_mean", "course_level_std"],
    "agg_grade_stats": ["course_grade_numeric_mean", "course_grade_numeric_std"],
    "agg_section_size_stats": ["section_num_students_enrolled_mean", "section_num_students_enrolled_std"],
    "agg_section_sums": ["sections_num_students_enrolled", "sections_num_students_passed", "sections_num_students_completed"],
    "agg_dummies": ["num_courses_delivery_method_f", "num_courses_delivery_method_o", "num_courses_delivery_method_h", "num_courses_course_grade_a", "num_courses_course_grade_f"],
    "agg_value_counts": ["num_courses_core_course_y", "num_courses_course_level_0_1", "num_courses_course_subject_area_13"],
    "agg_grade_flags": ["num_courses_grade_is_failing_or_withdrawal", "num_courses_grade_above_section_avg"],
}
_REAL = ("mean", "std", "credits")
for _name, _cols in AGGREGATES.items():
    query(_name, f"select student_id, term_id, {', '.join(f'r({c}) as {c}' if any(x in c for x in _REAL) else c for c in _cols)} from st")(lambda v, cols=_cols: v.st().select("student_id", "term_id", *cols))


@query("agg_collect_lists", "select student_id, term_id, array_to_string(course_ids,',') as course_ids, array_to_string(course_subjects,',') as course_subjects, len(course_subject_areas) as areas from st")
def _(v: Views) -> DataFrame:
    return v.st().select("student_id", "term_id", F.array_join("course_ids", ",").alias("course_ids"), F.array_join("course_subjects", ",").alias("course_subjects"), F.size("course_subject_areas").alias("areas"))


_SECTION = "select term_id, course_id, section_id, section_num_students_enrolled, section_num_students_passed, section_num_students_completed, r(section_course_grade_numeric_mean) as section_course_grade_numeric_mean from sec"
query("agg_section", _SECTION)(lambda v: S.section_features(v.ct()))


@query("agg_section_parts", "select course_id, academic_year, count(student_id) as num_students_enrolled, count(*) filter (where course_passed) as num_students_passed, count(*) filter (where course_completed) as num_students_completed, r(avg(cast(course_grade_numeric as double))) as course_grade_numeric_mean from ct group by 1, 2")
def _(v: Views) -> DataFrame:
    """The parts by themselves, for all sections of a course in a year."""
    return v.ct().groupBy("course_id", "academic_year").agg(*[x.alias(name) for name, x in S.section_parts().items()])


@query("agg_mode", "select student_id, delivery_method as value from (select student_id, delivery_method, row_number() over (partition by student_id order by count(*) desc, delivery_method) rn from v_course group by 1,2) where rn=1")
def _(v: Views) -> DataFrame:
    return v.course().groupBy("student_id").agg(F.mode("delivery_method", True).alias("value"))


@query("mode_per_column", """select (select delivery_method from v_course group by 1 order by count(*) desc, 1 limit 1) as delivery_method, (select core_course from v_course group by 1 order by count(*) desc, 1 limit 1) as core_course,
    (select grade from v_course group by 1 order by count(*) desc, 1 limit 1) as grade""")
def _(v: Views) -> DataFrame:
    return v.course().agg(*[F.mode(c, True).alias(c) for c in ("delivery_method", "core_course", "grade")])


@query("min_term_ranks", "select student_id, term_id, min_student_term_rank, min_student_term_rank_core, min_student_term_rank_noncore from cum")
def _(v: Views) -> DataFrame:
    return v.cum().select("student_id", "term_id", "min_student_term_rank", "min_student_term_rank_core", "min_student_term_rank_noncore")


@query("agg_cohort_id_first", "select student_id, min(cohort_id) as cohort_id from stj group by 1")
def _(v: Views) -> DataFrame:
    return v.stj().groupBy("student_id").agg(F.first("cohort_id", ignorenulls=True).alias("cohort_id"))


@query("group_size_check", "select student_id, count(*) as n from stj group by 1 having count(*)>1")
def _(v: Views) -> DataFrame:
    return v.stj().groupBy("student_id").agg(F.count("*").alias("n")).where("n > 1")


# --- windows --------------------------------------------------------------------------------


@query("term_rank", "select academic_year, academic_term, term_rank, term_rank_core from trm")
def _(v: Views) -> DataFrame:
    return S.term_dimension(v.crs()).select("academic_year", "academic_term", "term_rank", "term_rank_core")


@query("term_features", "select term_id, term_start_dt, term_rank, term_rank_core, term_rank_noncore, term_in_peak_covid, term_is_core, term_is_noncore from trm")
def _(v: Views) -> DataFrame:
    return S.term_dimension(v.crs()).drop("academic_year", "academic_term")


@query("expanding_aggs", "select student_id, term_id, cumsum_num_courses, r(cummean_num_courses) as cummean_num_courses, cummin_num_courses, cumsum_num_credits_earned, r(cummean_num_credits_earned) as cummean_num_credits_earned, r(cummean_course_grade_numeric_mean) as cummean_grade, r(cumstd_course_grade_numeric_mean) as cumstd_grade, r(cummin_course_level_mean) as cummin_level from cum")
def _(v: Views) -> DataFrame:
    return v.cum().select("student_id", "term_id", "cumsum_num_courses", "cummean_num_courses", "cummin_num_courses", "cumsum_num_credits_earned", "cummean_num_credits_earned", F.col("cummean_course_grade_numeric_mean").alias("cummean_grade"), F.col("cumstd_course_grade_numeric_mean").alias("cumstd_grade"), F.col("cummin_course_level_mean").alias("cummin_level"))


@query("cumfrac_courses", "select student_id, term_id, r(cumfrac_num_courses_passed) as cumfrac from cum")
def _(v: Views) -> DataFrame:
    return v.cum().select("student_id", "term_id", F.col("cumfrac_num_courses_passed").alias("cumfrac"))


@query("took_within_credits", "select student_id, term_id, max(cummax_took and cumsum_num_credits_earned<=12) over (partition by student_id) as took from cum")
def _(v: Views) -> DataFrame:
    return v.cum().select("student_id", "term_id", F.col("took_course_subject_area_13_in_12_creds").alias("took"))


@query("cum_unique_repeated", "select student_id, term_id, len(list_distinct(every)) as uniq, len(every)-len(list_distinct(every)) as repeated from (select student_id, term_id, flatten(list(course_ids) over (partition by student_id order by academic_year, ord rows unbounded preceding)) every from stj)")
def _(v: Views) -> DataFrame:
    return v.cum().select("student_id", "term_id", F.col("cumnum_unique_course_ids").alias("uniq"), F.col("cumnum_repeated_course_ids").alias("repeated"))


@query("cumfrac_terms", "select student_id, term_id, r(cast(cumnum_terms_enrolled as double)/(term_rank-min_student_term_rank+1)) as terms, r(case when term_rank_core is not null then cast(cumnum_core_terms_enrolled as double)/(term_rank_core-min_student_term_rank_core+1) end) as core_terms from cum")
def _(v: Views) -> DataFrame:
    return v.cum().select("student_id", "term_id", F.col("cumfrac_terms_enrolled").alias("terms"), F.col("cumfrac_core_terms_enrolled").alias("core_terms"))


_DIFFS = "select student_id, term_id, num_courses_diff_prev_term as prev, " + ", ".join(f"max(case when cumnum_terms_enrolled={n} then num_courses_diff_prev_term end) over (partition by student_id) as d{n}" for n in (2, 3, 4)) + " from cum"
query("term_diffs", _DIFFS)(lambda v: v.cum().select("student_id", "term_id", F.col("num_courses_diff_prev_term").alias("prev"), *[F.col(f"num_courses_diff_term_{n - 1}_to_term_{n}").alias(f"d{n}") for n in (2, 3, 4)]))


@query("pivot_terms", "select student_id, " + ", ".join(f"{f'r({e})' if c == 'num_credits_earned' else e} as {c}_term_{n}" for c in ("num_courses", "num_credits_earned") for n in (1, 2, 3, 4) for e in [f"max(case when cumnum_terms_enrolled={n} then {c} end)"]) + " from cum group by 1")
def _(v: Views) -> DataFrame:
    """Courses and credits of a student's first four terms, side by side."""
    return selection.pivot_terms(v.cum(), ["num_courses", "num_credits_earned"], [1, 2, 3, 4])


_CUM = "select student_id, term_id, cumnum_terms_enrolled, cumnum_core_terms_enrolled, cumsum_term_is_pre_cohort, cumsum_num_courses, r(cumfrac_num_courses_passed) as cumfrac_num_courses_passed, min_student_term_rank, num_courses_diff_prev_term from cum"
query("cumulative_features", _CUM)(lambda v: v.cum().select("student_id", "term_id", "cumnum_terms_enrolled", "cumnum_core_terms_enrolled", "cumsum_term_is_pre_cohort", "cumsum_num_courses", "cumfrac_num_courses_passed", "min_student_term_rank", "num_courses_diff_prev_term"))


@query("dataset_student_terms", "select " + ", ".join(f"{text} as {name}" for name, text in WHOLE.items()) + " from cum")
def dataset(v: Views) -> DataFrame:
    """All columns; lists as text."""
    d = S.student_term_dataset(v.cohort(), v.course(), key_areas=["13"])
    return d.withColumns({c: F.array_join(c, ",") for c in ("course_ids", "course_subjects", "course_subject_areas")})


@query("dedupe_renumber_courses", """select student_id, academic_year, academic_term, course_prefix, section_id, number_of_credits_attempted,
    case when count(*) over k>1 then course_number||'-'||cast(row_number() over (k order by number_of_credits_attempted desc) as varchar) else course_number end as course_number
    from v_course window k as (partition by student_id, academic_year, academic_term, course_prefix, course_number, section_id)""")
def _(v: Views) -> DataFrame:
    return cleaning.dedupe_renumber_courses(v.course()).select("student_id", "academic_year", "academic_term", "course_prefix", "section_id", "number_of_credits_attempted", "course_number")


@query("flag_shares", "select delivery_method, r(count(*)/sum(count(*)) over ()) as share from v_course group by 1")
def _(v: Views) -> DataFrame:
    n = v.course().groupBy("delivery_method").agg(F.count("*").alias("n"))
    return n.select("delivery_method", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


@query("sort_terms", f"select student_id, term_id, row_number() over (partition by student_id order by academic_year, {ORD.format(t='academic_term')}) as place from st")
def _(v: Views) -> DataFrame:
    w = Window.partitionBy("student_id").orderBy("academic_year", C.term_ordinal(F.col("academic_term")))
    return v.st().select("student_id", "term_id", F.row_number().over(w).alias("place"))


# --- checkpoints ----------------------------------------------------------------------------

_PICK = "select student_id, term_id from (select *, row_number() over (partition by student_id order by term_rank {d}) rn from cum where {w}) where rn={n}"
#: name: (function of student terms, filter, direction, place)
CHECKPOINTS = {
    "nth_term": (lambda d: selection.nth_terms(d, 1), "not term_is_pre_cohort and term_is_core", "", 2),
    "first_term": (selection.first_terms, "true", "", 1),
    "last_term": (selection.last_terms, "true", "desc", 1),
    "first_term_at_credits": (lambda d: selection.first_terms_at_credits(d, 12), "cumsum_num_credits_earned>=12", "", 1),
    "first_term_in_cohort": (selection.first_terms_in_cohort, "not term_is_pre_cohort", "", 1),
    "last_term_in_year": (lambda d: selection.last_terms_in_year(d, 2), "year_of_enrollment_at_cohort_inst=2", "desc", 1),
}
for _name, (_f, _w, _d, _n) in CHECKPOINTS.items():
    query(_name, _PICK.format(w=_w, d=_d, n=_n))(lambda v, f=_f: f(v.cum()).select("student_id", "term_id"))

# --- set operations -------------------------------------------------------------------------


@query("distinct_rows", "select distinct student_id from v_course")
def _(v: Views) -> DataFrame:
    return v.course().select("student_id").distinct()


@query("union_rows", "select student_id, 'a' as part from v_course union all select student_id, 'b' from v_cohort")
def _(v: Views) -> DataFrame:
    return v.course().select("student_id", F.lit("a").alias("part")).unionByName(v.cohort().select("student_id", F.lit("b").alias("part")))


@query("union_splits", "select student_id, split, case when split='train' then r(pred_prob) end as pred_prob from v_pred")
def _(v: Views) -> DataFrame:
    p = v.pred().select("student_id", "split", "pred_prob")
    return p.where("split = 'train'").unionByName(p.where("split <> 'train'").drop("pred_prob"), allowMissingColumns=True)


@query("melt", "select student_id, 'gender' as feature, gender as value from v_cohort union all select student_id, 'race', race from v_cohort")
def _(v: Views) -> DataFrame:
    return v.cohort().unpivot("student_id", ["gender", "race"], "feature", "value")
