"""The three table contracts once more, written by rule instead of by column, with data that breaks every rule: what SQL counts against the code of `operators.contracts`."""

from __future__ import annotations

#: Columns by kind, then by what is asked of them. A column's line is found by its name; `absent` ones are left out of the data.
COHORT = """
string: student_id institution_id cohort cohort_term enrollment_type enrollment_intensity_first_term math_placement english_placement dual_and_summer_enrollment student_age race ethnicity gender first_gen pell_status_first_year
string: attendance_status_term_1 credential_type_sought_year_1 program_of_study_term_1 program_of_study_year_1 gateway_math_status gateway_english_status attempted_gateway_math_year_1 attempted_gateway_english_year_1
string: completed_gateway_math_year_1 completed_gateway_english_year_1 gateway_math_grade_y_1 gateway_english_grade_y_1 attempted_dev_math_y_1 attempted_dev_english_y_1 completed_dev_math_y_1 completed_dev_english_y_1
string: reading_placement naspa_first_generation incarcerated_status military_status employment_status disability_status foreign_language_completion
string: most_recent_bachelors_at_other_institution_state most_recent_associates_or_certificate_at_other_institution_state most_recent_last_enrollment_at_other_institution_state
string: first_bachelors_at_other_institution_state first_associates_or_certificate_at_other_institution_state
string: most_recent_bachelors_at_other_institution_carnegie most_recent_associates_or_certificate_at_other_institution_carnegie most_recent_last_enrollment_at_other_institution_carnegie
string: first_bachelors_at_other_institution_carnegie first_associates_or_certificate_at_other_institution_carnegie
string: most_recent_bachelors_at_other_institution_locale most_recent_associates_or_certificate_at_other_institution_locale most_recent_last_enrollment_at_other_institution_locale
string: first_bachelors_at_other_institution_locale first_associates_or_certificate_at_other_institution_locale
boolean: retention persistence
int: years_of_last_enrollment_at_cohort_institution years_of_last_enrollment_at_other_institution
short: years_to_bachelors_at_cohort_inst years_to_associates_or_certificate_at_cohort_inst years_to_bachelor_at_other_inst years_to_associates_or_certificate_at_other_inst
short: first_year_to_bachelors_at_cohort_inst first_year_to_associates_or_certificate_at_cohort_inst first_year_to_bachelor_at_other_inst first_year_to_associates_or_certificate_at_other_inst
short: years_to_latest_associates_at_cohort_inst years_to_latest_certificate_at_cohort_inst years_to_latest_associates_at_other_inst years_to_latest_certificate_at_other_inst
short: first_year_to_associates_at_cohort_inst first_year_to_certificate_at_cohort_inst first_year_to_associates_at_other_inst first_year_to_certificate_at_other_inst
float: gpa_group_term_1 gpa_group_year_1 number_of_credits_attempted_year_1 number_of_credits_attempted_year_2 number_of_credits_attempted_year_3 number_of_credits_attempted_year_4
float: number_of_credits_earned_year_1 number_of_credits_earned_year_2 number_of_credits_earned_year_3 number_of_credits_earned_year_4
absent: time_to_credential
not_null: student_id institution_id cohort cohort_term enrollment_type retention persistence years_of_last_enrollment_at_cohort_institution years_of_last_enrollment_at_other_institution
isin FALL WINTER SPRING SUMMER: cohort_term
isin FIRST-TIME RE-ADMIT TRANSFER-IN: enrollment_type
isin FULL-TIME PART-TIME: enrollment_intensity_first_term
isin C N: math_placement english_placement reading_placement
isin DE SE DS: dual_and_summer_enrollment
isin Y N: pell_status_first_year attempted_gateway_math_year_1 attempted_gateway_english_year_1 disability_status
isin R N: gateway_math_status gateway_english_status
isin C D NA: completed_gateway_math_year_1 completed_gateway_english_year_1
isin Y N NA: attempted_dev_math_y_1 attempted_dev_english_y_1 completed_dev_math_y_1 completed_dev_english_y_1
isin -1 0 1 2 3 4 5 6: naspa_first_generation
isin Y P N: incarcerated_status
isin 0 1 2: military_status
isin -1 0 1 2 3 4: employment_status
in_range 0 4: gpa_group_term_1 gpa_group_year_1
in_range 0 8: years_of_last_enrollment_at_cohort_institution years_of_last_enrollment_at_other_institution years_to_bachelors_at_cohort_inst years_to_associates_or_certificate_at_cohort_inst years_to_bachelor_at_other_inst
in_range 0 8: years_to_associates_or_certificate_at_other_inst first_year_to_bachelors_at_cohort_inst first_year_to_associates_or_certificate_at_cohort_inst first_year_to_bachelor_at_other_inst first_year_to_associates_or_certificate_at_other_inst
in_range 0 8: years_to_latest_associates_at_cohort_inst years_to_latest_certificate_at_cohort_inst years_to_latest_associates_at_other_inst years_to_latest_certificate_at_other_inst
in_range 0 8: first_year_to_associates_at_cohort_inst first_year_to_certificate_at_cohort_inst first_year_to_associates_at_other_inst first_year_to_certificate_at_other_inst
ge 0: number_of_credits_attempted_year_2 number_of_credits_attempted_year_3 number_of_credits_attempted_year_4 number_of_credits_earned_year_1 number_of_credits_earned_year_2 number_of_credits_earned_year_3 number_of_credits_earned_year_4
warn ge 1: number_of_credits_attempted_year_1
"""
COURSE = """
string: student_id institution_id student_age race ethnicity gender cohort cohort_term academic_year academic_term course_prefix course_number section_id course_name course_cip course_type math_or_english_gateway co_requisite_course
string: grade delivery_method core_course core_course_type core_competency_completed enrolled_at_other_institution_s credential_engine_identifier course_instructor_employment_status course_instructor_rank
string: enrollment_record_at_other_institution_s_state_s enrollment_record_at_other_institution_s_carnegie_s
timestamp: course_begin_date course_end_date
float: number_of_credits_attempted number_of_credits_earned
absent: enrollment_record_at_other_institution_s_locale_s
not_null: student_id institution_id cohort cohort_term
isin FALL WINTER SPRING SUMMER: cohort_term academic_term
isin CU CG CC CD EL AB GE NC O: course_type
isin E M NA: math_or_english_gateway
isin Y N: co_requisite_course core_course core_competency_completed enrolled_at_other_institution_s
isin F O H: delivery_method
isin PT FT: course_instructor_employment_status
isin 1 2 3 4 5 6 7: course_instructor_rank
in_range 0 20: number_of_credits_attempted number_of_credits_earned
"""
#: Courses of a term that are counted.
_COUNTED = """passed completed enrolled_at_other_institution_s_y course_type_cc_cd course_type_cu course_type_cg course_type_cc course_type_cd course_type_el course_type_ab course_type_ge course_type_nc course_type_o
    delivery_method_f delivery_method_o delivery_method_h math_or_english_gateway_m math_or_english_gateway_e math_or_english_gateway_na co_requisite_course_y co_requisite_course_n
    course_instructor_employment_status_pt course_instructor_employment_status_ft course_instructor_rank_1 course_instructor_rank_2 course_instructor_rank_3 course_instructor_rank_4 course_instructor_rank_5
    course_instructor_rank_6 course_instructor_rank_7 course_level_1 course_grade_a grade_is_failing_or_withdrawal grade_above_section_avg core_course_y core_course_n""".split()
_NUM, _FRAC = (" ".join(f"{x}_courses_{c}" for c in _COUNTED) for x in ("num", "frac"))
STUDENT_TERM = f"""
string: student_id term_id institution_id academic_year academic_term cohort cohort_term enrollment_type enrollment_intensity_first_term math_placement english_placement reading_placement dual_and_summer_enrollment student_age
string: race ethnicity first_gen pell_status_first_year special_program incarcerated_status military_status employment_status disability_status foreign_language_completion credential_type_sought_year_1
string: program_of_study_term_1 program_of_study_year_1 cohort_id student_program_of_study_area_term_1 student_program_of_study_area_year_1 student_term_enrollment_intensity
timestamp: term_start_dt cohort_start_dt
boolean: term_in_peak_covid term_is_core student_program_of_study_area_changed_term_1_to_year_1 term_is_while_student_enrolled_at_other_inst
int: sections_num_students_enrolled sections_num_students_passed sections_num_students_completed
short: term_rank term_rank_core num_courses course_id_nunique course_subject_nunique course_subject_area_nunique year_of_enrollment_at_cohort_inst num_courses_diff_prev_term num_courses_diff_term_1_to_term_2 {_NUM}
float: num_credits_attempted num_credits_earned course_level_mean course_level_std course_grade_numeric_mean course_grade_numeric_std section_num_students_enrolled_mean section_num_students_enrolled_std gpa_group_term_1 gpa_group_year_1
float: number_of_credits_earned_year_1 number_of_credits_attempted_year_2 number_of_credits_earned_year_2 number_of_credits_attempted_year_3 number_of_credits_earned_year_3 number_of_credits_attempted_year_4 number_of_credits_earned_year_4
float: diff_gpa_term_1_to_year_1 frac_credits_earned_year_1 frac_credits_earned_year_2 frac_credits_earned_year_3 frac_credits_earned_year_4 num_credits_earned_diff_prev_term course_grade_numeric_mean_diff_prev_term
float: num_credits_earned_diff_term_1_to_term_2 course_grade_numeric_mean_diff_term_1_to_term_2 {_FRAC}
absent: frac_credits_earned
not_null: student_id term_id institution_id academic_year academic_term term_start_dt term_rank term_in_peak_covid term_is_core num_courses num_credits_attempted num_credits_earned sections_num_students_enrolled
not_null: sections_num_students_passed sections_num_students_completed cohort cohort_term student_age race ethnicity first_gen cohort_id cohort_start_dt year_of_enrollment_at_cohort_inst
not_null: term_is_while_student_enrolled_at_other_inst student_term_enrollment_intensity {_NUM} {_FRAC}
isin FALL WINTER SPRING SUMMER: academic_term cohort_term
isin FIRST-TIME RE-ADMIT TRANSFER-IN: enrollment_type
isin FULL-TIME PART-TIME: enrollment_intensity_first_term student_term_enrollment_intensity
isin C N: math_placement english_placement reading_placement
isin DE SE DS: dual_and_summer_enrollment
in_range 0 4: gpa_group_term_1 gpa_group_year_1
in_range 0 1: {_FRAC}
ge 0: num_courses num_credits_earned number_of_credits_earned_year_1 number_of_credits_attempted_year_2 number_of_credits_earned_year_2 number_of_credits_attempted_year_3 number_of_credits_earned_year_3 number_of_credits_attempted_year_4 number_of_credits_earned_year_4
"""

#: Values that columns of a kind take in turn; null is one of them. Each has some that fit and some that don't.
_VALUES = {
    "string": "FALL WINTER SUMMER FIRST-TIME RE-ADMIT FULL-TIME PART-TIME C D N Y P DE DS R NA CU CC O E M F H PT FT -1 0 1 3 4 5 6 7 8 other".split(),
    "short": "-1 0 1 4 8 9 many".split(),
    "int": "-1 0 8 9 many".split(),
    "float": "-0.5 0 0.5 1 1.5 4 4.25 20 20.5 many".split(),
    "boolean": "true false maybe".split(),
    "timestamp": ["2020-02-28", "2021-09-01", "later"],
}


def _lines(rules: str) -> list[tuple[list[str], list[str]]]:
    return [(ask.split(), columns.split()) for ask, columns in (line.split(": ") for line in rules.strip().splitlines())]


def soiled(rules: str, source: str) -> str:
    """A query, for Spark and DuckDB alike, over a source with a number k: all columns of the rules as text, with values in turn by k."""
    out = []
    for (kind, *_), columns in _lines(rules):
        for c in columns if kind in _VALUES else []:
            values = _VALUES[kind]
            cases = " ".join(f"when {j} then '{v}'" for j, v in enumerate(values))
            out.append(f"case (k+{len(out)})%{len(values) + 1} {cases} end as {c}")
    return f"select {', '.join(out)} from {source}"


def counted(rules: str, view: str) -> str:
    """What fails, for each rule: (check, column, severity, n_failed), in SQL."""
    kinds, out = {c: kind for (kind, *_), columns in _lines(rules) if kind in _VALUES for c in columns}, []

    def add(check: str, column: str, failed: str, severity: str = "error") -> None:
        out.append((check, column, severity, failed))

    for c, kind in kinds.items():
        add("kind", c, "false" if kind == "string" else f"{c} is not null and try_cast({c} as {kind}) is null")
    for (ask, *values), columns in _lines(rules):
        severity = "error"
        if ask == "warn":
            severity, ask, values = "warning", values[0], values[1:]
        for c in columns:
            if ask == "absent":
                add("missing", c, "true")
            elif ask == "not_null":
                add(ask, c, f"{c} is null")
            elif ask == "isin":
                listed = ", ".join(f"'{v}'" for v in values)
                add(ask, c, f"{c} not in ({listed})")
            elif ask == "in_range":
                add(ask, c, f"try_cast({c} as double) not between {values[0]} and {values[1]}", severity)
            elif ask == "ge":
                add(ask, c, f"try_cast({c} as double) < {values[0]}", severity)
    return " union all ".join(f"select '{check}' as \"check\", '{c}' as \"column\", '{severity}' as severity, count(*) filter (where {failed}) as n_failed from {view}" for check, c, severity, failed in out)
