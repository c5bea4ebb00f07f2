"""Equivalent SQL for DuckDB: named steps, of which a query's text takes those it needs."""

from __future__ import annotations

import re

from quadrangle.plans.adapters import COHORT, COURSE, PREDICTIONS

ORD = "case {t} when 'FALL' then 0 when 'WINTER' then 1 when 'SPRING' then 2 when 'SUMMER' then 3 end"
CIP = "nullif(trim(regexp_extract({c}, '^(\\d[\\d.])[\\d.]+$', 1), '.'), '')"
START = "make_date(cast(substr({y},1,4) as int) + case when {t}='FALL' then 0 else 1 end, case {t} when 'FALL' then 9 when 'WINTER' then 1 when 'SPRING' then 2 when 'SUMMER' then 6 end, 1)"
LETTER = """case when grade='A' then 'AUDIT' when grade='O' then 'OTHER' when grade in ('F','I','M','P','W') then grade
 when try_cast(grade as double)<0 or try_cast(grade as double)>4.01 then null when try_cast(grade as double)<=0.69 then 'F' when try_cast(grade as double)<=1.69 then 'D'
 when try_cast(grade as double)<=2.69 then 'C' when try_cast(grade as double)<=3.69 then 'B' when try_cast(grade as double)<=4.01 then 'A' end"""
PASSED = "case when grade in ('A','I','M','O','W') then null when grade='P' then true when grade='F' then false else try_cast(grade as double)>=1.0 end"
LEVEL = "try_cast(nullif(regexp_extract(trim(course_number), '^(\\d)\\d{2}(?:[A-Z]{0,2})?$', 1),'') as smallint)"
NUMERIC = "case when grade not in ('A','F','I','M','O','P','W') then try_cast(grade as float) end"

#: Counted courses of a student-term: name after num_courses_, and which rows count.
_LETTERS = ["A", "B", "C", "D", "F", "P", "I", "W", "M", "AUDIT", "OTHER"]
COUNTED = {
    "passed": "course_passed", "completed": "course_completed", "core_course_y": "core_course='Y'", "course_level_0_1": "course_level in (0,1)", "course_subject_area_13": "course_subject_area='13'",
    **{f"delivery_method_{v.lower()}": f"delivery_method='{v}'" for v in "FOH"}, **{f"course_level_{k}": f"course_level={k}" for k in range(10)}, **{f"course_grade_{g.lower()}": f"course_grade='{g}'" for g in _LETTERS},
    "grade_is_failing_or_withdrawal": "coalesce(grade in ('F','W') or (course_grade_numeric>=0 and course_grade_numeric<1.0), false)",
    "grade_above_section_avg": "coalesce(cast(course_grade_numeric as double)>section_course_grade_numeric_mean, false)",
}
AREAS = {"in_program_of_study_area_term_1": "area_term_1", "in_program_of_study_area_year_1": "area_year_1", "in_term_program_of_study_area": "cast(null as varchar)"}
ALL_COUNTED = [*COUNTED, *AREAS]

STEPS = {
    "v_course": COURSE,
    "v_cohort": COHORT,
    "v_pred": PREDICTIONS,
    "crs": f"""select *, course_prefix||course_number course_id, {CIP.format(c="course_cip")} course_subject_area, {PASSED} course_passed, coalesce(grade not in ('I','W'), true) course_completed,
        {LEVEL} course_level, {NUMERIC} course_grade_numeric, {LETTER} course_grade from v_course where course_prefix is not null and course_number is not null""",
    "trm0": f"""select distinct academic_year, academic_term, {ORD.format(t="academic_term")} ord, academic_term in ('FALL','SPRING') term_is_core from crs""",
    "trm": f"""select academic_year, academic_term, academic_year||' '||academic_term term_id, {START.format(y="academic_year", t="academic_term")} term_start_dt,
        cast(row_number() over (order by academic_year, ord)-1 as int) term_rank,
        case when term_is_core then cast(sum(cast(term_is_core as int)) over (order by academic_year, ord)-1 as int) end term_rank_core,
        case when not term_is_core then cast(sum(cast(not term_is_core as int)) over (order by academic_year, ord)-1 as int) end term_rank_noncore,
        (academic_year||' '||academic_term) in ('2019-20 SPRING','2019-20 SUMMER','2020-21 FALL','2020-21 WINTER','2020-21 SPRING','2020-21 SUMMER') term_in_peak_covid, term_is_core, not term_is_core term_is_noncore from trm0""",
    "ct": "select * from crs join trm using (academic_year, academic_term)",
    "sec": """select term_id, course_id, section_id, count(student_id) section_num_students_enrolled, count(*) filter (where course_passed) section_num_students_passed, count(*) filter (where course_completed) section_num_students_completed,
        avg(cast(course_grade_numeric as double)) section_course_grade_numeric_mean from ct group by all""",
    "cs": "select * from ct left join sec using (term_id, course_id, section_id)",
    "st": """select student_id, term_id, any_value(institution_id) institution_id, any_value(academic_year) academic_year, any_value(academic_term) academic_term, any_value(term_start_dt) term_start_dt,
        any_value(term_rank) term_rank, any_value(term_rank_core) term_rank_core, any_value(term_rank_noncore) term_rank_noncore, any_value(term_is_core) term_is_core, any_value(term_is_noncore) term_is_noncore, any_value(term_in_peak_covid) term_in_peak_covid,
        count(course_id) num_courses, sum(number_of_credits_attempted) num_credits_attempted, sum(number_of_credits_earned) num_credits_earned,
        list_sort(list(course_id)) course_ids, list_sort(list(course_cip)) course_subjects, list_sort(list(course_subject_area)) course_subject_areas,
        count(distinct course_id) course_id_nunique, count(distinct course_cip) course_subject_nunique, count(distinct course_subject_area) course_subject_area_nunique,
        avg(course_level) course_level_mean, stddev_samp(course_level) course_level_std, avg(cast(course_grade_numeric as double)) course_grade_numeric_mean, stddev_samp(cast(course_grade_numeric as double)) course_grade_numeric_std,
        avg(section_num_students_enrolled) section_num_students_enrolled_mean, stddev_samp(section_num_students_enrolled) section_num_students_enrolled_std,
        cast(sum(section_num_students_enrolled) as bigint) sections_num_students_enrolled, cast(sum(section_num_students_passed) as bigint) sections_num_students_passed, cast(sum(section_num_students_completed) as bigint) sections_num_students_completed,
        {counts}, num_courses_course_subject_area_13>=1 took_course_subject_area_13
        from cs group by student_id, term_id""".replace("{counts}", ", ".join(f"count(*) filter (where {w}) num_courses_{n}" for n, w in COUNTED.items())),
    "stu": f"""select *, cohort||' '||cohort_term cohort_id, {START.format(y="cohort", t="cohort_term")} cohort_start_dt, {CIP.format(c="program_of_study_term_1")} area_term_1, {CIP.format(c="program_of_study_year_1")} area_year_1,
        case pell_status_first_year when 'Y' then true when 'N' then false end pell, gpa_group_year_1-gpa_group_term_1 diff_gpa from v_cohort""",
    "stj": f"""select st.*, cohort, cohort_term, cohort_id, cohort_start_dt, enrollment_type, enrollment_intensity_first_term, gender, race, retention, first_year_to_bachelors_at_cohort_inst, gpa_group_year_1, gpa_group_term_1, area_term_1, area_year_1, diff_gpa, program_of_study_term_1, program_of_study_year_1, pell_status_first_year, pell,
        {{areas}},
        {ORD.format(t="academic_term")} ord, cast(ceil((date_diff('day', cohort_start_dt, term_start_dt)+1)/365.25) as int) year_of_enrollment_at_cohort_inst, term_start_dt<cohort_start_dt term_is_pre_cohort,
        case when num_credits_attempted<>0 then num_credits_earned/num_credits_attempted end frac_credits_earned, case when num_credits_attempted>=12 then 'FULL-TIME' else 'PART-TIME' end student_term_enrollment_intensity,
        {{fracs}}, cast(sections_num_students_passed as double)/nullif(sections_num_students_enrolled,0) frac_sections_students_passed, cast(sections_num_students_completed as double)/nullif(sections_num_students_enrolled,0) frac_sections_students_completed,
        frac_courses_passed>frac_sections_students_passed pass_above, frac_courses_completed>frac_sections_students_completed completion_above
        from st join stu using (institution_id, student_id)""".replace("{areas}", ", ".join(f"len([x for x in course_subject_areas if x=coalesce({a},'-1')]) num_courses_{n}" for n, a in AREAS.items())).replace("{fracs}", ", ".join(f"cast(num_courses_{n} as double)/nullif(num_courses,0) frac_courses_{n}" for n in ALL_COUNTED)),
    "cum": """select *, count(term_id) over w cumnum_terms_enrolled, cast(sum(cast(term_is_core as int)) over w as bigint) cumnum_core_terms_enrolled, cast(sum(cast(term_is_pre_cohort as int)) over w as bigint) cumsum_term_is_pre_cohort,
        cast(sum(num_courses) over w as bigint) cumsum_num_courses, avg(num_courses) over w cummean_num_courses, min(num_courses) over w cummin_num_courses, sum(num_credits_earned) over w cumsum_num_credits_earned, avg(num_credits_earned) over w cummean_num_credits_earned,
        avg(course_grade_numeric_mean) over w cummean_course_grade_numeric_mean, stddev_samp(course_grade_numeric_mean) over w cumstd_course_grade_numeric_mean, min(course_level_mean) over w cummin_course_level_mean,
        {fracs}, {more}, max(took_course_subject_area_13) over w cummax_took,
        min(term_rank) over (partition by student_id) min_student_term_rank, min(term_rank_core) over (partition by student_id) min_student_term_rank_core, min(term_rank_noncore) over (partition by student_id) min_student_term_rank_noncore,
        {diffs}
        from stj window o as (partition by student_id order by academic_year, ord), w as (partition by student_id order by academic_year, ord rows unbounded preceding)""",
}
_DIFFED = ["num_courses", "num_credits_earned", "course_grade_numeric_mean", "course_level_mean"]
_MORE = {
    "cumnum_noncore_terms_enrolled": "cast(sum(cast(term_is_noncore as int)) over w as bigint)", "cumsum_term_in_peak_covid": "cast(sum(cast(term_in_peak_covid as int)) over w as bigint)",
    "cummean_course_level_mean": "avg(course_level_mean) over w", "cumstd_course_level_mean": "stddev_samp(course_level_mean) over w", "cummin_course_grade_numeric_mean": "min(course_grade_numeric_mean) over w",
    "cumsum_num_credits_attempted": "sum(num_credits_attempted) over w", "cummean_num_credits_attempted": "avg(num_credits_attempted) over w", "cummin_num_credits_attempted": "min(num_credits_attempted) over w", "cummin_num_credits_earned": "min(num_credits_earned) over w",
    "cumsum_pass_above": "cast(sum(cast(pass_above as int)) over w as bigint)", "cumsum_completion_above": "cast(sum(cast(completion_above as int)) over w as bigint)",
    **{f"every_{c}": f"flatten(list({c}) over w)" for c in ("course_ids", "course_subjects", "course_subject_areas")},
}
STEPS["cum"] = (
    STEPS["cum"]
    .replace("{fracs}", ", ".join(f"cast(sum(num_courses_{n}) over w as double)/nullif(sum(num_courses) over w,0) cumfrac_num_courses_{n}" for n in ALL_COUNTED))
    .replace("{more}", ", ".join(f"{text} {name}" for name, text in _MORE.items()))
    .replace("{diffs}", ", ".join(f"{c}-lag({c}) over o {c}_diff_prev_term" for c in _DIFFED))
)

#: The student-term table as a whole: name, text over cum, and whether it is a real number.
_PLAIN = """institution_id student_id term_id academic_year academic_term term_start_dt term_rank term_rank_core term_rank_noncore term_is_core term_is_noncore term_in_peak_covid num_courses sections_num_students_enrolled
    sections_num_students_passed sections_num_students_completed course_id_nunique course_subject_nunique course_subject_area_nunique took_course_subject_area_13 cohort cohort_term enrollment_type enrollment_intensity_first_term gender race
    program_of_study_term_1 program_of_study_year_1 pell_status_first_year retention first_year_to_bachelors_at_cohort_inst cohort_id cohort_start_dt year_of_enrollment_at_cohort_inst term_is_pre_cohort student_term_enrollment_intensity
    cumnum_terms_enrolled cumsum_term_in_peak_covid cumnum_core_terms_enrolled cumnum_noncore_terms_enrolled cumsum_term_is_pre_cohort cumsum_num_courses cummin_num_courses min_student_term_rank min_student_term_rank_core
    min_student_term_rank_noncore num_courses_diff_prev_term""".split()
_REAL = """num_credits_attempted num_credits_earned course_level_mean course_level_std course_grade_numeric_mean course_grade_numeric_std section_num_students_enrolled_mean section_num_students_enrolled_std gpa_group_term_1 gpa_group_year_1
    frac_credits_earned frac_sections_students_passed frac_sections_students_completed cummean_course_level_mean cummin_course_level_mean cumstd_course_level_mean cummean_course_grade_numeric_mean cummin_course_grade_numeric_mean
    cumstd_course_grade_numeric_mean cummean_num_courses cumsum_num_credits_attempted cummean_num_credits_attempted cummin_num_credits_attempted cumsum_num_credits_earned cummean_num_credits_earned cummin_num_credits_earned
    num_credits_earned_diff_prev_term course_grade_numeric_mean_diff_prev_term course_level_mean_diff_prev_term""".split()
WHOLE = {c: c for c in _PLAIN} | {c: f"r({c})" for c in _REAL}
WHOLE |= {f"num_courses_{n}": f"num_courses_{n}" for n in ALL_COUNTED} | {f"frac_courses_{n}": f"r(frac_courses_{n})" for n in ALL_COUNTED} | {f"cumfrac_num_courses_{n}": f"r(cumfrac_num_courses_{n})" for n in ALL_COUNTED}
WHOLE |= {c: f"array_to_string({c},',')" for c in ("course_ids", "course_subjects", "course_subject_areas")}
WHOLE |= {f"cumnum_{k}_{c}": f"{'len(list_distinct(e))' if k == 'unique' else 'len(e)-len(list_distinct(e))'}".replace("e)", f"every_{c})") for c in ("course_ids", "course_subjects", "course_subject_areas") for k in ("unique", "repeated")}
WHOLE |= {f"{what}_{degree}_at_{inst}_inst": "cast(null as smallint)" for what in ("years_to_latest", "first_year_to") for degree in ("associates", "certificate") for inst in ("cohort", "other")}
WHOLE |= {"term_program_of_study": "cast(null as varchar)", "term_program_of_study_area": "cast(null as varchar)", "student_program_of_study_area_term_1": "area_term_1", "student_program_of_study_area_year_1": "area_year_1"}
WHOLE |= {"student_program_of_study_changed_term_1_to_year_1": "program_of_study_term_1<>program_of_study_year_1", "student_program_of_study_area_changed_term_1_to_year_1": "area_term_1<>area_year_1"}
WHOLE |= {"student_is_pell_recipient_first_year": "pell", "diff_gpa_term_1_to_year_1": "r(diff_gpa)", "student_has_earned_certificate_at_cohort_inst": "false", "student_has_earned_certificate_at_other_inst": "false"}
WHOLE |= {"student_pass_rate_above_sections_avg": "pass_above", "student_completion_rate_above_sections_avg": "completion_above", "cummax_took_course_subject_area_13": "cummax_took"}
WHOLE |= {"cumsum_student_pass_rate_above_sections_avg": "cumsum_pass_above", "cumsum_student_completion_rate_above_sections_avg": "cumsum_completion_above"}
WHOLE |= {f"cumfrac_{k}terms_enrolled": f"r(case when term_rank{c} is not null then cast(cumnum_{k}terms_enrolled as double)/(term_rank{c}-min_student_term_rank{c}+1) end)" for k, c in (("", ""), ("core_", "_core"), ("noncore_", "_noncore"))}
WHOLE |= {"took_course_subject_area_13_in_12_creds": "max(cummax_took and cumsum_num_credits_earned<=12) over (partition by student_id)"}
_TERM_DIFF = "max(case when cumnum_terms_enrolled={n} then {c}_diff_prev_term end) over (partition by student_id)"
WHOLE |= {f"{c}_diff_term_{n - 1}_to_term_{n}": (_TERM_DIFF if c == "num_courses" else f"r({_TERM_DIFF})").format(c=c, n=n) for c in _DIFFED for n in (2, 3, 4)}


def sql(body: str, decimals: int = 6) -> str:
    """A query over the steps it names. r(x) in the body stands for x as a double, rounded."""
    need: list[str] = []

    def add(text: str) -> None:
        for name in STEPS:
            if name not in need and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                add(STEPS[name])
                need.append(name)

    add(body)
    while (at := body.find("r(")) >= 0 and (m := re.search(r"(?<![a-z_])r\(", body)):
        depth, k = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(body[k], 0)
            k += 1
        body = f"{body[: m.start()]}round(cast(({body[m.end() : k - 1]}) as double), {decimals}){body[k:]}"
    steps = ", ".join(f"{n} as ({STEPS[n]})" for n in need)
    return f"with {steps} {body}" if need else body
