"""Literal cases of the column functions and the guards."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quadrangle.functions import columns as C
from quadrangle.functions import names
from quadrangle.operators import cleaning, modeling, selection, targets


def values(spark, data, kind, column):
    return [r[0] for r in spark.createDataFrame([(x,) for x in data], f"x {kind}").select(column).collect()]


@pytest.mark.parametrize(("name", "want"), [("num_courses_course_level_0|1", "num_courses_course_level_0_1"), ("AttemptedGatewayMathYear1", "attempted_gateway_math_year_1"), ("took_course_id_ENGL101", "took_course_id_engl_101"), ("Student GUID", "student_guid")])
def test_snake_case(name, want):
    assert names.snake_case(name) == want


def test_names_that_collide_are_refused(spark):
    with pytest.raises(ValueError, match="collide"):
        names.snake_case_columns(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))


def test_short_cip(spark):
    assert values(spark, ["40.02", "9.0101", "x", None], "string", C.short_cip(F.col("x"))) == ["40", "9", None, None]


def test_grades(spark):
    grades = ["A", "F", "P", "W", "I", "0.695", "0.0", "4.0", "0.69", "1.7", None]
    assert values(spark, grades, "string", C.course_passed(F.col("x"))) == [None, False, True, None, None, False, False, True, False, True, None]
    assert values(spark, grades, "string", C.course_completed(F.col("x"))) == [True, True, True, False, False, True, True, True, True, True, True]
    assert values(spark, grades, "string", C.grade_letter(F.col("x"))) == ["AUDIT", "F", "P", "W", "I", "D", "F", "A", "F", "C", None]


def test_year_term_dates(spark):
    got = values(spark, ["2022-23 FALL", "2022-23 spring", "2022-23 SUMMER", None], "string", C.year_term_date(F.col("x"), "end"))
    assert [str(d) for d in got] == ["2022-12-31", "2023-05-31", "2023-08-31", "None"]
    with pytest.raises(PySparkException):
        values(spark, ["FALL"], "string", C.year_term_date(F.col("x")))


def test_unknown_credits_are_part_time(spark):
    assert values(spark, [12.0, 11.9, None], "double", C.enrollment_intensity(F.col("x"))) == ["FULL-TIME", "PART-TIME", "PART-TIME"]


def test_fractions_outside_the_unit_raise(spark):
    with pytest.raises(PySparkException):
        values(spark, [2.0], "double", C.guarded_fraction(F.col("x"), F.lit(1.0), "x"))


def test_normal_cdf(spark):
    assert values(spark, [0.0, 1.959964, -1.0], "double", C.normal_cdf(F.col("x"))) == pytest.approx([0.5, 0.975, 0.158655], abs=1e-5)


def test_adjusted_skewness(spark):
    import pandas as pd

    data = [1.0, 2.0, 4.0, 9.0]
    assert values(spark, data, "double", C.adjusted_skewness(F.col("x")))[0] == pytest.approx(pd.Series(data).skew())


def test_null_future_values(spark):
    d = spark.createDataFrame([("a", 1, 1, 8.0, 2, 0.5, 3, True), ("b", 3, 2, 20.0, 2, 0.5, 3, True), ("c", None, None, None, 2, 0.5, 3, True)], "student_id string, year_of_enrollment_at_cohort_inst int, cumnum_terms_enrolled int, cumsum_num_credits_earned double, first_year_to_certificate_at_x int, frac_credits_earned_year_2 double, num_diff_term_1_to_term_2 int, cummax_in_12_creds_x boolean")
    got = [tuple(r)[4:] for r in cleaning.null_future_values(d).orderBy("student_id").collect()]
    assert got == [(None, None, None, None), (2, 0.5, 3, True), (None, None, None, None)]


def test_dedupe_renumber(spark):
    d = spark.createDataFrame([("s", "y", "t", "M", "1", "a", 1.0), ("s", "y", "t", "M", "1", "a", 4.0), ("s", "y", "t", "M", "2", "a", 1.0)], "student_id string, academic_year string, academic_term string, course_prefix string, course_number string, section_id string, number_of_credits_attempted double")
    assert sorted((r.course_number, r.number_of_credits_attempted) for r in cleaning.dedupe_renumber_courses(d).collect()) == [("1-1", 4.0), ("1-2", 1.0), ("2", 1.0)]


def test_no_criteria(spark):
    with pytest.raises(ValueError, match="criteria"):
        selection.select_students(spark.range(1))


def test_checkpoint_with_two_rows_raises(spark):
    d = spark.createDataFrame([("s", 1, "FULL-TIME"), ("s", 2, "FULL-TIME")], "student_id string, term_rank int, student_term_enrollment_intensity string")
    with pytest.raises(ValueError, match="one row"):
        targets.labelable_by_term(d, d, {"*": (1, "year")})


def test_split_does_not_depend_on_partitions(spark):
    d = spark.range(500).select(F.col("id").cast("string").alias("student_id"))
    a = {r.student_id: r.split for r in modeling.random_split(d.repartition(1)).collect()}
    assert a == {r.student_id: r.split for r in modeling.random_split(d.repartition(7)).collect()}
    assert 230 < sum(v == "train" for v in a.values()) < 370


def test_collinear(spark):
    d = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), F.pmod(F.hash("id"), F.lit(100)).cast("double").alias("c"))
    gone = modeling.collinear_features(d)
    assert "c" not in gone and len(gone) >= 1
    assert "a" not in modeling.collinear_features(d, force=["a"])
