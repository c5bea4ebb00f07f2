"""How often the student-term plans shuffle and read their tables, and steps that do it in another way than before."""

import random

import pytest
from pyspark.sql import functions as F

from quadrangle.plans import QUERIES
from quadrangle.plans import student_terms as S
from quadrangle.plans.registry import Views, rounded
from tests.test_queries import FOLDER


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["dataset_student_terms", "student_term_features", "above_section_rate"])
def test_few_readings_and_exchanges(spark, name):
    """Courses are read once for the terms and once for the rows (sections took a third reading); no exchange is by institution and student."""
    text = plan(QUERIES[name](spark, FOLDER))
    assert text.count("/lineitem.parquet") == 2
    keys = [x.split("hashpartitioning(")[1].split(")")[0] for x in text.split("\n") if "Exchange hashpartitioning(" in x]
    assert any("student_id" in k for k in keys) and not any("institution_id" in k for k in keys)


def test_sections_by_window(spark):
    """The same as by aggregate and join, also for rows of no section."""
    ct = Views(spark, FOLDER).ct().withColumn("section_id", F.when(F.col("l_linenumber") != 2, F.col("section_id")))
    want, got = S.join_section_features(ct, S.section_features(ct)), S.with_section_features(ct)
    assert sorted(want.columns) == sorted(got.columns)
    assert want.where("section_num_students_enrolled is null").count() == ct.where("section_id is null").count() > 0
    assert want.exceptAll(got.select(want.columns)).isEmpty() and got.select(want.columns).exceptAll(want).isEmpty()


def test_students_of_two_institutions(spark):
    """Only those of one's own institution join, and null institutions none."""
    terms = spark.createDataFrame([("s", "1", "t"), ("s", None, "u"), ("r", "2", "t")], "student_id string, institution_id string, term_id string")
    students = spark.createDataFrame([("s", "1", "a"), ("s", "2", "b"), ("s", None, "c"), ("r", "2", "d")], "student_id string, institution_id string, cohort string")
    got = S.join_student_terms(terms, students)
    assert got.columns == ["institution_id", "student_id", "term_id", "cohort"]
    assert sorted(map(tuple, got.collect())) == [("1", "s", "t", "a"), ("2", "r", "t", "d")]


def test_rounded_as_round_does(spark):
    rng = random.Random(1)
    xs = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 12) for _ in range(4000)] + [k / 2e6 for k in range(-300, 300)] + [0.0, -0.0, None, float("nan"), float("inf"), -float("inf"), 1e300, -1e-9]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", F.round("x", 6).alias("want"))
    df = rounded(df.select("x", "want", F.col("x").alias("got"))).select(F.col("want").cast("string").alias("w"), F.col("got").cast("string").alias("g"), "want")
    # `want` is rounded twice, which changes nothing.
    assert df.where("not (w <=> g)").count() == 0


@pytest.mark.parametrize("name", ["src_feature_names", "target_graduation", "labelable_by_term", "labelable_by_year", "target_credits", "target_retention", "join_checkpoint_target"])
def test_what_was_written_once_is_read(spark, name):
    assert "lineitem.parquet" not in plan(QUERIES[name](spark, FOLDER))
