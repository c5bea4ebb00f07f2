"""Reading raw tables: strings first, then fixed conversions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.functions import columns as C
from quadrangle.functions.names import snake_case_columns

Converter = Callable[[DataFrame], DataFrame]


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Every column is a string; nothing is inferred."""
    return spark.read.options(**options).csv(path, header=True, inferSchema=False)


def read_table(spark: SparkSession, name: str, *, format: str | None = None) -> DataFrame:
    """A catalog table, or a path in a format."""
    return spark.table(name) if format is None else spark.read.format(format).load(name)


def _source(spark: SparkSession, table_path: str | None, file_path: str | None) -> DataFrame:
    if (table_path is None) == (file_path is None):
        raise ValueError("give either a table or a file")
    return read_table(spark, table_path) if table_path else read_csv(spark, file_path)


def convert(df: DataFrame, converter: Converter | None) -> DataFrame:
    return df.transform(converter) if converter else df


def course_date(c: Column) -> Column:
    """ISO 8601, else yyyyMMdd, either with a trailing ".0"."""
    return C.parse_date(c, "yyyy-MM-dd", "yyyyMMdd")


def standard_course(df: DataFrame, *, date_format: str = "yyyyMMdd", converter: Converter | None = None) -> DataFrame:
    df = snake_case_columns(df)
    new = {"academic_term": F.upper(F.col("academic_term"))} if "academic_term" in df.columns else {}
    new |= {c: F.to_timestamp(F.col(c), date_format) for c in ("course_begin_date", "course_end_date") if c in df.columns}
    return convert(df.withColumns(new), converter)


def standard_cohort(df: DataFrame, *, converter: Converter | None = None) -> DataFrame:
    df = snake_case_columns(df)
    new = {"cohort_term": F.upper(F.col("cohort_term"))} if "cohort_term" in df.columns else {}
    new |= {c: C.values_to_null(F.col(c), ["UK"]) for c in ("gpa_group_term_1", "gpa_group_year_1") if c in df.columns}
    new |= {c: C.string_to_bool(F.col(c)) for c in ("retention", "persistence") if c in df.columns}
    return convert(df.withColumns(new), converter)


def read_raw_course(spark: SparkSession, *, table_path: str | None = None, file_path: str | None = None, **how) -> DataFrame:
    return standard_course(_source(spark, table_path, file_path), **how)


def read_raw_cohort(spark: SparkSession, *, table_path: str | None = None, file_path: str | None = None, **how) -> DataFrame:
    return standard_cohort(_source(spark, table_path, file_path), **how)
