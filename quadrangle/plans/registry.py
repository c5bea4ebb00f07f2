"""The table of registered queries: name, function and, where SQL can say the same, its text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.plans import adapters, student_terms
from quadrangle.plans.oracle import sql
from quadrangle.sources import writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _rounded(x: Column, decimals: int) -> Column:
    """F.round(x, decimals), without its way through text for values that are not close to the middle of two results."""
    y = x * 10.0**decimals
    plain = (F.abs(y) < 2.0**40) & (F.abs(y - F.floor(y) - 0.5) > 0.001)
    return F.when(plain, F.floor(y + 0.5) / 10.0**decimals).otherwise(F.round(x, decimals))


def rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Float columns as doubles, rounded."""
    return df.select(*[_rounded(F.col(f"`{c}`").cast("double"), decimals).alias(c) if k in ("float", "double") or k.startswith("decimal") else F.col(f"`{c}`") for c, k in df.dtypes])


def register(name: str, oracle: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if oracle:
            ORACLES[name] = sql(oracle)
        return f

    return put


class Views:
    """The steps of the student-term plan over one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.dir, name)

    def course(self) -> DataFrame:
        return adapters.course(self.spark, self.dir)

    def cohort(self) -> DataFrame:
        return adapters.cohort(self.spark, self.dir)

    def pred(self) -> DataFrame:
        return adapters.predictions(self.spark, self.dir)

    def crs(self) -> DataFrame:
        return student_terms.course_features(student_terms.standardize_course(self.course()))

    def ct(self) -> DataFrame:
        crs = self.crs()
        return student_terms.join_term_dimension(crs, student_terms.term_dimension(crs))

    def cs(self) -> DataFrame:
        ct = self.ct()
        return student_terms.join_section_features(ct, student_terms.section_features(ct))

    def _terms(self, rows: DataFrame) -> DataFrame:
        """Student-terms of rows; the term dimension meets them when they are aggregated."""
        terms = student_terms.aggregate_student_terms(rows, key_areas=["13"]).drop("academic_year", "academic_term")
        return student_terms.join_term_attributes(terms, student_terms.term_dimension(self.crs()))

    def _rows(self) -> DataFrame:
        return student_terms.with_section_features(student_terms.name_terms(self.crs()))

    def st(self) -> DataFrame:
        return self._terms(self._rows())

    def students(self) -> DataFrame:
        return student_terms.student_features(self.cohort())

    def stj(self) -> DataFrame:
        return student_terms.student_term_features(student_terms.join_student_terms(self.st(), self.students()))

    def cum(self) -> DataFrame:
        terms = self._terms(student_terms.mark_first_taken(self._rows()))
        joined = student_terms.place_features(student_terms.join_student_terms(terms, self.students()))
        return student_terms.share_features(student_terms.cumulative_features(joined), joined.columns)

    def written_cum(self, *columns: str) -> DataFrame:
        """These columns of cum(), written once, for queries that read them several times."""
        return self.spark.read.parquet(writers.scratch_parquet(self.cum().select(*columns)))


def query(name: str, oracle: str | None = None):
    """Register a function of Views."""

    def put(f: Callable[[Views], DataFrame]):
        register(name, oracle)(lambda spark, sf_dir: f(Views(spark, sf_dir)))
        return f

    return put
