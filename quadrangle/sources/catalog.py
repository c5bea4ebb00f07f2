"""Readable names and descriptions of feature columns: a catalog is a table in a file, ours is made by the rules of the naming scheme.

A catalog's keys are names of columns or, where they hold a group in
parentheses, patterns that a whole name must match; the group's text goes into
the name at {}. An exact key comes first, then the first pattern in the order
of the file.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrangle.sources.writers import scratch_dir, scratch_parquet

SCHEMA = "at int, feature string, name string, short_desc string, long_desc string"

#: Forms of features of single courses or subject areas, beside the keys that patterns have.
THINGS = {"course_subject_area": "subject area {}", "course_id": "course {}"}
FORMS = [
    ("cummax_in_12_creds_took", "took {} within the first 12 credits", "Whether a course of it was taken within the student's first 12 credits", "1 if the student took one before more than 12 credits were earned, else 0; the same in all terms of a student."),
    ("cummax_took", "took {} so far", "Whether a course of it was taken up to the term", "1 from the first term on in which the student took one, 0 before."),
    ("took", "took {} this term", "Whether a course of it was taken in the term", "1 if the student took at least one in this term, else 0."),
    ("frac_courses", "fraction of courses this term: {}", "Its share of the courses of the term", "Courses of it in this term, divided by all of the student's courses in the term; 1 means all of them."),
    ("cumfrac_num_courses", "fraction of courses so far: {}", "Its share of the courses up to the term", "Courses of it up to and with this term, divided by all of the student's courses up to then."),
    ("num_courses", "number of courses this term: {}", "Its number of courses in the term", "How many courses of it the student took in this term; sections of one course count each."),
]
#: Rules of other names: pattern, name, what it is, and how it is to be read. The first that matches describes a column.
RULES = [
    (r"cumfrac_(core_|noncore_|)terms_enrolled", "fraction of {}terms enrolled so far", "Share of the {}terms since the first one in which the student was enrolled", "Terms with courses, divided by all terms that there were since the student's first."),
    (r"cumfrac_num_courses_(.+)", "fraction of courses so far: {}", "Share of all courses up to the term: {}", "Counted over all of the student's terms up to this one; 1 means all courses, 0 none."),
    (r"frac_courses_(.+)", "fraction of courses this term: {}", "Share of the term's courses: {}", "Divided by the number of courses that the student took in the term."),
    (r"num_courses_diff_(.+)", "change of the number of courses: {}", "Difference of the numbers of courses: {}", "Positive if the later term has more courses; empty where there is no such term."),
    (r"(.+)_diff_prev_term", "change since the term before: {}", "Difference to the student's term before: {}", "Positive if the value rose; empty in a student's first term."),
    (r"(.+)_diff_(term_\d_to_term_\d)", "change from one term to a later one: {}", "Difference between two of the student's first terms: {}", "The same in all terms of a student; empty where one of them is missing."),
    (r"num_courses_(.+)", "number of courses this term: {}", "How many of the term's courses are so: {}", "A count of sections; 0 if there are none."),
    (r"cumnum_unique_(.+)", "number of different ones so far: {}", "Different values up to the term: {}", "Each value counts once, in the first term that has it."),
    (r"cumnum_repeated_(.+)", "number of repeated ones so far: {}", "Values up to the term that the student had before: {}", "All courses up to the term, less the different ones."),
    (r"cumnum_(.+)", "number so far: {}", "Terms up to the term: {}", "Counts the student's own terms, with this one."),
    (r"cumsum_(.+)", "total so far: {}", "Sum over the terms up to the term: {}", "Adds up the student's own terms, with this one."),
    (r"cummean_(.+)", "mean so far: {}", "Mean over the terms up to the term: {}", "Each term counts once, however many courses it has."),
    (r"cummin_(.+)", "least so far: {}", "Least value of the terms up to the term: {}", "Never rises from term to term."),
    (r"cumstd_(.+)", "spread so far: {}", "Standard deviation over the terms up to the term: {}", "Empty in a student's first term, as one value has no spread."),
    (r"cummax_(.+)", "ever so far: {}", "Whether it was so in any term up to the term: {}", "Once 1 it stays 1."),
    (r"sections_num_students_(.+)", "students in the same sections: {}", "Students in all sections of the term's courses: {}", "Summed over the student's sections; the student counts in each."),
    (r"section_num_students_(.+)", "students in a section: {}", "Students in the sections of the term's courses: {}", "Over the student's sections of the term."),
    (r"frac_sections_students_(.+)", "fraction of the sections' students: {}", "Share of all students in the same sections: {}", "Over all sections that the student took in the term."),
    (r"(?:first_year_to|years_to_latest)_(.+)", "years to a credential: {}", "Years from the first enrollment to the credential: {}", "0 means that none was earned."),
    (r"student_(.+)", "student: {}", "What is known of the student: {}", "As of the first year or of the term that it names."),
    (r"term_(.+)", "term: {}", "What is known of the term: {}", "The same for all students of a term, unless it names the student's courses."),
    (r"(.+)", "{}", "From the data of the institution: {}", "As reported, or counted from what was reported."),
]


def _words(x: str) -> str:
    return x.replace("_", " ").strip()


def describe(column: str) -> tuple[str, str, str]:
    """(name, short description, long description) of a column by the first rule that matches its whole name."""
    for pattern, name, short, long in RULES:
        if m := re.fullmatch(pattern, column):
            what = f"{_words(m[1])} " if m[1].endswith("_") and "terms" in pattern else ", ".join(_words(g) for g in m.groups() if g)
            return name.format(what), short.format(what), f"{short.format(what)}. {long}"
    raise ValueError(f"a column without a name: {column!r}")


def catalog_rows(columns: Sequence[str]) -> list[tuple[int, str, str, str, str]]:
    """Rows of SCHEMA: an exact key for each column that no pattern has, then the patterns of single courses and areas."""
    early = FORMS[0]
    patterns = [(f"^took_{thing}_(.*)_in_12_creds$", early[1].format(THINGS[thing]), f"{early[2]}: {_words(thing)} that the name gives", early[3]) for thing in THINGS]  # as the columns of this package are called
    patterns += [(f"^{form}_{thing}_(.*)$", name.format(THINGS[thing]), f"{short}: {_words(thing)} that the name gives", long) for thing in THINGS for form, name, short, long in FORMS]
    exact = [(c, *describe(c)) for c in dict.fromkeys(x.lower() for x in columns) if not any(re.fullmatch(p, c) for p, *_ in patterns)]
    return [(k, *row) for k, row in enumerate([*exact, *patterns])]


def write_catalog(spark: SparkSession, rows: Sequence[tuple], path: str | None = None) -> str:
    """Rows of SCHEMA as JSON lines in a folder; its path."""
    path = path or scratch_dir(spark)
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.json(path)
    return path


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog from JSON lines, keys in lower case. Descriptions may be absent; without `at`, patterns are in the order of their text."""
    return spark.read.schema(SCHEMA).json(path).withColumn("feature", F.lower("feature"))


def map_feature_names(df: DataFrame, catalog: DataFrame, *, col: str = "feature") -> DataFrame:
    """df with readable, short_desc and long_desc; names that the catalog has no key for are their own readable name, without descriptions.

    Keys are resolved once for each distinct name. Of repeated keys the first holds. Null names stay null.
    """
    group = F.col("feature").contains("(") & F.col("feature").contains(")")
    first = Window.partitionBy("feature").orderBy("at")
    exact = catalog.where(~group).withColumn("__rn", F.row_number().over(first)).where("__rn = 1").select("feature", "name", "short_desc", "long_desc")
    patterns = catalog.where(group).select(F.struct("at", "feature").alias("place"), F.concat(F.lit("^(?:"), "feature", F.lit(")$")).alias("pattern"), F.col("name").alias("template"), F.col("short_desc").alias("p_short"), F.col("long_desc").alias("p_long"))

    names = df.select(F.lower(col).alias("feature")).where("feature is not null").distinct()
    known = names.join(exact, "feature", "left")
    hits = names.join(exact, "feature", "left_anti").join(F.broadcast(patterns), F.expr("feature rlike pattern"))  # the few keys with a group
    best = hits.withColumn("__rn", F.row_number().over(Window.partitionBy("feature").orderBy("place"))).where("__rn = 1")
    best = best.select("feature", F.replace("template", F.lit("{}"), F.expr("regexp_extract(feature, pattern, 1)")).alias("p_name"), "p_short", "p_long")
    found = known.join(best, "feature", "left").select(F.col("feature").alias("__f"), F.coalesce("name", "p_name").alias("__name"), F.coalesce("short_desc", "p_short").alias("short_desc"), F.coalesce("long_desc", "p_long").alias("long_desc"))
    out = df.join(found, F.lower(F.col(col)) == F.col("__f"), "left")
    return out.withColumn("readable", F.coalesce("__name", F.lower(col))).select(*df.columns, "readable", "short_desc", "long_desc")


def feature_coverage(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """(feature, readable, short_desc, long_desc, n_known, n_rows): each column of df with what the catalog says of it, and how many rows have a value."""
    n = df.agg(F.count("*").alias("__all"), *[F.count(F.col(f"`{c}`")).alias(f"__{k}") for k, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c.lower()).alias("feature"), F.col(f"__{k}").alias("n_known"), F.col("__all").alias("n_rows")) for k, c in enumerate(df.columns)]
    counts = n.select(F.explode(F.array(*rows)).alias("r")).select("r.*")  # a row for each column
    counts = df.sparkSession.read.parquet(scratch_parquet(counts))  # names are looked up in several steps, each of which would count again
    return map_feature_names(counts, catalog).select("feature", "readable", "short_desc", "long_desc", "n_known", "n_rows")
