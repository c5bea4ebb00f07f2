"""Column expressions for student data. Null in, null out, unless a docstring says otherwise."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Defaults of the data model.
TERMS = ("FALL", "WINTER", "SPRING", "SUMMER")
CORE_TERMS = ("FALL", "SPRING")
MIN_PASSING_GRADE = 1.0
FULL_TIME_CREDITS = 12.0
CREDIT_CHECK = 12.0
COURSE_LEVEL = r"^(\d)\d{2}(?:[A-Z]{0,2})?$"
PEAK_COVID = (("2019-20", "SPRING"), ("2019-20", "SUMMER"), ("2020-21", "FALL"), ("2020-21", "WINTER"), ("2020-21", "SPRING"), ("2020-21", "SUMMER"))
NON_NUMERIC_GRADES = ("A", "F", "I", "M", "O", "P", "W")
TERM_BOUNDS = {"FALL": ((9, 1), (12, 31)), "WINTER": ((1, 1), (1, 31)), "SPRING": ((2, 1), (5, 31)), "SUMMER": ((6, 1), (8, 31))}


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def values_to_null(c: Column, values: Collection) -> Column:
    return F.when(~c.isin(list(values)), c)


def string_to_bool(c: Column) -> Column:
    """Only 1/True/true and 0/False/false count."""
    return F.when(c.isin("1", "True", "true"), True).when(c.isin("0", "False", "false"), False)


def in_categories(c: Column, categories: Sequence[str]) -> Column:
    """Stripped and upper-cased value, null outside the list."""
    u = upper_trim(c)
    return F.when(u.isin(list(categories)), u)


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0)).cast("short")


def military_status(c: Column) -> Column:
    """"0", "1" or "2", also where they come as decimals; others are null."""
    code = c.try_cast("float").try_cast("int").cast("string")
    return F.when(code.isin("0", "1", "2"), code)


def parse_date(c: Column, *formats: str) -> Column:
    """First of the formats that fits; a trailing ".0" is dropped first."""
    plain = F.regexp_replace(c, r"\.0$", "")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in formats])


def year_term(year: Column, term: Column) -> Column:
    return F.concat(year, F.lit(" "), term)


def term_ordinal(term: Column, terms: Sequence[str] = TERMS) -> Column:
    """Place of a term in its year from 0, by which terms sort; null for others."""
    return F.nullif(F.array_position(F.array(*map(F.lit, terms)), term), F.lit(0)).cast("int") - 1


def year_term_date(c: Column, bound: str = "start", first_term: str = "FALL") -> Column:
    """First or last day of a "YYYY-YY TERM"; anything else raises."""
    k = {"start": 0, "end": 1}[bound]
    year = F.regexp_extract(c, r"^(\d{4})-\d{2} ", 1)
    term = F.upper(F.regexp_extract(c, r"^\d{4}-\d{2} (\w+)$", 1))
    opens = ["FALL", "SUMMER"] if first_term == "SUMMER" else ["FALL"]
    y = F.when(term.isin(opens), year.try_cast("int")).otherwise(year.try_cast("int") + 1)
    out = None
    for name, bounds in TERM_BOUNDS.items():
        day = F.make_date(y, F.lit(bounds[k][0]), F.lit(bounds[k][1]))
        out = F.when(term == name, day) if out is None else out.when(term == name, day)
    return F.when(c.isNull(), F.lit(None).cast("date")).otherwise(out.otherwise(F.raise_error(F.concat(F.lit("not a year and term: "), c)).cast("date")))


def course_id(prefix: Column, number: Column) -> Column:
    return F.concat(prefix, number)


def short_cip(c: Column) -> Column:
    """"40.02" gives "40", "9.0101" gives "9"; null where there is no code."""
    return F.btrim(F.nullif(F.regexp_extract(c, r"^(\d[\d.])[\d.]+$", 1), F.lit("")), F.lit("."))


def course_passed(grade: Column, min_passing_grade: float = MIN_PASSING_GRADE) -> Column:
    """Null for audit, incomplete, missing, other, withdrawn; P passes, F fails; else by the number."""
    return F.when(grade.isin("A", "I", "M", "O", "W"), F.lit(None).cast("boolean")).when(grade == "P", True).when(grade == "F", False).otherwise(grade.try_cast("double") >= min_passing_grade)


def course_completed(grade: Column) -> Column:
    """False for incomplete and withdrawn; a null grade counts as completed."""
    return F.coalesce(~grade.isin("I", "W"), F.lit(True))


def course_level(number: Column, pattern: str = COURSE_LEVEL) -> Column:
    return F.nullif(F.regexp_extract(F.trim(number), pattern, 1), F.lit("")).try_cast("short")


def grade_numeric(grade: Column) -> Column:
    return F.when(~grade.isin(*NON_NUMERIC_GRADES), grade.try_cast("float"))


def grade_letter(grade: Column) -> Column:
    """Letters stay (A: AUDIT, O: OTHER); numbers 0 to 4.01 fall into right-closed bins F to A."""
    g = grade.try_cast("double")
    letters = F.when(grade == "A", "AUDIT").when(grade == "O", "OTHER").when(grade.isin(*NON_NUMERIC_GRADES), grade)
    bins = F.when((g < 0) | (g > 4.01), F.lit(None).cast("string")).when(g <= 0.69, "F").when(g <= 1.69, "D").when(g <= 2.69, "C").when(g <= 3.69, "B").when(g <= 4.01, "A")
    return F.coalesce(letters, bins)


def pell_flag(c: Column) -> Column:
    return F.when(c == "Y", True).when(c == "N", False)


def fraction(part: Column, whole: Column) -> Column:
    """Null where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def in_pairs(year: Column, term: Column, pairs: Collection[tuple[str, str]] = PEAK_COVID) -> Column:
    return F.coalesce(F.concat_ws(" ", year, term).isin([" ".join(p) for p in pairs]) & year.isNotNull() & term.isNotNull(), F.lit(False))


def in_subset(c: Column, values: Collection[str]) -> Column:
    """Null is in no subset."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def year_of_enrollment(term_start: Column, cohort_start: Column) -> Column:
    """1 in the cohort's first year; 0 and below before it."""
    return F.ceil((F.datediff(term_start, cohort_start) + 1) / F.lit(365.25)).cast("short")


def before_year(years: Sequence[Column], enrollment_year: Column) -> Column:
    out = F.lit(False)
    for y in years:
        out = out | F.coalesce(y < enrollment_year, F.lit(False))
    return out


def count_in_area(areas: Column, area: Column, fill: str = "-1") -> Column:
    """Array elements equal to the area; a null area counts as `fill`."""
    return F.size(F.filter(areas, lambda x: x == F.coalesce(area, F.lit(fill))))


def enrollment_intensity(credits: Column, full_time: float = FULL_TIME_CREDITS) -> Column:
    """Unknown credits count as part-time."""
    return F.when(credits >= full_time, "FULL-TIME").otherwise("PART-TIME")


def value_equals(c: Column, to) -> Column:
    return c.isin(list(to)) if isinstance(to, (list, tuple, set, frozenset)) else c == to


def guarded_fraction(part: Column, whole: Column, what: str) -> Column:
    """fraction(), raising outside [0, 1]."""
    f = fraction(part, whole)
    return F.when((f < 0) | (f > 1), F.raise_error(F.lit(f"{what} is outside [0, 1]")).cast("double")).otherwise(f)


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution by a published rational approximation of erf (error under 1.5e-7)."""
    z = F.abs(x) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + F.lit(0.3275911) * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - poly * F.exp(-z * z)
    return F.when(x >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)


def adjusted_skewness(c: Column) -> Column:
    """Bias-adjusted sample skewness (an aggregate); null under three values."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))
