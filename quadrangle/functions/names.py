"""Column names: driver-side string rules, applied with toDF()."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

#: Raw column names known to arrive mangled, and their right forms.
MANGLED_NAMES = {
    "attemptedgatewaymathyear_1": "attempted_gateway_math_year_1",
    "attemptedgatewayenglishyear_1": "attempted_gateway_english_year_1",
    "completedgatewaymathyear_1": "completed_gateway_math_year_1",
    "completedgatewayenglishyear_1": "completed_gateway_english_year_1",
    "gatewaymathgradey_1": "gateway_math_grade_y_1",
    "gatewayenglishgradey_1": "gateway_english_grade_y_1",
    "attempteddevmathy_1": "attempted_dev_math_y_1",
    "attempteddevenglishy_1": "attempted_dev_english_y_1",
    "completeddevmathy_1": "completed_dev_math_y_1",
    "completeddevenglishy_1": "completed_dev_english_y_1",
}


def snake_case(name: str) -> str:
    """Lower-case words joined by "_"; words end at punctuation and at case and digit boundaries; quotes vanish."""
    text = re.sub(r"['\"`’]", "", name)
    text = re.sub(r"[\W_]+", " ", text)
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+|[^\sA-Za-z\d]+", text)
    return "_".join(words).lower()


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"names collide: {sorted(twice)}")
    return df.toDF(*names)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return _renamed(df, [snake_case(c) for c in df.columns])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip, lower, and "_" for spaces and "-"."""
    return _renamed(df, [re.sub(r"[ -]", "_", c.strip().lower()) for c in df.columns])


def rename_mangled_columns(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in (MANGLED_NAMES | (overrides or {})).items() if k in df.columns})


def rename_student_id(df: DataFrame) -> DataFrame:
    """study_id, else student_guid, becomes student_id; always a string."""
    old = next((c for c in ("study_id", "student_guid") if c in df.columns), "student_id")
    renamed = df.withColumnRenamed(old, "student_id")
    return renamed.withColumn("student_id", renamed["student_id"].cast("string"))
