"""Writing tables, with a check of the rows that arrived."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadrangle.functions.names import snake_case_columns
from quadrangle.operators.contracts import Field, violations


def scratch_dir(spark: SparkSession) -> str:
    """A folder that all executors share: under spark.checkpoint.dir, or, in local mode, one of our own where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="quadrangle-")
        spark.sparkContext.setCheckpointDir(path)
    return f"{path.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def scratch_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, *, format: str = "parquet") -> DataFrame:
    """Create or replace a table with snake_case columns and return it; raises if it has other than the rows written."""
    spark, seen = df.sparkSession, Observation()
    snake_case_columns(df).observe(seen, F.count(F.lit(1)).alias("n")).write.format(format).mode("overwrite").saveAsTable(name)
    out = spark.table(name)
    if out.count() != seen.get["n"]:
        raise OSError(f"{name}: {out.count()} rows, of {seen.get['n']} written")
    return out


def verify_table(df: DataFrame, contract: dict[str, Field]) -> DataFrame:
    """What a table just written violates of its contract."""
    return violations(df, contract)


def write_single_csv(df: DataFrame, path: str | None = None) -> str:
    """One CSV file with a header, for people: only for outputs that fit one task."""
    path = path or scratch_dir(df.sparkSession)
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def scratch_csv(df: DataFrame) -> str:
    path = scratch_dir(df.sparkSession)
    df.write.option("header", True).csv(path)
    return path


def scratch_parquet(df: DataFrame) -> str:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return path
