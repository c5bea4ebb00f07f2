"""Distinct values of all columns in one pass: each task sends a column's values once, and stops at a limit if there is one."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that a task remembers for all columns; beyond, it forgets them and may send some again.
REMEMBERED = 500_000


def _text(c: str, kind: str) -> Column:
    """A column as text that is equal where values are equal."""
    x = F.col(f"`{c}`")
    if kind in ("float", "double"):
        return F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x).cast("string")  # -0.0 equals 0.0
    if kind == "binary":
        return F.hex(x)
    return F.to_json(x) if kind.startswith(("array", "map", "struct")) else x.cast("string")


def _seen(limit: int | None, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[set] = []
        held = 0
        for batch in batches:
            known = known or [set() for _ in range(batch.num_columns)]
            for k, column in enumerate(batch.columns):
                own = known[k]
                if limit and len(own) >= limit and None in own:
                    continue
                new = [v for v in pc.unique(column).to_pylist() if v not in own]
                if limit:
                    room = limit - sum(v is not None for v in own)
                    new = [v for v in new if v is None] + [v for v in new if v is not None][: max(room, 0)]
                if not new:
                    continue
                own.update(new)
                held += len(new)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(new), pa.int32()), pa.array(new, pa.string())], names=["k", "value"])
            if held > remembered and not limit:
                known, held = [], 0

    return run


def distinct_values(df: DataFrame, *, limit: int | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """(column, value) once for each distinct value of each column, as text; a null value where the column has nulls.

    With a limit, a column with more values than that comes with at least so
    many of them, and perhaps not with all.
    """
    rows = df.select(*[_text(c, kind).alias(f"c{k}") for k, (c, kind) in enumerate(df.dtypes)])
    sent = rows.mapInArrow(_seen(limit, remembered), "k int, value string").distinct()
    return sent.select(F.lit(df.columns)[F.col("k")].alias("column"), "value")


def distinct_counts(df: DataFrame, *, limit: int | None = None) -> DataFrame:
    """(column, n_distinct) of every column, nulls not counted; of a column with more than `limit` some number from it on."""
    n = distinct_values(df, limit=limit).groupBy("column").agg(F.count("value").alias("n_distinct"))
    every = df.sparkSession.range(1).select(F.explode(F.lit(df.columns)).alias("column"))
    return every.join(n, "column", "left").select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
