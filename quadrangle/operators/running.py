"""Running totals over a whole table: rows are range-partitioned once, and few offsets say what comes before each partition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows, and for each partition a copy of its first row and of its last one.
ROW, HEAD, TAIL = 0, 1, 2


def _within(names: list[str], values: list[str]):
    """Totals within a partition that is sorted by group and place; they begin again where `__group` changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, first, lo, group, last = TaskContext.get().partitionId(), None, None, None, None
        carry = [0] * len(values)

        def marked(batch: pa.RecordBatch, totals: list, mark: int, in_first) -> pa.RecordBatch:
            n = len(batch)
            own = [batch.column(batch.schema.get_field_index(c)) for c in names]
            kinds = [batch.schema.field(v).type for v in values]
            more = [pa.array(np.full(n, x), t) for x, t in ((pid, pa.int32()), (mark, pa.int32()), (lo, pa.int64()))]
            return pa.RecordBatch.from_arrays([*own, *(pa.array(t, k) for t, k in zip(totals, kinds, strict=True)), *more, pa.array(in_first)], names=[*names, *(f"__sum{k}" for k in range(len(values))), "__pid", "__mark", "__lo", "__first"])

        for batch in batches:
            if not len(batch):
                continue
            groups = batch.column(batch.schema.get_field_index("__group")).to_numpy()
            if first is None:
                first, group = groups[0], groups[0]
                lo = batch.column(batch.schema.get_field_index("__key"))[0].as_py()
                yield marked(batch.slice(0, 1), [np.zeros(1, int)] * len(values), HEAD, np.array([True]))
            starts = np.flatnonzero(np.append(groups[0] != group, groups[1:] != groups[:-1]))  # where a new group begins
            totals = []
            for k, v in enumerate(values):
                total = np.cumsum(pc.fill_null(batch.column(batch.schema.get_field_index(v)), 0).to_numpy(zero_copy_only=False))
                shift = np.full(len(total), carry[k], total.dtype)
                if len(starts):
                    before = np.where(starts > 0, total[starts - 1], 0)
                    shift[starts[0] :] = -np.repeat(before, np.diff(np.append(starts, len(total))))
                totals.append(total + shift)
                carry[k] = totals[-1][-1]
            group, last = groups[-1], batch.slice(len(batch) - 1, 1)
            yield marked(batch, totals, ROW, groups == first)
        if last is not None:
            yield marked(last, [[x] for x in carry], TAIL, np.array([group == first]))

    return run


def running(df: DataFrame, c: str, sums: dict[str, str], *, by: Sequence[str] = (), descending: bool = False, ties: Sequence[str] = (), whole: dict[str, str] | None = None) -> DataFrame:
    """df with totals {name: column} of all rows of a group up to and with this one, in order of c, then of ties. Null values count as 0.

    whole: {name: name of a total}, the same totals over the whole table (without groups only).

    df is evaluated once, and nothing runs before the result does. One exchange
    deals rows by ranges of (group, c); each partition adds up its own rows, and
    a window over two rows of each partition finds what is before its first
    group. Both read that one exchange; if a session shouldn't reuse it and the
    ranges differed, the result would be an error and never other totals.
    """
    kinds = dict(df.dtypes)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = [*(F.col(b).asc() for b in by), F.col(c).desc() if descending else F.col(c).asc()]
    values = [f"__v{k}" for k in range(len(sums))]
    rows = df.withColumns({v: F.col(x) for v, x in zip(values, sums.values(), strict=True)} | {"__group": F.xxhash64(*by) if by else F.lit(0).cast("long"), "__key": F.xxhash64(*by, c)})
    dealt = rows.repartitionByRange(n, *place).sortWithinPartitions(*place, *ties)
    totals = [f"__sum{k}" for k in range(len(sums))]
    number = [dict(rows.dtypes)[v] for v in values]
    number = [t if t in ("double", "bigint") else "double" if t == "float" else "bigint" for t in number]
    dealt = dealt.withColumns({v: F.col(v).cast(t) for v, t in zip(values, number, strict=True)})
    schema = ", ".join([*(f"`{x}` {kinds[x]}" for x in df.columns), *(f"{t} {k}" for t, k in zip(totals, number, strict=True)), "__pid int, __mark int, __lo long, __first boolean"])
    out = dealt.mapInArrow(_within(df.columns, values), schema)

    earlier = Window.partitionBy(*by).orderBy("__pid", "__mark").rowsBetween(Window.unboundedPreceding, -1)  # over two rows a partition
    marks = out.where(F.col("__mark") != ROW)
    if whole and by:
        raise ValueError("totals of the whole table are for tables without groups")
    ends = {name: totals[list(sums).index(x)] for name, x in (whole or {}).items()}
    before = marks.select("__mark", *[F.sum(t).over(Window.partitionBy()).alias(f"__all{k}") for k, t in enumerate(ends.values())], F.col("__pid").alias("__of"), F.col("__lo").alias("__from"), *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"{t}_before") for t in totals]).where(F.col("__mark") == HEAD).drop("__mark")
    joined = out.where(F.col("__mark") == ROW).join(F.broadcast(before), F.col("__pid") == F.col("__of"))
    same = F.col("__lo") == F.col("__from")
    wrong = F.raise_error(F.lit("ranges of the two readings differ"))
    sums_ = [F.when(~same, wrong.cast(k)).when(F.col("__first"), F.col(t) + F.col(f"{t}_before")).otherwise(F.col(t)).cast(k).alias(name) for name, t, k in zip(sums, totals, number, strict=True)]
    return joined.select(*[F.col(f"`{x}`") for x in df.columns], *sums_, *[F.col(f"__all{k}").alias(name) for k, name in enumerate(ends)])
