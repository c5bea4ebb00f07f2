"""Descriptions of tables and associations of columns, without any pass over rows on the driver."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.operators.distincts import distinct_counts
from quadrangle.operators.quantiles import exact_quantiles
from quadrangle.operators.running import running


def value_counts(df: DataFrame, cols: Sequence[str], *, dropna: bool = True) -> DataFrame:
    """cols, count, pct (half-even, one decimal). The window runs over groups, not rows."""
    rows = df.dropna(subset=list(cols)) if dropna else df
    n = rows.groupBy(*cols).agg(F.count("*").alias("count"))
    return n.withColumn("pct", F.bround(100 * F.col("count") / F.sum("count").over(Window.partitionBy()), 1))


def crosstab(df: DataFrame, row: str, col: str, *, margins: bool = False, normalize: str | None = None) -> DataFrame:
    """Long contingency table (row, col, value): counts, or shares of "all", "index" or "columns", 3 decimals. Margins are named "All"."""
    rows = df.dropna(subset=[row, col]).select(F.col(row).cast("string").alias("row"), F.col(col).cast("string").alias("col"))
    if margins:
        n = rows.cube("row", "col").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
        n = n.select(F.coalesce("row", F.lit("All")).alias("row"), F.coalesce("col", F.lit("All")).alias("col"), "n")
    else:
        n = rows.groupBy("row", "col").agg(F.count("*").alias("n"))
    if normalize is None:
        return n.withColumnRenamed("n", "value")
    inner = (F.col("row") != "All") & (F.col("col") != "All")
    over = {"all": Window.partitionBy(), "index": Window.partitionBy("row"), "columns": Window.partitionBy("col")}[normalize]
    total = F.sum(F.when(inner, F.col("n"))).over(over) if normalize == "all" else F.sum(F.when(F.col("col" if normalize == "index" else "row") != "All", F.col("n"))).over(over)
    return n.select("row", "col", F.bround(F.col("n") / total, 3).alias("value"))


def describe_columns(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, count, mean, sd, min, p.., max, null_count, null_pct) of numeric columns; (.., n_unique) of others is in `profile`."""
    aggs, rows = [], []
    for k, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        parts = {"count": F.count(x), "mean": F.avg(x), "sd": F.stddev_samp(x), "min": F.min(x), "max": F.max(x), "null_count": F.count_if(x.isNull()), "null_pct": 100.0 * F.count_if(x.isNull()) / F.count("*")}
        aggs += [a.alias(f"a{k}_{m}") for m, a in parts.items()]
        rows.append(F.struct(F.lit(c).alias("column"), *[F.col(f"a{k}_{m}").alias(m) for m in parts]))
    plain = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    names = {q: f"p{int(q * 100)}" for q in percentiles}
    found = exact_quantiles(df, cols, percentiles).groupBy("column").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(m) for q, m in names.items()])
    return plain.join(F.broadcast(found), "column").select("column", "count", "mean", "sd", "min", *names.values(), "max", "null_count", "null_pct")  # a row for each column


def unique_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: n_unique combinations, n_duplicates beyond the first of each, n_null rows with any null."""
    nulls = F.lit(False)
    for c in cols:
        nulls = nulls | F.col(c).isNull()
    g = df.groupBy(*cols).agg(F.count("*").alias("n"), F.count_if(nulls).alias("z"))
    return g.agg(F.count("*").alias("n_unique"), F.sum(F.col("n") - 1).alias("n_duplicates"), F.sum("z").alias("n_null"))


def single_value_columns(df: DataFrame) -> DataFrame:
    """Columns with one distinct value besides nulls."""
    return distinct_counts(df, limit=2).where("n_distinct = 1").select("column")


def null_fractions(df: DataFrame) -> DataFrame:
    flat = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(f"a{k}") for k, c in enumerate(df.columns)])
    return flat.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"a{k}").alias("fraction")) for k, c in enumerate(df.columns)])).alias("r")).select("r.*")


def _with_pairs(found: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """A row for each pair, with a null value where none of its rows is complete."""
    every = found.sparkSession.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "pair int, col1 string, col2 string")
    return every.join(found, "pair", "left").select("col1", "col2", "value")


def _cells(df: DataFrame, cells: Sequence[tuple[str, str]], mixed: Sequence[tuple[str, str]]) -> DataFrame:
    """(pair, a, b, n, s, q) of pairs of categories, and of a category and a number (b null; sums of the number and its square), of rows where both are known.

    One scan: tasks code levels once and count pairs of codes in blocks, whatever
    the number of pairs; only cells leave a task.
    """
    levels = list(dict.fromkeys([*(x for p in cells for x in p), *(c for c, _ in mixed)]))
    numbers = list(dict.fromkeys(x for _, x in mixed))
    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(levels)], *[F.col(f"`{x}`").cast("double").alias(f"x{k}") for k, x in enumerate(numbers)])
    of, at = {c: k for k, c in enumerate(levels)}, {x: len(levels) + k for k, x in enumerate(numbers)}
    crossed = [(k, of[a], of[b]) for k, (a, b) in enumerate(cells)]
    summed = [(len(cells) + k, of[c], at[x]) for k, (c, x) in enumerate(mixed)]
    return rows.mapInArrow(_blocks(len(levels), crossed, summed), "pair int, a string, b string, n double, s double, q double").groupBy("pair", "a", "b").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))


#: Cells that a task holds before it sends them.
HELD = 1_000_000


def _blocks(n_levels: int, crossed: list[tuple[int, int, int]], summed: list[tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[dict] = [{} for _ in range(n_levels)]
        cells: dict[tuple[int, int, int], np.ndarray] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            names = [list(k) for k in known]
            keys = list(cells)
            for s in range(0, len(keys), 50_000):
                part = keys[s : s + 50_000]
                values = np.array([cells[k] for k in part])
                firsts = {p: a for p, a, _ in [*crossed, *summed]}
                seconds = {p: b for p, _, b in crossed}
                a = [names[firsts[p]][i] for p, i, _ in part]
                b = [names[seconds[p]][j] if p in seconds else None for p, _, j in part]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in part], pa.int32()), pa.array(a, pa.string()), pa.array(b, pa.string()), *(pa.array(values[:, k]) for k in range(3))], names=["pair", "a", "b", "n", "s", "q"])

        for batch in batches:
            codes = []
            for k in range(n_levels):
                coded = pc.dictionary_encode(batch.column(k))
                own = np.array([known[k].setdefault(v, len(known[k])) for v in coded.dictionary.to_pylist()] or [0], np.int64)
                index = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
                codes.append(np.where(index < 0, -1, own[np.maximum(index, 0)]))
            for p, a, b in crossed:
                both = (codes[a] >= 0) & (codes[b] >= 0)
                pair, n = np.unique(codes[a][both] << 32 | codes[b][both], return_counts=True)
                for x, y in zip(pair.tolist(), n.tolist(), strict=True):
                    key = (p, x >> 32, x & 0xFFFFFFFF)
                    cells[key] = cells.get(key, 0.0) + np.array([y, 0.0, 0.0])
            for p, a, x in summed:
                values = pc.fill_null(batch.column(x), float("nan")).to_numpy(zero_copy_only=False)
                both = (codes[a] >= 0) & batch.column(x).is_valid().to_numpy(zero_copy_only=False)
                level, inverse = np.unique(codes[a][both], return_inverse=True)
                sums = np.stack([np.bincount(inverse, minlength=len(level)), np.bincount(inverse, values[both], len(level)), np.bincount(inverse, values[both] ** 2, len(level))], axis=1).astype(float)
                for i, row in zip(level.tolist(), sums, strict=True):
                    cells[p, i, -1] = cells.get((p, i, -1), 0.0) + row
            if len(cells) > HELD:
                yield from sent()
                cells, known = {}, [{} for _ in range(n_levels)]
        yield from sent()

    return run


def _cramers(cells: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    wa, wb = Window.partitionBy("pair", "a"), Window.partitionBy("pair", "b")
    cells = cells.withColumns({"ra": F.sum("n").over(wa), "cb": F.sum("n").over(wb)})
    # A level's first cell counts it; joins and windows run over cells.
    first_a, first_b = (F.row_number().over(w.orderBy(o)) == 1 for w, o in ((wa, "b"), (wb, "a")))
    cells = cells.withColumns({"fa": first_a, "fb": first_b})
    t = cells.groupBy("pair").agg(F.sum("n").alias("n"), F.sum(F.col("n") ** 2 / (F.col("ra") * F.col("cb"))).alias("q"), F.count_if("fa").alias("r"), F.count_if("fb").alias("c"))
    chi2 = F.greatest(F.col("n") * (F.col("q") - 1), F.lit(0.0))  # empty cells add their expectation, which this form includes
    low = F.least("r", "c") - 1
    return _with_pairs(t.select("pair", F.when(low > 0, F.sqrt(chi2 / F.col("n") / low)).alias("value")), pairs)


def _ratios(cells: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    t = cells.groupBy("pair").agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("mean"), F.sum(F.col("s") ** 2 / F.col("n")).alias("b"), F.sum("q").alias("q"), F.count("*").alias("k"))
    shift = F.col("n") * F.col("mean") ** 2
    between, total = F.greatest(F.col("b") - shift, F.lit(0.0)), F.col("q") - shift
    return _with_pairs(t.select("pair", F.when(F.col("k") > 1, F.when(total <= 0, F.lit(0.0)).otherwise(F.sqrt(F.least(between / total, F.lit(1.0))))).alias("value")), pairs)


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row, `value`: plain chi-square V on complete pairs; null where a column has one level."""
    return _cramers(_cells(df, [(a, b)], []), [(a, b)]).select("value")


def correlation_ratio(df: DataFrame, category: str, number: str) -> DataFrame:
    """One row, `value`: eta, 0 where the groups' means agree; null for a single group."""
    return _ratios(_cells(df, [], [(category, number)]), [(category, number)]).select("value")


def _average_rank(counts: DataFrame, col: str, out: str) -> DataFrame:
    """(col, out): the average rank of each distinct value."""
    g = running(counts.groupBy(col).agg(F.sum("n").alias("k")), col, {"upto": "k"})
    return g.select(F.col(col).alias(f"__{col}"), (F.col("upto") - (F.col("k") - 1) / 2).alias(out))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row, `value`: correlation of average ranks on complete pairs."""
    known = df.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    pairs = known.groupBy("a", "b").agg(F.count("*").cast("double").alias("n"))
    ra, rb = _average_rank(pairs, "a", "ra"), _average_rank(pairs, "b", "rb")
    j = pairs.join(ra, pairs["a"] == ra["__a"]).join(rb, pairs["b"] == rb["__b"])
    n, x, y = F.sum("n"), F.col("ra"), F.col("rb")
    t = j.agg(n.alias("n"), *[F.sum(F.col("n") * e).alias(k) for k, e in (("x", x), ("y", y), ("xx", x * x), ("yy", y * y), ("xy", x * y))])
    cov, vx, vy = (F.col("n") * F.col(p) - F.col(q) * F.col(r) for p, q, r in (("xy", "x", "y"), ("xx", "x", "x"), ("yy", "y", "y")))
    return t.select(F.try_divide(cov, F.sqrt(vx * vy)).alias("value"))


def _moments(pairs: list[tuple[int, int]], held: list[int], n: int):
    """Of rows of ranks, n numbers for each column (within all rows, then within those where each column of `held` is known): n, x, y, xx, yy, xy of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {c: 1 + k for k, c in enumerate(held)}
        total = np.zeros((len(pairs), 6))
        for batch in batches:
            ranks = [np.full((len(batch), n), np.nan) for _ in range(batch.num_columns)]
            for k, column in enumerate(batch.columns):
                there = column.is_valid().to_numpy(zero_copy_only=False)
                ranks[k][there] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            for i, (a, b) in enumerate(pairs):
                x, y = ranks[a][:, place.get(b, 0)], ranks[b][:, place.get(a, 0)]
                both = ~(np.isnan(ranks[a][:, 0]) | np.isnan(ranks[b][:, 0]))
                x, y = x[both], y[both]
                total[i] += len(x), x.sum(), y.sum(), x @ x, y @ y, x @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pairs), dtype=np.int32)), *(pa.array(total[:, k]) for k in range(6))], names=["pair", "n", "x", "y", "xx", "yy", "xy"])

    return run


def rank_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col1, col2, value): Spearman's correlation of each pair of numeric columns, by average ranks within the rows where both are known.

    One sort ranks all columns: distinct values are counted by column, and for
    each column with nulls once more, within its known rows; running totals of
    these counts are ranks. They go back to their cells and rows, whose products
    tasks add up. What is shuffled grows with cells (times the columns with
    nulls), not with pairs.
    """
    cols = list(dict.fromkeys(x for p in pairs for x in p))
    of = {c: k for k, c in enumerate(cols)}
    rows = df.select(F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(cols)])
    holes = rows.agg(*[F.count_if(F.col(f"x{k}").isNull()).alias(f"x{k}") for k in range(len(cols))]).first()  # one row
    held = [k for k in range(len(cols)) if holes[f"x{k}"]]
    counts = ["n", *(f"n{k}" for k in held)]
    known = [F.lit(1).cast("long").alias("n"), *[F.col(f"x{k}").isNotNull().cast("long").alias(f"n{k}") for k in held]]
    cells = rows.select("row", *known, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"x{k}").alias("x")) for k in range(len(cols))])).alias("c")).select("row", *counts, "c.k", "c.x").where("x is not null")
    values = cells.groupBy("k", "x").agg(*[F.sum(c).alias(c) for c in counts])
    upto = running(values, "x", {f"upto_{c}": c for c in counts}, by=["k"])
    ranks = upto.select("k", "x", F.array(*[F.col(f"upto_{c}") - (F.col(c) - 1) / 2 for c in counts]).alias("ranks"))
    placed = cells.select("row", "k", "x").join(ranks, ["k", "x"])
    wide = placed.groupBy("row").agg(*[F.first(F.when(F.col("k") == k, F.col("ranks")), ignorenulls=True).alias(f"r{k}") for k in range(len(cols))]).drop("row")
    wanted = [(of[a], of[b]) for a, b in pairs]
    t = wide.mapInArrow(_moments(wanted, held, len(counts)), "pair int, n double, x double, y double, xx double, yy double, xy double").groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    cov, vx, vy = (F.col("n") * F.col(p) - F.col(q) * F.col(r) for p, q, r in (("xy", "x", "y"), ("xx", "x", "x"), ("yy", "y", "y")))
    return _with_pairs(t.select("pair", F.try_divide(cov, F.sqrt(vx * vy)).alias("value")), pairs)


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")


def pairwise_associations(df: DataFrame, cols: Sequence[str] | None = None, *, ref_col: str | None = None) -> DataFrame:
    """(col1, col2, value): Cramer's V, correlation ratio or Spearman by the kinds of the two; dates count as numbers, booleans as strings; a column with itself is 1.

    Null where no row has both, or a category has one level.
    """
    kinds = dict(df.dtypes)
    cols = [c for c in (cols or df.columns) if kinds[c] in NUMBERS or kinds[c] in ("string", "boolean")]
    df = df.select(*[F.col(f"`{c}`").cast("timestamp").cast("double").alias(c) if kinds[c] in ("date", "timestamp") else F.col(f"`{c}`").cast("string").alias(c) if kinds[c] == "boolean" else F.col(f"`{c}`") for c in cols])
    wanted = [(a, b) for i, a in enumerate(cols) for b in cols[i:] if not ref_col or ref_col in (a, b)]
    number = {c: kinds[c] in NUMBERS for c in cols}
    spark, parts = df.sparkSession, []
    if same := [(a, b, 1.0) for a, b in wanted if a == b]:
        parts.append(spark.createDataFrame(same, "col1 string, col2 string, value double"))
    crossed = [(a, b) for a, b in wanted if a != b and not number[a] and not number[b]]
    mixed = [(a, b) for a, b in wanted if number[a] != number[b]]
    if crossed or mixed:
        cells = _cells(df, crossed, [(b, a) if number[a] else (a, b) for a, b in mixed])
        if crossed:
            parts.append(_cramers(cells.where(F.col("pair") < len(crossed)), crossed))
        if mixed:
            parts.append(_ratios(cells.where(F.col("pair") >= len(crossed)).withColumn("pair", F.col("pair") - len(crossed)), mixed))
    if ranked := [(a, b) for a, b in wanted if a != b and number[a] and number[b]]:
        parts.append(rank_correlations(df, ranked))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "col1 string, col2 string, value double")


def top_bottom(associations: DataFrame, n: int = 10) -> DataFrame:
    """(which, col1, col2, value): the n highest and the n lowest associations of different columns."""
    known = associations.where("col1 <> col2 and value is not null")  # a row for each pair of columns
    high = known.orderBy(F.desc("value"), "col1", "col2").limit(n).select(F.lit("high").alias("which"), "col1", "col2", "value")
    return high.unionByName(known.orderBy("value", "col1", "col2").limit(n).select(F.lit("low").alias("which"), "col1", "col2", "value"))


def histogram(c: Column, width: float) -> Column:
    return (F.floor(c / width) * width).cast("double")
