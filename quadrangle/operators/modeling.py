"""Preparing modelling tables and scoring them: splits, weights, imputation, feature selection, models, attributions."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.functions.columns import adjusted_skewness
from quadrangle.operators.evaluation import roc_auc
from quadrangle.operators.quantiles import exact_quantiles
from quadrangle.sources.writers import scratch_parquet

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
FRACTIONS = {"train": 0.6, "test": 0.2, "validate": 0.2}


def uniform(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the key and the seed only, so it is the same in any partitioning."""
    return F.conv(F.substring(_mark(key, seed), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def _mark(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", key, F.lit(seed)))


def random_split(df: DataFrame, *, id_col: str = "student_id", fractions: dict[str, float] | None = None, seed: int = 0, out: str = "split") -> DataFrame:
    fractions = fractions or FRACTIONS
    if abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError("fractions must sum to 1")
    u, total, label = uniform(F.col(id_col), seed), 0.0, None
    for name, f in list(fractions.items())[:-1]:
        total += f
        label = F.when(u < total, name) if label is None else label.when(u < total, name)
    last = list(fractions)[-1]
    return df.withColumn(out, F.lit(last) if label is None else label.otherwise(last))


def sample_weights(df: DataFrame, *, target_col: str = "target", weights: dict | None = None, out: str = "sample_weight") -> DataFrame:
    """n / (classes * n of the class), or given weights."""
    if weights is not None:
        w = F.lit(None).cast("double")
        for k, v in weights.items():
            w = F.when(F.col(target_col) == F.lit(k), F.lit(float(v))).otherwise(w)
        return df.withColumn(out, w)
    n = df.groupBy(F.col(target_col).alias("__t")).agg(F.count("*").alias("__n"))
    total = n.agg(F.sum("__n").alias("__all"), F.count("*").alias("__k"))
    per = n.crossJoin(F.broadcast(total)).select("__t", (F.col("__all") / (F.col("__k") * F.col("__n"))).alias(out))  # one row each side of a class
    return df.join(F.broadcast(per), df[target_col].eqNullSafe(per["__t"])).drop("__t")


# --- imputation -----------------------------------------------------------------------------


def impute_fit(df: DataFrame, columns: Sequence[str] | None = None, *, skewed: float = 0.5) -> DataFrame:
    """(column, strategy, value, kind, had_nulls): one aggregate over the training rows, and a selection of medians.

    No values: a constant (false, 0, "missing"); booleans and strings: the mode;
    numbers: the median where the skewness is at least `skewed`, else the mean.
    """
    kinds, aggs = dict(df.dtypes), []
    columns = list(columns or df.columns)
    for k, c in enumerate(columns):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{k}"), F.count_if(x.isNull()).alias(f"z{k}")]
        if kinds[c] in NUMBERS:
            d = x.cast("double")
            aggs += [adjusted_skewness(d).alias(f"s{k}"), F.avg(d).alias(f"a{k}")]
        else:
            aggs.append(F.mode(x, True).cast("string").alias(f"o{k}"))
    got, rows = df.agg(*aggs).first(), []  # one row
    slanted = [c for k, c in enumerate(columns) if kinds[c] in NUMBERS and got[f"s{k}"] is not None and abs(got[f"s{k}"]) >= skewed]
    medians = {r["column"]: r["value"] for r in exact_quantiles(df, slanted, [0.5]).collect()} if slanted else {}  # a row for each column
    for k, c in enumerate(columns):
        number = kinds[c] in NUMBERS
        if not got[f"n{k}"]:
            strategy, value = "constant", "0" if number else "false" if kinds[c] == "boolean" else "missing"
        elif not number:
            strategy, value = "mode", got[f"o{k}"]
        elif c in medians:
            strategy, value = "median", repr(medians[c])
        else:
            strategy, value = "mean", repr(got[f"a{k}"])
        rows.append((c, strategy, value, kinds[c], got[f"z{k}"] > 0))
    return df.sparkSession.createDataFrame(rows, "column string, strategy string, value string, kind string, had_nulls boolean")


def missing_flags(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """{column}_missing_flag for columns that had nulls when fitted; false where the column is absent."""
    names = [r["column"] for r in fitted.where("had_nulls").collect()]
    return df.withColumns({f"{c}_missing_flag": F.col(f"`{c}`").isNull() if c in df.columns else F.lit(False) for c in names})


def impute_transform(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Fill nulls with fitted values, whole numbers stay whole; a fitted column that is missing raises."""
    rows = fitted.collect()  # a row per column
    absent = [r["column"] for r in rows if r["column"] not in df.columns]
    if absent:
        raise ValueError(f"columns missing: {absent}")

    def filled(c: str, value: str, kind: str) -> Column:
        x = F.col(f"`{c}`")
        whole = kind in NUMBERS and kind not in ("float", "double")
        return F.coalesce(x, F.lit(round(float(value))).cast(kind) if whole else F.lit(value).cast(kind))

    return df.withColumns({r["column"]: filled(r["column"], r["value"], r["kind"]) for r in rows})


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) of columns with nulls left: empty if imputation is complete."""
    flat = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"a{k}") for k, c in enumerate(df.columns)])
    return flat.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"a{k}").alias("n_null")) for k, c in enumerate(df.columns)])).alias("r")).select("r.*").where("n_null > 0")


def fill_with_mode(df: DataFrame, train: DataFrame, cols: Sequence[str]) -> DataFrame:
    modes = train.agg(*[F.mode(c, True).alias(f"__{c}") for c in cols])  # one row
    return df.join(F.broadcast(modes)).withColumns({c: F.coalesce(c, f"__{c}") for c in cols}).drop(*[f"__{c}" for c in cols])


def reference_sample(df: DataFrame, *, n: int = 100, id_col: str = "student_id", seed: int = 0) -> DataFrame:
    """n rows, those with the smallest hash of id and seed."""
    return df.orderBy(_mark(F.col(id_col), seed), id_col).limit(n)


# --- feature selection ----------------------------------------------------------------------


def incomplete_features(df: DataFrame, threshold: float = 0.5) -> list[str]:
    got = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(f"a{k}") for k, c in enumerate(df.columns)]).first()
    return [c for k, c in enumerate(df.columns) if got[k] >= threshold]


def low_variance_features(df: DataFrame, threshold: float = 0.0) -> list[str]:
    """Numbers whose population variance is at most the threshold; others with one distinct value. Infinite numbers raise."""
    kinds, aggs = dict(df.dtypes), []
    for k, c in enumerate(df.columns):
        x = F.col(f"`{c}`")
        if kinds[c] in NUMBERS:
            aggs += [F.when(F.min(x) == F.max(x), 0.0).otherwise(F.var_pop(x)).alias(f"v{k}"), F.count_if(F.abs(x.cast("double")) == float("inf")).alias(f"i{k}")]
        else:
            aggs.append(F.coalesce(F.min(x) == F.max(x), F.lit(True)).alias(f"d{k}"))
    got = df.agg(*aggs).first()
    for k, c in enumerate(df.columns):
        if kinds[c] in NUMBERS and got[f"i{k}"]:
            raise ValueError(f"{c} has infinite values")
    return [c for k, c in enumerate(df.columns) if (kinds[c] in NUMBERS and (got[f"v{k}"] or 0.0) <= threshold) or (kinds[c] not in NUMBERS and got[f"d{k}"])]


def collinear_features(df: DataFrame, threshold: float = 10.0, force: Sequence[str] = ()) -> list[str]:
    """Numeric features to drop, worst variance inflation first, until all are below the threshold.

    Nulls count as the mean. One pass makes the matrix of sums of products; the
    factor of a feature is its diagonal entry times that of the inverse, so each
    round only takes a smaller part of that matrix.
    """
    kinds = dict(df.dtypes)
    cols = [c for c in df.columns if kinds[c] in NUMBERS]
    if len(cols) < 2:
        return []
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(float(means[c] or 0.0))) for c in cols]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    got = df.agg(*[F.sum(filled[i] * filled[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = got[f"g{i}_{j}"]
    gone: list[int] = []
    for i in range(len(cols)):  # exact copies first: the later one goes
        twin = [k for k in range(i) if k not in gone and gram[k, k] == gram[i, i] == gram[k, i]]
        if twin and cols[i] not in force:
            gone.append(i)
    while True:
        left = [i for i in range(len(cols)) if i not in gone]
        if len(left) < 2:
            break
        own = gram[np.ix_(left, left)]
        scale = np.sqrt(np.maximum(np.diag(own), 1e-300))
        unit = own / np.outer(scale, scale)
        if np.linalg.matrix_rank(unit) < len(left):
            vif = np.array([np.inf if np.linalg.matrix_rank(np.delete(np.delete(unit, k, 0), k, 1)) == np.linalg.matrix_rank(unit) else 1.0 for k in range(len(left))])
        else:
            vif = np.diag(np.linalg.inv(unit))
        free = [k for k, i in enumerate(left) if cols[i] not in force]
        if not free or np.isinf(vif).all():
            break
        worst = max(vif[k] for k in free)
        if worst < threshold:
            break
        gone += [left[k] for k in free if vif[k] == worst]
    return [cols[i] for i in gone]


def select_features(df: DataFrame, *, keep: Sequence[str] = (), force: Sequence[str] = (), incomplete: float = 0.5, low_variance: float = 0.0, collinear: float = 10.0) -> list[str]:
    """Names of the features that stay, in df's order; `keep` are no features and stay too. Pass training rows only."""
    features = [c for c in df.columns if c not in keep]
    d = df.select(*[f"`{c}`" for c in features])
    bad = set(incomplete_features(d, incomplete)) - set(force)
    d = d.drop(*bad)
    low = set(low_variance_features(d, low_variance)) - set(force)
    d = d.drop(*low)
    bad |= low | set(collinear_features(d, collinear, force))
    return [c for c in df.columns if c not in bad]


# --- models ---------------------------------------------------------------------------------


def _pipeline(numeric: Sequence[str], classifier):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler

    filled = [f"{c}__filled" for c in numeric]
    return Pipeline(stages=[Imputer(inputCols=list(numeric), outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="features"), classifier])


def _stored(fitted):
    """The model as a later job reads it: without the training summary, which ties it to this session's state."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import SparkSession

    from quadrangle.sources.writers import scratch_dir

    path = scratch_dir(SparkSession.getActiveSession())
    fitted.write().save(path)
    return PipelineModel.load(path)


def train_candidates(df: DataFrame, features: Sequence[str], *, target_col: str = "target", split_col: str = "split", weight_col: str | None = None, seed: int = 1) -> tuple[DataFrame, dict]:
    """Fit a few classifiers on split "train" and measure them on the others: (metrics table, models by name)."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier

    d = df.withColumns({"label": F.col(target_col).cast("double"), **{c: F.col(c).cast("double") for c in features}})
    extra = {"weightCol": weight_col} if weight_col else {}
    kinds = {"random_forest": RandomForestClassifier(numTrees=20, maxDepth=5, seed=seed, **extra), "gradient_boosting": GBTClassifier(maxIter=10, maxDepth=3, seed=seed, **extra)}
    train = d.where(F.col(split_col) == "train")
    models: dict = {"logistic_regression": fit_logistic(train, features, target_col=target_col, weight_col=weight_col)}
    models |= {name: _stored(_pipeline(features, classifier).fit(train)) for name, classifier in kinds.items()}
    parts = []
    for name, model in models.items():
        p = score(model, d.where(F.col(split_col).isin("validate", "test")), features).select(F.lit(name).alias("model"), F.col(split_col).alias("split"), (F.col("label") == 1).alias("target"), (F.col("pred_prob") >= 0.5).alias("pred"), "pred_prob")
        parts.append(p)
    scored = reduce(DataFrame.unionByName, parts)
    accuracy = scored.groupBy("model", "split").agg(F.avg((F.col("pred") == F.col("target")).cast("double")).alias("accuracy"))
    return roc_auc(scored, ["model", "split"]).join(accuracy, ["model", "split"]).select("model", "split", F.col("auc").alias("roc_auc"), "accuracy"), models


@dataclass(frozen=True)
class LinearModel:
    """A logistic model: weight and stand-in for nulls of each feature."""

    weights: dict[str, float]
    fills: dict[str, float]
    intercept: float

    def filled(self, c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(self.fills[c]))

    def probability(self) -> Column:
        z = F.lit(self.intercept)
        for c, w in self.weights.items():
            z = z + F.lit(w) * self.filled(c)
        return 1 / (1 + F.exp(-z))


def _sums(batches: Iterator[pa.RecordBatch], beta: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of rows (y, w, z) of a task: log likelihood, gradient and Hessian at beta, as (at, value)."""
    d = len(beta)
    total = np.zeros(1 + d + d * d)
    for batch in batches:
        if not len(batch):
            continue
        y, w = (batch.column(k).to_numpy() for k in (0, 1))
        z = np.column_stack([np.ones(len(y)), batch.column(2).flatten().to_numpy().reshape(len(y), d - 1)])
        eta = z @ beta
        p = 1 / (1 + np.exp(-eta))
        total[0] += w @ (y * eta - np.logaddexp(0, eta))
        total[1 : 1 + d] += z.T @ (w * (y - p))
        total[1 + d :] += (z.T @ (z * (w * p * (1 - p))[:, None])).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])


def fit_logistic(df: DataFrame, features: Sequence[str], *, target_col: str = "target", weight_col: str | None = None, ridge: float = 1.0, rounds: int = 50, tolerance: float = 1e-12) -> LinearModel:
    """A logistic model by Newton's method on sums over rows: the same coefficients in any partitioning, up to rounding.

    Nulls count as the mean of the feature, features are scaled to standard
    deviation 1, and half `ridge` times the squares of their coefficients is
    added to the loss; so the optimum is unique also where a feature separates
    the classes. Rows without a target are left out. Scaled rows are written
    once; each round sums them in tasks, and only the sums reach the driver.
    """
    d = df.where(F.col(target_col).isNotNull()).select(F.col(target_col).cast("boolean").cast("double").alias("y"), (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("w"), *[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(features)])
    stats = d.agg(F.count("*").alias("n"), *[a.alias(f"{m}{k}") for k in range(len(features)) for m, a in (("m", F.avg(f"x{k}")), ("s", F.count(f"x{k}") * F.var_pop(f"x{k}")))]).first()  # one row
    means = [float(stats[f"m{k}"] or 0.0) for k in range(len(features))]
    scales = [float(np.sqrt((stats[f"s{k}"] or 0.0) / max(stats["n"], 1))) or 1.0 for k in range(len(features))]
    z = F.array(*[(F.coalesce(F.col(f"x{k}"), F.lit(means[k])) - F.lit(means[k])) / F.lit(scales[k]) for k in range(len(features))])
    rows = df.sparkSession.read.parquet(scratch_parquet(d.select("y", "w", z.alias("z"))))
    penalty = np.array([0.0] + [ridge] * len(features))

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        sums = rows.mapInArrow(lambda batches: _sums(batches, beta), "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()  # 1 + d + d * d rows
        total = np.zeros(1 + len(beta) + len(beta) ** 2)
        for r in sums:
            total[r["at"]] = r["value"]
        n = len(beta)
        return total[0] - 0.5 * penalty @ beta**2, total[1 : 1 + n] - penalty * beta, total[1 + n :].reshape(n, n) + np.diag(penalty)

    beta = np.zeros(len(features) + 1)
    value, slope, bend = at(beta)
    for _ in range(rounds):
        step = np.linalg.lstsq(bend, slope, rcond=None)[0]
        while True:
            new = at(beta + step)
            if new[0] >= value - 1e-9 * abs(value) or np.abs(step).max() < tolerance:
                break
            step = step / 2  # beyond the top: shorter
        beta, (value, slope, bend) = beta + step, new
        if np.abs(step).max() < tolerance * (1 + np.abs(beta).max()):
            break
    weights = [float(b / s) for b, s in zip(beta[1:], scales, strict=True)]
    return LinearModel(dict(zip(features, weights, strict=True)), dict(zip(features, means, strict=True)), float(beta[0] - sum(w * m for w, m in zip(weights, means, strict=True))))


def score(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """df with pred_prob, by a LinearModel or a fitted pipeline."""
    from pyspark.ml.functions import vector_to_array

    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"features missing: {absent}")
    if isinstance(model, LinearModel):
        return df.withColumn("pred_prob", model.probability())
    scored = model.transform(df.withColumns({c: F.col(c).cast("double") for c in features}))
    return scored.select(*df.columns, vector_to_array("probability")[1].alias("pred_prob"))


def predict(model, df: DataFrame, features: Sequence[str], *, id_col: str = "student_id", threshold: float = 0.5) -> DataFrame:
    """(id, pred_prob, pred) by a fitted pipeline or a LinearModel."""
    return score(model, df, features).select(id_col, "pred_prob", (F.col("pred_prob") >= threshold).alias("pred"))


def linear_attributions(model: LinearModel, df: DataFrame, *, id_col: str = "student_id") -> DataFrame:
    """Exact additive attributions of a linear model: weight times distance from the mean, per feature."""
    means = df.agg(*[F.avg(model.filled(c)).alias(f"__m_{c}") for c in model.weights])  # one row
    return df.join(F.broadcast(means)).select(id_col, *[(F.lit(w) * (model.filled(c) - F.col(f"__m_{c}"))).alias(c) for c, w in model.weights.items()])


def apply_attributions(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """A user's explainer over batches of rows: fn takes and gives iterators of pandas frames."""
    return df.mapInPandas(fn, schema)


def permuted(block: pa.Table, number: int, features: Sequence[str], repeats: int, seed: int) -> Iterator[tuple[int, pa.Table]]:
    """(variant, rows): -1 the rows as they are, then for each feature and repeat the rows with that feature's values moved among them."""
    yield -1, block
    for k, f in enumerate(features):
        for r in range(repeats):
            order = np.random.default_rng([seed, number, k, r]).permutation(len(block))
            at = block.schema.get_field_index(f)
            yield k * repeats + r, block.set_column(at, block.schema.field(at), block.column(at).take(pa.array(order)))


def _variants(features: Sequence[str], repeats: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(block: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
            for variant, rows in permuted(pa.Table.from_batches(block).drop_columns(["__block"]), number, features, repeats, seed):
                yield from rows.append_column("__variant", pa.array(np.full(len(rows), variant, np.int32))).to_batches()

        held, now = [], None
        for batch in batches:
            numbers = batch.column(batch.schema.get_field_index("__block")).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(batch)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if s < e:
                    if numbers[s] != now and held:
                        yield from made(held, int(now))
                        held = []
                    now = numbers[s]
                    held.append(batch.slice(s, e - s))
        if held:
            yield from made(held, int(now))

    return run


def permutation_importance(model, df: DataFrame, features: Sequence[str], *, target_col: str = "target", repeats: int = 5, seed: int = 0, block_rows: int = 10_000) -> DataFrame:
    """(feature, importance, sd): mean drop of the area under the ROC curve when a feature's values are moved among rows.

    One job for all features and repeats. Rows are dealt by a hash of their
    values into blocks of about block_rows, and values move within blocks, so no
    task holds all rows; the moves are the same in any partitioning.
    """
    d = df.select(F.col(target_col).cast("boolean").alias("target"), *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    blocks = d.agg(F.greatest(F.lit(1), F.floor(F.count("*") / block_rows)).alias("__blocks"))  # one row
    mark = F.xxhash64("target", *features, F.lit(seed))
    # Equal rows get a number of their own, so that many of them don't share a block.
    from pyspark.sql import Window

    copy = F.row_number().over(Window.partitionBy("target", *features).orderBy("target"))
    dealt = d.withColumn("__copy", copy).join(F.broadcast(blocks)).withColumn("__block", F.pmod(F.xxhash64(mark, "__copy"), "__blocks").cast("long"))
    sorted_ = dealt.repartition("__block").sortWithinPartitions("__block", mark, "target", *features).select("target", *features, "__block")
    kinds = ", ".join(f"`{c}` double" for c in features)
    long = sorted_.mapInArrow(_variants(list(features), repeats, seed), f"target boolean, {kinds}, __variant int")
    auc = roc_auc(score(model, long, features).select("__variant", "target", "pred_prob"), ["__variant"])
    every = auc.groupBy().agg(F.max(F.when(F.col("__variant") == -1, F.col("auc"))).alias("base"), F.map_from_entries(F.collect_list(F.struct("__variant", "auc"))).alias("by"))  # a row for each variant
    drops = every.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), (F.col("base") - F.col("by")[F.lit(k * repeats + r)]).alias("drop")) for k, f in enumerate(features) for r in range(repeats)])).alias("d")).select("d.*")
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("sd"))


# --- attribution tables ---------------------------------------------------------------------


def long_attributions(values: DataFrame, features: Sequence[str], *, id_col: str = "student_id", out: str = "attribution") -> DataFrame:
    return values.select(id_col, *features).unpivot(id_col, list(features), "feature", out)


def rank_features(attributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, average, shown): mean absolute attribution, largest first, 4 decimals; "<0.0000" where that is 0."""
    flat = attributions.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in features])
    long = flat.select(F.lit(1).alias("one"), "*").unpivot("one", list(features), "feature", "average").drop("one")
    r = F.bround("average", 4)
    return long.select("feature", r.alias("average"), F.when(r == 0, "<0.0000").otherwise(F.format_number(r, 4)).alias("shown")).orderBy(F.desc("average"), "feature")


def top_features_per_student(attributions: DataFrame, values: DataFrame, features: Sequence[str], *, k: int = 3, id_col: str = "student_id") -> DataFrame:
    """Per student the k largest absolute attributions, side by side: feature_i, value_i, importance_i."""
    from pyspark.sql import Window

    long = long_attributions(attributions, features, id_col=id_col).join(long_attributions(values, features, id_col=id_col, out="value"), [id_col, "feature"])
    place = {f: i for i, f in enumerate(features)}
    rank = F.create_map(*[x for f, i in place.items() for x in (F.lit(f), F.lit(i))])[F.col("feature")]
    top = long.withColumn("__n", F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc(F.abs("attribution")), rank))).where(F.col("__n") <= k)
    pick = lambda n, c: F.max(F.when(F.col("__n") == n, c))
    aggs = [a for n in range(1, k + 1) for a in (pick(n, F.col("feature")).alias(f"feature_{n}"), pick(n, F.bround("value", 2)).alias(f"value_{n}"), pick(n, F.bround("attribution", 2)).alias(f"importance_{n}"))]
    return top.groupBy(id_col).agg(*aggs)


def top_k_features_global(attributions: DataFrame, values: DataFrame, features: Sequence[str], *, n: int = 10, id_col: str = "student_id") -> DataFrame:
    """Long rows (id, feature, attribution, value) of the n features with the largest mean absolute attribution."""
    best = rank_features(attributions, features).limit(n).select("feature")
    long = long_attributions(attributions, features, id_col=id_col).join(long_attributions(values, features, id_col=id_col, out="value"), [id_col, "feature"])
    return long.join(F.broadcast(best), "feature", "left_semi")  # n rows


def grouped_attributions(df: DataFrame, groups: dict[str, Sequence[str]], *, id_col: str = "student_id") -> DataFrame:
    """One-hot columns summed into their base feature."""
    return df.select(id_col, *[sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0)).alias(g) for g, cols in groups.items()])


def grouped_values(df: DataFrame, groups: dict[str, Sequence[str]], *, id_col: str = "student_id") -> DataFrame:
    """The one value that is set in a group of text columns, or "MISSING"; two different ones raise."""

    def one(cols: Sequence[str]) -> Column:
        got = F.array_distinct(F.filter(F.array(*[F.col(c).cast("string") for c in cols]), lambda x: x.isNotNull()))
        return F.when(F.size(got) > 1, F.raise_error(F.lit("ambiguous group")).cast("string")).when(F.size(got) == 0, "MISSING").otherwise(F.get(got, F.lit(0)))

    return df.select(id_col, *[one(cols).alias(g) for g, cols in groups.items()])


def balanced_score(runs: DataFrame, metrics: Sequence[str], directions: dict[str, str] | None = None) -> DataFrame:
    """runs with `balanced`: metrics scaled to [0, 1] over all runs, maximised ones flipped, averaged; lower is better."""
    from pyspark.sql import Window

    w, total = Window.partitionBy(), F.lit(0.0)  # over runs of an experiment
    for m in metrics:
        low, high = F.min(m).over(w), F.max(m).over(w)
        unit = F.when(high == low, F.lit(0.0)).otherwise((F.col(m) - low) / (high - low))
        up = (directions or {}).get(m, "minimize" if m.endswith(("loss", "error", "bias", "bias_score_mean")) else "maximize") == "maximize"
        total = total + (1 - unit if up else unit)
    return runs.withColumn("balanced", total / len(metrics))


def compare_models(runs: DataFrame, metric: str) -> DataFrame:
    best = F.min(metric) if metric.endswith("log_loss") else F.max(metric)
    return runs.groupBy("model_type").agg(best.alias(metric)).orderBy(F.asc(metric) if metric.endswith("log_loss") else F.desc(metric), "model_type")
