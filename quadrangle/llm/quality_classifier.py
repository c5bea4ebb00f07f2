"""Quality classifier: histogram gradient-boosted trees over document statistics.

Training reads a bounded, hash-chosen sample of labelled documents (parameter
`sample`); only their statistics reach the driver. Scoring is one pass without a
shuffle: workers compute the statistics of whole texts and send each batch down
the flattened trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import gbt
from quadrangle.llm.common import lean

STATISTICS = ["log_bytes", "upper", "lower", "digit", "other_ascii", "marked", "exclaim", "bar", "non_ascii", "space", "log_words", "word_bytes", "distinct_words", "distinct_pairs", "repeats", "commonest", "lines", "duplicate_lines", "words_a_line", "stops", "marked_words"]
_MARKED = np.isin(np.arange(256), np.frombuffer(b"#*$%&<>^~=_", np.uint8))


def statistics(text: bytes | None) -> list[float]:
    """Of one whole text in UTF-8, in the order of STATISTICS; null counts as empty."""
    text = text or b""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, words = max(len(text), 1), text.split()
    m = max(len(words), 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    upper, lower, digit = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
    space, high = count[9:14].sum() + count[32], count[128:].sum()
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    return [
        np.log1p(len(text)),
        upper / n,
        lower / n,
        digit / n,
        (n - upper - lower - digit - space - high) / n,
        count[_MARKED].sum() / n,
        count[33] / n,
        count[124] / n,
        high / n,
        space / n,
        np.log1p(len(words)),
        (n - space) / m,
        len(distinct) / m,
        len(set(zip(words, words[1:], strict=False))) / m,
        sum(map(bytes.__eq__, words, words[1:])) / m,
        max(distinct.values(), default=0) / m,
        np.log1p(len(lines)),
        1 - len(set(lines)) / k,
        m / k,
        (count[46] + count[44]) / m,
        sum(not w[-1:].isalnum() and w[-1] not in b".,;:!?)\"'" and w[-1] < 128 for w in distinct) / max(len(distinct), 1),
    ]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))


def training_sample(df: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, learn_from: Column | None, sample: int) -> DataFrame:
    """(label, text) of about `sample` labelled rows at most, chosen by a hash of the id; all of them where there are fewer.

    Rows without a label or id don't count; of an id's several labels the largest does.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    share = min(1.0, sample / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    # At most about `sample` ids and bits are broadcast.
    return df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), id_col).select("label", "text")


def fit_quality(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn_from: Column | None = None, sample: int = 12_000, **parameters) -> gbt.Trees:
    """learn_from: which rows of labels may be learned from. parameters go to gbt.fit()."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(_matrix(batch)), pa.list_(pa.float64()))], names=["label", "x"])

    rows = training_sample(df, labels, id_col=id_col, text_col=text_col, label_col=label_col, learn_from=learn_from, sample=sample)
    got = sorted((tuple(r.x), r.label) for r in rows.mapInArrow(lean(measure), "label int, x array<double>").collect())
    x = np.array([g[0] for g in got], float).reshape(len(got), len(STATISTICS))
    return gbt.fit(x, np.array([g[1] for g in got], float), **parameters)


def score_quality(df: DataFrame, trees: gbt.Trees, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per input row: id_col, score (likelihood of label 1), predicted (1 where score >= threshold).

    Null and empty texts get the score of an empty text.
    """
    model = df.sparkSession.sparkContext.broadcast(trees)  # a few thousand numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.value.probability(_matrix(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[id_col, "score", "predicted"])

    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(score), f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, score double, predicted int")


def keep_good(df: DataFrame, trees: gbt.Trees, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of df, with all their columns, that score at least `threshold`: one pass, no join.

    Null and empty texts have the score of an empty text; ids play no part, so
    null and repeated ids are rows like others.
    """
    model = df.sparkSession.sparkContext.broadcast(trees)
    names = df.columns

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(text_col)).cast(pa.binary()).to_pylist()
            x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))
            yield batch.filter(pa.array(model.value.probability(x) >= threshold))

    return df.mapInArrow(lean(choose), df.schema)
