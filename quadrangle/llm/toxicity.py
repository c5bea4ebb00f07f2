"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts: one on the words of
toxic texts whose beginnings are far more common there than in ordinary ones,
the other on windows of ordinary text. Toxic windows are compressed with the
toxic dictionary in front of a common one, ordinary ones with more of ordinary
text in front of the same, so what differs is only what was trained in front. A
window of a few words that compresses shorter with the first than with the
second holds something toxic. How often the difference passes each of a row of
thresholds is what a text is judged by; a logistic fit on labelled texts
calibrates them into a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.common import lean, materialize
from quadrangle.llm.gbt import logistic
from quadrangle.llm.quality_classifier import training_sample

#: Words in a window, and the bytes at which a longer word starts another window.
WINDOW, WINDOW_BYTES = 6, 256
#: Thresholds on the bytes that the toxic dictionary saves, and that it costs.
SAVED, COST = (1, 2, 3, 4, 5, 6, 8, 10), (2, 4)
_EDGES = b".,;:!?\"'()"


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    level: int = 9


def _words(text: bytes) -> set[bytes]:
    return {w[:64].strip(_EDGES) for w in text.lower().split()}


def _fragments(words: set[bytes], shortest: int, longest: int) -> set[bytes]:
    return {w[:k] for w in words for k in range(shortest, min(len(w), longest) + 1)}


def train(samples: list[bytes], size: int, *, segment: int = 32, key: int = 6) -> bytes:
    """A trained dictionary of at most `size` bytes; too few samples to train on are the dictionary themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=key).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def dictionaries(rows: DataFrame, *, toxic_bytes: int = 4096, common_bytes: int = 10_000, shortest: int = 4, longest: int = 12, ratio: float = 20.0, least: int = 3, least_share: float = 0.01, samples: int = 40_000, per_document: int = 64, segment: int = 32) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary, from rows (label, text).

    Toxic samples are words that begin with a fragment that `ratio` times as
    large a share of toxic as of ordinary documents have, and at least `least`
    and `least_share` of the toxic ones; ordinary samples are windows of
    ordinary documents, about `samples` at most, chosen by a hash. Documents are
    counted and cut on the executors; the fragments that pass, and at most
    `per_document` samples of a toxic document, reach the driver.
    """
    import xxhash

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, ordinary = Counter(), Counter()
            for label, text in zip(batch.column(0).to_pylist(), _texts(batch), strict=True):
                (toxic if label else ordinary).update(_fragments(_words(text), shortest, longest))
            grams = sorted({*toxic, *ordinary})
            for k in range(0, len(grams), 50_000):
                g = grams[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.binary()), pa.array([toxic[x] for x in g], pa.int64()), pa.array([ordinary[x] for x in g], pa.int64())], names=["gram", "toxic", "ordinary"])

    n = {r.label: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()}
    toxic_n, ordinary_n = (n[k].n if k in n else 0 for k in (1, 0))
    least = max(least, round(least_share * toxic_n))
    counts = rows.mapInArrow(lean(count), "gram binary, toxic long, ordinary long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    share = (F.col("toxic") + 0.5) / (toxic_n + 1) >= ratio * (F.col("ordinary") + 0.5) / (ordinary_n + 1)
    pool = {bytes(r.gram) for r in counts.where((F.col("toxic") >= least) & share).select("gram").collect()}
    # A window has some forty bytes.
    some = int(2**32 * min(1.0, samples / max((n[0].bytes or 0) / 40, 1))) if 0 in n else 0

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, chosen = [], []
            for label, text in zip(batch.column(0).to_pylist(), _texts(batch), strict=True):
                if label:
                    own = [b" " + w[:64] + b" " for w in text.lower().split() if _fragments(_words(w), shortest, longest) & pool][:per_document]
                else:
                    own = [w for w in windows(text) if xxhash.xxh32_intdigest(w) < some]
                chosen += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(chosen, pa.binary())], names=["label", "sample"])

    got = [(r.label, bytes(r.sample)) for r in rows.mapInArrow(lean(choose), "label int, sample binary").collect()]
    # The trainer takes the best segment of each stretch of samples: they are mixed, by a hash of sample and number among its equals.
    times: Counter = Counter()

    def place(sample: tuple[int, bytes]) -> tuple[int, bytes]:
        times[sample] += 1
        return xxhash.xxh32_intdigest(sample[1], times[sample]), sample[1]

    mixed = sorted((*place(x), x[0]) for x in got)
    marked, plain = ([w for _, w, label in mixed if label == k] for k in (1, 0))
    marks = train(marked, toxic_bytes, segment=segment)
    base = train(plain[: len(plain) // 2], common_bytes, segment=segment)
    rest = train(plain[len(plain) // 2 :], toxic_bytes, segment=segment)
    # Both end alike, and begin with as many bytes: the common part is equally far in both.
    return marks + base, rest[: len(marks)].ljust(len(marks)) + base


def windows(text: bytes) -> list[bytes]:
    """The words of a lower-cased text, WINDOW at a time; long words are cut, none is dropped."""
    words = text.lower().split()
    if any(len(w) > WINDOW_BYTES for w in words):
        words = [w[k : k + WINDOW_BYTES] for w in words for k in range(0, len(w), WINDOW_BYTES)]
    return [b" " + b" ".join(words[k : k + WINDOW]) for k in range(0, len(words), WINDOW)] or [b""]


def _distances(model: ToxicityModel):
    import zstandard

    def compressor(content: bytes):
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=model.level)
        return zstandard.ZstdCompressor(level=model.level, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    toxic, ordinary = compressor(model.toxic), compressor(model.ordinary)

    def features(text: bytes) -> list[float]:
        d = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)])
        top = np.sort(d)[-3:]
        return [float(top[-1]), float(top.mean()), *(math.log1p((d >= q).sum()) for q in SAVED), *(math.log1p((d <= -q).sum()) for q in COST), math.log1p(len(d))]

    return features


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def _measured(rows: DataFrame, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and whether it is set aside, of each of rows (label, text, aside), in an order of their own."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _distances(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([features(t) for t in _texts(batch)], pa.list_(pa.float64()))], names=["label", "aside", "x"])

    got = sorted((tuple(r.x), r.label, r.aside) for r in rows.mapInArrow(lean(measure), "label int, aside boolean, x array<double>").collect())
    x = np.array([g[0] for g in got], float).reshape(len(got), 3 + len(SAVED) + len(COST))
    return x, np.array([g[1] for g in got], float), np.array([g[2] for g in got], bool)


def _calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    if len(set(y)) < 2:
        return np.append(np.zeros(x.shape[1]), 20.0 if y.sum() else -20.0)
    return logistic(x, y)


def fit_toxicity(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn_from: Column | None = None, sample: int = 12_000, level: int = 9, shares: tuple[float, ...] = (0.1, 0.03, 0.01), **parameters) -> ToxicityModel:
    """Learns from at most about `sample` labelled documents. parameters go to dictionaries().

    shares: which least_share to choose from, by the log loss on a quarter of
    the sample that dictionaries and weights haven't seen (rare words of many
    copies of few toxic documents mark nothing). Without documents of both
    labels the score is a constant.
    """
    aside = (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("aside")  # copies are on one side
    rows = training_sample(df, labels, id_col=id_col, text_col=text_col, label_col=label_col, learn_from=learn_from, sample=sample)
    rows = materialize(rows.select("label", "text", aside), "toxicity-sample")
    losses = []
    for share in shares if len(shares) > 1 else ():
        x, y, out = _measured(rows, ToxicityModel(*dictionaries(rows.where("not aside"), least_share=share, **parameters), np.zeros(0), level))
        z = x[out] @ (w := _calibrated(x[~out], y[~out]))[:-1] + w[-1]
        losses.append((float(np.logaddexp(0, np.where(y[out] == 1, -z, z)).sum()), share))
    best = min(losses)[1] if losses else shares[0]
    toxic, ordinary = dictionaries(rows, least_share=best, **parameters)
    x, y, _ = _measured(rows, ToxicityModel(toxic, ordinary, np.zeros(0), level))
    return ToxicityModel(toxic, ordinary, _calibrated(x, y), level)


def score_toxicity(df: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: id_col, score (likelihood of label 1), predicted (1 where score >= threshold).

    Null and empty texts are one empty window. One pass over whole texts, no shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of some kilobytes

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights = _distances(shared.value), shared.value.weights
        for batch in batches:
            z = np.array([features(t) for t in _texts(batch)], float).reshape(len(batch), len(weights) - 1) @ weights[:-1] + weights[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[id_col, "score", "predicted"])

    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(score), f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, score double, predicted int")
