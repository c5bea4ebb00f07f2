"""Near duplicates by MinHash with tensored banding.

1. Texts with equal sets of shingles form a class; a class counts as one set.
2. Two collections of `half` keys are computed for each set; a key combines
   `rows` minhashes. Each pair of a key of the first and a key of the second
   collection is the key of one table, so half * half tables with 2 * rows
   minhashes each cost 2 * half * rows minhashes instead of 2 * rows * half * half.
   Two sets of similarity s meet unless one of the collections fails them: with
   probability (1 - (1 - s ** rows) ** half) ** 2 they are in a common bucket.
   The keys of the collections are written when classes are found, so each text
   is cut into words and shingles once for both.
3. Keys of tables meet in ranges. Each bucket of several classes gives the pairs of its
   smallest class, the hub, with the others: k - 1 of them, which the buckets
   of other tables repeat. Classes that meet no other have no link.
4. Pairs are confirmed on full sets, and what is linked is joined. Pairs of a
   bucket without its hub, in different components by then, are left to the
   exact join of ngram_join over the classes that met another: it finds every
   link among them, and tests no pair inside a component that is known.

At 0.85 a pair fails to meet with a probability of 3e-6 (half = 14, rows = 3),
at 0.9 with one of 2e-8; it is missed only if one of the two meets no other
class either.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.common import lean, materialize, partitions
from quadrangle.llm.ngram_join import PER_RANGE, RANGED, SLICE, by_range, class_members, class_roots, named_rows, range_bounds, ranged

_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Shingles whose minhashes are taken at once: their products stay in a core's cache.
_CHUNK = 512


@cache
def _constants(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, np.uint64)


def minhashes(grams: np.ndarray, n: int, seed: int) -> np.ndarray:
    times, plus = _constants(n, seed)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(grams), _CHUNK):
        values = np.multiply.outer(times, grams[k : k + _CHUNK])
        values += plus[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def half_keys(grams: np.ndarray, *, half: int, rows: int, seed: int) -> np.ndarray:
    """The 2 * half keys of one set, those of the first collection before those of the second."""
    least = minhashes(grams, 2 * half * rows, seed).reshape(2 * half, rows)
    key = np.arange(1, 2 * half + 1, dtype=np.uint64) * _MIX  # each key of a collection has a place of its own
    for k in range(rows):
        key = (key ^ least[:, k]) * _MIX
        key ^= key >> np.uint64(29)
    return key


def _paired(keys: np.ndarray) -> np.ndarray:
    """Of half_keys(), a row for each set, the keys of the half * half tables."""
    half = keys.shape[1] // 2
    pairs = (keys[:, :half, None] + (keys[:, None, half:] << np.uint64(1))) * _MIX
    return (pairs ^ (pairs >> np.uint64(32))).reshape(len(keys), half * half)


def table_keys(grams: np.ndarray, *, half: int, rows: int, seed: int) -> np.ndarray:
    """Sorted keys of the half * half tables for one set."""
    return np.sort(_paired(half_keys(grams, half=half, rows=rows, seed=seed)[None])[0])


def _tables(ranges: int):
    """The keys of all tables for each batch's classes (sid, keys), by ranges."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = range_bounds(ranges)
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                sids, keys = (c.to_pylist() for c in whole.slice(at, SLICE).columns)
                tables = _paired(np.frombuffer(b"".join(keys), np.uint64).reshape(len(keys), -1))
                place = np.repeat(np.arange(len(sids), dtype=np.uint16), tables.shape[1])
                yield ranged(tables.ravel(), place, np.array(sids, np.int64), bounds)

    return send


def _stars(h: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(a, b) of each bucket's smallest class and its others, once."""
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    sizes = np.diff(np.append(starts, len(h)))
    hubs, others = np.repeat(s[starts], sizes), s
    real = hubs != others
    pairs = np.unique(np.stack([hubs[real], others[real]], axis=1), axis=0)
    for k in range(0, len(pairs), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[k : k + 100_000, c]) for c in (0, 1)], names=["a", "b"])


def minhash_components(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 85, half: int = 14, rows: int = 3, seed: int = 7, fragments: int = 4, enough: int = 4) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id, kept.

    A text's set: its distinct n-word shingles after lower-casing A-Z; with
    fewer words the whole sequence as one. Rows link when each meets another in
    a bucket and the Jaccard similarity of their full sets is at least percent / 100;
    component_id is the smallest id reachable by links, the row's own included.
    Null and empty texts have no set and no link. Null ids never become a
    component_id unless the component has no other; kept tells whether the row's
    id is its component_id (two nulls are equal; rows that repeat it are all
    kept). An empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def keys(grams: np.ndarray) -> np.ndarray:
        return half_keys(grams, half=half, rows=rows, seed=seed)

    members, salt = class_members(docs, n, keys)
    classes = members.where("n > 0").select("sid").distinct().count()
    ranges = max(partitions(spark), -(-classes * half * half // PER_RANGE))
    sent = members.where("keys is not null").select("sid", "keys").mapInArrow(lean(_tables(ranges)), RANGED)
    stars = sent.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(lean(by_range(_stars)), "a long, b long")
    pairs = materialize(stars.distinct(), "stars")
    out = named_rows(members.drop("keys"), class_roots(docs, members.drop("keys"), F.min("id"), n, percent, fragments, enough, salt, pairs), id_col)
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
