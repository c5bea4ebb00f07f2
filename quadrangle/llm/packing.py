"""Vector best-fit packing of documents into training sequences.

Each piece of a document asks for three things: tokens, one document slot, and
attention cost (its length squared). A sequence is a bin with a capacity for
each. Items are taken longest first; among the open bins that can hold an item
under every constraint, the one with the best score is chosen: the largest
weighted dot product of demand and residual ("dot"), or the smallest weighted
norm of the residual left after placing it ("norm").

Items are dealt evenly into groups of a bounded number, whatever document or
source they come from; each group is packed in one task and leaves about one
sequence that is not full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.bpe import SPECIAL, encoding_of_ranks, ids_of, vocabulary_path
from quadrangle.llm.common import lean, materialize, release

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(demand: np.ndarray, capacity: np.ndarray, *, weights: np.ndarray, score: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and number of bins; demand has a row per item, capacity one number per dimension.

    An item that exceeds a capacity by itself gets a bin of its own.
    """
    share, n = demand / capacity, len(demand)
    order = np.lexsort((np.arange(n), -demand[:, 0]))
    smallest = np.minimum.accumulate(demand[order][::-1], axis=0)[::-1] / capacity  # of the items still to come
    bins = np.empty(n, np.int64)
    free = np.empty((max(n, 1), share.shape[1]))  # residuals of the open bins
    name = np.empty(max(n, 1), np.int64)
    opened = live = 0
    tiny = 1e-12
    for at, k in enumerate(order):
        want, best = share[k], -1
        if live:
            left = free[:live] - want
            fits = np.flatnonzero((left >= -tiny).all(axis=1))
            if len(fits):
                if score == "dot":
                    best = fits[np.argmax((free[fits] * want) @ weights)]
                else:
                    best = fits[np.argmin((left[fits] ** 2) @ weights)]
        if best < 0:
            best, live = live, live + 1
            free[best], name[best] = 1.0, opened
            opened += 1
        free[best] -= want
        bins[k] = name[best]
        if at + 1 < n and (free[best] < smallest[at + 1] - tiny).any():  # nothing to come can fit
            live -= 1
            free[best], name[best] = free[live], name[live]
    return bins, opened


def _packer(length: int, max_docs: int, max_cost: float, weights: tuple[float, ...], score: str):
    capacity, w = np.array([length, max_docs, max_cost], float), np.array(weights, float)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << 34, 0
        held = [f for f in frames if len(f)]  # one group: items_per_group rows of a few numbers
        if not held:
            return
        items = pd.concat(held, ignore_index=True).sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        n = items["length"].to_numpy(np.int64)
        bins, made = best_fit(np.stack([n, np.ones_like(n), n * n], axis=1).astype(float), capacity, weights=w, score=score)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(n[order])
        first = np.append(True, np.diff(bins[order]) > 0)
        begin = (ends - n[order])[np.maximum.accumulate(np.where(first, np.arange(len(n)), 0))]
        offset = np.empty_like(n)
        offset[order] = ends - n[order] - begin
        yield items.assign(sequence_id=base + bins, offset=offset)
        release()

    return pack


def pack_items(items: DataFrame, *, length: int = 1024, max_docs: int = 1024, max_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01), score: str = "norm", items_per_group: int = 16_384) -> DataFrame:
    """Add sequence_id and offset to rows of PIECES; no item may be longer than `length`.

    items is read twice (once to count), so pass a written table.
    """
    groups = max(1, -(-items.count() // items_per_group))
    cost = float(length) ** 2 if max_cost is None else max_cost
    # Round robin over sorted rows: even groups, the same ones when a lost task is run again, whatever repeats.
    return items.repartition(groups).mapInPandas(_packer(length, max_docs, cost, weights, score), PIECES + ", sequence_id long, offset long")


def tokenized_pieces(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, special: tuple[str, int] = (SPECIAL, 50256), end_id: int = 2, length: int = 1024) -> DataFrame:
    """Rows of PIECES: token ids and end_id, cut into `length`-token pieces with the shorter piece first.

    The string of the special token inside a text is that token.
    """
    path = ranks or vocabulary_path("byte_bpe_50k.tiktoken")
    names = [p.split()[0] for p in PIECES.split(", ")]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoding_of_ranks(path, special)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.append(ids_of(encoding, text, special[0]), end_id).astype("<u4")
                first = len(own) % length or length
                edges = [0, *range(first, len(own) + 1, length)]
                for k, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    for column, value in zip(out, (doc, k, s, e - s, zlib.crc32(own[s:e].tobytes())), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(lean(encoded), PIECES)


def pack_documents(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, end_id: int = 2, length: int = 1024, **constraints) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of end_id alone. Repeated rows are packed
    as often as they occur. Other columns are ignored. `constraints` go to pack_items().
    """
    pieces = materialize(tokenized_pieces(df, id_col=id_col, text_col=text_col, ranks=ranks, end_id=end_id, length=length), "pieces")
    return pack_items(pieces, length=length, **constraints)
