"""Ranked lexical search: term at a time with a limited number of accumulators.

1. Queries go in blocks of a bounded number of terms; what a block brings to the
   executors is that bounded table. Everything below is done for each block.
2. Each task reads whole texts and turns them into inverted slices: the postings
   of the block's terms, term by term, of a bounded number of documents. Slices
   are written; nothing is shuffled.
3. One aggregate over the slices gives the document frequency of each term, the
   number of documents and the number of all terms, which make the weights.
4. Each slice is searched term at a time, the rarest term first. A term adds to
   the accumulators of its documents and creates missing ones, until the bounds
   of the terms still to come add up to less than the k-th best partial score: no
   document without an accumulator can then be among the slice's best k.
   From there on only accumulators that exist are updated, up to exact scores.
5. A document that is among the best k of all is among the best k of its slice,
   so the final ranking reads k rows of each slice and query at most.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrangle.llm.common import lean, lower_ascii, materialize

#: A term: a run of characters that are letters or digits of ASCII, or not of ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: In UTF-8 all bytes from 0x80 on belong to terms, so texts are cut as bytes: others become a space.
_SPACED = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))
#: Postings of a slice, about: some 10 MB in a task.
SLICE_POSTINGS = 1_000_000
SLICE = "ids binary, lengths binary, terms binary, starts binary, docs binary, counts binary"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z lower-cased (bytes.lower() touches no others)."""
    return (text or b"").lower().translate(_SPACED).split()


@dataclass(frozen=True)
class Slice:
    """Postings of some documents: those of term terms[i] are docs[starts[i]:starts[i + 1]], ascending, with their counts."""

    ids: np.ndarray
    lengths: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    counts: np.ndarray

    def row(self) -> list[bytes]:
        return [x.tobytes() for x in (self.ids, self.lengths, self.terms, self.starts, self.docs, self.counts)]

    @staticmethod
    def of(row: list[bytes]) -> Slice:
        return Slice(*(np.frombuffer(x, k) for x, k in zip(row, ("<i8", "<i8", "<i4", "<i8", "<i4", "<i8"), strict=True)))


#: Stands for a null id in a slice; the smallest long can't be told from it and comes back as null.
_NULL = np.iinfo(np.int64).min


def invert(ids: list[int | None], lengths: list[int], found: list[tuple[list[int], list[int]]]) -> Slice:
    """A slice from each document's term numbers and their counts."""
    sizes = [len(t) for t, _ in found]
    term = np.fromiter((x for t, _ in found for x in t), np.int32, sum(sizes))
    count = np.fromiter((x for _, c in found for x in c), np.int64, sum(sizes))
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    order = np.argsort(term, kind="stable")
    term, edge = np.unique(term[order], return_index=True)
    own = np.array([_NULL if i is None else i for i in ids], np.int64)
    return Slice(own, np.array(lengths, np.int64), term, np.append(edge, len(order)).astype(np.int64), doc[order], count[order])


def _slices(vocabulary: dict[bytes, int], limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, found, held = [], [], [], 0

        def made() -> pa.RecordBatch:
            names = [c.split()[0] for c in SLICE.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in invert(ids, lengths, found).row()], names=names)

        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for i, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = terms(text)
                if not words:
                    continue
                counts = Counter(words)
                known = [w for w in counts if w in vocabulary]
                ids.append(i)
                lengths.append(len(words))
                found.append(([vocabulary[w] for w in known], [counts[w] for w in known]))
                held += 1 + len(known)
                if held >= limit:
                    yield made()
                    ids, lengths, found, held = [], [], [], 0
        if ids:
            yield made()

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    for batch in batches:
        for k in range(len(batch)):
            yield Slice.of([c[k].as_py() for c in batch.columns])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): documents of each term; term -1: documents, term -2: terms of all documents."""
    for s in _rows(batches):
        term = np.concatenate([s.terms, [-1, -2]]).astype(np.int32)
        n = np.concatenate([np.diff(s.starts), [len(s.ids), s.lengths.sum()]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], names=["term", "n"])


@dataclass(frozen=True)
class Queries:
    """A block of queries: for each its terms, rarest first, and weights (w times how often the query has the term); and the corpus's size."""

    terms: dict[int, list[tuple[int, int]]]
    n_documents: int
    n_terms: int


class Index:
    """What the search of one slice needs: impacts of each term's postings, made once."""

    def __init__(self, s: Slice, q: Queries):
        self.slice, self.place = s, {int(t): k for k, t in enumerate(s.terms)}
        self.m = 75 + 25 * s.lengths * q.n_documents // max(q.n_terms, 1)
        self.known: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Documents, impacts, and the largest of these; None where no document of the slice has the term."""
        if term not in self.known:
            if (k := self.place.get(term)) is None:
                return None
            s = self.slice
            docs, tf = s.docs[s.starts[k] : s.starts[k + 1]], s.counts[s.starts[k] : s.starts[k + 1]]
            impacts = 1_000_000_000 * tf // (1000 * tf + 12 * self.m[docs])
            self.known[term] = docs, impacts, int(impacts.max())
        return self.known[term]


def best_of(index: Index, query: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the slice's best k documents (more where scores tie with the last, so that ids can decide), and how many accumulators there were."""
    parts = [(w, p) for t, w in query if w > 0 and (p := index.postings(t)) is not None]
    bounds = np.cumsum([w * p[2] for w, p in parts][::-1])[::-1] if parts else []
    score = np.zeros(len(index.slice.ids), np.int64)
    survivors: np.ndarray | None = None
    for (w, (docs, impacts, _)), to_come in zip(parts, bounds, strict=True):
        if survivors is None:
            partial = score[score > 0]
            if len(partial) >= k and np.partition(partial, -k)[-k] > to_come:
                survivors = np.flatnonzero(score)
        if survivors is None:
            score[docs] += w * impacts
        elif len(survivors) < len(docs):
            at = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
            hit = docs[at] == survivors
            score[survivors[hit]] += w * impacts[at[hit]]
        else:
            at = np.minimum(np.searchsorted(survivors, docs), len(survivors) - 1)
            hit = survivors[at] == docs
            score[docs[hit]] += w * impacts[hit]
    places = np.flatnonzero(score)
    made = len(places)
    if made > k:
        places = places[score[places] >= np.partition(score[places], -k)[-k]]
    return places, score[places], made


def _search(queries: Queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _rows(batches):
            index, items, ids, scores = Index(s, queries), [], [], []
            for item, query in queries.terms.items():
                places, score, _ = best_of(index, query, k)
                own = s.ids[places]
                order = np.lexsort((own, own == _NULL, -score))[:k]
                items.append(np.full(len(order), item, np.int64))
                ids.append(own[order])
                scores.append(score[order])
            if items:
                own = np.concatenate(ids)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), pa.array(own, mask=own == _NULL), pa.array(np.concatenate(scores))], names=["item", "doc_id", "score"])

    return run


def _weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def _block(docs: DataFrame, entries: list[tuple[int, str, int]], k: int, slice_postings: int) -> DataFrame:
    vocabulary = {t: n for n, t in enumerate(dict.fromkeys(t.encode() for _, t, _ in entries))}
    slices = materialize(docs.mapInArrow(lean(_slices(vocabulary, slice_postings)), SLICE), "slices")
    sums = slices.mapInArrow(_sums, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r.term: r.n for r in sums.collect()}  # a row for each term of the block, and two
    own: dict[int, list[tuple[int, int, int]]] = {}
    for item, term, times in entries:
        t = vocabulary[term.encode()]
        if t in df:
            own.setdefault(item, []).append((df[t], t, times * _weight(df[-1], df[t])))
    rarest_first = {item: [(t, w) for _, t, w in sorted(found)] for item, found in own.items()}
    return slices.mapInArrow(lean(_search(Queries(rarest_first, df.get(-1, 0), df.get(-2, 0)), k)), "item long, doc_id long, score long")


def ranked_search(df: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = 20, block_terms: int = 200_000, slice_postings: int = SLICE_POSTINGS) -> DataFrame:
    """The k best documents of each row of items: item_col, rank, id_col, score; fewer, where fewer have a score above 0.

    Terms, weights and scores are exact and of 64 bits. Null and empty texts have
    no terms: such documents are not counted and never found, such items find
    nothing. Equal scores go by ascending id, null ids last. Rows are documents
    and queries of their own, also where they repeat others or their ids. An
    empty table gives no rows. Other columns are ignored. `block_terms`: (item,
    term) entries that are brought to the driver and to every task at a time.
    """
    spark: SparkSession = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = materialize(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")), "items")
    entries = asked.select("item", F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(TERM), F.lit(0))).alias("term")).groupBy("item", "term").agg(F.count("*").alias("times"))
    entries = materialize(entries, "query-terms")
    blocks = -(-entries.count() // block_terms)
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for b in range(blocks):
        own = entries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "term", "times").collect()
        found = found.union(_block(docs, [tuple(r) for r in own], k, slice_postings))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    out = ranked.join(asked.select("item", "item_id"), "item")
    return out.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
