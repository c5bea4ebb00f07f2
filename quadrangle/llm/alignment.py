"""Alignment of two tokenizers over a corpus, by external spill counting.

1. Each task tokenizes whole texts with both vocabularies. A link is a pair of
   token occurrences (A, B) whose byte ranges overlap; between two neighbouring
   ends of tokens lies exactly one. Records (pair, document, times) of a bounded
   number of links are sorted, radix-partitioned by a hash of the pair, and
   spilled as one zstd run for each radix, in the shared folder.
2. Runs of a radix meet in one task (with a salt, where there are many) and a
   k-way heap merge adds up each pair, in the order of B ids, then A ids. These
   counts, summed over salts, give the maximum of each B id.
3. The counts of a radix come first and its runs after them: each run is read
   once more and gives back, for each of its documents, the sum of counts and
   the number of links that reach their B id's maximum.
4. What the radices give is added up with the documents of each spill.

A pair that every text has makes a record a text, in the runs of one radix, in
the order of the other pairs; salts deal these runs out. Counted are sums of
whole runs, so no task sees a pair's records of all texts.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.bpe import encoding_of_ranks, ids_of, vocabulary_path
from quadrangle.llm.common import lean, materialize, partitions

#: Links of a spill, about, and pairs of one block of a run.
SPILL_LINKS, BLOCK_PAIRS = 2_000_000, 8192
#: Runs that meet in one merge, about.
RUNS_PER_MERGE = 64
#: Documents of a spill are numbered in so many bits.
PLACE_BITS = 20
_ODD = np.uint64(0x9E3779B97F4A7C15)

RUNS = "spill long, radix int, heads array<long>, pairs array<binary>, records array<binary>, size int, ids array<long>, numbers array<long>, digests array<string>"
_LISTS = {"array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary()), "array<string>": pa.list_(pa.string()), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _LISTS[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def _pack(*columns: np.ndarray) -> bytes:
    """Arrays byte by byte (all lowest bytes first), compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns))


def _unpack(blob: bytes, *kinds: str, lead: int = 0) -> list[np.ndarray]:
    """The arrays of _pack(); the first has `lead` numbers if given, the others share the rest evenly."""
    data, out, at = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), [], 0
    widths = [np.dtype(k).itemsize for k in kinds]
    rest = (len(data) - lead * widths[0]) // sum(widths[1:]) if lead else len(data) // sum(widths)
    for i, (k, w) in enumerate(zip(kinds, widths, strict=True)):
        n = lead if lead and not i else rest
        out.append(np.ascontiguousarray(data[at : at + n * w].reshape(w, n).T).view(k).ravel())
        at += n * w
    return out


# --- tokens and links -----------------------------------------------------------------------


class Vocabularies:
    """Both tokenizers, the bytes of their entries, and how ids are written in the text of groups."""

    def __init__(self, ranks_path: str, piece_path: str):
        import sentencepiece

        self.a, self.b = encoding_of_ranks(ranks_path), sentencepiece.SentencePieceProcessor(model_file=piece_path)
        a_bytes = [self.a.decode_single_token_bytes(k) for k in range(self.a.n_vocab)]
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (a_bytes, self.b_bytes))
        self.written = [b"%d%s" % (k, mark) for k in range(len(a_bytes)) for mark in (b",", b"|")] + [b"%d%s" % (k, mark) for k in range(len(self.b_bytes)) for mark in (b",", b";")]

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        if self.b.is_byte(k):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B of each text; None where either's bytes differ from a space and the text."""
        words = [t.decode(errors="replace") for t in texts]
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, word, b in zip(texts, words, self.b.encode(words, num_threads=1), strict=True):
            want = b" " + text
            if not text or b"".join(map(self.b_bytes.__getitem__, b)) != want:
                out.append(None)
                continue
            a = ids_of(self.a, f" {word}", None)
            out.append((a, np.array(b, np.int64)) if self.a.decode_bytes(a.tolist()) == want else None)
        return out


@cache
def vocabularies(ranks_path: str, piece_path: str) -> Vocabularies:
    return Vocabularies(ranks_path, piece_path)


def align(v: Vocabularies, found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Links of texts that have tokens: A ids, B ids and the text's place of each link; (n_a, n_b, n_groups, n_links) of each text; digests of groups."""
    a, b = (np.concatenate([f[k] for f in found]).astype(np.int64) for k in (0, 1))
    sizes_a, sizes_b = (np.array([len(f[k]) for f in found]) for k in (0, 1))
    ends_a, ends_b = np.cumsum(v.a_length[a]), np.cumsum(v.b_length[b])
    texts_end = ends_a[np.cumsum(sizes_a) - 1]  # in bytes, the same for both
    at_a, at_b = np.zeros(texts_end[-1] + 1, bool), np.zeros(texts_end[-1] + 1, bool)
    at_a[ends_a], at_b[ends_b] = True, True
    cuts = np.flatnonzero(at_a | at_b)
    in_a, in_b = at_a[cuts], at_b[cuts]
    both = in_a & in_b
    link_a, link_b = a[np.cumsum(in_a) - in_a], b[np.cumsum(in_b) - in_b]
    text_cut = np.searchsorted(cuts, texts_end, "right")  # cuts up to each text's end
    n_links, n_groups = np.diff(text_cut, prepend=0), np.diff(np.cumsum(both)[text_cut - 1], prepend=0)
    group = np.cumsum(both) - both
    group_a, group_b = group[in_a], group[in_b]
    before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g))]) for g in (group_a, group_b))
    written = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
    written[np.arange(len(a)) + before_b[group_a]] = 2 * a + last_a
    written[np.arange(len(b)) + before_a[group_b + 1]] = 2 * (len(v.a_length) + b) + last_b
    strings = list(map(v.written.__getitem__, written.tolist()))
    edges = np.concatenate([[0], np.cumsum(sizes_a + sizes_b)]).tolist()
    digests = [hashlib.sha256(b"".join(strings[s:e])[:-1]).hexdigest() for s, e in zip(edges[:-1], edges[1:], strict=True)]
    place = np.repeat(np.arange(len(found)), n_links)
    return link_a, link_b, place, np.stack([sizes_a, sizes_b, n_groups, n_links], axis=1), digests


# --- runs -----------------------------------------------------------------------------------


def runs_of(key: np.ndarray, place: np.ndarray, radices: int) -> Iterator[tuple[int, list[int], list[bytes], list[bytes]]]:
    """The links of one spill as a run for each radix: (radix, first pairs of its blocks, blocks of pairs, blocks of records)."""
    record, times = np.unique(key << PLACE_BITS | place, return_counts=True)
    pair = record >> PLACE_BITS
    radix = ((pair.astype(np.uint64) * _ODD) >> np.uint64(48)) % np.uint64(radices)
    order = np.argsort(radix.astype(np.uint16), kind="stable")  # pairs stay in order within a radix
    record, times, pair, radix = record[order], times[order], pair[order], radix[order]
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))  # pairs of different radices differ
    pairs, n_records, sums = pair[starts], np.diff(np.append(starts, len(pair))), np.add.reduceat(times, starts)
    of_radix = np.searchsorted(radix[starts], np.arange(radices + 1, dtype=np.uint64))
    for r in range(radices):
        heads, blocks, records = [], [], []
        for s in range(of_radix[r], of_radix[r + 1], BLOCK_PAIRS):
            e = min(s + BLOCK_PAIRS, of_radix[r + 1])
            x, y = starts[s], starts[e] if e < len(starts) else len(record)
            heads.append(int(pairs[s]))
            blocks.append(_pack(np.diff(pairs[s:e], prepend=0), sums[s:e]))
            records.append(_pack(n_records[s:e].astype("<u4"), (record[x:y] & ((1 << PLACE_BITS) - 1)).astype("<u4"), times[x:y]))
        if heads:
            yield r, heads, blocks, records


def _pairs(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, sums = _unpack(block, "<i8", "<i8")
    return np.cumsum(steps), sums


def _spills(ranks_path: str, piece_path: str, radices: int, spill_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, base, made = vocabularies(ranks_path, piece_path), TaskContext.get().partitionId() << 32, 0
        ids, numbers, digests, keys, places, held = [], [], [], [], [], 0

        def spill() -> Iterator[pa.RecordBatch]:
            if keys:
                for r, heads, pairs, records in runs_of(np.concatenate(keys), np.concatenate(places), radices):
                    yield _batch(RUNS, [(base + made, r, heads, pairs, records, len(ids), None, None, None)])
            yield _batch(RUNS, [(base + made, -1, None, None, None, len(ids), ids, np.concatenate(numbers).ravel(), digests)])

        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            found = v.encode(texts)
            has = np.array([k for k, f in enumerate(found) if f is not None], np.int64)
            own, own_digests = np.zeros((len(texts), 4), np.int64), np.full(len(texts), "", object)
            if len(has):
                a, b, place, own[has], own_digests[has] = align(v, [found[k] for k in has])
                keys.append(b * len(v.a_length) + a)
                places.append(has[place] + len(ids))
                held += len(a)
            ids += batch.column(0).to_pylist()
            numbers.append(own)
            digests += own_digests.tolist()
            if held >= spill_links or len(ids) >= 1 << (PLACE_BITS - 1):
                yield from spill()
                ids, numbers, digests, keys, places, held, made = [], [], [], [], [], 0, made + 1
        if ids:
            yield from spill()

    return run


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sums of each pair over runs (first pairs of blocks, blocks), in the order of pairs: a heap holds each run's next block by its first pair."""
    heap = [(heads[0], r, 0) for r, (heads, _) in enumerate(runs) if heads]
    heapq.heapify(heap)
    pool: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    while heap:
        _, r, k = heapq.heappop(heap)
        heads, blocks = runs[r]
        pool.append(_pairs(blocks[k]))
        waiting += len(pool[-1][0])
        if k + 1 < len(heads):
            heapq.heappush(heap, (heads[k + 1], r, k + 1))
        if heap and waiting < 8 * BLOCK_PAIRS:
            continue
        pair, n = (np.concatenate([p[i] for p in pool]) for i in (0, 1))
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], n[order]
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        pair, n = pair[starts], np.add.reduceat(n, starts)
        final = np.searchsorted(pair, heap[0][0]) if heap else len(pair)  # no block to come holds smaller pairs
        if final:
            yield pair[:final], n[:final]
        pool, waiting = [(pair[final:], n[final:])], len(pair) - final


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(len(batch)):
            yield tuple(c[k].as_py() for c in batch.columns)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, _), group in groupby(_rows(batches), key=lambda r: r[:2]):
        for pair, n in merge_runs([(heads, blocks) for _, _, heads, blocks in group]):
            for s in range(0, len(pair), 50_000):
                part = pair[s : s + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), radix, np.int32)), pa.array(part), pa.array(n[s : s + 50_000])], names=["radix", "pair", "n"])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each radix and salt first the counts, then the runs: (spill, sums of each document) of each run."""
    now, parts, known = None, [], None
    for batch in batches:
        radix, salt, kind = (batch.column(k).to_numpy() for k in range(3))
        edges = np.flatnonzero(np.append(True, (np.diff(radix) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)))
        for s, e in zip(edges, np.append(edges[1:], len(batch)), strict=True):
            part = batch.slice(s, e - s)
            if (radix[s], salt[s]) != now:
                now, parts, known = (radix[s], salt[s]), [], None
            if kind[s] == 0:
                parts.append([part.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5)])
                continue
            if known is None:
                known, parts = [np.concatenate([p[k] for p in parts]) for k in range(3)], []
            pairs, counts, best = known
            for row in range(len(part)):
                spill, size, blocks, records = (part.column(k)[row].as_py() for k in (6, 7, 8, 9))
                n_best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for block, record in zip(blocks, records, strict=True):
                    own, _ = _pairs(block)
                    at = np.searchsorted(pairs, own)
                    repeats, places, times = _unpack(record, "<u4", "<u4", "<i8", lead=len(own))
                    at = np.repeat(at, repeats)
                    np.add.at(total, places, times * counts[at])
                    np.add.at(n_best, places, times * best[at])
                yield _batch("spill long, sums binary", [(spill, _pack(n_best, total))])


OUT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _documents(id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each spill first its documents, then what the radices say of them."""
        for _, group in groupby(_rows(batches), key=lambda r: r[0]):
            _, _, _, ids, numbers, digests = next(group)
            n_best, total = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for row in group:
                more, sums = _unpack(row[2], "<i8", "<i8")
                n_best += more
                total += sums
            columns = [*np.array(numbers, np.int64).reshape(-1, 4).T, n_best, total]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, columns), pa.array(digests, pa.string())], names=[id_col, *(c.split()[0] for c in OUT.split(", "))])

    return run


def align_tokenizers(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, pieces: str | None = None, radices: int = 32, spill_links: int = SPILL_LINKS) -> DataFrame:
    """One row per input row: id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A reads a space and the text by the ranks of the byte-level vocabulary, B
    the text by the sentencepiece model, both without special tokens. Texts that
    are null or empty, or whose tokens' bytes are not a space and the text, have
    no tokens: zeros and an empty digest. Null and repeated ids are rows of
    their own; an empty table gives no rows; other columns are ignored.
    `radices` bounds what of all pairs' counts one task holds.
    """
    p = partitions(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spilled = _spills(ranks or vocabulary_path("byte_bpe_50k.tiktoken"), pieces or vocabulary_path("piece_bpe_32k.model"), radices, spill_links)
    table = materialize(docs.mapInArrow(lean(spilled), RUNS), "runs")
    salts = max(1, -(-table.where("radix = -1").count() // RUNS_PER_MERGE), -(-p // radices))
    runs = table.where("radix >= 0").withColumn("salt", F.pmod(F.xxhash64("spill"), F.lit(salts)).cast("int"))

    met = runs.select("radix", "salt", "heads", "pairs").repartition(p, "radix", "salt").sortWithinPartitions("radix", "salt")
    counts = met.mapInArrow(lean(_count), "radix int, pair long, n long").groupBy("radix", "pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pair-counts")
    b = F.expr(f"pair div {_n_a(ranks)}")
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    counts = counts.withColumn("b", b).join(highest, "b").select("radix", "pair", "n", (F.col("n") == F.col("highest")).alias("best"))

    none = lambda kind: F.lit(None).cast(kind)
    asked = runs.select("radix", "salt", F.lit(1).alias("kind"), none("long").alias("pair"), none("long").alias("n"), none("boolean").alias("best"), "spill", "size", "pairs", "records")
    known = counts.select("radix", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "pair", "n", "best", none("long").alias("spill"), none("int").alias("size"), none("array<binary>").alias("pairs"), none("array<binary>").alias("records"))
    both = known.union(asked).repartition(p, "radix", "salt").sortWithinPartitions("radix", "salt", "kind", "pair")
    sums = both.mapInArrow(lean(_answer), "spill long, sums binary")

    own = table.where("radix = -1").select("spill", F.lit(0).alias("kind"), none("binary").alias("sums"), "ids", "numbers", "digests")
    given = sums.select("spill", F.lit(1).alias("kind"), "sums", none("array<long>").alias("ids"), none("array<long>").alias("numbers"), none("array<string>").alias("digests"))
    whole = own.union(given).repartition(p, "spill").sortWithinPartitions("spill", "kind")
    return whole.mapInArrow(lean(_documents(id_col)), f"`{id_col}` long, {OUT}")


def _n_a(ranks: str | None) -> int:
    return encoding_of_ranks(ranks or vocabulary_path("byte_bpe_50k.tiktoken")).n_vocab
