"""Exact deduplication by content sort.

Sampled splitters range-partition the normalised bytes, an external sort puts
equal texts next to each other, and full comparisons of neighbours form runs.
The splitters sample (first bytes, hash, id), never whole texts, so the sample
stays small however long the texts are. The id is the last part of the range
key: a text with a third of all rows spreads over many partitions. Only the
runs at a partition's edges can go on in another partition; they are the few
rows that are compared again, by full text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.llm.common import lean, lower_ascii, materialize, partitions

RUNS = "id long, sha string, run_keep long, run_size long, cand boolean, run_id long, norm binary"


def _neighbours(largest: bool):
    pick = max if largest else min
    schema = pa.schema([("id", pa.int64()), ("sha", pa.string()), ("run_keep", pa.int64()), ("run_size", pa.int64()), ("cand", pa.bool_()), ("run_id", pa.int64()), ("norm", pa.binary())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        first_key = key = None
        pending: list[tuple[bytes, list]] = []  # the runs of the present key: one, but for equal hashes of unequal texts
        out: dict[str, list] = {f.name: [] for f in schema}
        number = 0

        def flush(edge: bool) -> None:
            nonlocal number
            for norm, ids in pending:
                sha, known = hashlib.sha256(norm).hexdigest(), [i for i in ids if i is not None]
                keep = pick(known) if known else None
                chosen = ids.index(keep)
                out["id"] += ids
                out["sha"] += [sha] * len(ids)
                out["run_keep"] += [keep] * len(ids)
                out["run_size"] += [len(ids)] * len(ids)
                out["cand"] += [k == chosen for k in range(len(ids))]
                out["run_id"] += [base + number if edge else None] * len(ids)
                out["norm"] += [norm if edge and not k else None for k in range(len(ids))]
                number += 1
            pending.clear()

        for batch in batches:
            heads, hashes, norms, ids = (batch.column(c).to_pylist() for c in ("head", "hash", "norm", "id"))
            for p, h, norm, i in zip(heads, hashes, norms, ids, strict=True):
                if (p, h) != key:
                    flush(key == first_key)
                    key = (p, h)
                    first_key = first_key or key
                if pending and pending[-1][0] == norm:
                    pending[-1][1].append(i)
                else:
                    pending.append((norm, [i]))
            if len(out["id"]) >= 20_000:
                yield pa.RecordBatch.from_pydict(out, schema)
                out = {f.name: [] for f in schema}
        flush(True)
        if out["id"]:
            yield pa.RecordBatch.from_pydict(out, schema)

    return walk


def exact_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", head_bytes: int = 64) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    keep: "smallest" or "largest" id of the group stays. Null ids never win over
    others; in a group of null ids only, keep_id is null and one row is kept. Of
    rows that repeat id and text, one is kept. Other columns are ignored.
    """
    largest = {"smallest": False, "largest": True}[keep]
    norm = F.encode(lower_ascii(F.col(text_col)), "UTF-8")
    rows = df.select(F.col(id_col).cast("long").alias("id"), norm.alias("norm"))
    keyed = rows.select("id", "norm", F.substring("norm", 1, head_bytes).alias("head"), F.xxhash64("norm").alias("hash"))
    ranged = keyed.repartitionByRange(partitions(df.sparkSession), "head", "hash", "id")
    runs = materialize(ranged.sortWithinPartitions("head", "hash", "norm", "id").mapInArrow(lean(_neighbours(largest)), RUNS), "exact-runs")

    same = Window.partitionBy("norm")
    edges = runs.where(F.col("norm").isNotNull()).withColumn("all_keep", (F.max if largest else F.min)("run_keep").over(same))
    edges = edges.select(
        "run_id",
        "all_keep",
        F.sum("run_size").over(same).alias("all_size"),
        F.min(F.when(F.col("run_keep").eqNullSafe(F.col("all_keep")), F.col("run_id"))).over(same).alias("winner"),
    )
    # At most the runs of the first and the last key of each partition: their number is bounded by that of partitions.
    out = runs.drop("norm").join(F.broadcast(edges), "run_id", "left")
    edge = F.col("run_id").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(edge, F.col("all_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.when(edge, F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
        (F.col("cand") & (~edge | (F.col("winner") == F.col("run_id")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of df, with all their columns, that exact_duplicates() keeps."""
    kept = exact_duplicates(df, id_col=id_col, text_col=text_col, keep=keep).where("kept").select(F.col(id_col).alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"))
    marked = df.withColumn("__sha", F.sha2(F.encode(lower_ascii(F.col(text_col)), "UTF-8"), 256))
    out = marked.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col("__kept_id")) & (F.col("__sha") == F.col("__kept_sha")), "left_semi")
    return out.dropDuplicates([id_col, "__sha"]).drop("__sha")
