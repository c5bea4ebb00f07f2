"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its token share to the power of an exponent, normalised.
The exponent (1: as the corpus is; 0: all sources alike) is found by bisection
so that the weights meet a target entropy or no source is repeated more often
than a limit. A source's quota is its weight times the token budget: so many
whole passes, then whole blocks of its documents in a permuted order, and of the
last block the documents that the quota still holds.

Documents are dealt to blocks by a hash of id and text, so blocks are even
however large a source is and however many rows share an id; running totals go over blocks first, in two levels, and only inside
one block over documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.llm.common import WORD, materialize


@dataclass(frozen=True)
class Mixture:
    exponent: float
    weights: list[float]
    quotas: list[int]


def temperature_weights(shares: list[float], exponent: float) -> list[float]:
    raised = [s**exponent if s > 0 else 0.0 for s in shares]
    total = sum(raised)
    return [r / total for r in raised] if total else raised


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def solve(tokens: list[int], *, target_entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None, steps: int = 60) -> Mixture:
    """Exponent in [0, 1], weights and quotas of sources with these token counts.

    target_entropy: as a share of the largest possible entropy; the largest
    exponent that reaches it. max_repeats: the smallest exponent at which no
    quota is more than that many times its source. With both, the limit wins.
    budget: tokens of the mixture; by default the fewest that hold every source
    at least once. Sources without tokens have weight and quota 0.
    """
    total = sum(tokens)
    shares = [t / total if total else 0.0 for t in tokens]
    live = [k for k, t in enumerate(tokens) if t > 0]

    def size(weights: list[float]) -> float:
        return budget if budget is not None else max((tokens[k] / weights[k] for k in live), default=0.0)

    def repeats(exponent: float) -> float:
        weights = temperature_weights(shares, exponent)
        return max((size(weights) * weights[k] / tokens[k] for k in live), default=0.0)

    def bisect(good, low: float, high: float) -> float:
        """The end of the stretch from `high` on which good() holds, towards `low`."""
        if good(low):
            return low
        for _ in range(steps):
            mid = (low + high) / 2
            low, high = (low, mid) if good(mid) else (mid, high)
        return high

    exponent = 1.0
    if target_entropy is not None and len(live) > 1:
        wanted = target_entropy * math.log(len(live))
        exponent = bisect(lambda e: entropy(temperature_weights(shares, e)) >= wanted - 1e-12, 1.0, 0.0)
    if max_repeats is not None and live:
        exponent = max(exponent if target_entropy is not None else 0.0, bisect(lambda e: repeats(e) <= max_repeats, 0.0, 1.0))
    weights = temperature_weights(shares, exponent)
    whole = size(weights)
    return Mixture(exponent, weights, [round(whole * w) for w in weights])


def mix_sources(df: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", token_col: str | None = None, target_entropy: float | None = None, max_repeats: float | None = 2.0, budget: int | None = None, block_docs: int = 256, seed: int = 1, max_sources: int = 100_000) -> DataFrame:
    """One row per document and pass: id_col, source_col, n_tokens, exponent, weight, pass, block, place.

    Reading each source by (pass, block, place) gives its permuted order; passes
    are permuted separately. n_tokens: token_col, or words of the whole text.
    Null sources are one source. Null and empty texts have no tokens: they come
    with whole passes, and with a partial one where their block does. Repeated
    rows count as often as they occur. A partial pass never exceeds its quota.
    Other columns are ignored. More than max_sources sources are an error: the
    table of sources is solved on the driver. Copies of one id and text that
    would overfill a block are dealt over several, by their place in the input.
    """
    found = _mix(df, F.monotonically_increasing_id(), id_col, source_col, text_col, token_col, target_entropy, max_repeats, budget, block_docs, seed, max_sources)
    return found.select(F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("n").alias("n_tokens"), "exponent", "weight", F.col("pass").cast("int").alias("pass"), "block", F.col("place").cast("int").alias("place"))


def _mix(df: DataFrame, row: Column, id_col: str, source_col: str, text_col: str, token_col: str | None, target_entropy: float | None, max_repeats: float | None, budget: int | None, block_docs: int, seed: int, max_sources: int) -> DataFrame:
    """One row per input row and pass, with `row`, which tells input rows apart."""
    count = F.col(token_col) if token_col else F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD))
    content = F.xxhash64(text_col) if text_col in df.columns else F.lit(0).cast("long")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), F.coalesce(count, F.lit(0)).cast("long").alias("n"), content.alias("h"), row.alias("row"))
    docs = materialize(docs, "mixing-docs")
    rows = docs.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    rows = sorted(rows, key=lambda r: (r.source is not None, str(r.source)))
    mixture = solve([r.tokens for r in rows], target_entropy=target_entropy, max_repeats=max_repeats, budget=budget)
    plan = [
        (r.source, mixture.exponent, w, q // r.tokens if r.tokens else 1, q % r.tokens if r.tokens else 0, max(1, -(-r.docs // block_docs)))
        for r, w, q in zip(rows, mixture.weights, mixture.quotas, strict=True)
    ]
    kind = df.schema[source_col].dataType.simpleString()
    plans = df.sparkSession.createDataFrame(plan, f"source {kind}, exponent double, weight double, passes long, rest long, blocks long")
    d = docs.join(F.broadcast(plans), docs["source"].eqNullSafe(plans["source"])).drop(plans["source"])  # at most max_sources rows
    # At most one group for each block_docs rows, and none in most tables.
    copies = materialize(docs.groupBy("source", "id", "h").count().where(F.col("count") > block_docs), "mixing-copies")
    part = F.lit(0).cast("long")
    if not copies.isEmpty():
        same = [d[c].eqNullSafe(copies[c]) for c in ("source", "id", "h")]
        d = d.join(copies, same, "left").drop(copies["source"], copies["id"], copies["h"])
        part = F.coalesce(F.pmod(F.xxhash64("row"), F.ceil(F.col("count") / block_docs)), part)
    d = d.withColumn("block_id", F.pmod(F.xxhash64("id", "h", part, F.lit(seed)), F.col("blocks"))).drop("count")

    def order(*what: str):
        return F.xxhash64(*what[:-1], F.lit(seed), F.col(what[-1]))

    whole = d.where("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    partial = d.where("rest > 0").withColumn("pass", F.col("passes"))
    every = whole.withColumn("all", F.lit(True)).unionByName(partial.withColumn("all", F.lit(False)))

    blocks = every.groupBy("source", "pass", "all", "block_id").agg(F.sum("n").alias("tokens"), F.first("rest").alias("rest"), F.first("blocks").alias("blocks"))
    blocks = blocks.withColumn("rank", order("block_id", "pass"))
    # About 1024 blocks share one upper group: the rank's leading part.
    groups = F.greatest(F.lit(1), F.ceil(F.col("blocks") / 1024))
    blocks = materialize(blocks.withColumn("upper", F.floor((F.col("rank") / F.lit(2.0**64) + 0.5) * groups)), "mixing-blocks")
    upper = blocks.groupBy("source", "pass", "upper").agg(F.sum("tokens").alias("t"), F.count("*").alias("k"))
    before = Window.partitionBy("source", "pass").orderBy("upper").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select("source", "pass", "upper", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("k0"))
    inside = Window.partitionBy("source", "pass", "upper").orderBy("rank", "block_id")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    keys = [blocks["source"].eqNullSafe(upper["source"]), blocks["pass"] == upper["pass"], blocks["upper"] == upper["upper"]]
    placed = blocks.join(upper, keys).drop(upper["source"], upper["pass"], upper["upper"])
    placed = placed.select("source", "pass", "block_id", "all", "tokens", "rest", (F.col("k0") + F.row_number().over(inside) - 1).alias("block"), (F.col("t0") + F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).alias("start"))
    placed = placed.where(F.col("all") | (F.col("start") < F.col("rest"))).select("source", "pass", "block_id", "block", "start")

    found = every.join(placed, [every["source"].eqNullSafe(placed["source"]), every["pass"] == placed["pass"], every["block_id"] == placed["block_id"]]).drop(placed["source"], placed["pass"], placed["block_id"])
    within = Window.partitionBy("source", "pass", "block_id").orderBy(order("id", "h", "pass"), "id", "h", "n", "row")
    found = found.withColumn("place", F.row_number().over(within) - 1).withColumn("end", F.col("start") + F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    found = found.where(F.col("all") | (F.col("end") <= F.col("rest")))
    return found.select("row", "id", "source", "n", "exponent", "weight", "pass", "block", "place")


def mixed_rows(df: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", token_col: str | None = None, target_entropy: float | None = None, max_repeats: float | None = 2.0, budget: int | None = None, block_docs: int = 256, seed: int = 1, max_sources: int = 100_000) -> DataFrame:
    """The rows of df, with all their columns, as often as mix_sources() takes them: each row by itself, whether or not others share its id."""
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "mixing-rows")  # written, so that the keys stay
    found = _mix(rows, F.col("__row"), id_col, source_col, text_col, token_col, target_entropy, max_repeats, budget, block_docs, seed, max_sources)
    times = found.groupBy(F.col("row").alias("__row")).agg(F.count("*").cast("int").alias("__times"))
    out = rows.join(times, "__row")
    return out.withColumn("__pass", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*[rows[c] for c in df.columns])
