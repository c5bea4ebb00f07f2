"""Similarity join on word n-grams by vertical partitioning.

1. Every text becomes its set of distinct n-grams (64-bit hashes). Texts with
   equal sets form a class; from here on a class counts as one set.
2. n-grams meet in ranges of the hash. Those of one class only can't be shared
   and are dropped. The others get their frequency, which makes the global order
   (rare first), and a signature of the classes that hold them: n-grams of equal
   signature always come together, so they count as one symbol with a weight. A
   passage that thousands of texts share is one symbol, not hundreds.
3. Classes that share a symbol within their prefixes, fit in size and can still
   reach the wanted overlap are candidates.
4. The global order is cut into fragments. For each candidate pair the overlap
   is counted fragment by fragment, and the partial counts are summed per pair.

Only the components of the links are wanted, so pairs inside a component that
is known already need no test. Each round tests the members of a symbol's list
against one member, its hub, and merges what is linked; a list of k near copies
costs about k tests. Lists that stay long although nothing in them links (texts
put together from the same few passages) are split by the next symbol that two
members can share, again and again; pairs of short lists are tested. No link
between different components is missed:

- Two linked classes share, within the weight that each may lack, a first
  symbol, a second one and so on; so the lists split by all symbols that come
  next hold every pair that shares a further one.
- A pair that shares no further symbol has exactly the list's symbols in common;
  then either is linked with the member that has the fewest n-grams, as that one
  shares as much and is no larger. This member is the first hub of every list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.common import lean, materialize, partitions, short_plans
from quadrangle.llm.components import components

#: Classes that a worker remembers to have sent.
REMEMBERED = 100_000
#: Splits of a list at most, and how many times the entries of the first lists their splits may have. Beyond, rounds of hubs go on until one links nothing, and all pairs left are tested.
DEEPEST, GROWTH = 12, 4
#: Lists are split when so many rounds of hubs at least have been made and the last one left more than this share of the pairs.
ROUNDS, ENDED = 3, 0.8
#: n-grams that meet in one task, in the mean.
PER_RANGE = 2_000_000
#: Texts that are sent together; places among them fit in 16 bits.
SLICE = 2048
#: Parts of a range that are sorted one after another.
PARTS = 4
_ODD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Hashes:
    """Of words, 64 bits each. None is remembered: to find a word takes longer than to hash it again."""

    def __init__(self):
        import xxhash

        self.digest = xxhash.xxh3_64_digest

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.digest, words)), ">u8").astype(np.uint64)


def ngram_set(text: bytes | None, n: int, hashes: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text in UTF-8, A-Z lower-cased; shorter texts are one n-gram."""
    words = (text or b"").lower().split()  # on bytes: A-Z only; space and \t \n \v \f \r only
    if not words:
        return np.zeros(0, np.uint64)
    w = hashes(words)
    m = min(n, len(w))
    h = np.full(len(w) - m + 1, m, np.uint64)
    for k in range(m):
        h += w[k : len(w) - m + 1 + k]
        h *= _ODD
        h ^= h >> np.uint64(29)
    h ^= h >> np.uint64(30)
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    h.sort()
    return h[np.append(True, h[1:] != h[:-1])]


def _class_of(grams: np.ndarray, salt: int) -> tuple[int, int]:
    """128 bits of a set: the number of its class, and bits that tell whether two classes got the same number."""
    import xxhash

    both = xxhash.xxh3_128_digest(grams.tobytes(), salt)
    return int.from_bytes(both[:8], "big", signed=True), int.from_bytes(both[8:], "big", signed=True)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def _measure(n: int, salt: int, keys: Callable[[np.ndarray], np.ndarray] | None = None):
    """keys: an array made of a class's n-grams, whose bytes are written with its first text (others, and texts without a set, have null)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, met = _Hashes(), set()
        for batch in batches:
            sizes, sids, twins, made = [], [], [], []
            for text in _texts(batch):
                grams = ngram_set(text, n, hashes)
                sid, twin = _class_of(grams, salt)
                sizes.append(len(grams))
                sids.append(sid)
                twins.append(twin)
                if keys:
                    fresh = len(grams) and sid not in met
                    made.append(keys(grams).tobytes() if fresh else None)
                    met.add(sid)
            if len(met) > REMEMBERED:
                met.clear()
            own = [c for c in batch.schema.names if c != "text"]
            columns, names = [*(batch.column(c) for c in own), *(pa.array(x, pa.int64()) for x in (sizes, sids, twins))], [*own, "n", "sid", "twin"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())] if keys else columns, names=[*names, "keys"] if keys else names)

    return measure


def range_bounds(ranges: int) -> np.ndarray:
    """Where ranges of 64-bit hashes end."""
    return (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64)


def ranged(h: np.ndarray, place: np.ndarray, sids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """Per range of the hash one row: sorted hashes, each with its place among sids, which are SLICE at most."""
    order = np.argsort(h, kind="stable")
    h, place = h[order], place[order]
    cuts = [0, *np.searchsorted(h, bounds), len(h)]
    rows = []
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            own, where = np.unique(place[a:b], return_inverse=True)
            steps = np.diff(h[a:b], prepend=np.uint64(0))
            # Byte by byte: the high bytes of steps are zeros, which shuffles compress.
            rows.append((k, sids[own].tobytes(), where.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), steps.view(np.uint8).reshape(-1, 8).T.tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["range", "sids", "places", "steps"])


#: What ranged() gives, and by_range() takes.
RANGED = "range int, sids binary, places binary, steps binary"


def _sender(n: int, ranges: int, salt: int):
    """The n-grams of each batch's classes, by ranges."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sent, bounds = _Hashes(), set(), range_bounds(ranges)
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                sids, sets = [], []
                for text in _texts(whole.slice(at, SLICE)):
                    grams = ngram_set(text, n, hashes)
                    if len(grams) and (sid := _class_of(grams, salt)[0]) not in sent:
                        sent.add(sid)
                        sids.append(sid)
                        sets.append(grams)
                if len(sent) > REMEMBERED:
                    sent.clear()
                if sets:
                    place = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
                    yield ranged(np.concatenate(sets), place, np.array(sids, np.int64), bounds)

    return send


def by_range(emit: Callable[[np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]):
    """For ranges that come one after another: `emit` gets sorted pairs (key, class), without repeats, a part of a range at a time; equal keys are in one part."""

    def part(hs: list, ss: list) -> Iterator[pa.RecordBatch]:
        h, s = np.concatenate(hs), np.concatenate(ss)
        order = np.lexsort((s, h))
        h, s = h[order], s[order]
        fresh = np.append(True, (h[1:] != h[:-1]) | (s[1:] != s[:-1]))
        yield from emit(h[fresh], s[fresh])

    def done(hs: list, ss: list) -> Iterator[pa.RecordBatch]:
        """Each pair of arrays is sorted by hash: cutting all at the same hashes keeps equal ones together."""
        low, high = int(min(h[0] for h in hs)), int(max(h[-1] for h in hs))
        bounds = np.array([low + (high - low) * k // PARTS for k in range(1, PARTS)], np.uint64)
        cuts = [[0, *np.searchsorted(h, bounds), len(h)] for h in hs]
        for k in range(PARTS):
            if any(c[k] < c[k + 1] for c in cuts):
                yield from part([h[c[k] : c[k + 1]] for h, c in zip(hs, cuts, strict=True)], [s[c[k] : c[k + 1]] for s, c in zip(ss, cuts, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hs, ss = None, [], []
        for batch in batches:
            for r, sids, places, steps in zip(*(batch.column(c).to_pylist() for c in ("range", "sids", "places", "steps")), strict=True):
                if r != now and hs:
                    yield from done(hs, ss)
                    hs, ss = [], []
                now = r
                hs.append(np.cumsum(np.ascontiguousarray(np.frombuffer(steps, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64))
                where = np.ascontiguousarray(np.frombuffer(places, np.uint8).reshape(2, -1).T).view("<u2").ravel()
                ss.append(np.frombuffer(sids, np.int64)[where])
        if hs:
            yield from done(hs, ss)

    return run


def _signed(h: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(sid, sig, df) of the n-grams that two classes or more have; sig: a sum of the classes that do."""
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    df = np.diff(np.append(starts, len(h)))
    sig = np.add.reduceat(s.view(np.uint64), starts).view(np.int64)  # classes are numbered by hashes, so sums of different ones differ
    many = np.repeat(df, df) > 1
    s, sig, df = s[many], np.repeat(sig, df)[many], np.repeat(df, df)[many]
    for k in range(0, len(s), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(s[k : k + 100_000]), pa.array(sig[k : k + 100_000]), pa.array(df[k : k + 100_000], pa.int64())], names=["sid", "sig", "df"])


def _order(t: Column) -> Column:
    """A number that grows along the global order: frequency first, signature next."""
    return t["df"] + (t["sig"].cast("double") / F.lit(2.0**64) + 0.5)


def _fits(x: str, y: str, percent: int) -> Column:
    """Whether a pair that lacks so many n-grams can still be similar."""
    nx, ny, lx, ly = (F.col(c) for c in (f"{x}.n", f"{y}.n", f"{x}.lost", f"{y}.lost"))
    sizes = (percent * nx <= 100 * ny) & (percent * ny <= 100 * nx)
    return sizes & ((100 + percent) * F.least(nx - lx, ny - ly) >= percent * (nx + ny))


def _weighed(t: str) -> Column:
    """Of a sorted array of (df, sig), one element for each n-gram: its symbols (df, sig, at, w), `at` being the n-grams before it and w its own."""
    e = F.col(t)
    starts = F.filter(F.sequence(F.lit(0), F.size(e) - 1), lambda i: (i == 0) | (F.get(e, i) != F.get(e, i - 1)))
    ends = F.concat(F.slice(starts, 2, F.size(e)), F.array(F.size(e)))
    return F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.struct(F.get(e, x["a"])["df"].alias("df"), F.get(e, x["a"])["sig"].alias("sig"), x["a"].cast("long").alias("at"), (x["b"] - x["a"]).cast("long").alias("w")))


def _packed(tokens: Column) -> Column:
    """Symbols as numbers, which are compared by hashing: 47 bits of signature, and 16 bits of weight, low or (marked by the 17th bit) high."""

    def number(t: Column, low: Column) -> Column:
        return t["sig"].bitwiseAND(F.lit(-1 << 17)).bitwiseOR(low)

    every = F.transform(tokens, lambda t: number(t, t["w"].bitwiseAND(F.lit(0xFFFF))))
    heavy = F.transform(F.filter(tokens, lambda t: t["w"] > 0xFFFF), lambda t: number(t, F.shiftright(t["w"], 16) + (1 << 16)))
    return F.concat(every, heavy)


def _weight(packed: Column) -> Column:
    def of(x: Column) -> Column:
        low = x.bitwiseAND(F.lit(0x1FFFF))
        return F.when(low <= 0xFFFF, low).otherwise(F.shiftleft(low - (1 << 16), 16))

    return F.aggregate(packed, F.lit(0).cast("long"), lambda acc, x: acc + of(x))


class _Join:
    def __init__(self, sets: DataFrame, percent: int, fragments: int):
        self.sets, self.percent = sets, percent
        t = F.col("tokens")
        quartiles = [_order(t[F.floor(F.size(t) * q / fragments).cast("int")]) for q in range(1, fragments)]
        cuts = sets.select(F.explode(F.array(*quartiles)).alias("k")).agg(F.percentile_approx("k", [q / fragments for q in range(1, fragments)], 1000).alias("p")).first()["p"] or []
        self.cuts = [float("-inf"), *sorted(cuts), float("inf")]
        self.tested: DataFrame | None = None

    @staticmethod
    def _between(a: float, b: float) -> Column:
        return _packed(F.filter("tokens", lambda t: (_order(t) >= a) & (_order(t) < b)))

    def segments(self, of: DataFrame) -> DataFrame:
        """(sid, fragment, grams): the sets of these classes, cut where the global order is cut."""
        parts = [self._between(a, b) for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]
        cut = self.sets.join(of, "sid", "left_semi").select("sid", F.posexplode(F.array(*parts)).alias("fragment", "grams"))
        return cut.where(F.size("grams") > 0)

    def links(self, candidates: DataFrame) -> DataFrame:
        """Tests candidates (a, b, na, nb), and returns (a, b) of the similar ones; tested ones are remembered."""
        pairs = candidates if self.tested is None else candidates.join(self.tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        self.tested = pairs.select("a", "b") if self.tested is None else self.tested.union(pairs.select("a", "b"))
        segments = self.segments(pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct())
        left = segments.select(F.col("sid").alias("a"), "fragment", F.col("grams").alias("ga"))
        right = segments.select(F.col("sid").alias("b"), "fragment", F.col("grams").alias("gb"))
        parts = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", _weight(F.array_intersect("ga", "gb")).alias("part"))
        whole = parts.groupBy("a", "b").agg(F.sum("part").alias("both"), F.first("na").alias("na"), F.first("nb").alias("nb"))
        return materialize(whole.where(100 * F.col("both") >= self.percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), "links")


def _pairs(joined: DataFrame) -> DataFrame:
    """(a, b, na, nb) with a < b, once each, of rows with x.sid, x.n, y.sid, y.n."""
    x, y = F.struct(F.col("x.sid").alias("s"), F.col("x.n").alias("n")), F.struct(F.col("y.sid").alias("s"), F.col("y.n").alias("n"))
    ends = joined.select(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"))
    return ends.select(F.col("lo.s").alias("a"), F.col("hi.s").alias("b"), F.col("lo.n").alias("na"), F.col("hi.n").alias("nb")).dropDuplicates(["a", "b"])


def named_rows(members: DataFrame, owned: DataFrame, id_col: str) -> DataFrame:
    """(id_col, n_shingles, component_id) of every member: the smallest id of its class's component, its own without a set."""
    smallest = owned.groupBy("root").agg(F.min("first").alias("component_id"))
    named = owned.join(smallest, "root").select("sid", "component_id")
    # A class may have a third of all rows: an equi-join whose large partitions Spark splits.
    out = members.where("n > 0").join(named, "sid").select("id", "n", "component_id")
    out = out.union(members.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def join_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(sid, root) after links (a, b) join what the labels of before tell apart."""
    if labels is not None:
        old = labels.withColumnRenamed("sid", "node")
        ends = links.join(old.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(old.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        links = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).union(labels.select(F.col("sid").alias("a"), F.col("root").alias("b")).where("a <> b"))
    return materialize(components(links).withColumnRenamed("node", "sid"), "labels")


def ngram_components(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, fragments: int = 4, enough: int = 4) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id.

    A text's set: its distinct n-word shingles after lower-casing A-Z; with
    fewer words the whole sequence as one. Two rows link when the Jaccard
    similarity of their sets is at least percent / 100; component_id is the
    smallest id reachable by links, the row's own included. Null and empty texts
    have no set and no link: their component_id is their own id. Null ids never
    become a component_id unless the component has no other. Other columns are
    ignored. `enough`: all pairs left are tested when they number at most this
    many times the prefix entries, or in a list this many times its members.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    members, salt = class_members(docs, n)
    return named_rows(members, class_roots(docs, members, F.min("id"), n, percent, fragments, enough, salt), id_col)


def class_members(docs: DataFrame, n: int, keys: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[DataFrame, int]:
    """docs without text, with n (size of the set), sid (number of the class) and, if wanted, keys (see _measure()); and the salt of these numbers."""
    salt = 0
    while True:
        kinds = ", ".join(f"{c} long" for c in docs.columns if c != "text") + ", n long, sid long, twin long" + (", keys binary" if keys else "")
        members = materialize(docs.mapInArrow(lean(_measure(n, salt, keys)), kinds), "members")
        clash = members.groupBy("sid").agg(F.min("twin").alias("a"), F.max("twin").alias("b")).where("a <> b")
        if clash.isEmpty():  # else two different sets have one number; about one corpus in 1e9 of 1e5 classes
            return members.drop("twin"), salt
        salt += 1


def class_roots(docs: DataFrame, members: DataFrame, first: Column, n: int, percent: int, fragments: int, enough: int, salt: int, pairs: DataFrame | None = None) -> DataFrame:
    """See _class_roots(); its rounds leave short descriptions of their plans with the driver."""
    with short_plans(docs.sparkSession):
        return _class_roots(docs, members, first, n, percent, fragments, enough, salt, pairs)


def _class_roots(docs: DataFrame, members: DataFrame, first: Column, n: int, percent: int, fragments: int, enough: int, salt: int, pairs: DataFrame | None) -> DataFrame:
    """(sid, n, first, root) of each class of docs (id, text): `first` is that aggregate of its members (id, n, sid), root names its component.

    pairs (a, b), if given: only classes in them can have a link; they are tested first, and then what they leave apart.
    """
    spark, p = docs.sparkSession, partitions(docs.sparkSession)
    every = classes = members.where("n > 0").groupBy("sid").agg(F.max("n").alias("n"), first.alias("first"))
    if pairs is not None:
        # A class is read from the texts of one of its ids (null where it has no other).
        wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
        of = members.where("n > 0").join(wanted, "sid", "left_semi").groupBy("sid").agg(F.max("n").alias("n"), F.min("id").alias("of"))
        classes = materialize(of, "candidates")
        # Texts are shuffled whatever the number of candidates: the same plan at every size.
        docs = docs.join(classes.select("of").distinct().hint("merge"), F.col("id").eqNullSafe(F.col("of")), "left_semi")

    grams = classes.agg(F.sum("n")).first()[0] or 0
    ranges = max(p, -(-grams // PER_RANGE))
    sent = docs.select("text").mapInArrow(lean(_sender(n, ranges, salt)), RANGED)
    shared = sent.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(lean(by_range(_signed)), "sid long, sig long, df long")
    tokens = shared.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("grams"))  # at most one document's
    tokens = tokens.select("sid", F.size("grams").alias("shared"), _weighed("grams").alias("tokens"))
    # The unshared n-grams come first in the global order.
    known = tokens.join(classes.select("sid", "n"), "sid").select("sid", "n", (F.col("n") - F.col("shared")).alias("before"), "tokens")
    sets = materialize(known, "sets")

    slack = F.col("n") - F.ceil(F.col("n") * percent / 100)  # so many of its n-grams a class may lack
    prefix = F.filter("tokens", lambda t: F.col("before") + t["at"] <= slack)
    join, labels = _Join(sets, percent, fragments), None

    def listed() -> DataFrame:
        """The entries of the first lists, with the components known: classes meet these before each becomes several entries."""
        heads = sets.where(F.col("before") <= slack)
        heads = heads.withColumn("root", F.lit(None).cast("long")) if labels is None else heads.join(labels, "sid", "left")
        heads = heads.select("sid", "n", "before", F.coalesce("root", "sid").alias("comp"), F.explode(prefix).alias("t"))
        # lost: n-grams that come before and aren't shared; got: n-grams of the list's symbols, the last of which is at `at`.
        return materialize(heads.select(F.col("t.sig").alias("h"), "sid", "n", (F.col("before") + F.col("t.at")).alias("lost"), F.col("t.w").alias("got"), F.col("t.at").alias("at"), "comp"), "entries")

    def merge(candidates: DataFrame) -> bool:
        """Tests candidates, and joins the components that they link: whether there are any."""
        nonlocal labels
        links = join.links(_pairs(candidates))
        found = not links.isEmpty()
        if found:
            labels = join_labels(labels, links)
        return found

    def across(now: DataFrame, lists: DataFrame) -> DataFrame:
        """All pairs of these lists: whoever is not of a list's main component, against all others of the list."""
        mixed = now.join(lists.select("h", F.col("main.comp").alias("main")), "h")
        x, y = mixed.where("comp <> main").alias("x"), mixed.alias("y")
        return x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.comp") != F.col("y.comp")) & _fits("x", "y", percent) & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.sid") < F.col("y.sid"))))

    if pairs is not None:
        known = sets.select("sid", "n", F.col("before").alias("lost"))
        ends = pairs.join(known.alias("x"), F.col("a") == F.col("x.sid")).join(known.alias("y"), F.col("b") == F.col("y.sid"))
        merge(ends.where(_fits("x", "y", percent)))
    fresh = listed()
    entries, total = fresh.drop("comp"), fresh.count()
    step, depth, was, merged, whole = 0, 0, 0, True, False
    while total:
        now = fresh if fresh is not None else entries.withColumn("comp", F.col("sid")) if labels is None else entries.join(labels, "sid", "left").withColumn("comp", F.coalesce("root", "sid")).drop("root")
        if pairs is not None and fresh is None:  # most entries are in one component by now: written once a round, and fewer with each
            now = materialize(now, "now")
        fresh = None
        sizes = now.groupBy("h", "comp").agg(F.count("*").alias("k"))
        lists = sizes.groupBy("h").agg(F.sum("k").alias("size"), F.max(F.struct("k", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
        others = F.col("size") - F.col("main.k")
        left = lists.agg(F.sum(others * F.col("size"))).first()[0]
        if not left:
            break
        if pairs is not None:
            entries = now.drop("comp").join(lists.select("h"), "h", "left_semi")  # lists of one component stay so
        if (step or pairs is not None) and (left <= enough * total or whole and not merged):
            merge(across(now, lists))
            break
        if not step or whole or merged and (step < ROUNDS or left < ENDED * was):
            # The hub: first the member with the fewest n-grams, then that which lacks fewest, then any other.
            rank = F.col("n") if step == 0 else F.col("lost") if step == 1 else F.xxhash64("sid", F.lit(step))
            hubs = now.groupBy("h").agg(F.min(F.struct(rank.alias("rank"), "sid", "n", "lost", "comp")).alias("hub")).select("h", "hub.*")
            fits = _fits("x", "y", percent)
            if depth and not step:  # of a split list only those that its symbols alone make similar
                fits = (100 + percent) * F.col("x.got") >= percent * (F.col("x.n") + F.col("y.n"))
            merged = merge(now.alias("x").join(hubs.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.comp") != F.col("y.comp")) & fits))
            step, was = step + 1, left
            continue
        lists = materialize(lists, "lists")
        long = now.join(lists.where(others > enough).select("h"), "h", "left_semi").select("h", "sid", "n", "lost", "got", "at")
        following = F.filter("tokens", lambda t: (t["at"] > F.col("at")) & (F.col("before") + t["at"] - F.col("got") <= slack))
        split = long.join(sets.select("sid", "before", "tokens"), "sid").withColumn("after", following)
        if depth == DEEPEST or (split.agg(F.sum(F.size("after"))).first()[0] or 0) > GROWTH * total:
            whole = merged = True  # more rounds of hubs, until one links nothing
            continue
        merge(across(now, lists.where(others <= enough)))
        split = split.select("h", "sid", "n", "before", "got", F.explode("after").alias("t"))
        entries = materialize(split.select(F.xxhash64("h", "t.sig").alias("h"), "sid", "n", (F.col("before") + F.col("t.at") - F.col("got")).alias("lost"), (F.col("got") + F.col("t.w")).alias("got"), F.col("t.at").alias("at")), "entries")
        step, depth, merged = 0, depth + 1, True

    return every.withColumn("root", F.col("sid")) if labels is None else every.join(labels, "sid", "left").withColumn("root", F.coalesce("root", "sid"))


def drop_near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, fragments: int = 4, enough: int = 4) -> DataFrame:
    """The rows of df, with all their columns, that stay when one row of each component of ngram_components() does.

    It is a row with the component's smallest id; null ids win only where there
    is no other. Of rows that repeat this id one stays. Null and empty texts
    are no near copies of anything: all their rows stay.
    """
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "near-rows")  # written, so that the keys stay
    docs = rows.select(F.col(id_col).cast("long").alias("id"), F.col("__row").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    members, salt = class_members(docs, n)
    owned = class_roots(docs.select("id", "text"), members, F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "sid", "row")), n, percent, fragments, enough, salt)
    kept = owned.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("__row"))
    return rows.join(kept.union(members.where("n = 0").select("row")), "__row", "left_semi").drop("__row")
