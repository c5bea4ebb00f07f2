"""Ranked search against scores of every document by brute force, whatever slices, blocks, ties, nulls and repeated rows there are."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quadrangle.llm.ranked_search import Index, Queries, Slice, best_of, invert, ranked_search, terms
from tests.llm.helpers import LOWER, SCHEMA, documents, frame

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id int, text string, extra int"


def split(text: str | None) -> list[str]:
    return PATTERN.findall((text or "").translate(LOWER))


def brute_force(docs, items, k: int):
    bags = [(i, Counter(split(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + 25 * b.total() * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in split(text) if b[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def corpus(seed: int, n: int):
    """Words with frequencies over a wide range, so that common ones come late and stop making accumulators."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(200)]
    weights = [1 / (k + 1) for k in range(200)]
    return [(k, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for k in range(n)], [(k, " ".join(rng.choices(words, weights, k=rng.randint(1, 12)) + rng.choices(words, k=2))) for k in range(25)]


@pytest.mark.parametrize(("slice_postings", "block_terms"), [(1_000_000, 200_000), (40, 20), (1, 7)])
def test_search_by_brute_force(spark, slice_postings, block_terms):
    docs, items = corpus(1, 300)
    docs += documents() + [(k % 3, "w0 w150") for k in range(30)] + [(None, "w0 w150")] * 3
    items += [(90, None), (91, ""), (92, "?! ..."), (93, "no such"), (94, "w0 W0 w0"), (94, "w150 w3"), (None, "Straße é🙂 x")]
    df = frame(spark, docs).repartition(3)
    got = ranked_search(df, spark.createDataFrame([(*i, 1) for i in items], ITEMS), k=5, slice_postings=slice_postings, block_terms=block_terms)
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got.collect()), key=str) == brute_force(docs, items, 5)


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b", 0)], ITEMS)
    assert ranked_search(none, one).count() == 0
    assert ranked_search(frame(spark), one.where("false")).count() == 0
    assert ranked_search(frame(spark, [(1, None), (2, "--")]), one).count() == 0


def test_terms_are_cut_on_bytes():
    for text in ("Ab1-c\x7fÉa b_̀x", "ÀÉ;é", "", "a\0b[c]d{e}f@g:h/i0", " ßİ"):
        assert [t.decode() for t in terms(text.encode())] == split(text)


def test_accumulators_are_limited_and_scores_exact():
    """Far fewer accumulators than documents with a term, the same best documents and scores as without a limit."""
    rng = random.Random(2)
    n = 5000
    found = []
    for _ in range(n):
        own = sorted({0, *(t for t in range(1, 12) if rng.random() < 0.5 / t)})
        found.append((own, [rng.randint(1, 4) for _ in own]))
    s = invert(list(range(n)), [rng.randint(20, 90) for _ in range(n)], found)
    assert all(np.array_equal(x, y) for x, y in zip(s.__dict__.values(), Slice.of(s.row()).__dict__.values(), strict=True))
    df = np.diff(s.starts)
    query = sorted(((int(t), math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1)))) for t, d in zip(s.terms, df, strict=True)), key=lambda x: df[x[0]])
    index = Index(s, Queries({}, n, int(s.lengths.sum())))
    places, scores, made = best_of(index, query, 10)
    every = np.zeros(n, np.int64)
    for t, w in query:
        docs, impacts, most = index.postings(t)
        every[docs] += w * impacts
        assert impacts.max() == most
    best = np.sort(every)[-10]
    assert sorted(places.tolist()) == np.flatnonzero(every >= best).tolist() and scores.tolist() == every[places].tolist()
    assert made < 0.8 * n
