"""Exact and near duplicates, packing, token counts, mixing: against brute force on awkward documents and empty tables."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrangle.llm import bpe, mixing, ngram_join
from quadrangle.llm.components import components as spark_components
from quadrangle.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from quadrangle.llm.mixing import mix_sources, mixed_rows, solve
from quadrangle.llm.ngram_join import drop_near_duplicates, ngram_components
from quadrangle.llm.packing import best_fit, pack_documents
from quadrangle.llm.token_counts import token_counts
from tests.llm.helpers import LOWER, SCHEMA, components, documents, frame, ordered


@pytest.fixture(scope="module")
def library():
    return bpe_library()


def bpe_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("parts", ["1", "4", "9"])
def test_exact_duplicates(spark, keep, parts):
    rows = documents() + [(1000 + k, "hot copy") for k in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = exact_duplicates(frame(spark, rows), keep=keep).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    pick = min if keep == "smallest" else max
    want = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        want += [(i, pick(known) if known else None, len(ids), hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    assert ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(want)
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_exact_duplicates_keeps_columns(spark):
    df = frame(spark)
    out = drop_exact_duplicates(df, keep="largest")
    assert out.columns == df.columns
    assert out.count() == len({(t or "").translate(LOWER) for _, t in documents()})


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ngram_components(spark, seed):
    rows = documents(seed)
    got = ngram_components(frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(components(rows))


def test_ngram_components_of_a_large_group(spark):
    """Many near copies of one text, of which only some pairs are similar, and a passage that others share."""
    rng = random.Random(4)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(1000)}"
        rows.append((k, " ".join(w)))
    rows += [(500 + k, " ".join(base[:60] + [f"o{rng.randrange(5000)}" for _ in range(40)])) for k in range(40)]
    got = ngram_components(frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(components(rows))


def test_drop_near_duplicates(spark):
    rows = [r for r in documents() if r[0] is not None and r[0] != 3]
    out = drop_near_duplicates(frame(spark, rows))
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, _, c in components(rows)})


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    got = dict(map(tuple, spark_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(50)}


def test_token_counts(spark, library):
    rows = documents()
    got = token_counts(frame(spark, rows), limit=20).collect()
    want = [(i, len((t or "").encode()), len(e.ids), len(e.ids) > 20) for (i, t), e in zip(rows, library.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True)]
    assert ordered(map(tuple, got)) == ordered(want)


def test_merging_equals_the_library(library):
    rng = random.Random(5)
    alphabet = [*"aaab '’s\n\t  é½²٣中x́🙂  .,!<|", "'ll", bpe.SPECIAL, "'re"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    cut = [bpe.cut(t) for t in texts]
    distinct = sorted({w for x in cut for w in x})
    n = dict(zip(distinct, bpe.count_by_merging(bpe.vocabulary_path(), distinct), strict=True))
    assert [sum(n[w] for w in x) for x in cut] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packing(spark, library):
    rows = documents()
    got = pack_documents(frame(spark, rows), length=64).collect()
    ids = Counter()
    encoded = {(i, t): [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    want = []
    for i, t in rows:
        e = encoded[i, t]
        first = len(e) % 64 or 64
        edges = [0, *range(first, len(e) + 1, 64)]
        want += [(i, k, s, f - s, zlib.crc32(np.array(e[s:f], "<u4").tobytes())) for k, (s, f) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    assert ordered(tuple(r)[:5] for r in got) == ordered(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
        ids["tokens"] += at
    assert len(bins) <= -(-ids["tokens"] // 64) * 1.05 + 1


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_respects_every_constraint(score):
    rng = np.random.default_rng(6)
    n = rng.integers(1, 100, 400)
    demand = np.stack([n, np.ones_like(n), n * n], axis=1).astype(float)
    capacity = np.array([100.0, 4.0, 6000.0])
    bins, k = best_fit(demand, capacity, weights=np.ones(3), score=score)
    for b in range(k):
        own = demand[bins == b]
        assert len(own) and (len(own) == 1 or (own.sum(0) <= capacity + 1e-9).all())


def test_solve():
    m = solve([8000, 1000, 1000], max_repeats=2.0)
    assert 0 < m.exponent < 1 and sum(m.weights) == pytest.approx(1)
    assert m.quotas[0] == 8000 and max(m.quotas[1:]) == pytest.approx(2000, abs=1)
    e = solve([8000, 1000, 1000], target_entropy=0.9, budget=10_000)
    assert mixing.entropy(e.weights) == pytest.approx(0.9 * np.log(3), abs=1e-6) and sum(e.quotas) == pytest.approx(10_000, abs=2)
    assert solve([5, 5], max_repeats=2.0).quotas == [5, 5] and solve([0, 0], max_repeats=2.0).quotas == [0, 0]


@pytest.mark.parametrize("how", [{"max_repeats": 2.0}, {"target_entropy": 0.95, "max_repeats": None, "budget": 900}])
def test_mixing_meets_its_quotas(spark, how):
    rows = [(k, " ".join(["w"] * (1 + k % 7))) for k in range(300)]
    df = spark.createDataFrame([(i, t, "big" if i < 240 else "small" if i < 299 else None) for i, t in rows], "doc_id long, text string, source string")
    got = mix_sources(df, block_docs=16, **how).collect()
    tokens = Counter()
    for i, t in rows:
        tokens["big" if i < 240 else "small" if i < 299 else None] += len(t.split())
    names = sorted(tokens, key=lambda s: (s is not None, str(s)))
    m = solve([tokens[s] for s in names], **how)
    seen = Counter((r.doc_id, r["pass"]) for r in got)
    assert max(seen.values()) == 1
    for s, quota in zip(names, m.quotas, strict=True):
        have = sum(r.n_tokens for r in got if r.source == s)
        assert quota - 7 <= have <= quota
        whole = quota // tokens[s]
        assert all(sum(r["pass"] < whole for r in got if r.doc_id == i) == whole for i in {r.doc_id for r in got if r.source == s})
    again = mix_sources(df.repartition(5), block_docs=16, **how).collect()
    assert ordered(map(tuple, got)) == ordered(map(tuple, again))


def test_mixed_rows_keep_columns_and_every_row(spark):
    rows = [r for r in documents() if r[0] is not None and r[0] != 3]
    df = frame(spark, rows)
    out = mixed_rows(df, max_repeats=2.0)
    assert out.columns == df.columns
    n = Counter(r.doc_id for r in out.collect())
    assert set(n) == {i for i, _ in rows} and max(n.values()) <= 3


@pytest.mark.parametrize("operator", [exact_duplicates, drop_exact_duplicates, ngram_components, drop_near_duplicates, token_counts, pack_documents, mix_sources, mixed_rows])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


def test_awkward_rows_mix(spark):
    assert mix_sources(frame(spark)).where(F.col("pass") == 0).count() == len(documents())


def test_mixed_rows_of_null_and_repeated_ids(spark):
    """Each row counts by itself: once at least, and as often as mix_sources takes it, however many rows share its id."""
    rows = documents() + [(None, f"null id {k}") for k in range(40)] + [(3, f"other text {k}") for k in range(5)] + [(77, "same")] * 30
    df = frame(spark, rows)
    out = Counter((r.doc_id, r.text) for r in mixed_rows(df, max_repeats=2.0).collect())
    have = Counter(rows)
    assert set(out) == set(have) and all(have[k] <= out[k] <= 3 * have[k] for k in have)
    assert sum(out.values()) == mix_sources(df, max_repeats=2.0).count()


def test_no_id_overfills_a_block(spark):
    rows = [(None, f"text {k}", "a") for k in range(500)] + [(7, "same", "a")] * 500
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_docs=50).collect()
    assert len(got) == 1000 and max(Counter((r.doc_id, r.block) for r in got).values()) <= 200


def test_drop_near_duplicates_of_null_and_repeated_ids(spark):
    """One row of each component, with its smallest id, and every row without words: on all rows, and with null and repeated ids on both sides of a link."""
    near = " ".join(f"k{k}" for k in range(60))
    rows = documents() + [(None, near), (None, f"{near} tail"), (-5, "stands alone"), (-5, f"{near} end"), (-5, f"{near} tail"), (None, None), (None, ""), (None, "null id alone"), (None, "null id alone")]
    out = [(r.doc_id, r.text) for r in drop_near_duplicates(frame(spark, rows)).collect()]
    assert not Counter(out) - Counter(rows)
    parts, label = defaultdict(list), _labels(rows)
    for k, (i, t) in enumerate(rows):
        parts[label[k]].append((i, t))
    blank = [p[0] for p in parts.values() if not (p[0][1] or "").strip()]
    assert ordered(r for r in out if not (r[1] or "").strip()) == ordered(blank)
    left = Counter(out)
    for p in parts.values():
        known = [i for i, _ in p if i is not None]
        stays = [r for r in set(p) if left[r]]
        assert len(stays) == 1 and stays[0][0] == (min(known) if known else None)
    assert len(out) == len(parts)


def _labels(rows) -> list[int]:
    """The first row of each row's component; each row stands for itself under an id of its own."""
    return [c for _, _, c in components([(k, t) for k, (_, t) in enumerate(rows)])]


@pytest.mark.parametrize("filler", [" ", "\n", "\u00a0", "a", " x", "\t<|endoftext|>"])
def test_packing_of_very_long_runs(spark, library, filler):
    text = "a" + filler * (2_000_000 // len(filler)) + "b"
    ids = [*library.encode(text, add_special_tokens=False).ids, 2]
    got = sorted(pack_documents(frame(spark, [(1, text), (2, "short")])).where("doc_id = 1").collect(), key=lambda r: r.piece)
    assert sum(r.length for r in got) == len(ids)
    assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in got)


def joined_passages(n: int, seed: int = 8) -> list[tuple[int, str]]:
    """Documents that each join 4 of 24 common passages, in any order: many share three of them, few are similar."""
    rng = random.Random(seed)
    passages = [" ".join(f"p{k}x{j}" for j in range(30)) for k in range(24)]
    return [(k, " ".join(rng.sample(passages, 4))) for k in range(n)]


def test_ngram_components_of_joined_passages(spark):
    rows = joined_passages(300) + [(1000 + k, f"{t} tail") for k, t in joined_passages(300)[:20]]
    got = ngram_components(frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(components(rows))


def test_tested_pairs_grow_with_the_input(spark, monkeypatch):
    tested, links = Counter(), ngram_join._Join.links

    def counting(self, candidates):
        out = links(self, candidates)
        tested[size] = self.tested.count()
        return out

    monkeypatch.setattr(ngram_join._Join, "links", counting)
    for size in (500, 2000):  # of 2000, some 237,000 pairs are in one list
        ngram_components(frame(spark, joined_passages(size))).count()
    assert max(tested[size] / size for size in tested) <= 15


def test_solve_against_a_grid():
    """Exponent, weights and quotas by trying every exponent of a fine grid."""
    rng = random.Random(9)
    for _ in range(5):
        tokens = np.array([rng.randint(1, 10 ** rng.randint(1, 6)) for _ in range(rng.randint(2, 6))], float)
        grid = np.linspace(0, 1, 20_001)
        raised = (tokens / tokens.sum())[None] ** grid[:, None]
        weights = raised / raised.sum(1, keepdims=True)
        size = (tokens / weights).max(1)  # the fewest tokens that hold every source once
        repeats = (size[:, None] * weights / tokens).max(1)
        first = np.argmax(repeats <= 2.0)
        m = solve([int(t) for t in tokens], max_repeats=2.0)
        assert m.exponent == pytest.approx(grid[first], abs=1e-4)
        assert m.weights == pytest.approx(weights[first].tolist(), abs=1e-3)
        assert m.quotas == pytest.approx((size[first] * weights[first]).tolist(), rel=1e-3, abs=1)


def test_passes_are_permutations(spark):
    """Blocks and places have no gaps, a whole pass holds every document once, and passes come in different orders."""
    rows = [(k, "w " * (1 + k % 5), "big" if k < 300 else "small") for k in range(340)]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_docs=16, max_repeats=2.0).collect()
    orders = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.source, r["pass"], r.block, r.place)):
        orders[r.source, r["pass"]].append(r)
    for (source, number), have in orders.items():
        blocks = defaultdict(list)
        for r in have:
            blocks[r.block].append(r.place)
        assert sorted(blocks) == list(range(len(blocks)))
        assert all(places == list(range(len(places))) for places in blocks.values())
        if number == 0:
            assert sorted(r.doc_id for r in have) == [i for i, _, s in rows if s == source]
    ids = {k: [r.doc_id for r in v] for k, v in orders.items()}
    assert len({k[1] for k in ids}) > 1
    again = [i for i in ids["small", 0] if i in set(ids["small", 1])]
    assert ids["small", 0] != sorted(ids["small", 0]) and ids["small", 1] != again


def test_long_words_are_merged_in_windows(library):
    """Random letters, repeats, common endings and other scripts, from just above a window on; windows so small that they seldom agree."""
    rng = random.Random(9)
    path, words = bpe.vocabulary_path(), ["x" * 50_000, "ab" * 20_000, "é" * 700, "中文" * 400, "0123456789" * 900]
    for _ in range(150):
        letters = rng.choice(["ab", "aeiou", "etaoinshrdlu", "lmnopqrstuvw", "aaab"])
        words.append("".join(rng.choice(letters) if rng.random() < 0.6 else rng.choice(["the", "ing", "tion", "er", "un"]) for _ in range(rng.randint(60, 500))))
    want = [len(e.ids) for e in library.encode_batch(words, add_special_tokens=False)]
    assert bpe.count_by_merging(path, words).tolist() == want
    assert [bpe.count_long(path, w.encode(), 8, 6) for w in words[2:60]] == want[2:60]


def test_a_million_letters_take_seconds(library):
    rng = random.Random(10)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    began = time.time()
    n = bpe.count_by_merging(bpe.vocabulary_path(), [word])[0]
    assert time.time() - began < 15  # about 1.3 s on an idle core
    assert n == len(library.encode(word, add_special_tokens=False).ids)


@pytest.mark.parametrize("run", [98, 99, 100, 150, 9_999])
def test_ids_of_runs_of_space(library, run):
    """Runs on both sides of the length from which texts are cut by their own pattern; with and without special strings."""
    text = ("a" + " " * run + "b\n" + "\t" * run) * max(3, 300_000 // run // 4) + "<|endoftext|> end"
    encoding = bpe.encoding_of_ranks(bpe.vocabulary_path("byte_bpe_50k.tiktoken"), (bpe.SPECIAL, 50256))
    began = time.time()
    got = bpe.ids_of(encoding, text, bpe.SPECIAL).tolist()
    assert time.time() - began < 5
    assert got == library.encode(text, add_special_tokens=False).ids
