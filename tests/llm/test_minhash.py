"""Tensored MinHash: components against all pairs, and how often pairs meet in a table."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quadrangle.llm import minhash_dedup, ngram_join
from quadrangle.llm.minhash_dedup import _stars, _tables, half_keys, minhash_components, minhashes, table_keys
from quadrangle.llm.ngram_join import _Hashes, _measure, by_range, ngram_set
from tests.llm.helpers import SCHEMA, components, documents, frame, ordered


def brute_force(rows):
    return ordered((i, n, c, i == c) for i, n, c in components(rows, n=3, percent=85))


def edited_copies(seed: int, texts: int, copies: int, edits: int) -> list[tuple[int, str]]:
    """Copies with some words replaced: similarities on both sides of the wanted one."""
    rng = random.Random(seed)
    rows = []
    for t in range(texts):
        base = [f"t{t}w{k}" for k in range(rng.randint(20, 120))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(100_000)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_awkward_documents(spark, seed):
    rows = documents(seed)
    got = minhash_components(frame(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert ordered(map(tuple, got.collect())) == brute_force(rows)


def test_components_of_edited_copies(spark):
    """Groups of small and large size whose pairs lie around the wanted similarity."""
    rows = edited_copies(3, 60, 4, 3)
    rows += [(10_000 + i, t.replace("t0w", "big")) for i, t in edited_copies(4, 1, 200, 6)]
    got = minhash_components(frame(spark, rows)).collect()
    assert ordered(map(tuple, got)) == brute_force(rows)


def test_no_rows(spark):
    assert minhash_components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r) for r in minhash_components(frame(spark, [(4, None), (5, "")])).orderBy("doc_id").collect()] == [(4, 0, 4, True), (5, 0, 5, True)]


def test_minhashes_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        agree = []
        for _ in range(40):
            both, one, other = rng.integers(0, 1 << 63, int(400 * share), np.uint64), *(rng.integers(0, 1 << 63, int(400 * (1 - share) / 2), np.uint64) for _ in range(2))
            x, y = (minhashes(np.append(both, z), 84, 3) for z in (one, other))
            agree.append((x == y).mean())
        assert np.mean(agree) == pytest.approx(share, abs=0.02)


def test_pairs_meet_in_a_table():
    """196 keys of 84 minhashes; pairs just above 0.85 share one, those far below seldom do."""
    hashes, rng = _Hashes(), random.Random(5)
    far = near = 0
    for t in range(200):
        base = [f"{t}w{k}" for k in range(200)]
        w = list(base)
        for k in (20, 60, 100, 140, 180):
            w[k] = f"edit{rng.random()}"
        x, y = (table_keys(ngram_set(" ".join(v).encode(), 3, hashes), half=14, rows=3, seed=7) for v in (base, w))
        z = table_keys(ngram_set(" ".join(base[:60] + [f"{t}o{k}" for k in range(140)]).encode(), 3, hashes), half=14, rows=3, seed=7)
        assert len(set(x.tolist())) == 196 and (np.diff(x.view(np.uint64)) > 0).all()
        near += bool(np.intersect1d(x, y).size)
        far += bool(np.intersect1d(x, z).size)
    assert near == 200 and far < 60


def test_stars_of_buckets():
    """Each bucket's smallest class with its others, a pair once; buckets of one class give none."""
    h, s = np.array([1, 1, 1, 2, 3, 3, 4, 4], np.uint64), np.array([5, 7, 9, 5, 5, 9, -3, 7])
    (batch,) = list(_stars(h, s))
    assert sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True)) == [(-3, 7), (5, 7), (5, 9)]
    assert list(_stars(h[3:4], s[3:4])) == []


def test_links_without_a_hub(spark):
    """A chain of texts, each similar to the next ones only, and copies of it under other words: pairs that no hub is in."""
    rows = [(k, " ".join(f"c{j}" for j in range(6 * k, 6 * k + 120))) for k in range(40)]
    rows += [(500 + k, t.replace("c", "d")) for k, t in rows[::3]] + [(None, rows[3][1]), (2, "other text under an id that repeats")]
    got = minhash_components(frame(spark, rows)).collect()
    assert ordered(map(tuple, got)) == brute_force(rows)


def test_components_join_classes_and_not_entries(spark, monkeypatch):
    """When the first lists are made, labels meet one row a class; they met every entry of every class."""
    from quadrangle.llm import ngram_join

    written, materialize = {}, ngram_join.materialize

    def seen(df, name):
        written.setdefault(name, []).append(df.columns)
        return materialize(df, name)

    monkeypatch.setattr(ngram_join, "materialize", seen)
    rows = edited_copies(5, 10, 5, 3)
    assert ordered(map(tuple, minhash_components(frame(spark, rows)).collect())) == brute_force(rows)
    assert "comp" in written["entries"][0] and list(written).index("labels") < list(written).index("entries")


def test_keys_are_made_once_a_class():
    """A class's first text has the keys of the two collections; copies in the same task and texts without a set have none."""
    texts = ["one two three four", None, "ONE  two three four", "", "five", "one two three four five"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "text": texts})
    (out,) = _measure(3, 0, lambda grams: half_keys(grams, half=14, rows=3, seed=7))(iter([batch]))
    keys, sids = (out.column(out.schema.get_field_index(c)).to_pylist() for c in ("keys", "sid"))
    assert [k is not None for k in keys] == [True, False, False, False, True, True]
    first = [0, 4, 5]
    sent = _tables(3)(iter([pa.RecordBatch.from_pydict({"sid": [sids[k] for k in first], "keys": [keys[k] for k in first]})]))
    got: list[tuple[int, int]] = []

    def emit(h, s):
        got.extend(zip(h.tolist(), s.tolist(), strict=True))
        return iter(())

    list(by_range(emit)(sent))
    hashes = _Hashes()
    wanted = [(h, sids[k]) for k in first for h in table_keys(ngram_set(texts[k].encode(), 3, hashes), half=14, rows=3, seed=7).tolist()]
    assert sorted(got) == sorted(wanted)


def test_tables_are_made_of_written_keys(spark, monkeypatch):
    """Texts were cut into shingles twice, for their classes and for their tables; now tables read what the classes wrote."""
    written, materialize = {}, ngram_join.materialize

    def seen(df, name):
        written.setdefault(name, df._jdf.queryExecution().analyzed().toString())
        return materialize(df, name)

    for module in (ngram_join, minhash_dedup):
        monkeypatch.setattr(module, "materialize", seen)
    rows = edited_copies(6, 6, 4, 3) + [(900, None), (901, "")]
    assert ordered(map(tuple, minhash_components(frame(spark, rows)).collect())) == brute_force(rows)
    assert "text" in written["members"] and "keys" in written["members"]
    assert "text" not in written["stars"] and "keys" in written["stars"]


def test_hashes_of_ngrams_are_as_defined():
    """Against arithmetic with Python's integers."""
    import xxhash

    mask, odd = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def one(words):
        h = len(words)
        for w in words:
            h = (h + xxhash.xxh3_64_intdigest(w)) * odd & mask
            h ^= h >> 29
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & mask
        h = (h ^ h >> 27) * 0x94D049BB133111EB & mask
        return h ^ h >> 31

    for text in (b"a", b"a B", b"a b c a b c A B C d", b"\xc3\x80 \xc3\xa0 x\ty\nz", b"w " * 50):
        words = text.lower().split()
        m = min(3, len(words))
        assert ngram_set(text, 3, _Hashes()).tolist() == sorted({one(words[k : k + m]) for k in range(len(words) - m + 1)})
    assert not len(ngram_set(b" \n", 3, _Hashes())) and not len(ngram_set(None, 3, _Hashes()))
