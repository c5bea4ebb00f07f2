"""Alignment of two tokenizers: against all pairs of tokens, by the libraries themselves."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quadrangle.llm import alignment, bpe
from quadrangle.llm.alignment import align_tokenizers, merge_runs, runs_of
from tests.llm.helpers import SCHEMA, documents, frame, ordered


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(bpe.vocabulary_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_path("piece_bpe_32k.model"))


def tokens(libraries, text: str | None):
    """(id, start, end) of A's and B's tokens; nothing where the bytes differ."""
    a, b = libraries
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(plain)))}
    if not text:
        return [], []
    want, out = f" {text}".encode(), []
    parts = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
    pieces = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    for side in (parts, pieces):
        if b"".join(x for _, x in side) != want:
            return [], []
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return tuple(out)


def brute_force(libraries, rows):
    every, links = [], Counter()
    for _, text in rows:
        a, b = tokens(libraries, text)
        found, k = [], 0
        for i, s, e in a:
            while k and b[k - 1][2] > s:
                k -= 1
            while k < len(b) and b[k][1] < e:
                if b[k][2] > s:
                    found.append((i, b[k][0]))
                k += 1
        links.update(found)
        every.append((a, b, found))
    highest = Counter()
    for (_, j), n in links.items():
        highest[j] = max(highest[j], n)
    out = []
    for (doc, _), (a, b, found) in zip(rows, every, strict=True):
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, x, y = [], 0, 0
        for end in ends:
            own_a = [i for i, _, e in a[x:] if e <= end]
            own_b = [j for j, _, e in b[y:] if e <= end]
            x, y = x + len(own_a), y + len(own_b)
            groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(ends), len(found), sum(links[p] == highest[p[1]] for p in found), sum(links[p] for p in found), digest))
    return out


def awkward():
    rows = [r for r in documents() if len(r[1] or "") < 5000]
    rows += [(300, "▁a b"), (301, "a\0b"), (302, "<s>hi</s> <|endoftext|> <0x41>"), (303, "  two  spaces "), (304, "\n\n\tx\r\n"), (305, "中文字符 é🙂"), (306, " "), (307, "x" * 3000), (308, " " * 500 + "y")]
    return rows + [(400 + k, f"the same words again {k}") for k in range(50)]


@pytest.mark.parametrize("spill", [50, 2_000_000])
@pytest.mark.parametrize("radices", [1, 5])
def test_alignment_by_brute_force(spark, libraries, spill, radices):
    rows = awkward()
    got = align_tokenizers(frame(spark, rows).repartition(3), radices=radices, spill_links=spill)
    assert ordered(map(tuple, got.collect())) == ordered(brute_force(libraries, rows))


def test_salts_and_long_texts(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "RUNS_PER_MERGE", 2)
    rows = [(1, "word and other words, " * 20_000), (2, "z" * 50_000), (3, None), (None, "word and"), (3, "word and")]
    got = align_tokenizers(frame(spark, rows), radices=2, spill_links=10)
    want = brute_force(libraries, [(1, "word and other words, " * 20), *rows[2:]])
    assert {r.doc_id: r.n_a for r in got.collect()}[2] == len(libraries[0].encode(" " + "z" * 50_000).ids)
    small = align_tokenizers(frame(spark, [(1, "word and other words, " * 20), *rows[2:]]), radices=2, spill_links=10)
    assert ordered(map(tuple, small.collect())) == ordered(want)


def test_no_rows_and_no_tokens(spark):
    assert align_tokenizers(spark.createDataFrame([], SCHEMA)).count() == 0
    got = align_tokenizers(frame(spark, [(1, None), (2, ""), (3, "▁")])).collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_merging_of_runs():
    """Sums of the heap merge equal those of all links, in order, whatever blocks the runs have."""
    rng, want, runs = random.Random(2), Counter(), {r: [] for r in range(3)}
    for size in (1, 20_000, 90_000, 40_000):
        keys = np.array([rng.randrange(60_000) for _ in range(size)], np.int64)
        want.update(keys.tolist())
        for r, heads, blocks, _ in runs_of(keys, np.array([rng.randrange(50) for _ in range(size)], np.int64), 3):
            runs[r].append((heads, blocks))
    got = Counter()
    for own in runs.values():
        last = -1
        for pair, n in merge_runs(own):
            assert pair[0] > last and (np.diff(pair) > 0).all()
            last = pair[-1]
            got.update(dict(zip(pair.tolist(), n.tolist(), strict=True)))
    assert got == want
