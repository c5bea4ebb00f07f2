"""Small documents with everything that can go wrong in them, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, words string, n long, h long, norm string, block long, score double"


def documents(seed: int = 1) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 80))) for _ in range(12)]
    rows: list[tuple[int | None, str | None]] = []
    for b in base:
        rows.append((len(rows), b))
        for _ in range(rng.randint(0, 4)):
            w = b.split(" ")
            w[rng.randrange(len(w))] = "edited"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, base[0].upper()) for k in range(3)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one two"), (204, "One  TWO"), (205, "é🙂 ÀB é🙂 àb"), (206, "Straße x"), (207, "word " * 20_000), (208, "x" * 150_000), (209, "a\nb\na\n\n a\nc"), (None, base[1]), (None, "only null id")]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (210, "<|endoftext|> in <|endoftext|>text"), (211, "tail   ")]
    return rows


def frame(spark, rows=None):
    """documents() with extra columns whose names operators use inside."""
    rows = documents() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}" if i != 5 else None, None, True, "w", 1, 2, "z", 3, 0.5) for i, t in rows], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def components(rows, n: int = 5, percent: int = 80) -> list[tuple[int | None, int, int | None]]:
    """(id, size of the set, component) of each row, by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    ids: dict[int, list[int]] = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids.setdefault(root(k), []).append(i)
    return [(rows[k][0], len(sets[k]), min(ids[root(k)]) if root(k) in ids else None) for k in range(len(rows))]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))
