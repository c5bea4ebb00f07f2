"""Byte-level BPE over whole columns of texts.

The JVM cuts texts into pre-tokens (`pretokens`); Python workers see them as
Arrow lists, of which only the distinct strings of a batch become Python
objects. Texts that hold the string of a special token are rare and are cut in
the worker, as the tokenizers library does by default: that string is one
token, and the texts on its sides are cut separately.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The published pre-tokenisation pattern of this vocabulary, with white space as Unicode defines it.
JAVA_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?![^\p{IsWhite_Space}])|\p{IsWhite_Space}+"
SPECIAL = "<|endoftext|>"
#: Distinct pre-tokens a worker remembers between batches.
REMEMBERED = 400_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretokens(text: Column) -> list[Column]:
    """Columns `words` (null where the text holds a special string) and `raw` (that text, else null)."""
    text = F.coalesce(text, F.lit(""))
    odd = F.instr(text, SPECIAL) > 0
    return [F.when(~odd, F.regexp_extract_all(text, F.lit(JAVA_PATTERN), F.lit(0))).alias("words"), F.when(odd, text).alias("raw")]


def cut(text: str, special: str | None = SPECIAL) -> list[str]:
    """Pre-tokens of one text in Python, special strings whole (None: there are none)."""
    import public_tokenizers
    import regex

    find = regex.compile(public_tokenizers.PATTERN).findall
    out: list[str] = []
    for k, part in enumerate(text.split(special) if special else [text]):
        out += [special] * bool(k) + find(part)
    return out


@cache
def encoding_of_ranks(path: str, special: tuple[str, int] | None = None):
    """The published ranks in the tiktoken library; tests hold its ids against the tokenizers library's."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict([special] if special else []))


#: The library's regular expression takes time that grows with the square of a run of white space; texts with runs this long are cut by another.
LONG_SPACE = re.compile(r"\s{100}")


def ids_of(encoding, text: str, special: str | None) -> np.ndarray:
    """Token ids of a text, whatever runs are in it; the special string, if any, is its token."""
    allowed = {special} if special else set()
    if not LONG_SPACE.search(text):
        return encoding.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
    known: dict[str, np.ndarray] = {special: encoding.encode_to_numpy(special, allowed_special=allowed)} if special else {}
    words = cut(text, special)
    for w in set(words).difference(known):
        known[w] = np.array(encoding._encode_single_piece(w), np.uint32)
    return np.concatenate([known[w] for w in words])


def encoded(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of a batch, their indices in order, and where each text's begin and the last's end."""
    words, raw = batch.column(batch.schema.get_field_index("words")), batch.column(batch.schema.get_field_index("raw"))
    if raw.null_count < len(raw):
        lists = [cut(r) if r is not None else w for w, r in zip(words.to_pylist(), raw.to_pylist(), strict=True)]
        words = pa.array(lists, pa.list_(pa.string()))
    flat = words.flatten()
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(flat)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])


class Memory(dict):
    """What a worker knows about pre-tokens, emptied when it grows too large."""

    def known(self, words: list[str], learn) -> list:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = words
        if new:
            self.update(zip(new, learn(new), strict=True))
        return [self[w] for w in words]


@cache
def merge_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbol of each byte; sorted keys of mergeable pairs, their ranks and the symbols they become."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    # Printable bytes stand for themselves, the others for the code points from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    symbols = np.array([vocab[chars[b]] for b in range(256)], np.int64)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    return symbols, keys[order], np.arange(len(keys))[order], made[order]


#: Longer words are merged in windows of WINDOW bytes, a step of STEP apart; both double for words whose windows don't agree.
WINDOW, STEP = 96, 64


def merged(path: str, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of non-empty byte strings, after all merges: the string of each symbol, in order, and how many bytes it has.

    The strings are one ragged array. In each round every string takes the
    lowest rank of its adjacent pairs and merges all the non-overlapping places
    of that pair, from the left, at once with all other strings. Strings without
    a mergeable pair leave the array. Ranks are looked up again only beside what
    was merged.
    """
    symbols, keys, ranks, made = merge_table(path)
    none = len(keys)

    def look_up(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(keys, key), none - 1)
        return np.where(keys[at] == key, ranks[at], none), made[at]

    sym = symbols[np.frombuffer(b"".join(blobs), np.uint8)]
    owner, size = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs]), np.ones(len(sym), np.int64)
    rank, into = np.full(len(sym), none), np.zeros(len(sym), np.int64)
    if len(sym) > 1:
        rank[:-1], into[:-1] = look_up(sym[:-1], sym[1:])
        rank[:-1][owner[1:] != owner[:-1]] = none
    out: list[tuple[np.ndarray, np.ndarray]] = [(owner[:0], size[:0])]
    while len(sym):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(starts, len(sym)))
        least = np.minimum.reduceat(rank, starts)
        done = least == none
        if done.any():
            gone = np.repeat(done, sizes)
            out.append((owner[gone], size[gone]))
            sym, owner, size, rank, into = (x[~gone] for x in (sym, owner, size, rank, into))
            sizes, least = sizes[~done], least[~done]
            if not len(sym):
                break
        where = np.flatnonzero((rank == np.repeat(least, sizes)) & (rank < none))
        # Of a streak of overlapping places (a a a) the first, third, ... merge.
        fresh = np.append(True, np.diff(where) > 1)
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
        where = where[(np.arange(len(where)) - first) % 2 == 0]
        sym[where] = into[where]
        size[where] += size[where + 1]
        stay = np.ones(len(sym), bool)
        stay[where + 1] = False
        new = (np.cumsum(stay) - 1)[where]
        sym, owner, size, rank, into = (x[stay] for x in (sym, owner, size, rank, into))
        beside = np.unique(np.concatenate([new, np.maximum(new - 1, 0)]))
        last = beside == len(sym) - 1
        following = np.where(last, beside, beside + 1)
        rank[beside], into[beside] = look_up(sym[beside], sym[following])
        rank[beside[last | (owner[beside] != owner[following])]] = none
    owners, lengths = (np.concatenate([o[k] for o in out]) for k in (0, 1))
    order = np.argsort(owners, kind="stable")
    return owners[order], lengths[order]


def count_long(path: str, word: bytes, window: int = WINDOW, step: int = STEP) -> int:
    """Symbols of one long string, merged in windows that overlap.

    Merging a string's part gives the symbols of the whole wherever the merges
    of two neighbours agree on one symbol in their overlap: adjacent symbols that
    come from one merge can stand side by side in any, and a string of symbols
    that all can is the result of merging it. So the left window counts up to
    that symbol and the right one from it on. Where two windows share no symbol,
    windows of twice the size are tried, at last the whole string.
    """
    while True:
        begins = [0] if len(word) <= window else list(range(0, len(word) - (window - step), step))
        owner, size = merged(path, [word[b : b + window] for b in begins])
        if len(begins) == 1:
            return len(size)
        ends = np.cumsum(size)
        firsts = np.searchsorted(owner, np.arange(len(begins)))
        base = np.array(begins) - np.append(0, ends[firsts[1:] - 1])  # from the joined windows to the word
        end = ends + base[owner]
        start = end - size
        # Whole symbols in the overlap with the window before, and with the one after.
        head, tail = np.flatnonzero(end <= owner * step + window - step), np.flatnonzero((start >= (owner + 1) * step) & (owner < len(begins) - 1))
        key = lambda at, pair: (pair * (len(word) + 1) + start[at]) * (window + 1) + size[at]
        head = head[owner[head] > 0]
        both, h, t = np.intersect1d(key(head, owner[head] - 1), key(tail, owner[tail]), return_indices=True)
        pair = both // ((len(word) + 1) * (window + 1))
        pairs, once = np.unique(pair, return_index=True)
        if len(pairs) == len(begins) - 1:
            # Each window but the first counts from the shared symbol on, each but the last up to it.
            return int(len(size) - (head[h[once]] - firsts[1:]).sum() - (np.append(firsts[1:], len(size))[:-1] - tail[t[once]]).sum())
        window, step = 2 * window, 2 * step


def count_by_merging(path: str, words: list[str]) -> np.ndarray:
    """Symbols left of each word after all merges; an empty word has none, a special string is one."""
    blobs = [w.encode() for w in words]
    out = np.array([1 if w == SPECIAL else 0 for w in words], np.int64)
    short = [k for k, b in enumerate(blobs) if b and words[k] != SPECIAL and len(b) <= WINDOW]
    if short:
        owner, _ = merged(path, [blobs[k] for k in short])
        out[short] = np.bincount(owner, minlength=len(short))
    for k, b in enumerate(blobs):
        if len(b) > WINDOW and words[k] != SPECIAL:
            out[k] = count_long(path, b)
    return out
