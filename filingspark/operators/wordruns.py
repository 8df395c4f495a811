"""Words of texts and hashes of runs of them, found in the bytes of many texts at once."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Neighbouring hashes of which the least is an anchor: every run of so many that two texts share gives them one in common.
SPAN = 64
#: Bytes of texts that are read at once; a longer text is read alone.
CHUNK = 1 << 20
#: Letters and digits in lower case, all else a space.
FOLD = np.array([ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _placed(code: np.ndarray) -> np.ndarray:
    return _mixed((code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


#: A number for each byte at each of the first places of a word.
PLACES = 64
PLACED = _placed(np.arange(PLACES * 256))


def _hashes(kept: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each word, with the space after it, the mixed sum of what its bytes stand for at their places."""
    place = np.arange(len(kept)) - np.repeat(starts, sizes)
    code = place * 256 + kept
    far = np.flatnonzero(place >= PLACES)
    code[far] %= len(PLACED)
    value = PLACED[code]
    value[far] = _placed(place[far] * 256 + kept[far])
    return _mixed(np.add.reduceat(value, starts))


def _runs(each: np.ndarray, width: int) -> np.ndarray:
    """A polynomial over the words of each run, mixed."""
    total = np.zeros(max(len(each) - width + 1, 0), np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[i : i + len(total)]
    return _mixed(total).view(np.int64)


def _least(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least of each SPAN neighbouring hashes (of all, if there are fewer), each once: of all, and of all but the first and the last."""

    def few(part: np.ndarray) -> np.ndarray:
        return part.min(keepdims=True) if len(part) else part

    if len(h) < SPAN:
        return few(h), few(h[1:-1])
    low, k = h, 1
    while k < SPAN:
        low, k = np.minimum(low[:-k], low[k:]), 2 * k
    return np.unique(low), np.unique(low[1:-1]) if len(low) > 2 else few(h[1:-1])


def _read(raw: list[bytes], width: int, least: int, cap: int | None) -> list[tuple]:
    low = FOLD[np.frombuffer(b" ".join([*raw, b""]), np.uint8)]
    word = low != 32
    after = np.concatenate(([False], word[:-1]))
    kept = low[word | after]
    ends = np.flatnonzero(kept == 32) + 1
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    each = _hashes(kept, starts, ends - starts) if len(ends) else np.zeros(0, np.uint64)
    runs = _runs(each, width)
    words = np.concatenate(([0], np.cumsum(word & ~after)))[np.cumsum([0] + [len(r) + 1 for r in raw])]
    text, at, out = kept.tobytes(), np.concatenate(([0], ends)), []
    for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
        plain = text[at[a] : at[b] - 1] if b > a else b""
        if b - a < least:
            out.append((b - a, plain, None, None, None))
            continue
        h = runs[a : max(b - width + 1, a)]
        step = max(1, -(-len(h) // cap)) if cap else 1
        out.append((b - a, plain, np.unique(h[::step]), *_least(h)))
    return out


def _lists(parts: list[np.ndarray | None]) -> pa.Array:
    ends = np.cumsum([0] + [0 if p is None else len(p) for p in parts]).astype(np.int32)
    values = [p for p in parts if p is not None]
    mask = pa.array([p is None for p in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else [], pa.int64()), mask=mask)


def read(text: Column, width: int, least: int, cap: int | None = None) -> Column:
    """Struct of n_tokens, normalized (the tokens, parted by one space) and, of at least `least` tokens, shingles, whole and inner; else null.

    Tokens are those of dedup.tokens(). Shingles: hashes of all runs of `width` tokens, or, with cap, of those at a stride
    that keeps them at about `cap`; each once. whole: anchors, the least hash of each SPAN neighbouring runs (of all, if
    there are fewer); inner: those of all runs but the first and the last.
    """

    @F.arrow_udf("struct<n_tokens:int,normalized:string,shingles:array<bigint>,whole:array<bigint>,inner:array<bigint>>")
    def found(arr: pa.Array) -> pa.Array:
        out, chunk, size = [], [], 0
        for t in arr.to_pylist():
            t = t or ""
            chunk.append((t if t.isascii() else unicodedata.normalize("NFKC", t).lower()).encode())
            size += len(chunk[-1])
            if size >= CHUNK:
                out += _read(chunk, width, least, cap)
                chunk, size = [], 0
        if chunk:
            out += _read(chunk, width, least, cap)
        n, plain, *lists = zip(*out, strict=True) if out else ([],) * 5
        fields = [pa.array(n, pa.int32()), pa.array(plain, pa.binary()).cast(pa.string()), *map(_lists, lists)]
        return pa.StructArray.from_arrays(fields, names=["n_tokens", "normalized", "shingles", "whole", "inner"])

    return found(text)
