"""Benchmark decontamination by SimHash of item-sized windows.

Each benchmark item is a bag of word shingles with a SimHash fingerprint. Windows of an item's length
slide over every document, one word at a time, and are fingerprinted: the sums of their shingles' bits roll
on from one size to the next. A multi-index over blocks of the items' fingerprints finds all items within
the radius of a window's, and exact weighted-shingle similarity verifies them. Only windows without a single
shingle of the benchmark, which are like no item at all, are passed over.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, own_columns, ship, shipped, texts

WIDTH = 5
SIMILARITY = 0.8
#: Bits in which the fingerprints of a window and an item may differ: of four blocks of sixteen bits, one differs
#: by at most BLOCK_RADIUS bits if all together differ by at most RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1.
BLOCKS, BLOCK_RADIUS = 4, 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Items that one pass over the documents looks for; more items take more passes, one after the other.
ITEMS = 500
#: Code points of a document that are cut into words at once, and words that are searched at once.
SEGMENT, WORDS = 1 << 20, 1 << 17
#: Windows whose sums are held at once: a few arrays of this length stay in a processor's cache.
ROW = 4096
#: Words whose hashes a worker remembers.
MEMO = 200_000

_WORD = re.compile(r"\w+")
_MASKS = np.array([m for m in range(1 << 16) if m.bit_count() <= BLOCK_RADIUS], np.int64)


def _odd(k: int) -> np.uint64:
    return np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))


def words(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall(text.lower())


def shingles(items: list, width: int = WIDTH) -> list[tuple]:
    """All runs of `width` items; the whole list if it is shorter, none if it is empty."""
    return [tuple(items[i : i + width]) for i in range(max(1, len(items) - width + 1))] if items else []


def similarity(left: Counter, right: Counter) -> float:
    """Weighted Jaccard: the shared weight over the joint weight; a shingle's weight is its count."""
    shared = sum(min(n, right[s]) for s, n in left.items() if s in right)
    joint = left.total() + right.total() - shared
    return shared / joint if joint else 0.0


def _rolled(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` values; of all of them if there are fewer."""
    n = max(1, len(values) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(values))):
        out += values[k : k + n] * _odd(k)
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


class Hashes(dict):
    """The hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


class Numbers(dict):
    """Numbers of the benchmark's words; 0 for all others."""

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.get, ws, repeat(0)), np.uint64, len(ws))


def simhash(ws: list[str], width: int = WIDTH) -> int:
    """The fingerprint of a window of words: a bit is 1 if set in over half of its shingles' hashes."""
    if not ws:
        return 0
    bits = np.unpackbits(_rolled(Hashes().of(ws), width).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(bits), bitorder="little").view(np.uint64)[0])


class Sums:
    """How many hashes of a window have each bit set, for a row of windows at once.

    planes[k] holds bit k of the 64 counts of each window, so that one operation on 64-bit integers moves all
    counts of a window. A window of n hashes grows by those after it, a power of two at a time.
    """

    def __init__(self, hashes: np.ndarray, starts: int):
        self.starts, self.size = starts, 0
        self.runs = [[hashes]]  # sums of 1, 2, 4, ... hashes from each place
        self.planes: list[np.ndarray] = []

    def _run(self, k: int) -> list[np.ndarray]:
        while len(self.runs) <= k:
            last, n = self.runs[-1], 1 << (len(self.runs) - 1)
            self.runs.append(_added([p[:-n] for p in last], [p[n:] for p in last]))
        return self.runs[k]

    def grow(self, size: int) -> None:
        """Make the windows `size` hashes long."""
        while self.size < size:
            k = (size - self.size).bit_length() - 1
            more = [p[self.size : self.size + self.starts] for p in self._run(k)]
            self.planes = _added(self.planes, more)
            self.size += 1 << k

    def prints(self) -> np.ndarray:
        """The windows' fingerprints: which counts are over half of the size."""
        least = self.size // 2 + 1
        over, equal = np.zeros(self.starts, np.uint64), np.full(self.starts, ~np.uint64(0))
        for k in range(max(len(self.planes), least.bit_length()) - 1, -1, -1):
            plane = self.planes[k] if k < len(self.planes) else np.zeros(self.starts, np.uint64)
            if least >> k & 1:
                equal &= plane
            else:
                over |= equal & plane
                equal &= ~plane
        return over | equal


def _added(left: list[np.ndarray], right: list[np.ndarray]) -> list[np.ndarray]:
    """The sums of counts held as planes."""
    if len(left) < len(right):
        left, right = right, left
    out, carry = [], None
    for k, a in enumerate(left):
        if k < len(right):
            b = right[k]
            half = a ^ b
            if carry is None:
                out.append(half)
                carry = a & b
            else:
                out.append(half ^ carry)
                half &= carry
                carry = (a & b) | half
        elif carry is None:
            out.append(a)
        else:
            out.append(a ^ carry)
            carry = a & carry
    return out if carry is None else [*out, carry]


class Index:
    """The items of one size: of each block's values, which items have theirs within BLOCK_RADIUS bits, as a mask."""

    def __init__(self, items: list[int], prints: np.ndarray):
        self.items, self.prints = np.array(items), prints
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(items) <= np.iinfo(t).bits)
        self.tables = [np.zeros(1 << 16, kind) for _ in range(BLOCKS)]
        for j, p in enumerate(prints.tolist()):
            for b, table in enumerate(self.tables):
                table[(p >> (16 * b) & 0xFFFF) ^ _MASKS] |= kind(1 << j)

    def near(self, prints: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, places, bits that differ) of the fingerprints within the radius, for each item that has some."""
        found = self.tables[0][(prints & np.uint64(0xFFFF)).view(np.int64)]
        for b in range(1, BLOCKS):
            found |= self.tables[b][(prints >> np.uint64(16 * b) & np.uint64(0xFFFF)).view(np.int64)]
        some = np.flatnonzero(found)
        if not len(some):
            return
        masks, own = found[some], prints[some]
        for j, p in enumerate(self.prints):
            at = np.flatnonzero(masks & masks.dtype.type(1 << j))
            bits = np.bitwise_count(own[at] ^ p)
            within = bits <= radius
            if within.any():
                yield int(self.items[j]), some[at[within]], bits[within]


class Items:
    """Benchmark items with their bags of shingles and fingerprints, and an index for each size."""

    def __init__(self, rows: list[tuple[object, str]], width: int = WIDTH, radius: int = RADIUS):
        assert radius <= RADIUS, "the multi-index guarantees no such radius"
        self.width, self.radius = width, radius
        kept = [(i, ws) for i, t in rows if t and (ws := words(t))]
        self.ids = [i for i, _ in kept]
        self.sizes = [len(ws) for _, ws in kept]
        self.bags = [Counter(shingles(ws, width)) for _, ws in kept]
        self.prints = np.array([simhash(ws, width) for _, ws in kept], np.uint64)
        self.vocabulary = Numbers((w, k) for k, w in enumerate(dict.fromkeys(w for _, ws in kept for w in ws), 1))
        # The items' shingles as hashes of word numbers; items shorter than a shingle are runs of their own length.
        known: dict[int, set[int]] = {}
        for _, ws in kept:
            run = min(width, len(ws))
            known.setdefault(run, set()).update(_rolled(self.vocabulary.of(ws), run).tolist())
        self.known = {run: np.array(sorted(hs), np.uint64) for run, hs in known.items()}
        self.index: dict[int, list[Index]] = {}

    def prepare(self) -> Items:
        """Build the indexes; done by each task, as they are larger than the items."""
        self.hashes = Hashes()
        by_size: dict[int, list[int]] = {}
        for k, n in enumerate(self.sizes):
            by_size.setdefault(n, []).append(k)
        self.index = {n: [Index(ks[at : at + 64], self.prints[ks[at : at + 64]]) for at in range(0, len(ks), 64)] for n, ks in sorted(by_size.items())}
        return self

    def within(self, window_print: int, size: int) -> list[tuple[int, int]]:
        """(item, bits that differ) of all items of a size within the radius."""
        one = np.array([window_print], np.uint64)
        return [(k, int(bits[0])) for index in self.index.get(size, ()) for k, _, bits in index.near(one, self.radius)]

    def matches(self, batch: list[str], threshold: float = SIMILARITY) -> list[list[tuple[object, int, int, float]]]:
        """For each text, (item_id, first word of the window, bits, similarity) of the best window for each item found."""
        best: list[dict[int, tuple[float, int, int]]] = [{} for _ in batch]
        for parts in _packed(batch, max(self.sizes, default=1)):
            for text, at, k, bits, s in self._in_parts(self._near_shingles(parts), threshold):
                if k not in best[text] or (s, -at) > (best[text][k][0], -best[text][k][1]):
                    best[text][k] = (s, at, bits)
        return [[(self.ids[k], at, bits, s) for k, (s, at, bits) in sorted(b.items())] for b in best]

    def _near_shingles(self, parts: list[tuple[int, int, bool, list[str]]]) -> list[tuple[int, int, bool, list[str]]]:
        """The stretches of parts that hold all windows with a shingle of the benchmark."""
        ws = list(chain.from_iterable(part for _, _, _, part in parts))
        numbers, longest = self.vocabulary.of(ws), max(self.sizes, default=0)
        change = np.zeros(len(ws) + 1, np.int64)
        others = np.concatenate([[0], np.cumsum(numbers == 0)])
        for run, known in self.known.items():
            if len(ws) < run:
                continue
            places = np.flatnonzero(others[run:] == others[:-run])
            hashes = _rolled(numbers[(places[:, None] + np.arange(run)).reshape(-1)], run)[::run] if len(places) else np.zeros(0, np.uint64)
            hits = places[known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes]
            np.add.at(change, np.maximum(hits + run - longest, 0), 1)
            np.add.at(change, np.minimum(hits + longest, len(ws)), -1)
        near, out, start = np.cumsum(change[:-1]) > 0, [], 0
        for text, before, whole, part in parts:
            own = near[start : start + len(part)]
            if whole and own.all():
                out += [(text, before, True, part)] * bool(part)
            elif own.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
                out += [(text, before + a, False, part[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True)]
            start += len(part)
        return out

    def _in_parts(self, parts: list[tuple[int, int, bool, list[str]]], threshold: float) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, first word, item, bits, similarity) of windows in parts (text, words before, whether it is the whole text, words)."""
        ws = list(chain.from_iterable(part for _, _, _, part in parts))
        starts = np.cumsum([0, *(len(part) for _, _, _, part in parts)])
        for length, at, k, bits in self._candidates(ws):
            p = int(np.searchsorted(starts, at, "right")) - 1
            if at + length <= starts[p + 1]:  # windows that run over into the next part are none
                s = similarity(Counter(shingles(ws[at : at + length], self.width)), self.bags[k])
                if s >= threshold:
                    yield parts[p][0], parts[p][1] + at - int(starts[p]), k, bits, s
        for text, _, whole, part in parts:
            if not whole or not part or len(part) >= max(self.sizes, default=0):
                continue
            # A text shorter than an item is one window; one with too few shingles can't be similar.
            n_shingles = max(1, len(part) - self.width + 1)
            longer = [n for n in self.index if n > len(part) and n_shingles >= threshold * max(1, n - self.width + 1) - 1e-9]
            if longer:
                own, bag = simhash(part, self.width), Counter(shingles(part, self.width))
                for n in longer:
                    for k, bits in self.within(own, n):
                        if (s := similarity(bag, self.bags[k])) >= threshold:
                            yield text, 0, k, bits, s

    def _candidates(self, ws: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(words of the window, its place, item, bits that differ) of all windows within the radius of an item of their size."""
        hashes = self.hashes.of(ws)
        for run in sorted({min(self.width, n) for n in self.index}):
            rolled = _rolled(hashes, run)
            sizes = [n for n in self.index if min(self.width, n) == run and n <= len(ws)]
            for low in range(0, len(rolled) if sizes else 0, ROW):
                sums = Sums(rolled[low : low + ROW + sizes[-1] - run], 0)
                for n in sizes:
                    starts = min(ROW, len(ws) - n + 1 - low)
                    if starts <= 0:
                        break
                    if sums.starts != starts:
                        sums.starts = starts
                        sums.planes = [p[:starts] for p in sums.planes]
                    sums.grow(n - run + 1)
                    prints = sums.prints()
                    for index in self.index[n]:
                        for k, places, bits in index.near(prints, self.radius):
                            for at, d in zip(places.tolist(), bits.tolist(), strict=True):
                                yield n, low + at, k, d


def _packed(batch: list[str], overlap: int) -> Iterator[list[tuple[int, int, bool, list[str]]]]:
    """The texts' words in packs of at least WORDS: parts (text, words before, whether it is the whole text, words)."""
    pack, held = [], 0
    for i, text in enumerate(batch):
        for before, whole, ws in _segments(text, overlap):
            pack.append((i, before, whole, ws))
            held += len(ws)
            if held >= WORDS:
                yield pack
                pack, held = [], 0
    if pack:
        yield pack


def _segments(text: str, overlap: int) -> Iterator[tuple[int, bool, list[str]]]:
    """(number of words before, whether it is all, words) of a text; neighbours share overlap - 1 words, so no window is lost."""
    if len(text) <= SEGMENT:
        yield 0, True, words(text)
        return
    before, kept, at = 0, [], 0
    while at < len(text):
        end = min(at + SEGMENT, len(text))
        while end < len(text) and (text[end - 1].isalnum() or text[end - 1] == "_"):
            end += 1
        ws = kept + words(text[at:end])
        yield before, at == 0 and end == len(text), ws
        keep = min(len(ws), overlap - 1)
        before, kept, at = before + len(ws) - keep, ws[len(ws) - keep :], end


def matches_udf(items, threshold: float, item_type):
    """items: a broadcast of Items; item_type: the Spark type of their ids."""
    ids = to_arrow_type(item_type)
    found = pa.list_(pa.struct([("item_id", ids), ("window_start", pa.int32()), ("bits", pa.int32()), ("similarity", pa.float64())]))

    @F.arrow_udf(f"array<struct<item_id:{item_type.simpleString()},window_start:int,bits:int,similarity:double>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shipped(items).prepare()
        names = ("item_id", "window_start", "bits", "similarity")
        for arr in batches:
            # Bytes that aren't UTF-8 are read as replacement characters, which are no part of a word.
            rows = own.matches([t.decode("utf-8", "replace") for t in texts(arr)], threshold)
            yield pa.array([[dict(zip(names, m, strict=True)) for m in ms] for ms in rows], found)

    return find


def passes(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The distinct items of benchmark (item_id, text), about ITEMS at a time; of like lengths, so that a pass has few sizes of windows."""
    items = own_columns(benchmark, item_id=F.col("item_id"), text=F.col("text")).where("text is not null").distinct()
    n = items.count()
    if n <= ITEMS:
        yield [tuple(r) for r in items.collect()]
        return
    items = cut(items, "items")
    n_ranges = -(-n // ITEMS)
    bounds = items.select(F.percentile_approx(F.length("text"), [k / n_ranges for k in range(1, n_ranges)], 100_000)).first()[0]
    edges = [-1, *sorted(set(bounds)), 1 << 31]
    for low, high in zip(edges, edges[1:]):
        part = items.where((F.length("text") > low) & (F.length("text") <= high))
        n_parts = -(-part.count() // ITEMS)
        for k in range(n_parts):
            yield [tuple(r) for r in part.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)) == k).collect()]


def _searches(docs: DataFrame, benchmark: DataFrame, width: int, threshold: float, radius: int) -> Iterator[Column]:
    """For each pass, a column of docs (text): the matches with its items."""
    kind = benchmark.schema["item_id"].dataType
    for rows in passes(benchmark):
        yield matches_udf(ship(docs.sparkSession, Items(rows, width, radius)), threshold, kind)(F.coalesce(F.col("text"), F.lit("")))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, window_start, bits, similarity: the best window of a document for each item it holds.

    docs: (doc_id, text), benchmark: (item_id, text). window_start counts words. A document shorter than an
    item is one window. Null and empty texts and items hold nothing; repeated documents are each
    returned, of repeated items one; ties go to the first window. Empty tables give no rows; other
    columns aren't read. One pass at a time reads the documents, with about ITEMS items in each worker.
    """
    docs, out = own_columns(docs, doc_id=F.col("doc_id"), text=F.col("text")), None
    for found in _searches(docs, benchmark, width, threshold, radius):
        rows = docs.select("doc_id", found.alias("found")).select("doc_id", F.inline("found"))
        out = rows if out is None else cut(out, "found").unionByName(cut(rows, "found"))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns."""
    clean = None
    for found in _searches(docs, benchmark, width, threshold, radius):
        clean = (docs if clean is None else cut(clean, "clean")).where(F.size(found) == 0)
    return clean
