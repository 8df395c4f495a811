"""Toxicity by noisy-channel deobfuscation.

A character trigram model of the whole corpus is the source; leetspeak, letters spaced apart and repeated
letters are the channel. Spans that may be obfuscated become character lattices, whose best path Viterbi
finds; a logistic regression then scores the words of the restored text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, hash_mod, ship, shipped, texts

#: Rows of each label that the classifier learns from, and words that it knows at most.
SAMPLE, WORDS = 3000, 2000
#: Rows of the sample that a word must be in.
LEAST = 3

#: Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou"}
SEPARATORS = " ._-"
#: Costs of the channel, in nats: a sign read as a letter, a sign or separator dropped, a separator kept, a run shortened.
AS_LETTER, DROP, SEPARATOR_DROP, SEPARATOR_KEEP, SHORTEN = 1.5, 9.0, 0.5, 1.5, 1.0
#: Bytes of spans, their readings and what Python needs to hold them, that a worker remembers.
MEMO, ENTRY = 32 << 20, 200
#: Characters of a span that are decoded together.
PART = 1 << 16

N = 28  # boundary, a to z, any other letter
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = _CLASS > 0
_SIGN = np.isin(np.arange(256), [ord(c) for c in LEET])
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_SEPARATOR = np.isin(np.arange(256), [ord(c) for c in SEPARATORS])
#: Letters as they are in lower case, all else as spaces.
_PLAIN = bytes(int(_LOWER[i]) if _LETTER[i] else 32 for i in range(256))
_ONE = rb"(?:[a-zA-Z0-9@$!|+*]|[\xc2-\xf4][\x80-\xbf]+)"
_CHAIN = re.compile(_ONE + rb"(?:[ ._-]+" + _ONE + rb")*+")
_RUN = re.compile(r"(.)\1*+", re.S)
_TOKEN = re.compile(rb"\S+")
SEGMENT = 1 << 20


def classes(text: bytes) -> np.ndarray:
    """The class of each character, as the lattice reads it: a letter beyond ASCII is one character, whatever its bytes."""
    if text.isascii():
        return _CLASS[np.frombuffer(text, np.uint8)]
    code = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    out = _CLASS[np.minimum(code, 127)]
    other = np.flatnonzero(code > 127)
    found, place = np.unique(code[other], return_inverse=True)
    out[other] = np.array([_class(chr(c)) if chr(c).isalpha() else 0 for c in found.tolist()], np.uint8)[place]
    return out


def trigram_counts(text: bytes) -> np.ndarray:
    """Counts of character triples; text is read as classes, with a boundary at each end."""
    out = np.zeros(N**3, np.int64)
    whole = np.concatenate([np.zeros(1, np.uint8), classes(text), np.zeros(1, np.uint8)])
    for at in range(0, len(whole) - 2, SEGMENT):
        c = whole[at : at + SEGMENT + 2].astype(np.int32)
        out += np.bincount(c[:-2] * (N * N) + c[1:-1] * N + c[2:], minlength=N**3)
    return out


class CharacterModel:
    """An interpolated trigram model: costs[a, b, c] = -ln P(c | a, b)."""

    def __init__(self, counts: np.ndarray, weight: float = 5.0):
        three = counts.reshape(N, N, N).astype(np.float64)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + N)
        p2 = (two + weight * p1) / (two.sum(1, keepdims=True) + weight)
        p3 = (three + weight * p2[None]) / (three.sum(2, keepdims=True) + weight)
        self.costs = (-np.log(p3)).tolist()
        self.seen: dict[bytes, bytes] = {}
        self.held = 0

    def decode(self, span: bytes) -> bytes:
        """The cheapest reading of a span, in lower case; words are parted by spaces."""
        if (found := self.seen.get(span)) is None:
            found = b"".join(viterbi(steps, self.costs).encode() for steps in lattices(span.decode("utf-8", "replace").lower()))
            size = 2 * len(span) + ENTRY
            if self.held + size > MEMO:
                self.seen.clear()
                self.held = 0
            if size <= MEMO:
                self.seen[span] = found
                self.held += size
        return found


def lattices(span: str) -> Iterator[list[list[tuple[str, float]]]]:
    """The lattice of a span; that of a very long one in parts, each decoded alone, so that paths stay small."""
    at = 0
    while at < len(span):
        end = _RUN.match(span, min(at + PART, len(span)) - 1).end()  # not inside a run
        yield lattice(span[at:end])
        at = end


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each run of one character, the strings it may stand for, with the channel's cost."""
    out = []
    for c, run in groupby(span):
        k = sum(1 for _ in run)
        if c.isalpha():
            keep = [(c * k, 0.0)] if k < 3 else [(c * 2, SHORTEN)]
            out.append(keep + [(c, SHORTEN * (1 if k > 2 else 3))] * (k > 1))
        elif c in LEET:
            letters = [(x * n, AS_LETTER * n) for x in LEET[c] for n in range(1, min(k, 2) + 1)]
            out.append([*letters, ("", DROP), (" ", DROP)])
        elif c in SEPARATORS:
            out.append([("", SEPARATOR_DROP), (" ", SEPARATOR_KEEP)])
        else:
            out.append([(" ", 0.0)])
    return out


def _class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27


def viterbi(steps: list[list[tuple[str, float]]], costs: list) -> str:
    """The best path: a state is the classes of the last two characters, paths share their beginnings."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in steps:
        nxt: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (total, path) in best.items():
            for string, channel in options:
                x, y, cost = a, b, total + channel
                for c in string:
                    z = _class(c)
                    if z or y:  # boundaries don't follow each other
                        cost += costs[x][y][z]
                        x, y = y, z
                if (x, y) not in nxt or cost < nxt[x, y][0]:
                    nxt[x, y] = (cost, (string, path))
        best = nxt
    _, path = min((total + (costs[a][b][0] if b else 0), path) for (a, b), (total, path) in ((s, (v[0], _Path(v[1]))) for s, v in best.items()))
    out, node = [], path.node
    while node:
        out.append(node[0])
        node = node[1]
    return "".join(reversed(out)).strip()


class _Path:
    """Keeps min() from comparing paths: ties go to the first."""

    def __init__(self, node: tuple | None):
        self.node = node

    def __lt__(self, other: object) -> bool:
        return False


def spaced_end(text: bytes, i: int) -> tuple[int, int]:
    """(end, end of the chain): where single characters spaced apart from i on end before a space, a stop or the end, at the second or later; i if nowhere.

    No other end of the chain is looked at twice: what begins further on in it ends there too or nowhere.
    """
    m = _CHAIN.match(text, i)
    if not m:
        return i, i
    j = m.end()
    while True:
        k = j - 1
        while text[k] & 0xC0 == 0x80:
            k -= 1
        if k <= i:
            return i, m.end()
        if j == len(text) or text[j] in b" \t\n\r\x0b\x0c.,;:!?":
            return j, m.end()
        while text[k - 1] in b" ._-":
            k -= 1
        j = k


def suspects(text: bytes) -> list[tuple[int, int]]:
    """All spans that a lattice can rewrite, in order, apart from each other: tokens with a sign beside a letter or
    sign, a mark inside or a letter twice, and single characters spaced apart by any number of separators."""
    if not text:
        return []
    b = _LOWER[np.frombuffer(b" " + text + b"  ", np.uint8)]
    letter, sign, space, mark = _LETTER[b], _SIGN[b], _SPACE[b], _SEPARATOR[b]
    some = letter | sign
    n = len(text)
    at = lambda x, k: x[k + 1 : k + 1 + n]
    hits = at(letter, 0) & (at(b, 0) == at(b, 1)) & (at(b, 0) < 128)
    # Other letters have several bytes and cases; any two of them in a row count as a letter twice.
    hits |= (at(b, 0) >= 128) & (at(b, 1) >= 192)
    hits |= (at(sign, 0) & at(some, 1)) | (at(some, 0) & at(sign, 1))
    hits |= at(some, -1) & at(mark, 0) & ~at(space, 0) & ~at(space, 1)
    spaced = at(space, -1) & ~at(space, 0) & (at(mark, 1) | (at(b, 0) >= 192))
    out, end, tried = [], 0, 0
    for i in np.flatnonzero(hits | spaced).tolist():
        if i < end:
            continue
        s = e = i
        if spaced[i] and i >= tried:
            e, tried = spaced_end(text, i)
        if e == i:
            while s > end and text[s - 1] not in b" \t\n\r\x0b\x0c":
                s -= 1
            e = _TOKEN.match(text, s).end()
        out.append((s, e))
        end = e
    return out


_BEFORE, _AFTER = b"\"'([", b"\"')].,;:?!"
_MARK = ~_SPACE & ~np.isin(np.arange(256), [ord(c) for c in "0123456789_abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])


def trimmed(token: bytes) -> bytes:
    """Without brackets, quotes and stops at its ends, and without a mark at its end that is there three times or more."""
    token = token.lstrip(_BEFORE)
    while token:
        less = token.rstrip(_AFTER)
        if less and _MARK[less[-1]]:
            shorter = less.rstrip(less[-1:])
            if len(less) - len(shorter) > 2:
                less = shorter
        if len(less) == len(token):
            break
        token = less
    return token


def restore(text: bytes, model: CharacterModel) -> bytes:
    """The text with its suspect spans decoded, marks at their ends first taken off.

    A span stays beside its reading: a plain word that a lattice misreads (a name, a word of another language) still counts.
    """
    spans = suspects(text)
    if not spans:
        return text
    out, end = [], 0
    for s, e in spans:
        core = trimmed(text[s:e])
        out += [text[end:s], model.decode(core), b" ", core, b" "]
        end = e
    return b"".join([*out, text[end:]])


#: Bytes of a word's beginnings that count as features of their own.
BEGINNINGS = (4, 6)


def words(text: bytes) -> set[bytes]:
    """Distinct words of ASCII and other letters, lower-cased A to Z, and the beginnings of longer ones with a mark."""
    found = set(text.translate(_PLAIN).split())
    return found.union(*({b"^" + w[:k] for w in found if len(w) > k} for k in BEGINNINGS))


class Classifier:
    """Logistic regression on which of its words a restored text has."""

    def __init__(self, known: list[bytes], weights: np.ndarray, bias: float):
        self.weights = dict(zip(known, weights.tolist(), strict=True))
        self.known = set(known)
        self.bias = bias

    def score(self, found: set[bytes]) -> float:
        z = self.bias + sum(self.weights[w] for w in sorted(found & self.known))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def train_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.005, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient descent on the mean log loss, classes counting alike."""
    n = len(y)
    share = (np.where(y == 1, n / (2 * max(1, (y == 1).sum())), n / (2 * max(1, (y == 0).sum()))) / n).astype(np.float32)
    y = y.astype(np.float32)
    w, bias = np.zeros(x.shape[1], np.float32), np.float32(0)
    # The curvature is at most a quarter of the largest eigenvalue of the weighted second moments.
    v = np.ones(x.shape[1] + 1, np.float32)
    for _ in range(20):
        u = share * (x @ v[:-1] + v[-1])
        v = np.append(x.T @ u, u.sum())
        size = np.linalg.norm(v) or 1.0
        v /= size
    step = np.float32(1 / (size / 4 + ridge))
    seen_w, seen_b = w, bias
    for k in range(rounds):
        ahead = np.float32(k / (k + 3))
        at_w, at_b = w + ahead * (w - seen_w), bias + ahead * (bias - seen_b)
        off = share * (1 / (1 + np.exp(-np.clip(x @ at_w + at_b, -50, 50))) - y)
        seen_w, seen_b = w, bias
        w, bias = at_w - step * (x.T @ off + np.float32(ridge) * at_w), at_b - step * off.sum()
    return w.astype(np.float64), float(bias)


def character_model(docs: DataFrame) -> CharacterModel:
    """The trigram model of all texts; partitions count, at most N**3 sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, np.int64)
        for batch in batches:
            held: list[bytes] = []
            size = 0
            for t in texts(batch.column(0)):
                held.append(t)
                size += len(t)
                if size >= SEGMENT:
                    total += trigram_counts(b"  ".join(held))
                    held, size = [], 0
            total += trigram_counts(b"  ".join(held))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    sums = docs.select("text").where("text is not null").mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    counts = np.zeros(N**3, np.int64)
    for at, n in sums.collect():
        counts[at] = n
    return CharacterModel(counts)


def train(docs: DataFrame, labels: DataFrame, learn: Column, characters: CharacterModel, sample: int = SAMPLE) -> Classifier:
    """Fit on up to `sample` rows of each label, among rows of docs (doc_id, text) where learn holds.

    labels: (doc_id, toxic), 0 or 1; others, and null ids and texts, teach nothing. The base rate comes
    from all labels of such rows. Without both labels, all scores are the base rate.
    """
    from .language_id import sampled_ids

    spark = docs.sparkSession
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.where(learn & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    slim = cut(rows.select("doc_id").distinct().join(marked, "doc_id"), "labelled")
    totals = dict(slim.groupBy("toxic").count().collect())
    if len(totals) < 2:
        rate = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
        return Classifier([], np.zeros(0), float(np.log(rate / (1 - rate))))
    ids = sampled_ids(slim, "toxic", sample)
    model = ship(spark, characters)

    @F.arrow_udf("array<binary>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shipped(model)
        for arr in batches:
            yield pa.array([sorted(words(restore(t, own))) for t in texts(arr)], pa.list_(pa.binary()))

    picked = rows.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min("text").alias("text"))
    picked = cut(picked.join(F.broadcast(slim.where(F.col("doc_id").isin(ids))), "doc_id").select("doc_id", "toxic", read("text").alias("words")), "sample")
    each = picked.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("one"), F.count(F.lit(1)).alias("n"))
    n1, n0 = (picked.where(f"toxic = {k}").count() for k in (1, 0))
    odds = F.abs(F.log((F.col("one") + 0.5) / (n1 + 1.0)) - F.log((F.col("n") - F.col("one") + 0.5) / (n0 + 1.0)))
    rank = odds * F.sqrt(F.col("n"))
    known = sorted(bytes(r[0]) for r in each.where(F.col("n") >= LEAST).orderBy(rank.desc(), "word").limit(WORDS).select("word").collect())
    table = spark.createDataFrame([(bytearray(w), i) for i, w in enumerate(known)], "word binary, place int")
    places = picked.select("doc_id", F.explode("words").alias("word")).join(F.broadcast(table), "word").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    found = sorted(picked.select("doc_id", "toxic").join(places, "doc_id", "left").collect(), key=lambda r: r.doc_id)
    x, y = np.zeros((len(found), len(known)), np.float32), np.array([r.toxic for r in found])
    for i, r in enumerate(found):
        x[i, r.places or []] = 1
    share = totals[1] / sum(totals.values())
    prior = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    # Thirds of the sample calibrate what the other thirds have learned; the weights learn from all.
    part, z = np.arange(len(y)) % 3, np.zeros(len(y))
    for k in range(3):
        w, bias = train_logistic(x[part != k], y[part != k])
        z[part == k] = x[part == k] @ w + bias
    slope, shift = calibrated(z, y, prior)
    w, bias = train_logistic(x, y)
    return Classifier(known, slope * w, slope * bias + shift)


def calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of margins by Newton's steps on the weighted log loss."""
    a = np.stack([z, np.ones(len(z))], 1)
    t = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ t, -30, 30)))
        g = a.T @ (weight * (p - y)) + 1e-4 * (t - [1, 0])
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-4 * np.eye(2)
        move = np.linalg.solve(h, g)
        t = t - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return max(float(t[0]), 1e-3), float(t[1])


def score_udf(both):
    """both: a broadcast of (CharacterModel, Classifier)."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        characters, classifier = shipped(both)
        for arr in batches:
            yield pa.array([classifier.score(words(restore(t, characters))) for t in texts(arr)], pa.float64())

    return score


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text), null texts as empty.

    Rows whose crc32(doc_id) mod 5 is 0 are held out of training. Repeated rows are each scored; of
    contradicting labels of an id, 1 holds. An empty table gives no rows; other columns aren't read.
    """
    rows = docs.select("doc_id", "text")
    held = hash_mod("doc_id", 5) == 0
    characters = character_model(rows)
    classifier = train(rows, labels.select("doc_id", "toxic"), ~held, characters, sample)
    score = score_udf(ship(docs.sparkSession, (characters, classifier)))(F.coalesce(F.col("text"), F.lit("")))
    return rows.select("doc_id", held.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
