"""Language-model scores by a hidden Markov model over word classes.

The most frequent words are classes of their own, all other words fall into hashed classes; inside a class
a word has its smoothed share of the class's training count. Latent states emit classes. Baum-Welch counts
are summed over the partitions of all training documents in each round, until a round gains little; the
scaled forward recursion gives the exact likelihood of each whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hash_mod, own_columns, ship, shipped, texts

STATES = 6
#: Words with a class of their own, or twice the root of the number of distinct words if that is more; and hashed classes for the rest.
OWN, HASHED = 4000, 1000
#: Words whose counts every Python worker holds at most; the counts of all others come by a shuffle join.
HELD = 150_000
#: Rounds of Baum-Welch end when one raises the mean log likelihood of a training token by less than this; there are at most ROUNDS.
GAIN, ROUNDS = 0.004, 40
#: Distinct words that a task counts before it passes them on.
FLUSH = 200_000
#: Tokens of a sequence that are worked on side by side with others; the parts' ends are joined exactly.
PART = 512
#: Parts that are worked on at once.
PARTS = 1000
#: Classes, the most frequent ones, that tell how a class is followed, for first values.
FOLLOWING = 16
SEED = 11


def tokens(text: bytes) -> list[bytes]:
    """Words of ASCII-lower-cased text, parted by ASCII white space."""
    return text.lower().split()


@dataclass
class Vocabulary:
    """held: place of each held word, most frequent first; counts: theirs; n_own: those with a class of their own."""

    held: dict[bytes, int]
    counts: np.ndarray
    n_own: int
    hashed: int

    @property
    def n_classes(self) -> int:
        return self.n_own + self.hashed + 1

    @property
    def kind(self) -> type:
        """The narrowest type of class numbers."""
        return np.uint16 if self.n_classes <= 1 << 16 else np.uint32

    def read(self, text: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Classes of the tokens, the last of them being the end; places of held words; the other words."""
        words = tokens(text)
        get = self.held.get
        places = np.array([get(w, -1) for w in words], np.int64)
        rest = [words[i] for i in np.flatnonzero(places < 0).tolist()]
        classes = np.empty(len(words) + 1, self.kind)
        classes[:-1] = self.class_of[places]
        if rest:
            classes[np.flatnonzero(places < 0)] = [self.n_own + zlib.crc32(w) % self.hashed for w in rest]
        classes[-1] = self.n_classes - 1
        return classes, places[places >= 0], rest

    def prepare(self) -> Vocabulary:
        own = np.arange(len(self.held), dtype=np.int64)
        for w, k in self.held.items():
            if k >= self.n_own:
                own[k] = self.n_own + zlib.crc32(w) % self.hashed
        self.class_of = np.append(own, 0).astype(self.kind)  # the last is read at -1 and then replaced
        return self


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes by states

    def log_likelihood(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Natural logs of the sequences' probabilities, by the scaled forward recursion."""
        out = np.zeros(len(sequences))
        order = np.argsort([-len(s) for s in sequences], kind="stable")
        lengths = np.array([len(sequences[i]) for i in order])
        total = np.zeros(len(order))
        state = np.zeros((0, len(self.start)))
        # Columns of a block of steps at once: memory stays bounded for very long texts.
        for t, n, classes in _steps([sequences[i] for i in order], lengths):
            state = (np.broadcast_to(self.start, (n, len(self.start))) if t == 0 else state[:n] @ self.move) * self.emit[classes]
            scale = state.sum(1)
            total[:n] += np.log(scale)
            state /= scale[:, None]
        out[order] = total
        return out

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions of whole sequences, and their log likelihood.

        Long sequences are worked on in parts side by side. What is known at a part's ends from the rest of its
        sequence, the state before it and what follows it, comes first, by products of the parts' matrices.
        """
        k = len(self.start)
        parts = [s[at : at + PART] for s in sequences for at in range(0, len(s), PART)]
        first = np.array([at == 0 for s in sequences for at in range(0, len(s), PART)], bool)
        before, after = self._ends(parts, first)
        starts, moves, emits, total = np.zeros(k), np.zeros((k, k)), np.zeros((len(self.emit), k)), 0.0
        order = np.argsort([-len(p) for p in parts], kind="stable")
        for at in range(0, len(order), PARTS):
            some = order[at : at + PARTS]
            found = self._counts([parts[i] for i in some], first[some], before[some], after[some])
            starts, moves, emits, total = starts + found[0], moves + found[1], emits + found[2], total + found[3]
        return starts, moves * self.move, emits, total

    def _ends(self, parts: list[np.ndarray], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each part, the distribution of the state before it (of no use to first ones), and the likelihood of what follows by state, scaled."""
        n, k = len(parts), len(self.start)
        before, after = np.zeros((n, k)), np.ones((n, k))
        more = ~np.append(first[1:], True) if n else first  # whose sequence goes on
        matrix = np.zeros((n, k, k))
        inner = np.flatnonzero(~first)
        matrix[inner] = self._matrices([parts[i] for i in inner], None)
        heads = np.flatnonzero(first & more)
        ends = np.zeros((n, k))
        ends[heads] = self._matrices([parts[i] for i in heads], self.start)[:, 0]
        for i in inner.tolist():
            before[i] = ends[i - 1] / ends[i - 1].sum()
            ends[i] = before[i] @ matrix[i]
        for i in inner[::-1].tolist():
            follows = matrix[i] @ after[i]
            after[i - 1] = follows / follows.sum()
        return before, after

    def _matrices(self, parts: list[np.ndarray], start: np.ndarray | None) -> np.ndarray:
        """Scaled products of the matrices (move, then emit) of parts, or of a start that emits first."""
        k = len(self.start)
        out = np.zeros((len(parts), 1 if start is not None else k, k))
        order = np.argsort([-len(p) for p in parts], kind="stable")
        for at in range(0, len(order), PARTS):
            some = order[at : at + PARTS]
            lengths = np.array([len(parts[i]) for i in some])
            state = np.zeros((0, 1, k))
            for t, n, classes in _steps([parts[i] for i in some], lengths):
                if n < len(state):
                    out[some[n : len(state)]] = state[n:]
                    state = state[:n]
                if t == 0:
                    state = np.broadcast_to(self.start[None, None] if start is not None else self.move[None], (n, out.shape[1], k))
                else:
                    state = (state.reshape(-1, k) @ self.move).reshape(n, -1, k)
                state = state * self.emit[classes][:, None]
                if t % 16 == 15:
                    state /= state.sum((1, 2), keepdims=True)
            out[some[: len(state)]] = state / np.maximum(state.sum((1, 2), keepdims=True), 1e-300)
        return out

    def _counts(self, parts: list[np.ndarray], first: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """The expected counts of parts, the longest first, given their ends; moves lack the factor of the model's own."""
        k, one = len(self.start), np.ones(len(self.start))
        lengths = np.array([len(p) for p in parts])
        forward, emitted, scales, seen = [], [], [], []
        for t, n, classes in _steps(parts, lengths):
            e = self.emit[classes]
            state = (np.where(first[:n, None], self.start, before[:n] @ self.move) if t == 0 else forward[-1][:n] @ self.move) * e
            scale = (state @ one)[:, None]
            forward.append(state / scale)
            emitted.append(e)
            scales.append(scale)
            seen.append(classes)
        moves, emits = np.zeros((k, k)), np.zeros((len(self.emit), k))
        backward, ahead = np.ones((0, k)), np.ones((0, k))
        gammas: list[np.ndarray] = []
        for t in range(len(forward) - 1, -1, -1):
            n, later = len(forward[t]), len(backward)
            now = after[:n].copy()
            now[later:] /= ((forward[t][later:] * now[later:]) @ one)[:, None]
            if later:
                moves += forward[t][:later].T @ ahead
                now[:later] = ahead @ self.move.T
            gammas.append(forward[t] * now)
            backward, ahead = now, emitted[t] * now / scales[t]
        starts, total = np.zeros(k), 0.0
        if gammas:
            starts = gammas[-1][first].sum(0)
            moves += before[~first].T @ ahead[~first]  # from the part before into this one
            which, weight = np.concatenate(seen[::-1]), np.concatenate(gammas)
            for j in range(k):
                emits[:, j] = np.bincount(which, weights=weight[:, j], minlength=len(self.emit))
            total = float(np.log(np.concatenate(scales)).sum())
        return starts, moves, emits, total


def _steps(sequences: list[np.ndarray], lengths: np.ndarray, block: int = 256) -> Iterator[tuple[int, int, np.ndarray]]:
    """(t, how many sequences reach t, their classes at t), the sequences being sorted by falling length."""
    longest = int(lengths[0]) if len(lengths) else 0
    for at in range(0, longest, block):
        n = int(np.searchsorted(-lengths, -at, "left"))
        table = np.zeros((min(block, longest - at), n), np.intp)
        for i in range(n):
            part = sequences[i][at : at + block]
            table[: len(part), i] = part
        reach = np.searchsorted(-lengths, -np.arange(at, at + len(table)), "left").tolist()
        for t, m in enumerate(reach):
            yield at + t, m, table[t, :m]


def maximised(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, share: np.ndarray) -> Hmm:
    """The model of some expected counts; emissions are smoothed by the classes' overall shares."""
    start = starts + 1.0
    move = moves + 1.0
    emit = emits + 5.0 * share[:, None]
    return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def first_model(following: np.ndarray, share: np.ndarray, states: int, seed: int) -> Hmm:
    """Values to begin with: classes that are followed alike go to one state, by k-means.

    following: how often each class is followed by each of the FOLLOWING most frequent ones and by others.
    """
    k = max(1, states)
    own = following / np.maximum(following.sum(1, keepdims=True), 1e-12)
    own = own - (share @ own) / share.sum()
    rng = np.random.default_rng(seed)
    centres = own[[int(np.argmax(share))]]
    while len(centres) < k:  # the next centre is drawn by its distance to those there are
        away = ((own[:, None] - centres[None]) ** 2).sum(2).min(1) * share
        centres = np.vstack([centres, own[int(rng.choice(len(own), p=away / away.sum()) if away.sum() > 0 else rng.integers(len(own)))]])
    for _ in range(50):
        nearest = ((own[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        weight = np.stack([np.bincount(nearest, weights=share * own[:, j], minlength=k) for j in range(own.shape[1])], 1)
        sums = np.bincount(nearest, weights=share, minlength=k)[:, None]
        centres = np.where(sums > 0, weight / np.maximum(sums, 1e-12), centres)
    held = np.full((len(share), k), 0.2 / k) + 0.8 * np.eye(k)[nearest]
    emit = share[:, None] * held * (1 + 0.01 * rng.random((len(share), k)))
    move = np.full((k, k), 0.5 / k) + 0.5 * np.eye(k)
    return Hmm(np.full(k, 1 / k), move, emit / emit.sum(0))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all rows of docs (text); tasks count before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in texts(batch.column(0)):
                seen.update(tokens(text))
                if len(seen) >= FLUSH:
                    yield flushed()
        yield flushed()

    return docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _held_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, at most `most`: those over a count that few enough words reach."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    histogram = sorted(counts.groupBy(step.alias("k")).count().collect(), reverse=True)  # some hundred rows at most
    least, total = None, 0
    for k, n in histogram:
        if total + n > most:
            break
        least, total = k, total + n
    if least is None:
        return []
    rows = counts.where(step >= least).collect()
    return sorted(((bytes(w), n) for w, n in rows), key=lambda r: (-r[1], r[0]))


def lm_scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, own: int = OWN, hashed: int = HASHED, held: int = HELD, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs (doc_id, text).

    Rows whose crc32(doc_id) mod 5 is 1 are held out of training. base_score is the smoothed unigram
    score, score the model's log10 probability of the text: that of its classes times that of each word
    within its class, where each hashed class keeps half a count for unknown words. Null texts are
    empty: one token, the end. Repeated rows each train and are each returned. With nothing to learn
    from, all words are unknown. An empty table gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    rows = own_columns(docs, doc_id=F.col("doc_id"), text=F.coalesce(F.col("text"), F.lit("")), held_out=hash_mod("doc_id", 5) == 1)
    learned = rows.where(~F.col("held_out"))
    counts = cut(word_counts(learned), "word_counts")
    n_docs = learned.count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    train_tokens, types = n_words + n_docs, n_types + (n_docs > 0)
    mass = train_tokens + 0.5 * (types + 1)
    words = _held_words(counts, held)
    vocabulary = Vocabulary({w: i for i, (w, _) in enumerate(words)}, np.array([n for _, n in words], np.float64), min(max(own, 2 * isqrt(n_types)), len(words)), hashed).prepare()
    n_own, n_classes = vocabulary.n_own, vocabulary.n_classes

    # What a class holds: (count + 0.5) of its words, and half a count for the unknown in hashed ones.
    own_words = spark.createDataFrame([(bytearray(w),) for w, _ in words[:n_own]], "word binary")
    others = counts.join(F.broadcast(own_words), "word", "left_anti").groupBy((F.crc32("word") % hashed).cast("int").alias("at")).agg((F.sum("n") + 0.5 * F.count(F.lit(1))).alias("z"))
    z = np.full(n_classes, 0.5)
    z[:n_own] = vocabulary.counts[:n_own] + 0.5
    z[-1] = n_docs + 0.5
    for at, total in others.collect():
        z[n_own + at] += float(total)
    share = z / z.sum()

    shipped_vocabulary, kind = ship(spark, vocabulary), vocabulary.kind

    @F.arrow_udf("struct<classes:binary,n_held:bigint,held_log:double,rest:array<binary>>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own_vocabulary = shipped(shipped_vocabulary)
        logs = np.log10(own_vocabulary.counts + 0.5)
        for arr in batches:
            found = [own_vocabulary.read(t) for t in texts(arr)]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([c.tobytes() for c, _, _ in found], pa.binary()),
                    pa.array([len(p) for _, p, _ in found], pa.int64()),
                    pa.array([float(logs[p].sum()) for _, p, _ in found], pa.float64()),
                    pa.array([r for _, _, r in found], pa.list_(pa.binary())),
                ],
                ["classes", "n_held", "held_log", "rest"],
            )

    coded = cut(rows.select("doc_id", "held_out", F.monotonically_increasing_id().alias("rid"), read("text").alias("r")).select("doc_id", "held_out", "rid", "r.*"), "classes")
    model = fit(coded, share, kind, states, rounds, seed)

    # The words that aren't held: their counts come by a shuffle join; unknown ones stay behind as a number.
    rest = coded.select("rid", F.explode("rest").alias("word"))
    rest = rest.join(counts, "word").groupBy("rid").agg(F.count(F.lit(1)).alias("n_rest"), F.sum(F.log10(F.col("n") + F.lit(0.5))).alias("rest_log"))
    packed = ship(spark, (model, np.log10(mass / z) if mass else z))

    @F.arrow_udf("struct<log10_p:double,classes_log:double>")
    def forward(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own_model, spread = shipped(packed)
        for arr in batches:
            sequences = [np.frombuffer(b, kind) for b in texts(arr)]
            likely = own_model.log_likelihood(sequences) / np.log(10)
            yield pa.StructArray.from_arrays([pa.array(likely), pa.array([float(spread[s].sum()) for s in sequences], pa.float64())], ["log10_p", "classes_log"])

    scored = coded.select("doc_id", "held_out", "rid", (F.octet_length("classes") / np.dtype(kind).itemsize).cast("bigint").alias("n_tokens"), "n_held", "held_log", forward("classes").alias("f"))
    whole = scored.join(rest, "rid", "left").fillna({"n_rest": 0, "rest_log": 0.0})
    known = F.col("n_held") + F.col("n_rest") + F.lit(int(n_docs > 0))
    unknown = F.col("n_tokens") - 1 - F.col("n_held") - F.col("n_rest")
    base = F.col("held_log") + F.col("rest_log") + unknown * float(np.log10(0.5)) + float(np.log10(n_docs + 0.5)) - F.col("n_tokens") * float(np.log10(mass))
    whole = whole.select("doc_id", "held_out", "n_tokens", known.cast("bigint").alias("n_known"), F.lit(train_tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), "f")
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", (F.col("base_score") + F.col("f.log10_p") + F.col("f.classes_log")).alias("score"))


def fit(coded: DataFrame, share: np.ndarray, kind: type, states: int, rounds: int, seed: int) -> Hmm:
    """Baum-Welch over all training rows of coded (held_out, classes), each text a whole sequence."""
    spark = coded.sparkSession
    learned = coded.where(~F.col("held_out")).select("classes")
    following = _summed(learned.mapInArrow(_following(np.argsort(-share, kind="stable")[:FOLLOWING], len(share), kind), _schema(FOLLOWING + 1)), len(share), FOLLOWING + 1)
    model, before = first_model(following, share, states, seed), -np.inf
    for _ in range(rounds if following.any() else 0):
        sums = _summed(learned.mapInArrow(_expected(ship(spark, model), kind), _schema(states)), len(share) + states + 2, states)
        mean = sums[-1, 0] / sums[: len(share)].sum()
        model = maximised(sums[-2], sums[len(share) : -2], sums[: len(share)], share)
        if mean - before < GAIN:
            break
        before = mean
    return model


def _schema(columns: int) -> str:
    return "at int, " + ", ".join(f"v{j} double" for j in range(columns))


def _rows(table: np.ndarray) -> pa.RecordBatch:
    """The rows of a table that aren't all 0, with their places."""
    at = np.flatnonzero(table.any(1))
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *[pa.array(table[at, j]) for j in range(table.shape[1])]], ["at", *[f"v{j}" for j in range(table.shape[1])]])


def _summed(parts: DataFrame, rows: int, columns: int) -> np.ndarray:
    """The sum of the tables that tasks pass on; as large as one of them."""
    names = [f"v{j}" for j in range(columns)]
    table = parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    out = np.zeros((rows, columns))
    for j, c in enumerate(names):
        out[table.column("at").to_numpy(), j] = table.column(c).to_numpy()
    return out


def _following(frequent: np.ndarray, n_classes: int, kind: type):
    """Counts which of the frequent classes, or another, follows each class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(frequent) + 1
        place = np.full(n_classes, width - 1)
        place[frequent] = np.arange(width - 1)
        total = np.zeros(n_classes * (FOLLOWING + 1))
        for batch in batches:
            c = np.frombuffer(b"".join(texts(batch.column(0))), kind).astype(np.int64)
            c, after = c[:-1], place[c[1:]]
            inner = c != n_classes - 1  # nothing follows an end
            total += np.bincount(c[inner] * (FOLLOWING + 1) + after[inner], minlength=len(total))
        yield _rows(total.reshape(n_classes, FOLLOWING + 1))

    return count


def _expected(sent, kind: type):
    """Baum-Welch counts of a task: emissions, moves, starts and the log likelihood, one below the other."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped(sent)
        k = len(own.start)
        total = np.zeros((len(own.emit) + k + 2, k))
        for batch in batches:
            starts, moves, emits, likelihood = own.expected([np.frombuffer(b, kind) for b in texts(batch.column(0))])
            total += np.vstack([emits, moves, starts[None], np.eye(1, k) * likelihood])
        yield _rows(total)

    return count
