"""Language identification in two steps: the family, then the language within it.

Texts are read as relative frequencies of hashed character pairs and triples. One-versus-rest linear
classifiers tell families apart; inside a family, one-versus-one linear support vector machines vote.
All are trained by dual coordinate descent on a bounded sample of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hash_mod, ship, shipped, texts

#: Hashed features of each order (pairs, triples).
BUCKETS = 4096
#: Rows of each language that the classifiers learn from, and rows of all languages together.
SAMPLE, ROWS = 600, 12_000
#: Code points that are scored at once.
SEGMENT = 1 << 20
#: Frequencies are scaled so that texts are of about unit length.
SCALE = 8.0

#: Families of related languages by code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa"),
    "baltic": ("lt", "lv"),
}


def family(lang: str) -> str:
    """The family of a language code; a code that isn't listed is a family of its own."""
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def code_points(text: bytes) -> np.ndarray:
    """Lower-cased letters of a text; all else, bytes that aren't UTF-8 too, as spaces, two at each end."""
    points = np.frombuffer(("  " + text.decode("utf-8", "replace").lower() + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(letters()[points], points, np.uint32(32))


def features(points: np.ndarray) -> Iterator[np.ndarray]:
    """Feature numbers of the pairs and of the triples that start at each place but the last two."""
    a, b, c = points[:-2], points[1:-1], points[2:]
    pair = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)
    triple = pair + c * np.uint32(0xC2B2AE3D)
    shift = np.uint32(32 - (BUCKETS - 1).bit_length())
    for k, h in enumerate((pair, triple)):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield (h >> shift).astype(np.int32) + k * BUCKETS


def frequencies(text: bytes) -> np.ndarray:
    """The scaled relative frequencies of a text's features."""
    points = code_points(text)
    counts = np.zeros(2 * BUCKETS)
    for at in range(0, max(1, len(points) - 2), SEGMENT):
        for f in features(points[at : at + SEGMENT + 2]):
            counts += np.bincount(f, minlength=2 * BUCKETS)
    return (counts * (SCALE / max(1, len(points) - 2))).astype(np.float32)


#: A row of features: places, and values there; all others are 0.
Row = tuple[np.ndarray, np.ndarray]


def train_svm(rows: list[Row], y: np.ndarray, size: int, c: float = 1.0, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) of a linear support vector machine over rows of `size` features; y is 1 or -1. Classes count alike."""
    w, alpha = np.zeros(size + 1), np.zeros(len(rows))
    square = [float(v @ v) + 1.0 for _, v in rows]
    share = {s: max(1, (y == s).sum()) for s in (1, -1)}
    most = [c * len(y) / (2 * share[int(s)]) for s in y]
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)).tolist():
            at, value = rows[i]
            old = alpha[i]
            new = min(most[i], max(0.0, old - (y[i] * (value @ w[at] + w[-1]) - 1) / square[i]))
            if new != old:
                alpha[i] = new
                step = (new - old) * y[i]
                w[at] += step * value
                w[-1] += step
                moved = max(moved, abs(new - old))
        if moved < 1e-3:
            break
    return w


@dataclass
class Model:
    """families: their languages, by name; weights: a row for each family, then for each pair of languages."""

    families: list[tuple[str, list[str]]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray

    def margins(self, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The classifiers' margins for some texts, and how many letters each has."""
        out = np.repeat(self.weights[None, :, -1].astype(np.float64), len(batch), 0)
        n_letters = np.zeros(len(batch), np.int64)
        w = np.ascontiguousarray(self.weights[:, :-1].T.astype(np.float32))
        group: list[tuple[int, np.ndarray, int]] = []
        held = 0
        for i, text in enumerate(batch):
            points = code_points(text)
            whole = max(1, len(points) - 2)
            n_letters[i] = int((points != 32).sum())
            for at in range(0, whole, SEGMENT):
                part = points[at : at + SEGMENT + 2]
                group.append((i, part, whole))
                held += len(part)
                if held >= SEGMENT:
                    self._add(group, w, out)
                    group, held = [], 0
        if group:
            self._add(group, w, out)
        return out, n_letters

    @staticmethod
    def _add(group: list[tuple[int, np.ndarray, int]], w: np.ndarray, out: np.ndarray) -> None:
        points = np.concatenate([p for _, p, _ in group])
        ends = np.cumsum([len(p) for _, p, _ in group])
        starts = np.append(0, ends[:-1])
        # The last two places of a part start no pair or triple of its own; the array's last two have none at all.
        cuts = np.stack([starts, ends - 2], 1).reshape(-1)
        owner = np.array([i for i, _, _ in group])
        share = SCALE / np.array([n for _, _, n in group])
        for f in features(points):
            f = np.append(f, np.zeros(2, np.int32))
            for m in range(w.shape[1]):
                values = np.take(w[:, m], f)
                np.add.at(out[:, m], owner, np.add.reduceat(values, cuts, dtype=np.float64)[::2] * share)

    def predict(self, batch: list[bytes]) -> list[tuple[str, float]]:
        """(language, score) of each text; `und` and 0 without a letter."""
        if not self.families:
            return [("und", 0.0)] * len(batch)
        margins, n_letters = self.margins(batch)
        sure = 1 / (1 + np.exp(-np.clip(2 * margins, -50, 50)))
        n, out = len(self.families), []
        for i in range(len(batch)):
            if not n_letters[i]:
                out.append(("und", 0.0))
                continue
            best = int(np.argmax(margins[i, :n]))
            score = float(sure[i, best]) if n > 1 else 1.0
            langs = self.families[best][1]
            votes, least = dict.fromkeys(langs, 0), dict.fromkeys(langs, 1.0)
            for k, (a, b) in enumerate(self.pairs, n):
                if a in votes:
                    won, p = (a, sure[i, k]) if margins[i, k] >= 0 else (b, 1 - sure[i, k])
                    votes[won] += 1
                    least[won] = min(least[won], float(p))
            lang = max(langs, key=lambda x: (votes[x], least[x], x))
            out.append((lang, score * least[lang]))
        return out


def fit(rows: list[tuple[str, Row]]) -> Model:
    """A model from languages and rows of features."""
    families: dict[str, list[str]] = {}
    for lang in sorted({lang for lang, _ in rows}):
        families.setdefault(family(lang), []).append(lang)
    size = 2 * BUCKETS
    its = np.array([family(lang) for lang, _ in rows])
    x = [r for _, r in rows]
    weights = [train_svm(x, np.where(its == f, 1, -1), size) if len(families) > 1 else np.zeros(size + 1) for f in families]
    pairs = [p for f in families.values() for p in combinations(f, 2)]
    for a, b in pairs:
        both = [(lang, r) for lang, r in rows if lang in (a, b)]
        weights.append(train_svm([r for _, r in both], np.array([1 if lang == a else -1 for lang, _ in both]), size))
    return Model(list(families.items()), pairs, np.array(weights))


def sampled_ids(rows: DataFrame, label: str, most: int) -> list:
    """Up to `most` doc_ids of each label, those with the smallest digests.

    Ids whose digest is far above what `most` of the label's count need are left out first, so that the
    ranking of a label gets about twice as many rows as it keeps, however many there are.
    """
    rows = rows.select(label, "doc_id").distinct().withColumn("key", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    counts = F.broadcast(rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")))  # a row for each label
    rows = rows.join(counts, label).where(F.col("key").cast("double") * F.col("n") <= float((2 * most + 50) << 40))
    order = Window.partitionBy(label).orderBy("key", "doc_id")
    return [r[0] for r in rows.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= most).select("doc_id").collect()]


def train(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """Fit on up to `sample` rows of docs (doc_id, text, lang) of each language and ROWS in all, among those where learn holds.

    Rows with a null lang, id or text teach nothing. Of rows with the same id, one is used.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    n_langs = rows.select("lang").distinct().count()
    ids = sampled_ids(rows, "lang", min(sample, max(1, ROWS // max(1, n_langs))))
    picked = rows.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r")).select("r.lang", "r.text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [frequencies(t) for t in texts(batch.column(1))]
            at = [np.flatnonzero(f).astype(np.int32) for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a.tobytes() for a in at], pa.binary()), pa.array([f[a].tobytes() for f, a in zip(found, at, strict=True)], pa.binary())], ["lang", "at", "value"])

    rows = [(lang, bytes(at), bytes(value)) for lang, at, value in picked.mapInArrow(read, "lang string, at binary, value binary").toLocalIterator()]
    return fit([(lang, (np.frombuffer(at, np.int32), np.frombuffer(value, np.float32))) for lang, at, value in sorted(rows)])


def predict_udf(model):
    """model: a broadcast of Model."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shipped(model)
        for arr in batches:
            rows = own.predict(texts(arr))
            yield pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())], ["lang", "score"])

    return predict


def reject(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of docs whose language is found with a score of at least `least`, with all their columns."""
    found = predict_udf(ship(docs.sparkSession, model))(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), found.alias("found"))
    return rows.where((F.col("found.lang") != "und") & (F.col("found.score") >= least)).select("row.*")


def language_id(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs (doc_id, text, lang).

    Rows whose crc32(doc_id) mod 3 is 1 are held out of training. Repeated rows are each returned;
    with nothing to learn from, all are `und`. An empty table gives no rows; other columns aren't read.
    """
    rows = docs.select("doc_id", "text", "lang")
    held = hash_mod("doc_id", 3) == 1
    model = train(rows, ~held, sample)
    found = predict_udf(ship(docs.sparkSession, model))(F.coalesce(F.col("text"), F.lit("")))
    return rows.select("doc_id", held.alias("held_out"), found.alias("found")).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
