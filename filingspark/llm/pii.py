"""Personal data by gradient-boosted candidate selection.

Base patterns give spans that always stay. High-recall generators propose further spans, which may overlap:
written-out e-mail addresses, phone numbers without a plus, card numbers and addresses with other
separators. Boosted trees judge each by its format and context; per-kind thresholds, calibrated on spans of
documents that the trees haven't seen, select those that are added.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, shipped, texts
from .language_id import sampled_ids

KINDS = ("email", "ip", "card", "phone")
#: Documents whose base spans, rewritten, teach the trees; of each, so many spans of a kind, of at most so many code points.
SAMPLE, SPANS, LONGEST = 2000, 5, 100
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 16
#: Share of calibration candidates over a threshold that must be right, and the least threshold.
PRECISION, LEAST = 0.95, 0.7
#: Code points around a span that count as its context.
CONTEXT = 40

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A dotted number can't begin inside a run of digits that failed, so runs are tried once, from their start.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_DOT = r"\s?(?:\(dot\)|\[dot\]|\{dot\}|\.|\sdot\s)\s?"
_NAME = r"[a-z0-9][a-z0-9._%+-]{0,63}"
_HOST = rf"[a-z0-9-]{{1,63}}(?:{_DOT}[a-z0-9-]{{2,63}}){{1,4}}"
#: Generators of further candidates, by kind; what they propose may overlap, within a kind too.
GENERATORS = {
    "email": (re.compile(rf"(?i){_NAME}\s?(?:\(at\)|\[at\]|\{{at\}}|@)\s?{_HOST}"), re.compile(rf"(?i){_NAME}\sat\s\s?{_HOST}")),
    "ip": (re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?(?:\[\.\]|\(\.\)|\[dot\]|\.|\sdot\s)\s?[0-9]{1,3}){3}(?![0-9])"),),
    "card": (re.compile(r"(?<![0-9])[0-9](?:[ ./_-]{0,3}[0-9]){12,18}(?![0-9])"),),
    "phone": (re.compile(r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./()-]{1,2}[0-9]{2,5}){2,5}(?![0-9A-Za-z])"),),
}
HINTS = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "credit", "pay"), "phone": ("phone", "tel", "call", "fax", "mobile")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost spans of a local part, @ and a dotted domain, found from each @: linear on any text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at)
        if m and start < at:
            end = m.end()
            out.append((start, end))
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The base spans of each kind in code points; matches that fail their test are dropped."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    out["email"] = emails(text)
    if _DIGIT.search(text):
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


#: What every e-mail candidate has; the generator itself begins at any letter, so it is tried only on texts with this.
_AT = re.compile(r"(?i)@|\(at\)|\[at\]|\{at\}|\sat\s\s?[a-z0-9-]{1,63}\s?(?:\(dot\)|\[dot\]|\{dot\}|\.|\sdot\s)")


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all generators; kinds may overlap."""
    digits = _DIGIT.search(text)
    tried = {"email": _AT.search(text), "ip": digits, "card": digits, "phone": digits}
    return [(k, *m.span()) for k, kind in enumerate(KINDS) if tried[kind] for g in GENERATORS[kind] for m in g.finditer(text)]


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    groups = re.findall(r"[0-9]+", span)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    near = before[-1:]
    return [
        kind,
        len(span),
        len(digits),
        sum(c.isalpha() for c in span),
        len({c for c in span if not c.isalnum()}),
        len(span) - sum(c.isalnum() for c in span),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        span.startswith("+"),
        "@" in span,
        ".." in span,
        span.count("."),
        " " in span,
        luhn(digits) if digits else 0,
        all(int(g[-4:]) <= 255 for g in groups) if groups else 0,
        int(digits[:1] or 10),
        len(groups[-1]) if groups else 0,
        len(set(digits)),
        bool(near) and (near.isalnum() or near in "_#=.\""),
        after[:1].isalnum(),
        any(h in before.lower() for h in HINTS[KINDS[kind]]),
        sum(c.isdigit() for c in before),
        sum(c.isdigit() for c in after),
        "(" in span,
        " at " in span.lower(),
        bool(re.search(r"(?i)[(\[{]at[)\]}]", span)),
        bool(re.search(r"(?i)\.?\s?(?:dot|\.)\W?\s?(?:com|org|net|edu|de|fr|es|io|example)\b", span)),
    ]


class Boosted:
    """Gradient-boosted trees on binned features, with the log loss."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.n, self.depth, self.rate = trees, depth, rate
        self.trees: list[list] = []
        self.start = 0.0
        self.edges: list[np.ndarray] = []

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        b, f = self.binned(x), np.full(len(y), self.start)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(b, p - y, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            f += self._values(tree, b)
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> list:
        """[value], or [feature, bin, left, right]: left takes bins up to that one."""
        G, H = g[rows].sum(), h[rows].sum()
        leaf = [float(-self.rate * G / (H + 1))]
        if not depth or len(rows) < 20:
            return leaf
        best = (1e-6, None)
        for j in range(b.shape[1]):
            gs = np.cumsum(np.bincount(b[rows, j], weights=g[rows], minlength=BINS))[:-1]
            hs = np.cumsum(np.bincount(b[rows, j], weights=h[rows], minlength=BINS))[:-1]
            gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), (j, k))
        if best[1] is None:
            return leaf
        j, k = best[1]
        low = b[rows, j] <= k
        if low.all() or not low.any():
            return leaf
        return [j, k, self._grow(b, g, h, rows[low], depth - 1), self._grow(b, g, h, rows[~low], depth - 1)]

    def _values(self, tree: list, b: np.ndarray) -> np.ndarray:
        if len(tree) == 1:
            return np.full(len(b), tree[0])
        out, low = np.empty(len(b)), b[:, tree[0]] <= tree[1]
        out[low], out[~low] = self._values(tree[2], b[low]), self._values(tree[3], b[~low])
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        f = np.full(len(x), self.start)
        for tree in self.trees:
            f += self._values(tree, b)
        return 1 / (1 + np.exp(-f))


def _rewritten(kind: str, span: str, rng: random.Random) -> str:
    """A personal datum as someone might write it otherwise."""
    if kind == "email":
        at = rng.choice((" at ", "(at)", "[at]", "{at}", " (at) ", " [at] ", " {at} ", "@"))
        dot = rng.choice((" dot ", "(dot)", "[dot]", "{dot}", " (dot) ", " [dot] ", " {dot} ", ".", "."))
        local, _, domain = span.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return span.replace(".", rng.choice(["[.]", "(.)", ".", " . ", "[dot]"]))
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "card":
        return rng.choice(["", " ", "-", ".", "/", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    tail = digits[-10:]
    if len(tail) < 10:
        return span
    form = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "+1 {} {} {}", "001 {} {} {}", "{} {} {}", "1-{}-{}-{}"])
    return form.format(tail[:3], tail[3:6], tail[6:])


def _decoy(kind: str, rng: random.Random) -> str:
    """Something of like shape that isn't personal data."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "email":
        return rng.choice([f"look at thing{rng.choice('.,')} com", f"meet at {d(2)}.{d(2)}", f"was at home. in{d(1)}", f"at {d(1)}.{d(1)}.{d(1)}", "it at the.re", "sale at shop. now"])
    if kind == "ip":
        parts = [str(rng.randint(0, 999)) for _ in range(4)]
        parts[rng.randrange(4)] = str(rng.randint(256, 999))
        return rng.choice([".", " . ", "[.]"]).join(parts)
    if kind == "card":
        n = rng.choice([13, 14, 15, 16, 16, 16, 17, 18])
        digits = d(n)
        if luhn(digits):
            digits = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
        if rng.random() < 0.3:
            return f"{digits}a{d(3)}"
        return rng.choice(["", " ", "-", ".", "/"]).join(digits[i : i + 4] for i in range(0, n, 4))
    return rng.choice([f"20{d(2)}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.{d(4)}", f"{d(2)} {d(2)} {d(2)}", f"{d(3)}/{d(2)}/{d(2)}", f"{d(4)} {d(4)} {d(4)} {d(4)}", f"{d(1)}.{d(2)}.{d(3)}", f"{d(2)}-{d(2)}-{d(2)}-{d(2)}", f"{d(5)} {d(5)} {d(5)} {d(5)}"])


@dataclass
class Model:
    trees: Boosted
    thresholds: list[float]

    def add(self, found: list[tuple[str, dict, list]]) -> list[list[tuple[int, int, int]]]:
        """For texts with their base spans and candidates: all spans by kind and start, base ones kept."""
        rows, owner = [], []
        for i, (text, base, extra) in enumerate(found):
            taken = Taken(s for spans in base.values() for s in spans)
            for k, s, e in extra:
                if taken.free(s, e):
                    rows.append(features(text, k, s, e))
                    owner.append((i, k, s, e))
        out = [[(k, s, e) for k, kind in enumerate(KINDS) for s, e in base[kind]] for _, base, _ in found]
        if rows:
            p = self.trees.probability(np.array(rows, np.float64))
            added: dict[int, Taken] = {}
            for (i, k, s, e), sure in sorted(zip(owner, p.tolist(), strict=True), key=lambda r: (-r[1], r[0])):
                if sure >= self.thresholds[k] and added.setdefault(i, Taken()).free(s, e):
                    added[i].add(s, e)
                    out[i].append((k, s, e))
        return [sorted(spans) for spans in out]


class Taken:
    """Parts of a text that are taken, apart from each other and in order."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def free(self, s: int, e: int) -> bool:
        return bisect_right(self.ends, s) == bisect_left(self.starts, e)

    def add(self, s: int, e: int) -> None:
        """Take a free part."""
        k = bisect_left(self.starts, s)
        self.starts.insert(k, s)
        self.ends.insert(k, e)


def fit(contexts: list[tuple[int, str, str, str, str]], seed: int = 5) -> Model:
    """From base spans (document, kind, before, span, after): rewritten ones are right, decoys in their place are wrong.

    Documents are numbered by a digest: those of two remainders of three grow the trees, the rest calibrate
    the thresholds. Some made-up spans join in, so that there is a model without any base span.
    """
    rng = random.Random(seed)
    given = sorted(contexts)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    local = lambda: letters(rng.randint(2, 9)) + rng.choice(["", "", ".", "_", "-"]) + rng.choice([letters(rng.randint(1, 8)), str(rng.randint(1, 2030))])
    made = [("email", f"{local()}@{letters(rng.randint(2, 10))}.{rng.choice(['com', 'org', 'net', 'edu', 'de', 'fr', 'co.uk', 'example.com', letters(3)])}") for _ in range(240)]
    made += [("ip", ".".join(str(rng.randint(1, 255)) for _ in range(4))) for _ in range(60)]
    made += [("phone", f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}") for _ in range(60)]
    for _ in range(60):
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        made.append(("card", next(digits + c for c in "0123456789" if luhn(digits + c))))
    given += [(n, kind, "word of ", span, " and so") for n, (kind, span) in enumerate(made)]
    rows, marks, held = [], [], []
    for document, kind, before, span, after in given:
        for text, mark in ((_rewritten(kind, span, rng), 1), (_decoy(kind, rng), 0), (_decoy(rng.choice(KINDS), rng), 0)):
            whole = before + text + after
            for k, s, e in candidates(whole):
                if s >= len(before) + len(text) or e <= len(before):
                    continue
                right = mark and KINDS[k] == kind and s == len(before) and e == len(before) + len(text)
                rows.append(features(whole, k, s, e))
                marks.append(int(right))
                held.append(document % 3 == 0)
    x, y, held = np.array(rows, np.float64), np.array(marks), np.array(held)
    trees = Boosted().fit(x[~held], y[~held])
    p, thresholds = trees.probability(x[held]), []
    for k in range(len(KINDS)):
        of = x[held][:, 0] == k
        order = np.argsort(-p[of], kind="stable")
        right = np.cumsum(y[held][of][order]) / np.arange(1, of.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        thresholds.append(max(LEAST, float(p[of][order][good[-1]])) if len(good) else 2.0)
    return Model(trees, thresholds)


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the base spans of up to `sample` rows of docs (doc_id, text) that have digits or an @, by a digest of the id."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"@|[0-9]{2}"))
    ids = sampled_ids(rows.withColumn("all", F.lit(0)), "all", sample)
    picked = rows.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min("text").alias("text")).select("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in texts(batch.column(0)):
                text = raw.decode("utf-8", "replace")
                for kind, spans in base_spans(text).items():
                    some = [(s, e) for s, e in spans if e - s <= LONGEST][:SPANS]
                    out += [(zlib.crc32(raw), kind, text[max(0, s - CONTEXT) : s], text[s:e], text[e : e + CONTEXT]) for s, e in some]
            kinds = (pa.int64(), *[pa.string()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(5)], ["document", "kind", "before", "span", "after"])

    schema = "document bigint, kind string, before string, span string, after string"
    return fit([tuple(r) for r in picked.mapInArrow(read, schema).collect()] if ids else [])


def spans_udf(model):
    """model: a broadcast of Model."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shipped(model)
        for arr in batches:
            found = [(t, base_spans(t), candidates(t)) for t in (raw.decode("utf-8", "replace") for raw in texts(arr))]
            rows = []
            for (_, base, _), spans in zip(found, own.add(found), strict=True):
                sure = {(k, s, e) for k, kind in enumerate(KINDS) for s, e in base[kind]}
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": (k, s, e) in sure} for k, s, e in spans])
            yield pa.array(rows, pa.list_(span))

    return find


def pii_spans(docs: DataFrame, model: Model | None = None, sample: int = SAMPLE) -> DataFrame:
    """docs with a column `found`: array of (kind, start, end, base), by kind as in KINDS, then start.

    Positions are code points, ends exclusive. Null and empty texts have none.
    """
    model = model or train(docs.select("doc_id", "text"), sample)
    return docs.withColumn("found", spans_udf(ship(docs.sparkSession, model))(F.coalesce(F.col("text"), F.lit(""))))


def redact_udf(model):
    """model: a broadcast of Model; each span becomes its kind in brackets, overlapping ones of two kinds as one."""

    @F.arrow_udf("string")
    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shipped(model)
        for arr in batches:
            found = [(t, base_spans(t), candidates(t)) for t in (raw.decode("utf-8", "replace") for raw in texts(arr))]
            out = []
            for (text, _, _), spans in zip(found, own.add(found), strict=True):
                done, end = [], 0
                for k, s, e in sorted(spans, key=lambda r: (r[1], -r[2])):
                    if s >= end:
                        done += [text[end:s], f"[{KINDS[k]}]"]
                    end = max(end, e)
                out.append("".join([*done, text[end:]]))
            yield pa.array(out, pa.string())

    return redact


def pii_digest(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of docs (doc_id, text).

    Counts and base_sha256 are of base spans, spans lists all, as kind:start:end. Null texts count as
    empty, bytes that aren't UTF-8 as replacement characters. Repeated rows are each returned; an empty table gives no rows; other columns aren't read.
    """
    rows = pii_spans(docs.select("doc_id", "text"), sample=sample)
    base = F.filter("found", lambda x: x["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select("doc_id", *map(count, KINDS), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
