"""Top-k search, spelling variants and conversation repair against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingspark.llm import conversations, top_k, variants

VECTORS = "vec_id long, embedding array<float>, label int, q int, score string, id string"


def slow_top_k(rows, k):
    good = [(i, [math.floor(Fraction(float(np.float32(x))) * 1024) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i % 10 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)[:k]
            out += [(i, r, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(found, 1)]
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"block": 3}, {"sample": 12}])
def test_top_k(spark, options):
    """Dense, sparse, tied, ragged and unusable vectors, large components, ids that repeat; in blocks, and with first scores from a sample."""
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    rows += [(i, [rng.choice([0.0, 0.0, 0.0, 1.0, -0.5]) for _ in range(8)]) for i in range(150, 260)]
    rows += [(300 + i, [0.25] * 8) for i in range(15)] + [(400, []), (401, [0.5]), (410, [0.0] * 8), (411, [-1.0] * 12)]
    rows += [(500, None), (510, [1.0, None]), (520, [math.nan] * 8), (530, [math.inf] * 8), (None, [1.0] * 8)]
    rows += [(10, rows[10][1]), (-20, [3e9] * 8), (601, [-3e9] * 8), (602, [1e30] * 3)]
    df = spark.createDataFrame([(i, v, 1, 2, "s", "x") for i, v in rows], VECTORS).repartition(3)
    got = top_k.top_k(df, F.col("vec_id") % 10 == 0, k=5, **options)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert Counter(tuple(r) for r in got.collect()) == slow_top_k(rows, 5)
    none = df.limit(0)
    assert top_k.top_k(none, F.col("vec_id") % 10 == 0).collect() == []
    assert top_k.top_k(df.where("vec_id = 400 or vec_id = 401"), F.col("vec_id") % 10 == 0).count() == 1


def test_shards_skip_rows():
    """Rows that only non-essential terms hold are not looked at, and no row that counts is lost."""
    rng = np.random.default_rng(2)
    rows = rng.integers(-50, 50, (3000, 16)) * (rng.random((3000, 16)) < 0.2)
    shard, query = top_k.Shard(np.arange(3000), rows), rng.integers(-90, 90, 16)
    scores = rows @ query
    for least in np.sort(scores)[[-1, -10, -300, 100]].tolist():
        at, got = shard.search(query, least)
        assert sorted(at.tolist()) == np.flatnonzero(scores >= least).tolist()
        assert (got == scores[at]).all()


WORDS = {"n": 0}


def slow_variants(rows, least_length=5, least_count=3, ratio=2):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            at = h % len(low)
            counts[low[:at] + low[at + 1 :] if h % 97 == 0 else low] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[p:] == b[p + 1 :]

    form, out = {}, {}
    for w in n:
        close = [x for x in n if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = len(close)
    rows = []
    for w in n:
        end = w
        while form[end]:
            end = form[end]
        rows.append((w, form[w], end, n[w], out[w], n[form[w]] if form[w] else None))
    return Counter(rows)


def test_variants(spark):
    """Short and long words and those about the bound, repeated letters, ties, accents, capitals, words of other letters."""
    rng = random.Random(8)
    base = ["banana", "bananas", "bannana", "abcde", "abcdé", "ÀBCDE", "àbcde", "zzzzz", "zzzzzz", "zzzz", "straße", "strasse"]
    base += ["x" * 63 + "a", "x" * 64, "x" * 65, "x" * 64 + "y", "xy" * 32, "xy" * 32 + "x", "xy" * 33, "q" + "xy" * 32, "ab" * 2000, "ab" * 2000 + "a", "ab" * 1000 + "c" + "ab" * 999 + "b"]
    for w in list(base):
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice("abcxyzé")
            base.append(rng.choice([w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + c + w[i:]]))
    rows = [(i, " ".join(rng.choice([w, w.upper() if w.isascii() else w, w.capitalize()]) for w in rng.choices(base, [rng.choice([1, 2, 4, 9]) for _ in base], k=30)) + " 12 мир a_b") for i in range(60)]
    rows += [(None, None), (7, ""), (None, "banana banana abcde"), (9, "banana"), (9, "banana"), (77, "--- 123")]
    df = spark.createDataFrame([(i, t, "word", 1, "n") for i, t in rows], "doc_id long, text string, word string, n int, place string").repartition(3)
    got = variants.variants(df).collect()
    assert Counter(tuple(r) for r in got) == slow_variants(rows)
    assert any(len(r.word) > 64 and r.form for r in got) and any(r.root not in (r.word, r.form) for r in got)
    assert variants.variants(df.limit(0)).collect() == []


def slow_repair(rows):
    """rows: (conv_id, turn, role, text); every edit sequence that can be cheapest, by breadth."""
    space = lambda x: " " if x is None else str(x)
    left = {}
    for c, t, role, text in rows:
        left.setdefault(c, [])
        k = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20
        role, text = space(role), space(text)
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            left[c] += [(t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = []
    for c, turns in left.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{space(c)}:{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, fault = set(), []
        for _, role, text in turns:
            bare = text.strip(" \t\n\r\x0b\x0c")
            fault.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [t for t, *_ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        # All states as (system, users and assistants so far) strings: the best (cost, audit, lines) for each prefix of turns and each last role.
        best = {"": (0, "", [])}
        for i in range(len(turns) + 1):
            for _ in range(4):  # insertions
                for s, (cost, audit, lines) in list(best.items()):
                    new = {"": "u", "s": "u", "u": "a", "a": "u"}[s]
                    cand = (cost + 5, audit + "I", [*lines, f"{'user' if new == 'u' else 'assistant'}:"])
                    if new not in best or cand[:2] < best[new][:2]:
                        best[new] = cand
            if i == len(turns):
                break
            nxt = {}
            _, role, text = turns[i]
            for s, (cost, audit, lines) in best.items():
                new = {"": "u", "s": "u", "u": "a", "a": "u"}[s]
                options = [(s, cost + 2, audit + "D", lines)]
                if fault[i] not in ("b", "d"):
                    more = 5 * (fault[i] == "t")
                    if role[:1] == new or (role[:1] == "s" and s == ""):
                        options.append((role[:1], cost + more, audit + "K", [*lines, f"{role}:{text}"]))
                    options.append((new, cost + more + 1, audit + "R", [*lines, f"{'user' if new == 'u' else 'assistant'}:{text}"]))
                for state, *rest in options:
                    if state not in nxt or tuple(rest[:2]) < nxt[state][:2]:
                        nxt[state] = tuple(rest)
            best = nxt
        cost, audit, lines = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        out.append((c, gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return Counter(out)


def make_turns(rng, convs):
    rows = []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 3, 5, 9, 40])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]) if rng.random() < 0.3 else ("user", "assistant")[t % 2]
            text = rng.choice([None, "", " \n ", "Yes.", "No", "Ok! ", "Same text.", f"Turn {t} says é."])
            rows.append((c, rng.choice([t, t, t, None, 3 * t]), role, text))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_repair(spark, small, monkeypatch):
    """Whole conversations, and in pieces of two rows, over several tasks; one conversation holds a third of all rows."""
    rng = random.Random(6)
    rows = make_turns(rng, 120) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hello"), (None, None, None, None), (7, None, "user", "x"), (10**12, -(10**12), "assistant", "Late.")]
    rows += [(5000, t, ("user", "assistant")[t % 2] if t % 7 else "user", f"Turn {t % 90}." if t % 5 else "x") for t in range(900)]
    rows += [(6000, t, "user", "Same." if t % 2 else f"{t}.") for t in range(200)]
    if small:
        monkeypatch.setattr(conversations, "PIECE_ROWS", 2)
    df = spark.createDataFrame([(*r, 1, "x", "y", 5) for r in rows], "conv_id long, turn long, role string, text string, row int, fault string, cost string, piece int").repartition(3)
    got = conversations.conversation_repair(df)
    assert Counter(tuple(r) for r in got.collect()) == slow_repair(rows)
    assert conversations.conversation_repair(df.limit(0)).collect() == []


def test_search_takes_the_least_audit():
    """Against all edit sequences of up to two insertions."""
    rng = random.Random(1)
    for _ in range(60):
        turns = [(rng.choice("suat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(5))]
        best = None
        for n in range(len(turns), len(turns) + 3):
            for audit in itertools.product("DIKR", repeat=n):
                if sum(e != "I" for e in audit) != len(turns):
                    continue
                cost, at, state = 0, 0, 0
                for e in audit:
                    step = next((x for x in conversations.edges(state, turns[at] if at < len(turns) else None) if x[0] == e), None)
                    if step is None:
                        break
                    cost, at, state = cost + step[1], at + step[2], step[3]
                else:
                    if state in (0, 3) and (best is None or (cost, "".join(audit)) < best):
                        best = (cost, "".join(audit))
        found = next(iter(conversations.cheapest(turns).values()))
        assert found[0] <= best[0] and (found == best or len(found[1]) > len(turns) + 2)


def test_odd_bytes(spark):
    docs = spark.createDataFrame([(1, bytearray(b"caf\xff\xc3\xa9tier \xfe words words words"))] * 3, "doc_id long, raw binary").select("doc_id", F.expr("cast(raw as string)").alias("text"))
    assert {r.word for r in variants.variants(docs).collect()} >= {"words"}
    turns = docs.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text")
    assert conversations.conversation_repair(turns).count() == 1
