"""Operators against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from filingspark.llm import decontaminate, exact_dedup, hmm, language_id, licenses, mixing, pii, simhash, token_counts, toxicity
from filingspark.llm.queries import tokenizer_path

from .conftest import WORDS, make_docs, sentence


def test_fingerprints_compose():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 30_000).astype(np.uint8)
    whole = exact_dedup.polynomial(data)
    slow = tuple(sum(int(b) * pow(r, len(data) - 1 - i, p) for i, b in enumerate(data)) % p for r, p in zip(exact_dedup.POINTS, exact_dedup.PRIMES))
    assert whole == slow
    for at in (0, 1, 4096, 29_999, 30_000):
        assert exact_dedup.combine(exact_dedup.polynomial(data[:at]), exact_dedup.polynomial(data[at:]), len(data) - at) == whole


@pytest.mark.parametrize("options", [{}, {"primes": (3, 5)}, {"huge": 50, "block": 16}])
def test_exact_dedup(spark, edge_docs, edge_rows, options):
    """Also with primes so small that different texts collide, and with texts split over tasks."""
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t, *_ in edge_rows:
        groups.setdefault(norm(t), []).append(i)
    out = exact_dedup.exact_dedup(edge_docs, **options).collect()
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out)
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    assert got == Counter((i, low(groups[norm(t)]), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, *_ in edge_rows)
    kept = [r for r in out if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_simhash_components(spark):
    rng = random.Random(5)
    base = [sentence(rng, "en", 120) for _ in range(30)]
    rows = [(1000 - i, t, "en", "s") for i, t in enumerate(base)]
    for k in range(60):
        w = base[k % 30].split()
        w[rng.randrange(len(w))] = "other"
        rows.append((k, " ".join(w), "en", "s"))
    rows += [(2000, None, None, None), (2001, "", None, None)]
    out = {r.doc_id: r for r in simhash.simhash_components(make_docs(spark, rows)).collect()}

    def slow(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: slow(t) for i, t, *_ in rows}
    parent = {i: i for i in prints}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i in prints:
        for j in prints:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {i: out[i].fingerprint for i in prints} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: out[i].component_id for i in prints} == {i: find(i) for i in prints}
    assert len({find(i) for i in prints}) < len(prints)


def test_bk_tree_and_large_shards(spark, monkeypatch):
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values for _ in range(6)]
    values = np.array(sorted(set(values)), np.uint64)
    tree = simhash.BKTree(values)
    got = {(node, int(q)) for node, near in tree.search(values, 3) for q in near}
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert got == want
    monkeypatch.setattr(simhash, "SLICE", 3)
    nodes = spark.createDataFrame([(int(v.astype(np.int64)),) for v in values], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.near_edges(nodes, 3)).collect()}
    signed = values.astype(np.int64).tolist()
    low = {i: i for i in range(len(signed))}
    for _ in range(10):
        for i, j in want:
            low[i] = low[j] = min(low[i], low[j], key=lambda x: signed[x])
    assert {s: roots.get(s, s) for s in signed} == {s: signed[low[i]] for i, s in enumerate(signed)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)], "u long, v long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_decontamination(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, text(rng.choice([3, 12, 30, 31]))) for k in range(12)]
    docs = []
    for i in range(40):
        body = text(rng.choice([5, 80, 300]))
        if i % 2:
            w = list(items[i % 12][1])
            if i % 4 == 1 and len(w) > 25:
                w[0] = "changed"
            if i % 8 == 7 and len(w) > 25:
                w[10] = w[20] = "changed"
            at = rng.randrange(len(body))
            body[at:at] = w
        docs.append((i, " ".join(body).title() + "!", "en", "s"))
    monkeypatch.setattr(decontaminate, "ITEMS", 5)
    monkeypatch.setattr(decontaminate, "SEGMENT", 300)
    monkeypatch.setattr(decontaminate, "ROW", 64)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.window_start, round(r.similarity, 9)) for r in decontaminate.contaminated(make_docs(spark, docs), bench).collect()}
    want = {}
    for i, t, *_ in docs:
        w = decontaminate.words(t)
        for k, item in items:
            bag, n = Counter(decontaminate.shingles(item)), min(len(item), len(w))
            for at in range(len(w) - n + 1):
                s = decontaminate.similarity(Counter(decontaminate.shingles(w[at : at + n])), bag)
                if s >= 0.8 and s > want.get((i, k), (0, 0))[1]:
                    want[i, k] = (at, round(s, 9))
    assert got == want and len(want) >= 15


def test_multi_index_holds_all_within_radius():
    rng = random.Random(1)
    items = decontaminate.Items([(k, " ".join(f"x{rng.randrange(99)}" for _ in range(20))) for k in range(80)]).prepare()
    for _ in range(300):
        p = int(items.prints[rng.randrange(80)])
        for b in rng.sample(range(64), rng.randrange(decontaminate.RADIUS + 1)):
            p ^= 1 << b
        want = {(j, (int(items.prints[j]) ^ p).bit_count()) for j in range(80) if (int(items.prints[j]) ^ p).bit_count() <= decontaminate.RADIUS}
        assert set(items.within(p, 20)) == want


def test_rolling_fingerprints_are_those_of_the_windows():
    rng = random.Random(6)
    ws = [f"w{rng.randrange(9)}" for _ in range(90)]
    hashes = decontaminate._rolled(decontaminate.Hashes().of(ws), 5)
    sums = decontaminate.Sums(hashes, 20)
    for size in (5, 6, 7, 15, 64, 70):
        sums.grow(size - 4)
        assert sums.prints().tolist() == [decontaminate.simhash(ws[i : i + size]) for i in range(20)]


def test_windows_are_found_at_the_least_similarity():
    """Over random edits that leave a similarity of at least 0.8, nine in ten windows and more are within the radius."""
    rng = random.Random(3)
    found = total = 0
    for _ in range(3000):
        ws = [f"w{rng.randrange(500)}" for _ in range(rng.choice([8, 15, 30, 60]))]
        other = list(ws)
        for _ in range(rng.randrange(1, 5)):
            other[rng.choice([0, -1, rng.randrange(len(ws))])] = "other"
        if decontaminate.similarity(Counter(decontaminate.shingles(ws)), Counter(decontaminate.shingles(other))) >= 0.8:
            total += 1
            found += (decontaminate.simhash(ws) ^ decontaminate.simhash(other)).bit_count() <= decontaminate.RADIUS
    assert total > 500 and found >= 0.95 * total


def test_token_counts(spark, edge_docs, edge_rows, tmp_path):
    import tokenizers

    encoder = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = Counter((i, len((t or "").encode()), len(encoder.encode(t or "", add_special_tokens=False))) for i, t, *_ in edge_rows)
    cache = f"file://{tmp_path}/cache"
    for _ in range(2):
        out = token_counts.token_counts(edge_docs, tokenizer_path(), cache).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in out)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count()
    more = make_docs(spark, [(1, "something new <|endoftext|> here", "en", "s"), (2, edge_rows[0][1], "en", "s")])
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(more, tokenizer_path(), cache).collect()}[1] == len(encoder.encode("something new <|endoftext|> here", add_special_tokens=False))
    assert spark.read.parquet(cache).count() == stored.count() + 1


def test_counts_add_up_over_pieces():
    source = open(tokenizer_path(), encoding="utf-8").read()
    assert token_counts.splits_at_white_space(source)
    counter, whole = token_counts.Piecewise(source, memo=4000), token_counts.Whole(source)
    rng = random.Random(4)
    for _ in range(300):
        t = "".join(rng.choice(["a", "É", " ", "\n", " ", "́", "'s", "1", "<|endoftext|>", "ß", "你", "!", " ", "don't", "İ", "\t\x0b"]) for _ in range(rng.randrange(30))).encode()
        assert counter.count(t) == whole.count(t), t


def test_language_id_held_out(spark):
    rng = random.Random(6)
    rows = [(i, sentence(rng, lang, 30), lang, "s") for i in range(600) for lang in [list(WORDS)[i % 4]]]
    out = {r.doc_id: r for r in language_id.language_id(make_docs(spark, rows), 60).collect()}
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    held = [(out[i].lang_pred, lang) for i, _, lang, _ in rows if out[i].held_out]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_margins_match_features():
    rng = np.random.default_rng(3)
    model = language_id.Model([("a", ["en"])], [], rng.normal(size=(3, 2 * language_id.BUCKETS + 1)))
    batch = ["Hello, world".encode(), b"", "Ünïcode ñ".encode() * 50, b"x"]
    got, n = model.margins(batch)
    for i, t in enumerate(batch):
        assert np.allclose(got[i], model.weights[:, :-1] @ language_id.frequencies(t) + model.weights[:, -1], atol=1e-3)
        assert n[i] == sum(c.isalpha() for c in t.decode())


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x[:, 0] - x[:, 1] > 0, 1, -1)
    w = language_id.train_svm([(np.arange(5), r) for r in x], y, 5)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_toxicity_restores_and_learns(spark):
    rng = random.Random(7)
    bad = ["idiot", "moron", "stupid"]
    rows, marks = [], []
    for i in range(500):
        w = sentence(rng, "en", 30).split()
        if toxic := i % 4 == 0:
            w[rng.randrange(len(w))] = bad[i // 4 % 3]
        rows.append((i, " ".join(w), "en", "s"))
        marks.append((i, 1, int(toxic)))
    rows += [(1000, "you 1d10t there", "en", "s"), (1001, "a s t u p i d thing", "en", "s"), (1002, "a market report", "en", "s"), (1003, "such a moooooron", "en", "s")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(make_docs(spark, rows), labels, 200).collect()}
    held = [r for i, r in out.items() if i < 500 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert out[1000].predicted == out[1001].predicted == out[1003].predicted == 1 and out[1002].predicted == 0


def test_viterbi_is_the_cheapest_path():
    rng = np.random.default_rng(2)
    costs = rng.random((toxicity.N,) * 3).tolist()
    steps = toxicity.lattice("a1b.c$$d")

    def paths(k):
        if k == len(steps):
            yield 0.0, ""
            return
        for string, cost in steps[k]:
            for c, s in paths(k + 1):
                yield cost + c, string + s

    def total(cost, string):
        x = y = 0
        for c in string:
            z = toxicity._class(c)
            if z or y:
                cost += costs[x][y][z]
                x, y = y, z
        return cost + (costs[x][y][0] if y else 0)

    best = min((total(c, s), re.sub(" +", " ", s).strip()) for c, s in paths(0))
    assert re.sub(" +", " ", toxicity.viterbi(steps, costs)) == best[1]


def test_trigram_counts_over_segments(monkeypatch):
    text = b"the quick brown fox jumps" * 40
    whole = toxicity.trigram_counts(text)
    monkeypatch.setattr(toxicity, "SEGMENT", 17)
    assert (toxicity.trigram_counts(text) == whole).all() and whole.sum() == len(text)


def test_lm_scores(spark, edge_docs, edge_rows):
    out = hmm.lm_scores(edge_docs, states=3, rounds=2, own=3, hashed=8, held=25).collect()
    toks = lambda t: (t or "").encode().lower().split()
    train = [toks(t) for i, t, *_ in edge_rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()) + len(train), len(c) + 1
    log = lambda k: np.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    want = Counter()
    for i, t, *_ in edge_rows:
        ws = toks(t)
        want[i, len(ws) + 1, sum(w in c for w in ws) + 1, n, round(float(sum(log(c[w]) for w in ws) + log(len(train))), 4)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)


def hmm_model(rng, classes, states):
    return hmm.Hmm(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(classes), states).T)


def test_forward_is_exact_and_training_climbs():
    rng = np.random.default_rng(4)
    model = hmm_model(rng, 12, 3)
    sequences = [rng.integers(0, 12, n).astype(np.uint16) for n in (1, 2, 5, 300, 700, 1600)]
    got = model.log_likelihood(sequences)
    for s, g in zip(sequences, got):
        a, total = model.start * model.emit[s[0]], 0.0
        for x in s[1:]:
            total += np.log(a.sum())
            a = (a / a.sum()) @ model.move * model.emit[x]
        assert np.isclose(total + np.log(a.sum()), g)
    # All paths of a short one, by brute force.
    k, s = 3, sequences[2]
    paths = np.array(np.meshgrid(*[range(k)] * len(s))).reshape(len(s), -1).T
    p = sum(model.start[z[0]] * np.prod([model.emit[x, j] for x, j in zip(s, z)]) * np.prod([model.move[a, b] for a, b in zip(z, z[1:])]) for z in paths)
    assert np.isclose(np.log(p), got[2])
    before = -np.inf
    for _ in range(4):
        starts, moves, emits, total = model.expected(sequences)
        assert np.isclose(emits.sum(), sum(map(len, sequences))) and np.isclose(total, model.log_likelihood(sequences).sum()) and total >= before - 1e-6
        before = total
        model = hmm.Hmm((starts + 1e-9) / (starts + 1e-9).sum(), (moves + 1e-9) / (moves + 1e-9).sum(1, keepdims=True), (emits + 1e-12) / (emits + 1e-12).sum(0))


def test_training_sees_whole_sequences(monkeypatch):
    """Counts of sequences in parts are those of plain forward and backward recursions over the whole."""
    rng = np.random.default_rng(9)
    model = hmm_model(rng, 20, 4)
    sequences = [rng.integers(0, 20, n).astype(np.uint16) for n in (1, 6, 7, 8, 40, 95)]
    starts, moves, emits = np.zeros(4), np.zeros((4, 4)), np.zeros((20, 4))
    for s in sequences:
        a = [model.start * model.emit[s[0]]]
        for x in s[1:]:
            a.append(a[-1] @ model.move * model.emit[x])
        b = [np.ones(4)]
        for x in s[:0:-1]:
            b.append(model.move @ (model.emit[x] * b[-1]))
        b = b[::-1]
        p = a[-1].sum()
        starts += a[0] * b[0] / p
        for t, x in enumerate(s):
            emits[x] += a[t] * b[t] / p
            if t:
                moves += np.outer(a[t - 1], model.emit[x] * b[t]) * model.move / p
    for part, held in ((7, 3), (512, 1000)):
        monkeypatch.setattr(hmm, "PART", part)
        monkeypatch.setattr(hmm, "PARTS", held)
        got = model.expected(sequences)
        assert np.allclose(got[0], starts) and np.allclose(got[1], moves) and np.allclose(got[2], emits)
        assert np.isclose(got[3], model.log_likelihood(sequences).sum())


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = {k: [] for k in BASE}
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out[kind].append(m.span())
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(9)
    parts = ["a@b.c", "x.y@z", "@", "1.2.3.4", "1.2.3.4.5.6", "256.1.1.1", "0001.2.3.4", "+1 (555) 555-1234", "+12", "4111 1111 1111 1111", "4111-1111-1111-1112", "9" * 25, " ", "é", ".", "-", "a.b@c-d.e.f@g.h", "+", "12", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_are_linear():
    pii.base_spans("a" * 300_000 + "1" * 300_000 + "." * 1000 + "@" * 1000)


def test_pii_digest_and_added_spans(spark):
    rows = [(1, "é mail a.b@mail.example.com or call +1 (212) 555-0199 now", "en", "s"), (2, "pay 4111 1111 1111 1111, host 10.0.0.1", "en", "s"), (3, "contact jane.doe (at) mail5 (dot) example (dot) com please", "en", "s"), (4, "nothing here at all in 2024 or 12.5 percent", "en", "s")]
    out = {r.doc_id: r for r in pii.pii_digest(make_docs(spark, rows)).collect()}
    for i, t, *_ in rows:
        base = plain_spans(t)
        listed = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in base[k])
        assert out[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [out[i][f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(out[i].spans.split(","))
    assert out[3].spans == "email:8:51"
    assert out[4].spans == ""


def test_redaction(spark):
    model = pii.fit([])
    docs = make_docs(spark, [(1, "write a@b.example.com!", "en", "s"), (2, None, None, None)])
    out = docs.select("doc_id", pii.redact_udf(pii.ship(spark, model))(F.coalesce("text", F.lit(""))).alias("t")).collect()
    assert {r.doc_id: r.t for r in out} == {1: "write [email]!", 2: ""}


def test_boosted_trees_learn():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    p = pii.Boosted().fit(x[:1500], y[:1500]).probability(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.95


def test_licenses(spark):
    apache = "\n".join(['Licensed under the Apache License, Version 2.0 (the "License");'.replace(";", "."), "you may not use this file", "except in compliance with the License."])
    rows = [
        (1, "Intro text.\nReleased under the MIT License.\nMore.", "en", "s"),
        (2, "LICENSED!! UNDER!! CC!! BY-NC!! 4.0.!!", "en", "s"),
        (3, apache, "en", "s"),
        (4, "All rights reserved. Released under the MIT License.", "en", "s"),
        (5, "We like the Apache License here.", "en", "s"),
    ]
    out = {r.doc_id: (r.sentence_ids, r.licenses) for r in licenses.license_scan(make_docs(spark, rows)).collect()}
    assert out[1] == ("mit-short", "MIT")
    assert out[2] == ("cc-by-nc-short", "CC-BY-NC-4.0")
    assert out[3] == ("apache2-notice,apache2-use", "Apache-2.0")
    assert out[4] == ("all-rights,mit-short", "MIT,LicenseRef-all-rights-reserved")
    assert out[5] == ("", "")


def test_rules_take_sequences_in_order(spark):
    ids = spark.createDataFrame([(["a", "b", "a"],), (["b", "a"],), ([],)], "ids array<string>")
    rules = (("AB", ("a", "b")), ("A", ("a",)), ("B", ("b",)))
    assert [r[0] for r in ids.select(licenses.match_rules(F.col("ids"), rules)).collect()] == [["AB", "A"], ["A", "B"], []]


def water(total, children):
    """Budgets of (weight, cap) one token at a time in proportion: the reference by bisection of the level."""
    live = [(w, c) for w, c in children if w and c]
    low, high = 0.0, float(total + 1)
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(c, mid * w) for w, c in live) <= total else (low, mid)
    return [min(c, low * w) if w and c else 0 for w, c in children]


def test_budgets_refill_siblings_first(spark):
    leaves = spark.createDataFrame([("x", "en", "a", 100), ("x", "en", "b", 1000), ("x", "de", "c", 50), ("y", "en", "d", 5000), ("y", "fr", "e", 10)], "domain string, lang string, source string, tokens long")
    weights = spark.createDataFrame([("x", None, None, 3), ("y", None, None, 1), ("x", "en", "a", 9)], "domain string, lang string, source string, weight long")
    for total in (0, 7, 1100, 99_999):
        got = {r.source: r.budget for r in mixing.budgets(leaves, weights, total, 1).collect()}
        x, y = water(total, [(3, 1150), (1, 5010)])
        en, de = water(x, [(1, 1100), (1, 50)])
        a, b = water(en, [(9, 100), (1, 1000)])
        d, e = water(y, [(1, 5000), (1, 10)])
        for source, want in zip("abcde", (a, b, de, d, e)):
            assert abs(got.get(source, 0) - want) <= 3, (total, source, got, want)
        assert sum(got.values()) == min(total, 6160)


def test_mix_takes_prefixes_of_epochs(spark):
    rows = [(i, "one two three four five", "en", "s1") for i in range(50)]
    docs = make_docs(spark, rows).withColumn("domain", F.lit("web"))
    weights = spark.createDataFrame([], "domain string, lang string, source string, weight long")
    out = mixing.mix(docs, weights, total=613, max_epochs=4, seed=3, slices=8).collect()
    assert sum(r.taken for r in out) == 613
    assert Counter(r.epoch for r in out if r.epoch < 3) == {1: 50, 2: 50}
    order = sorted(range(50), key=lambda i: hashlib.md5(f"3:3:{i}".encode()).hexdigest())
    last = [(i, 5) for i in order[:22]] + [(order[22], 3)]
    assert sorted((r.doc_id, r.taken) for r in out if r.epoch == 3) == sorted(last)
