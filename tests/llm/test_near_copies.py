"""The near-dedup stage against plain Python."""

import random

from filingspark.llm import near_copies, simhash

from .conftest import make_docs


def _words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]


def _shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_drop_near_copies_links_by_exact_similarity(spark):
    rng = random.Random(11)
    rows, i = [], 0
    for _ in range(12):
        base = _words(rng, 150)
        for edits in (0, 1, 2, 3, 4, 6, 9):
            w = list(base)
            for at in rng.sample(range(150), edits):
                w[at] = "other"
            rows.append((1000 - i, " ".join(w), "en", "s"))
            i += 1
    # One phrase said over and over brings fingerprints near, but the texts share few of their shingles.
    phrase = " ".join(_words(rng, 7))
    rows += [(2000 + k, " ".join([phrase] * 60 + _words(rng, 20)), "en", "s") for k in range(3)]
    rows += [(3000, None, None, None), (3001, "", None, None), (3002, " \n ", None, None)]
    sets = {d: _shingles(t or "") for d, t, *_ in rows}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] | sets[b])
            if a < b and (not both or len(sets[a] & sets[b]) >= 0.8 * both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    kept = sorted(r.doc_id for r in near_copies.drop_near_copies(make_docs(spark, rows)).collect())
    assert kept == sorted(d for d in sets if find(d) == d)
    assert {2000, 2001, 2002} < set(kept) and 15 < len(kept) < len(rows) - 20


def test_large_groups_lose_no_link(spark):
    """Copies of copies: many texts of a group aren't similar to the first, but to others of the group."""
    rng = random.Random(4)
    w, rows = _words(rng, 200), []
    for k in range(80):
        w = list(w)
        for at in rng.sample(range(200), 3):
            w[at] = f"w{k}x{at}"
        rows.append((k, " ".join(w), "en", "s"))
    assert [r.doc_id for r in near_copies.drop_near_copies(make_docs(spark, rows)).collect()] == [0]


def test_many_edges_settle_in_rounds(spark, monkeypatch):
    edges = spark.createDataFrame([(5, 3), (3, 9), (2, 7), (9, 1)], "u long, v long")
    want = {(5, 1), (3, 1), (9, 1), (1, 1), (2, 2), (7, 2)}
    for most in (simhash.BROADCAST_ROWS, 1):
        monkeypatch.setattr(simhash, "BROADCAST_ROWS", most)
        assert {tuple(r) for r in simhash.settled(edges).select("node", "root").collect()} == want


def test_shards_in_parts_lose_no_pair(spark, monkeypatch):
    """Shards cut into parts that meet two by two give the same rows."""
    rng = random.Random(5)
    w, rows = _words(rng, 120), []
    for k in range(40):
        w = list(w)
        for at in rng.sample(range(120), 2):
            w[at] = f"w{k}x{at}"
        rows.append((k, " ".join(w), "en", "s"))
    monkeypatch.setattr(near_copies, "SLICE", 4)
    assert [r.doc_id for r in near_copies.drop_near_copies(make_docs(spark, rows)).collect()] == [0]
