"""Like sets and texts within texts: no pair is lost, and rows that share only what all share do not meet."""

import random

import pytest
from pyspark.sql import functions as F

from filingspark.operators import dedup, setjoin, tables, wordruns


def _jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("least", [0.5, 0.8, 0.985])
def test_no_like_pair_is_lost(spark, least):
    rng = random.Random(3)
    sets = {}
    for base in range(12):
        core = [rng.randrange(1 << 40) for _ in range(rng.choice([1, 3, 40, 200]))]
        for k in range(6):
            drop = int(len(core) * rng.choice([0, 0, 0.005, 0.02, 0.1, 0.3]))
            sets[base * 6 + k] = set(rng.sample(core, len(core) - drop)) | {rng.randrange(1 << 40) for _ in range(drop // 2)} | {7}
    df = spark.createDataFrame([(i % 2, i, list(v)) for i, v in sets.items()], "g int, k int, s array<bigint>")
    got = {(r.later, r.earlier) for r in setjoin.alike(df, ["g"], "k", "s", least).collect()}
    want = {(a, b) for a in sets for b in sets if a > b and a % 2 == b % 2 and _jaccard(sets[a], sets[b]) >= least}
    assert want and want <= got


def test_sets_that_share_what_all_share_do_not_meet(spark):
    common = list(range(100))
    df = spark.createDataFrame([(0, i, [*common, *range(1000 + 100 * i, 1030 + 100 * i)]) for i in range(150)], "g int, k int, s array<bigint>")
    assert setjoin.alike(df, ["g"], "k", "s", 0.9).count() == 0


def _rows(texts):
    return [("x", f"u{i}", f"d{i}.pdf", t, f"sha{i}", False, i) for i, t in enumerate(texts)]


def test_near_pairs_are_those_of_all_pairs(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9)))
    shared = [word() for _ in range(150)]
    texts = []
    for size in (119, 120, 130, 400, 6500, 13000):
        body = shared + [word() for _ in range(size - 150)] if size > 150 else [word() for _ in range(size)]
        whole = " ".join(body)
        texts += [whole, whole.upper() + " .", whole[3:-2], "zz" + whole + "yy", " ".join(body[: size // 2] + ["other"] + body[size // 2 + 1 :]), " ".join(body[2:]), " ".join(body[:-9] + [word() for _ in range(9)])]
    schema = "announcement_id string, url string, filename string, text string, sha256 string, is_attachment boolean, ordinal int"
    rows = dedup.settled(dedup.features(spark.createDataFrame(_rows(texts), schema)))
    for near in (0.7, 0.985):
        got = {(r.later, r.earlier): round(r.similarity, 9) for r in dedup.near_pairs(rows, near).collect()}
        a, b = rows.alias("a"), rows.alias("b")
        pairs = a.join(b, (F.col("a.rank") > F.col("b.rank")) & (F.least("a.n_tokens", "b.n_tokens") >= 120) & (F.least("a.n_tokens", "b.n_tokens") / F.greatest("a.n_tokens", "b.n_tokens") >= 0.94))
        pairs = pairs.select(F.col("a.rank").alias("later"), F.col("b.rank").alias("earlier"), dedup.similarity("a", "b").alias("s")).where(F.col("s") >= near)
        assert got == {(r.later, r.earlier): round(r.s, 9) for r in pairs.collect()} and len(got) > 20


def test_alike_texts_of_a_group_meet_little(spark):
    """Filings of one form, each with a part of its own, are never candidates, however many there are."""
    rng = random.Random(9)
    form = [f"form{i}" for i in range(300)]
    texts = [" ".join(form + [f"own{i}x{rng.randrange(1 << 30)}" for _ in range(20)]) for i in range(120)]
    schema = "announcement_id string, url string, filename string, text string, sha256 string, is_attachment boolean, ordinal int"
    rows = dedup.settled(dedup.features(spark.createDataFrame(_rows(texts), schema)))
    assert setjoin.alike(rows, ["announcement_id", "suffix"], "rank", "shingles", 0.985).count() == 0


def test_texts_of_one_group_stay_in_many_tasks_and_copies_stand_for_each_other(spark, monkeypatch):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(1 << 30)}" for _ in range(200)] for _ in range(8)]
    texts = [" ".join(b) for b in base for _ in range(5)] + [" ".join([*b[:-1], "end"]) for b in base]
    items = [("x", f"u{i}", f"d{i}.pdf", t, f"sha{t[:9]}{i % 2}", False, i) for i, t in enumerate(texts)]
    schema = "announcement_id string, url string, filename string, text string, sha256 string, is_attachment boolean, ordinal int"
    for most in (1_000_000, 3):
        monkeypatch.setattr(tables, "SMALL", most)
        rows = dedup.settled(dedup.features(spark.createDataFrame(items, schema).repartition(8)))
        if most > 3:
            assert max(r.n for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()) < len(texts) / 2
        seen = []
        monkeypatch.setattr(setjoin, "alike", lambda *a, f=setjoin.alike: seen.append(a[0].count()) or f(*a))
        got = {(r.later, r.earlier) for r in dedup.near_pairs(rows, 0.7).collect()}
        at = {r.ordinal: (r.rank, r.sha256, r.ordinal) for r in rows.collect()}
        same = lambda i: i % 40 // 5 if i < 40 else i - 40
        want = {(max(at[i], at[j])[0], min(at[i], at[j])[0]) for i in at for j in at if i < j and same(i) == same(j) and at[i][1] != at[j][1]}
        assert got == want and seen == [16]
        monkeypatch.undo()


def test_what_needs_no_texts_reads_none(spark):
    """Ranks, digests and numbers of stored features are read by columns; no window counts the elements of sets."""
    schema = "announcement_id string, url string, filename string, text string, sha256 string, is_attachment boolean, ordinal int"
    rows = dedup.features(spark.createDataFrame(_rows(["a b c " * 60, "d e f " * 60]), schema))
    plan = rows.select("announcement_id", "rank", "digest")._jdf.queryExecution().executedPlan().toString()
    assert "digest" in plan and "normalized" not in plan and "shingles" not in plan
    p = setjoin.prefixes(rows, ["announcement_id"], "rank", "shingles", 0.7)
    assert "Window" not in p._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_prefixes_are_those_of_counted_elements(spark, batch):
    rng = random.Random(batch)
    sets = {i: {rng.randrange(40) for _ in range(rng.randrange(1, 25))} | {1000 + i} for i in range(40)}
    df = spark.createDataFrame([(i % 3, i, list(v)) for i, v in sets.items()], "g int, k int, s array<bigint>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {}
        for r in setjoin.prefixes(df, ["g"], "k", "s", 0.7).collect():
            got.setdefault(r.k, {})[r.place] = r.e
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs = [(i % 3, e) for i, v in sets.items() for e in v]
    codes = {(r.g, r.x): r.e for r in spark.createDataFrame(pairs, "g int, x bigint").distinct().select("g", "x", F.xxhash64("x", "g").alias("e")).collect()}
    n = {(codes[x]): pairs.count(x) for x in pairs}
    for i, v in sets.items():
        order = sorted((n[codes[i % 3, e]], codes[i % 3, e]) for e in v)
        first = order[: len(order) - -(-7 * len(order) // 10) + 1]
        assert got.get(i, {}) == {k: e for k, (m, e) in enumerate(first) if m > 1}


def test_words_and_runs_are_those_of_the_tokens(spark):
    rng = random.Random(2)
    odd = [None, "", " . ", "Ａb ﬁx² İ K ß é1é", "A" * 70 + "b " + "A" * 70 + "c " + "A" * 69 + "bc", "one-two"]
    long = [" ".join(rng.choice(["Ab", "é", "x1.", "--", "ﬁn", "z" * 66, "q" * 65]) + str(rng.randrange(9)) for _ in range(n)) for n in (5, 12, 70, 75, 200)]
    texts = [*odd, *long, *odd, *long]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    rows = df.select("i", dedup.tokens(F.col("t")).alias("toks"), wordruns.read(F.col("t"), 5, 10).alias("r"), wordruns.read(F.col("t"), 5, 10, 20).alias("c")).collect()
    seen = {}
    for x in rows:
        assert (x.r.n_tokens, x.r.normalized) == (len(x.toks), " ".join(x.toks))
        if len(x.toks) < 10:
            assert x.r.shingles is None and x.r.whole is None and x.r.inner is None
            continue
        runs = [tuple(x.toks[k : k + 5]) for k in range(len(x.toks) - 4)]
        assert len(x.r.shingles) == len(set(runs)) and set(x.r.whole) | set(x.r.inner) <= set(x.r.shingles)
        assert len(x.c.shingles) == len(set(runs[:: -(-len(runs) // 20)])) and set(x.c.shingles) <= set(x.r.shingles)
        assert seen.setdefault(x.i - len(odd) - len(long) if x.i >= len(odd) + len(long) else x.i, x.r) == x.r
        if len(runs) <= 64:
            assert x.r.whole == [min(x.r.shingles)]
