"""Reduction in levels, digests of large groups, counts of stages."""

import hashlib
import json

from pyspark.sql import functions as F

from filingspark.operators import reduce, scans, telemetry


def test_levels_hold_few_texts_and_lose_none(spark):
    rows = spark.range(1000).select((F.col("id") % 7 == 0).cast("int").alias("k"), F.col("id").alias("o"), F.concat(F.col("id").cast("string"), F.lit(" ")).alias("t"))

    def join(texts):
        assert len(texts) <= 10
        return "".join(texts)

    got = {r.k: (r.n, r.summary, r.problem) for r in reduce.reduce_groups(rows, "k", "o", "t", join, 10, lambda s: "long" if len(s) > 1000 else None).collect()}
    for k in (0, 1):
        want = [i for i in range(1000) if (i % 7 == 0) == bool(k)]
        assert got[k] == (len(want), "".join(f"{i} " for i in want), None if k else "long")
    empty = reduce.reduce_groups(rows.limit(0), "k", "o", "t")
    assert empty.columns == ["k", "n", "summary"] and empty.count() == 0


def test_levels_over_keys_that_many_tasks_scan(spark, monkeypatch):
    monkeypatch.setattr(scans, "HOT", 100)
    rows = spark.range(900).select((F.col("id") % 5 == 0).cast("int").alias("k"), F.col("id").alias("o"), F.col("id").cast("string").alias("t"))
    ends = lambda texts: f"{texts[0].split()[0]} {texts[-1].split()[-1]}"
    got = reduce.reduce_groups(rows, "k", "o", "t", ends, 10).collect()
    assert sorted(map(tuple, got)) == [(0, 720, "1 899"), (1, 180, "0 895")]


def test_levels_give_what_one_level_gives(spark):
    """Sentences and blanks in every place; a small key beside a large one is reduced once."""
    text = F.when(F.col("id") % 4 == 0, " \n").otherwise(F.concat(F.lit(" part "), F.col("id").cast("string"), F.lit(". "), F.repeat(F.lit("x"), 90)))
    rows = spark.range(1000).select((F.col("id") < 995).cast("int").alias("k"), F.col("id").alias("o"), text.alias("t"))
    whole, parts = (sorted(map(tuple, reduce.reduce_groups(rows, "k", "o", "t", fan_in=n).collect())) for n in (2000, 7))
    assert whole == parts and len(whole[1][2]) > 5000
    brackets = lambda texts: f"({' '.join(texts)})"
    got = {r.k: r.summary for r in reduce.reduce_groups(rows.select("k", "o", F.col("o").cast("string").alias("t")), "k", "o", "t", brackets, 10, merge=" ".join).collect()}
    assert got[0] == "(995 996 997 998 999)" and got[1].startswith("(0 1 2 3 4 5 6 7 8 9) (10 ")


def test_digests_stream_in_order_with_null_keys_and_ties(spark):
    data = [(None, 2, "b"), (None, 1, "a"), ("x", 1, None), ("x", 1, "z"), ("x", 1, "z"), ("y", 3, 'q"é')] + [("big", i, "v" * 50) for i in range(30_000)]
    df = spark.createDataFrame(data, "k string, o int, v string").repartition(5)
    got = {r.k: r.fingerprint for r in reduce.fingerprint(df, ["k"], ["o"], ["v", "o"]).collect()}
    for k in (None, "x", "y", "big"):
        rows = sorted(((o, v is not None, v or "") for a, o, v in data if a == k))
        body = json.dumps([{"o": o, "v": v if full else None} for o, full, v in rows], separators=(",", ":"), ensure_ascii=False)
        assert got[k] == hashlib.sha256(body.encode()).hexdigest()
    assert len(got) == 4 and reduce.fingerprint(df.limit(0), ["k"], ["o"], ["v"]).count() == 0


def test_stages_are_counted_as_rows_pass_by(spark):
    seen = []

    def sink(count):
        seen.append(count["stage"])
        raise OSError("nobody listens")

    calls = spark.sparkContext.accumulator(0)

    def touch(x):
        calls.add(1)
        return x

    stages = [("read", lambda d: d), ("mark", lambda d: d.select("id", F.udf(touch, "long")("id").alias("v"))), ("even", lambda d: d.where("v % 2 = 0"))]
    rows, counts = telemetry.observed(spark.range(100), stages, {"last": F.max("id")}, sink)
    assert rows.count() == 50 and seen == ["read", "mark", "even"]
    assert counts == [{"stage": "read", "n": 100, "last": 99}, {"stage": "mark", "n": 100, "last": 99}, {"stage": "even", "n": 50, "last": 98}]
    assert calls.value == 100
