"""The store touches only the buckets of a write's rows, and a write is there whole or not at all; scans of large keys."""

import random

import pytest
from pyspark.sql import functions as F

from filingspark.operators import ledger, relational as R, scans, state, telemetry, timewin
from filingspark.operators.store import Store


def rows(spark, pairs):
    return spark.createDataFrame([(k, v, f"t{k}") for k, v in pairs], "k long, v int, t string")


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"), ["k"], "k long, v int, t string", 8)
    assert s.read().collect() == [] and s.upsert(rows(spark, [])) == []
    s.upsert(rows(spark, [(k, k) for k in range(100)]))
    return s


def values(s):
    return {r.k: r.v for r in s.read().collect()}


def files(s):
    return {b: sorted(r[0] for r in s.read([b]).select(F.input_file_name()).distinct().collect()) for b in range(8)}


def test_a_write_leaves_other_buckets_alone(spark, store):
    before = files(store)
    touched = store.upsert(spark.createDataFrame([(5, 1, "a", 0), (5, 2, "b", 1), (500, 7, "c", 0)], "k int, v int, t string, _batch int"))
    after = files(store)
    assert len(touched) <= 2 and [b for b in before if before[b] != after[b]] == touched
    want = {k: k for k in range(100)} | {5: 2, 500: 7}
    assert values(store) == want
    store.patch(spark.createDataFrame([(6, None), (9999, 1)], "k long, v int"))
    assert values(store) == want | {6: None} and store.read().where("k = 6").first().t == "t6"
    store.delete(rows(spark, [(k, 0) for k in range(0, 100, 2)]))
    assert sorted(values(store)) == [*range(1, 100, 2), 500]
    store.delete(store.read())
    assert values(store) == {} and store.folders() == {}


def test_a_write_that_dies_changes_nothing(spark, store, monkeypatch):
    before, was = values(store), files(store)
    boom = F.raise_error(F.lit("lost")).cast("int")
    with pytest.raises(Exception, match="lost"):  # while rows are written
        store.rewrite(rows(spark, [(1, 1)]), lambda old, new: old.withColumn("v", F.when(F.col("k") == 1, boom).otherwise(F.col("v"))))
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):  # between the rows and the commit
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        store.upsert(rows(spark, [(1, 77)]))
    assert values(store) == before and files(store) == was
    fs, path = store._files(f"{store.path}/writes/{store.version() + 1:012d}")
    fs.mkdirs(path)  # in the commit itself
    assert values(store) == before
    store.upsert(rows(spark, [(1, 78)]))
    assert values(store) == before | {1: 78}
    old = store.version()
    store.upsert(rows(spark, [(2, 79)]))
    assert {r.k: r.v for r in store.read(version=old).collect()} == before | {1: 78}
    assert store.vacuum() > 0 and values(store) == before | {1: 78, 2: 79}


def test_one_writer_at_a_time(spark, store):
    def meddle(old, new):
        Store(spark, store.path, ["k"], "k long, v int, t string", 8).upsert(rows(spark, [(3, 33)]))
        return R.upsert(old, new, ["k"])

    with pytest.raises(RuntimeError, match="another write"):
        store.rewrite(rows(spark, [(3, 44)]), meddle)
    assert values(store)[3] == 33


def test_attachments_and_coverage(spark, tmp_path):
    store = Store(spark, str(tmp_path / "a"), ["url"], "url string, announcement_id long, selected boolean, duplicate_of string", 4)
    base = spark.createDataFrame([("a", 1, True, "x"), ("b", 1, False, "x"), ("c", 2, True, "x")], store.schema)
    store.upsert(base)
    batch = spark.createDataFrame([("a", 1, True, 1), ("c", 2, True, 1), ("c", 2, False, 2), ("d", 3, True, 1)], "url string, announcement_id long, selected boolean, _batch int")
    out, flips = ledger.upsert_attachments(base, batch)
    assert ledger.write_attachments(store, batch).collect() == flips.collect()
    assert sorted(map(str, store.read().collect())) == sorted(map(str, out.select(store.schema.names).collect()))
    kept = Store(spark, str(tmp_path / "c"), ["scope"], "scope string, s int, e int", 4)
    have = spark.createDataFrame([("x", 1, 3), ("y", 1, 3), ("z", 1, 3)], "scope string, s int, e int")
    kept.replace(have, have)
    gaps = spark.createDataFrame([("x", 3, 5), ("x", 9, 10), ("y", 3, 5), ("w", 1, 2)], "scope string, s int, e int")
    runs = spark.createDataFrame([("x", True, 0, False), ("y", True, 1, False), ("w", True, 0, False)], "scope string, complete boolean, errors int, filtered boolean")
    state.save_coverage(kept, gaps, runs)
    want = state.commit_coverage(have, gaps, runs)
    assert sorted(map(tuple, kept.read().collect())) == sorted(map(tuple, want.collect())) == [("w", 1, 2), ("x", 1, 5), ("x", 9, 10), ("y", 1, 3), ("z", 1, 3)]


@pytest.fixture(scope="module")
def skewed(spark):
    """One scope with 97 percent of the rows, a null scope, ties in order."""
    rng = random.Random(2)
    data = [("hot" if rng.random() < 0.97 else rng.choice(["a", "b", None]), rng.randrange(4000), i, rng.choice([0.0, 0.0, 1.5, -2.0, 7.0]) if i > 30 else 0.0, rng.randrange(1, 60)) for i in range(3000)]
    return spark.createDataFrame(data, "scope string, at int, id int, v double, width int").withColumn("e", F.col("at") + F.when(F.col("id") % 50 == 0, F.col("width")).otherwise(0)).cache()


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables in as many ranges as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_and_spread(monkeypatch, f):
    got = []
    for hot in (10**9, 100):
        monkeypatch.setattr(scans, "HOT", hot)
        got.append(sorted(map(str, f().collect())))
    assert got[0] and got[0] == got[1]


@pytest.mark.parametrize(
    "f",
    [
        lambda d: timewin.merge_intervals(d.select("scope", F.col("at").alias("s"), "e"), "scope"),
        lambda d: R.running_cap(d, ["scope"], ["at", "id"], "width", 2000).select("id", "status"),
        lambda d: R.breaker(d, ["scope"], ["at", "id"], F.col("id") % 700 == 1).select("id", "status"),
        lambda d: R.round_robin(d, "scope", ["at", "id"]).select("id", "turn"),
        lambda d: telemetry.ewma(d, "scope", ["at", "id"], "v").select("scope", F.round("ewma", 9).alias("ewma")),
        lambda d: timewin.contained(d.select("id", "scope", F.col("at") + 7, "at"), "at", d.where("id % 50 = 0").select("scope", F.col("at").alias("s"), "e"), ["scope"], "left_semi").select("id"),
        lambda d: timewin.contained(d.select("id", "scope", "at"), "at", d.where("id % 50 = 0").select("scope", F.col("at").alias("s"), "e"), ["scope"], "left_anti").select("id"),
    ],
)
def test_large_keys_lie_in_many_tasks(skewed, monkeypatch, f):
    plain_and_spread(monkeypatch, lambda: f(skewed))


def test_a_large_key_is_spread(skewed, monkeypatch):
    monkeypatch.setattr(scans, "HOT", 100)
    sizes = scans.Scan(skewed, ["scope"], ["at", "id"]).rows.where("scope = 'hot'").groupBy("_part").count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 1500


def test_ewma_is_the_fold(skewed):
    rows_ = {}
    for r in skewed.orderBy("at", "id").collect():
        x = max(0.0, r.v)
        acc = rows_.get(r.scope, 0.0)
        rows_[r.scope] = x if acc <= 0 else 0.22 * x + 0.78 * acc
    assert {r.scope: pytest.approx(r.ewma, rel=1e-9) for r in telemetry.ewma(skewed, "scope", ["at", "id"], "v").collect()} == rows_


def test_containment_against_a_loop(skewed):
    ranges = skewed.where("id % 40 = 0").select("scope", F.col("at").alias("s"), (F.col("at") + F.col("width")).alias("e"))
    have = [tuple(r) for r in ranges.collect()]
    want = {r.id for r in skewed.collect() if any(k is not None and k == r.scope and s <= r.at <= e for k, s, e in have)}
    assert {r.id for r in timewin.contained(skewed, "at", ranges, ["scope"], "left_semi").collect()} == want
    assert {r.id for r in timewin.contained(skewed, "at", ranges, ["scope"], "left_anti").collect()} == {r.id for r in skewed.collect()} - want
