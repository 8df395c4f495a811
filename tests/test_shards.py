"""Recorded pages as a stream with restarts, publishing with answers that are left out and tasks that fail."""

import json

import pytest
from pyspark.sql import Row

from filingspark.sources import shards


def record(folder, seq, shard, replies, reported):
    path = folder / f"seq={seq}" / f"shard={shard}"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"p{len(list(path.iterdir()))}.txt").write_text(json.dumps({"Replies": [{"id": r} for r in replies], "ResultCount": reported}) + "\n")


def test_shards_come_when_they_are_whole(tmp_path):
    record(tmp_path, 1, "a", [1, 2], 2)
    record(tmp_path, 1, "b", [3], 3)
    record(tmp_path, 2, "b", [4, 4], 3)  # raw rows count, repeated ids too
    record(tmp_path, 3, "a", [5], 3)
    record(tmp_path, 3, "c", [], 1)

    def rows(start, end):
        return [(r[0], json.loads(r[4])["id"]) for p in shards.planned(str(tmp_path), start, end) for r in shards.shard_rows(str(tmp_path), p)]

    assert rows(0, 1) == [("a", 1), ("a", 2)]
    assert rows(1, 2) == [("b", 3), ("b", 4), ("b", 4)] == rows(1, 2)
    assert rows(2, 3) == [("a", 5)]
    assert rows(0, None) == [("a", 1), ("a", 2), ("a", 5), ("b", 3), ("b", 4), ("b", 4)] == rows(0, 3)
    assert shards.planned(str(tmp_path / "none"), 0, None) == [] == shards.planned(str(tmp_path), 3, 3)


def test_a_stream_that_is_restarted_gives_the_batch(spark, tmp_path):
    spark.dataSource.register(shards.ShardSource)
    pages = tmp_path / "pages"
    pages.mkdir()
    for seq in range(3):
        for shard in range(4):
            record(pages, seq + 1, f"s{shard}", [f"{seq}-{shard}-{k}" for k in range(shard + 1)], 99 if shard == 3 else (shard + 1) * (1 if shard == 0 else 2))
        shards.read_recordings(spark.readStream.format("shards").load(str(pages)), str(tmp_path / "rows"), str(tmp_path / "state"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "rows")).select("shard", "payload").collect())
    want = sorted(tuple(r) for r in spark.read.format("shards").load(str(pages)).select("shard", "payload").collect())
    assert got == want and {r[0] for r in got} == {"s0", "s1", "s2"} and len(got) == 3 + 6 + 9


def left_out(batch):
    return [a for a in shards.accept(batch) if not a["external_id"].endswith("3")]


def broken(batch):
    if any(r["external_id"] == "x7" for r in batch):
        raise ConnectionError("gone")
    return shards.accept(batch)


def test_publishing(spark, tmp_path):
    rows = spark.createDataFrame([(f"b{k // 5}", f"x{k}", "{}") for k in range(20)], "batch string, external_id string, payload string")
    path = str(tmp_path)
    assert shards.publish(rows, path, "r1") == "COMPLETE"
    first = sorted(map(str, shards.outcomes(rows, path, "r1").collect()))
    assert shards.publish(rows, path, "r1") == "COMPLETE"  # again: the same files, the same answers
    assert sorted(map(str, shards.outcomes(rows, path, "r1").collect())) == first
    assert shards.publish(rows, path, "r2", left_out) == "PARTIAL"
    assert {r.external_id: r.status for r in shards.outcomes(rows, path, "r2").collect()} == {f"x{k}": "PARTIAL" if k % 10 == 3 else "READY" for k in range(20)}
    report = shards.run_report(spark, path, "r2")
    assert (report["ready"], report["partial"], report["error_code"]) == (18, 2, "SOURCE_PROCESSING_PARTIAL")
    assert shards.publish(rows, path, "r3", broken) == "FAILED"
    assert {(r.status, r.internal_id) for r in shards.outcomes(rows, path, "r3").collect()} == {("FAILED", None)}
    assert shards.publish(rows, path, "r3") == "COMPLETE"  # resumed under the same name
    assert {r.status for r in shards.outcomes(rows, path, "r3").collect()} == {"READY"}
    assert shards.publish(rows.limit(0), path, "r4") == "COMPLETE"


def test_a_task_keeps_few_answers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "ANSWERS", 6)
    rows = [Row(batch=f"b{k // 5:02}", external_id=f"x{k}", payload="{}") for k in range(33)]
    sent = shards.PublishWriter(str(tmp_path), "r", None).write(iter(rows))
    lines = [(tmp_path / f).read_text().splitlines() for f in sent.files]
    assert [len(x) for x in lines] == [10, 10, 10, 3] and sent.counts == {"READY": 33}
    assert [json.loads(a)["external_id"] for x in lines for a in x] == [f"x{k}" for k in range(33)]
    again = shards.PublishWriter(str(tmp_path), "r", None).write(iter(rows))
    assert again.files == sent.files and len(list((tmp_path / "answers/r").iterdir())) == 4


@pytest.mark.parametrize("status,code", [("COMPLETE", None), ("PARTIAL", "SOURCE_PROCESSING_PARTIAL"), ("FAILED", "SOURCE_RUN_FAILED")])
def test_codes(status, code):
    assert shards.CODES[status] == code
