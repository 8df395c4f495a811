"""Recorded pages of shards as a table and as a stream, and publishing to a folder: Python data sources.

A recorder writes pages below a folder as `seq=<number>/shard=<name>/<file>`, one JSON object a line with its
Replies and ResultCount; numbers only grow. A shard counts once its pages hold as many raw rows as it reports.
"""

from __future__ import annotations

import base64
import hashlib
import json
import pickle
import re
import uuid
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from .manifests import _files

PLACE = re.compile(r"seq=(\d+)/shard=([^/]+)/[^/_.][^/]*$")


def recorded(path: str) -> list[tuple[int, str, str]]:
    """(number, shard, file) of each page file, in order."""
    from pyarrow import fs

    files, folder = _files(path)
    if files.get_file_info(folder).type == fs.FileType.NotFound:
        return []
    found = files.get_file_info(fs.FileSelector(folder, recursive=True))
    places = ((PLACE.search(f.path), f.path) for f in found if f.type == fs.FileType.File)
    return sorted((int(m[1]), m[2], p) for m, p in places if m)


class Shard(InputPartition):
    """A shard's files up to the end of a batch, and the number up to which earlier batches have read."""

    def __init__(self, name: str, files: list[tuple[int, str]], start: int):
        super().__init__(name)
        self.name, self.files, self.start = name, files, start


def planned(path: str, start: int, end: int | None) -> list[Shard]:
    """The shards that have pages in (start, end], each with all its pages up to there: one that was incomplete is planned anew."""
    shards: dict[str, list[tuple[int, str]]] = {}
    for number, shard, file in recorded(path):
        if end is None or number <= end:
            shards.setdefault(shard, []).append((number, file))
    return [Shard(name, files, start) for name, files in sorted(shards.items()) if files[-1][0] > start]


def shard_rows(path: str, shard: Shard) -> Iterator[tuple]:
    """(shard, seq, ordinal, reported, payload) of a shard that is complete: all of them when it becomes so, later only what is new.

    What a batch gives depends only on where it starts and ends, so a batch that is run again gives the same.
    """
    files, _ = _files(path)
    rows, reported, before = [], 0, 0
    complete_before = False
    for number, file in shard.files:
        if number > shard.start and not before:
            before = len(rows) or -1
            complete_before = bool(shard.start) and before > 0 and len(rows) >= reported
        with files.open_input_stream(file) as f:
            for line in f.read().decode().splitlines():
                page = json.loads(line)
                reported = int(page.get("ResultCount") or 0)
                rows += [(number, json.dumps(r, ensure_ascii=False)) for r in page.get("Replies") or []]
    if len(rows) >= reported:
        first = max(before, 0) if complete_before else 0
        for k in range(first, len(rows)):
            yield shard.name, rows[k][0], k, reported, rows[k][1]


class ShardSource(DataSource):
    """spark.read.format("shards").load(folder), or readStream: rows of the complete shards of recorded pages."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> str:
        return "shard string, seq long, ordinal int, reported long, payload string"

    def reader(self, schema: object) -> DataSourceReader:
        return ShardReader(self.options["path"])

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return ShardStream(self.options["path"])


class ShardReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return planned(self.path, 0, None) or [Shard("", [], 0)]

    def read(self, partition: Shard) -> Iterator[tuple]:
        yield from shard_rows(self.path, partition) if partition.files else ()


class ShardStream(DataSourceStreamReader):
    """An offset is the number of the last recording that a batch has seen; Spark keeps it in the query's checkpoint."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"seq": 0}

    def latestOffset(self) -> dict:
        found = recorded(self.path)
        return {"seq": found[-1][0] if found else 0}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return planned(self.path, start["seq"], end["seq"]) or [Shard("", [], 0)]

    def read(self, partition: Shard) -> Iterator[tuple]:
        yield from shard_rows(self.path, partition) if partition.files else ()

    def commit(self, end: dict) -> None:
        pass


#: States of rows and runs, codes of runs.
READY, PARTIAL, FAILED, COMPLETE = "READY", "PARTIAL", "FAILED", "COMPLETE"
CODES = {COMPLETE: None, PARTIAL: "SOURCE_PROCESSING_PARTIAL", FAILED: "SOURCE_RUN_FAILED"}


def accept(batch: list[dict]) -> list[dict]:
    """A remote that takes all rows: an id and READY for each."""
    return [{"external_id": r["external_id"], "internal_id": hashlib.sha256(r["external_id"].encode()).hexdigest()[:16], "status": READY} for r in batch]


#: Answers that a task keeps before it writes them to a file.
ANSWERS = 20_000


class Sent(WriterCommitMessage):
    def __init__(self, files: list[str], counts: dict[str, int]):
        self.files, self.counts = files, counts


class PublishSink(DataSource):
    """df.write.format("publish"): rows (batch, external_id, payload), sorted by batch, sent batch by batch.

    Options: path, run, and remote, a pickled function from a batch's rows to their answers (external_id, internal_id,
    status). A row without an answer is PARTIAL. A task writes its answers to files of some ANSWERS rows, each named by run
    and its first batch, so that a task that runs again replaces what it wrote. The run's own file is written last and names the files that
    count; if any task fails for good it says FAILED and names none.
    """

    @classmethod
    def name(cls) -> str:
        return "publish"

    def writer(self, schema: object, overwrite: bool) -> DataSourceWriter:
        return PublishWriter(self.options["path"], self.options["run"], self.options.get("remote"))


class PublishWriter(DataSourceWriter):
    def __init__(self, path: str, run: str, remote: str | None):
        self.path, self.run, self.remote = path.rstrip("/"), run, remote

    def write(self, rows: Iterator) -> Sent:
        send: Callable = pickle.loads(base64.b64decode(self.remote)) if self.remote else accept
        names: list[str] = []
        counts: dict[str, int] = {}
        lines: list[str] = []
        now: list[dict] = []

        def flush() -> None:
            got = {a["external_id"]: a for a in send(now)}
            for r in now:
                a = got.get(r["external_id"]) or {"external_id": r["external_id"], "internal_id": None, "status": PARTIAL}
                lines.append(json.dumps({"batch": r["batch"], "external_id": r["external_id"], "internal_id": a["internal_id"], "status": a["status"]}) + "\n")
                counts[a["status"]] = counts.get(a["status"], 0) + 1

        def keep(first: str) -> None:
            name = f"answers/{self.run}/{hashlib.sha256(str(first).encode()).hexdigest()[:24]}.jsonl"
            self._put(name, "".join(lines))
            names.append(name)
            lines.clear()

        first = None
        for row in rows:
            r = row.asDict()
            if now and r["batch"] != now[0]["batch"]:
                flush()
                now.clear()
                if len(lines) >= ANSWERS:
                    keep(first)
                    first = None
            first = r["batch"] if first is None else first
            now.append(r)
        if now:
            flush()
            keep(first)
        return Sent(names, counts)

    def _put(self, name: str, text: str) -> None:
        """A file that is there whole or not at all."""
        files, root = _files(self.path)
        folder, last = f"{root}/{name}".rsplit("/", 1)
        files.create_dir(folder, recursive=True)
        new = f"{folder}/_{uuid.uuid4().hex}"
        with files.open_output_stream(new) as f:
            f.write(text.encode())
        files.move(new, f"{folder}/{last}")

    def commit(self, messages: list[Sent | None]) -> None:
        counts: dict[str, int] = {}
        for m in messages:
            for k, n in (m.counts if m else {}).items():
                counts[k] = counts.get(k, 0) + n
        status = COMPLETE if counts.keys() <= {READY} else PARTIAL
        self._finish(status, counts, [f for m in messages if m for f in m.files])

    def abort(self, messages: list[Sent | None]) -> None:
        self._finish(FAILED, {}, [])

    def _finish(self, status: str, counts: dict[str, int], files: list[str]) -> None:
        self._put(f"runs/{self.run}.json", json.dumps({"run": self.run, "status": status, "error_code": CODES[status], "ready": counts.get(READY, 0), "partial": sum(n for k, n in counts.items() if k != READY), "files": files}) + "\n")


def publish(rows: DataFrame, path: str, run: str, remote: Callable[[list[dict]], list[dict]] | None = None) -> str:
    """Send rows (batch, external_id, payload) and return the run's status; an error of the remote fails the run, not the caller."""
    rows.sparkSession.dataSource.register(PublishSink)
    out = rows.select("batch", "external_id", "payload").repartition("batch").sortWithinPartitions("batch", "external_id").write.format("publish").mode("append").option("path", path).option("run", run)
    if remote is not None:
        out = out.option("remote", base64.b64encode(cloudpickle.dumps(remote)).decode())
    try:
        out.save()
    except Exception:
        if run_report(rows.sparkSession, path, run)["status"] != FAILED:
            raise
    return run_report(rows.sparkSession, path, run)["status"]


def run_report(spark: SparkSession, path: str, run: str) -> dict:
    """What a run's file says."""
    files, root = _files(path.rstrip("/"))
    with files.open_input_stream(f"{root}/runs/{run}.json") as f:
        return json.loads(f.read())


def outcomes(sent: DataFrame, path: str, run: str) -> DataFrame:
    """sent (external_id) with internal_id and status: as answered, PARTIAL without an answer, FAILED for all rows of a run that failed."""
    spark = sent.sparkSession
    report = run_report(spark, path, run)
    if report["status"] == FAILED:
        return sent.withColumn("internal_id", F.lit(None).cast("string")).withColumn("status", F.lit(FAILED))
    schema = "batch string, external_id string, internal_id string, status string"
    files = [f"{path.rstrip('/')}/{f}" for f in report["files"]]
    answers = spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
    answers = answers.groupBy("external_id").agg(F.max("internal_id").alias("internal_id"), F.min("status").alias("status"))
    return sent.join(answers, "external_id", "left").withColumn("status", F.coalesce("status", F.lit(PARTIAL)))


def read_recordings(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Run a stream of shards over what has been recorded so far; a later call goes on where this one ended."""
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
