"""A live tail of each run's events: replay after a cursor from a bounded ring, updates, keep-alives, an end."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ledger import ring_start

#: What happens to runs: an `event` (seq, data), a `status` (data), a `subscribe` (client, cursor) or a `leave` (client).
HAPPENINGS = "run string, kind string, seq bigint, data string, client string, cursor bigint, at timestamp"
FRAMES = "run string, client string, id bigint, event string, data string"
#: Statuses after which a run has no more events.
ENDED = ("completed", "partial", "failed", "interrupted")
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Tail(StatefulProcessor):
    """One run: its ring of events, its status and who listens, with the cursor of each."""

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "last bigint, status string, due bigint")
        self.ring = handle.getListState("ring", "seq bigint, data string")
        self.clients = handle.getMapState("clients", "client string", "cursor bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, status, due = self.head.get() if self.head.exists() else (0, None, None)
        held = {seq: data for seq, data in self.ring.get()} if self.ring.exists() else {}
        clients = {k[0]: v[0] for k, v in self.clients.iterator()} if self.clients.exists() else {}
        before, known, heard, seen = last, set(clients), 0, set(held)
        for frame in rows:
            out: list[tuple] = []
            heard = max(heard, int(frame["ms"].max()))
            kinds = {k: part for k, part in frame.groupby("kind")}
            for client, cursor in kinds["subscribe"][["client", "cursor"]].itertuples(index=False) if "subscribe" in kinds else ():
                cursor = 0 if pd.isna(cursor) else int(cursor)
                out += [(key[0], client, s, "update", held[s]) for s in sorted(held) if s > cursor]
                clients[client] = cursor
            for client in kinds["leave"]["client"] if "leave" in kinds else ():
                clients.pop(client, None)
            for seq, data in kinds["event"].sort_values("seq")[["seq", "data"]].itertuples(index=False) if "event" in kinds else ():
                seq = int(seq)
                # A repeat: met in this trigger or held, or let go before it.
                if seq in seen or seq < ring_start(before):
                    continue
                seen.add(seq)
                held[seq], last = data, max(last, seq)
                out += [(key[0], c, seq, "update", data) for c, cursor in clients.items() if seq > cursor]
            start = ring_start(last)
            held = {s: d for s, d in held.items() if s >= start}
            if "status" in kinds:
                status = kinds["status"].sort_values("ms")["data"].iloc[-1]
            if out:
                yield pd.DataFrame(out, columns=["run", "client", "id", "event", "data"])
        if status in ENDED and clients:
            yield self._told(key, clients, last, "done", status)
            clients = {}
        if due is not None:
            self.handle.deleteTimer(due)
        due = heard + self.wait if clients else None
        if due is not None:
            self.handle.registerTimer(due)
        for gone in known - set(clients):
            self.clients.removeKey((gone,))
        for client, cursor in clients.items():
            self.clients.updateValue((client,), (cursor,))
        if held:
            self.ring.put(sorted(held.items()))
        self.head.update((last, status, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, status, _ = self.head.get()
        due = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) + self.wait
        self.handle.registerTimer(due)
        self.head.update((last, status, due))
        yield self._told(key, [k[0] for k in self.clients.keys()], None, "keep-alive", None)

    def _told(self, key, clients, seq, event: str, data) -> pd.DataFrame:
        out = pd.DataFrame([(key[0], c, seq, event, data) for c in clients], columns=["run", "client", "id", "event", "data"])
        return out.astype({"id": "Int64"})

    def close(self) -> None:
        """Nothing is open."""


def follow(happenings: DataFrame, wait: int = 15_000, late: str = "10 seconds") -> DataFrame:
    """Frames (FRAMES) for who listens, from a stream of HAPPENINGS.

    A client gets what the ring holds after its cursor, then each new event once, whatever the source reads again;
    `keep-alive` after `wait` milliseconds of event time in which its run is quiet, once a trigger at most; `done` with
    the status once the run has ended and all events are out. What comes `late` or more after the newest happening
    of any run is lost, as in every stream with a watermark, so `late` must cover how late sources can be; keep-alives
    wait as much longer. A run's state is its ring, a few thousand events, and
    its clients; a trigger's sequence numbers of a run are in memory at once, so limit what the source gives a trigger.
    """
    rows = happenings.withColumn("ms", F.unix_millis("at")).withWatermark("at", late)
    return rows.groupBy("run").transformWithStateInPandas(statefulProcessor=Tail(wait), outputStructType=FRAMES, outputMode="Append", timeMode="EventTime")


def drain(frames: DataFrame, folder: str) -> DataFrame:
    """Run the stream over what is there by now, from where the folder's state left off; all frames so far."""
    spark = frames.sparkSession
    old = spark.conf.get(PROVIDER[0])
    spark.conf.set(*PROVIDER)
    try:
        query = frames.writeStream.format("parquet").option("path", f"{folder}/frames").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER[0], old)
    return spark.read.schema(frames.schema).parquet(f"{folder}/frames")
