"""The live tail over several triggers, each a new start from the state of the one before."""

import datetime as dt

from filingspark.operators.ledger import KEPT, RING, ring_start
from filingspark.streaming import tail


def _held(n):
    held = []
    for seq in range(1, n + 1):
        held.append(seq)
        if len(held) > RING:
            held = held[-KEPT:]
    return held


def test_ring_start_is_that_of_a_ring():
    for n in (1, RING, RING + 1, RING + 900, 2 * RING - KEPT + 1, 2 * RING - KEPT + 2, 12_345):
        held = _held(n)
        assert [s for s in range(1, n + 1) if s >= ring_start(n)] == held


def test_tail_replays_updates_keeps_alive_and_ends(spark, tmp_path):
    base = dt.datetime(2027, 1, 1, tzinfo=dt.timezone.utc)
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda s: base + dt.timedelta(seconds=s)
    event = lambda run, seq, s: (run, "event", seq, f"{run}{seq}", None, None, at(s))
    listen = lambda run, client, cursor, s: (run, "subscribe", None, None, client, cursor, at(s))

    def trigger(*rows):
        spark.createDataFrame(list(rows), tail.HAPPENINGS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(tail.HAPPENINGS).parquet(source)
        frames = tail.drain(tail.follow(stream, late="0 seconds"), folder).collect()
        out: dict = {}
        for f in frames:
            out.setdefault((f.run, f.client), []).append((f.event, f.id))
        return {k: sorted(v, key=lambda e: (e[0], e[1] or 0)) for k, v in out.items()}

    updates = lambda *ids: [("update", i) for i in ids]
    assert trigger(listen("r", "a", 1, 0), listen("q", "z", None, 0)) == {}
    got = trigger(event("r", 1, 1), event("r", 2, 1), event("r", 3, 2), event("r", 3, 2))
    assert got == {("r", "a"): updates(2, 3)}
    # The source reads an overlap again; another client comes back with a cursor.
    got = trigger(event("r", 2, 3), event("r", 3, 3), event("r", 4, 3), listen("r", "b", 3, 3))
    assert got == {("r", "a"): updates(2, 3, 4), ("r", "b"): updates(4)}
    # Twenty seconds later only q has news: r's listeners are told that it is alive.
    got = trigger(event("q", 1, 23))
    assert got[("q", "z")] == updates(1) and got[("r", "a")] == [("keep-alive", None), *updates(2, 3, 4)] and got[("r", "b")] == [("keep-alive", None), *updates(4)]
    # More events than the ring holds all reach who listens; who comes later gets what it still holds, and the end.
    trigger(*[event("r", k, 24) for k in range(5, RING + 100)])
    got = trigger(("r", "status", None, "partial", None, None, at(25)), listen("r", "c", 0, 25))
    assert [i for e, i in got[("r", "a")] if e == "update"] == list(range(2, RING + 100))
    assert got[("r", "c")] == [("done", RING + 99), *updates(*_held(RING + 99))] and ("done", RING + 99) in got[("r", "b")]
    # Nobody listens to r any more.
    assert len(trigger(event("r", RING + 100, 26))[("r", "c")]) == len(got[("r", "c")])
