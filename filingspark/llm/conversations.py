"""Conversation structure repair: the cheapest edits that make turns a well-formed conversation.

A node of the lattice is (index of the next turn, state of the grammar); edits are its edges. Dijkstra's search
takes nodes by (cost, audit), where the audit is the edits' initials so far, and stops at the first accepting end
node. The lattice is implicit: edges are made when a node is popped.

The first edits of a path are never a proper beginning of another path's to the same node at the same cost, as
what leads from a node back to itself inserts turns, which costs. So the best way through a run of turns depends
only on the states before and after it, and runs can be searched apart. Rows are sorted once over all tasks; a task
cuts them into pieces of bounded size. A conversation that is one piece is finished there. Others, however many
tasks they lie in, give for each piece the best way between each two states; a second search goes over pieces.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, cut, own_columns, small_batches

SPACES = " \t\n\x0b\x0c\r"
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after the system's turn, after the user's, after the assistant's. What may come next, and the state after it.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLES = {"u": "user", "a": "assistant"}
ACCEPTING = (0, 3)
LEGAL = ("su", "ua", "au")
#: Rows, and characters of texts, of a piece.
PIECE_ROWS, PIECE_SIZE = 1024, 1 << 20
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def damaged(turns: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) of a test set: a digest of conv_id and turn drops, empties, cuts, repeats or renames some. Nulls are one space."""
    space = F.lit(" ")
    rows = own_columns(turns, conv_id=F.col("conv_id"), turn=F.col("turn"), role=F.coalesce(F.col("role"), space), text=F.coalesce(F.col("text"), space))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("kind", F.crc32(key.cast("binary")) % 20).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def faults(turns: DataFrame) -> DataFrame:
    """turns with each row's first fault and a number of the row; `seen` is the first row of like role and text, for all that occur again.

    Texts that occur again meet by a digest; those that are frequent by broadcast, so one that a third of the rows share is never one task's.
    """
    turns = turns.select("conv_id", "turn", F.make_valid_utf8("role").alias("role"), F.make_valid_utf8("text").alias("text"))
    text = F.btrim("text", F.lit(SPACES))
    fault = F.when(text == "", BLANK).when(~F.substring(text, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN)
    parts = [F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")]
    rows = turns.select("conv_id", "turn", "role", "text", fault.alias("fault"), F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256)).alias("digest"))
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "turns")
    again = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n_rows"), F.min(F.struct("turn", "row")).alias("seen")).where("n_rows > 1")
    rows = attach_groups(rows, cut(again, "again"), "digest", "left")
    repeated = (F.col("fault") != BLANK) & F.col("seen").isNotNull() & (F.col("seen.row") != F.col("row"))
    return rows.select("conv_id", "turn", "role", "text", F.when(repeated, DUPLICATE).otherwise(F.col("fault")).alias("fault"), "digest", "row")


def edges(state: int, turn: tuple[str, int] | None) -> Iterator[tuple[str, int, int, int]]:
    """(initial, cost, turns used, state after) of each edit; turn: initial of the role and fault, None at the end."""
    if turn is not None:
        initial, fault = turn
        yield "D", DELETE, 1, state
        if fault not in (BLANK, DUPLICATE):
            more = LEFT_TRUNCATED if fault == TRUNCATED else 0
            if initial in NEXT[state]:
                yield "K", more, 1, NEXT[state][initial]
            for role in NEXT[state].keys() & ROLES.keys():
                yield "R", REROLE + more, 1, NEXT[state][role]
    for role in NEXT[state].keys() & ROLES.keys():
        yield "I", INSERT, 0, NEXT[state][role]


def cheapest(turns: list[tuple[str, int]], start: int = 0, goals: tuple[int, ...] | None = ACCEPTING) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the best way through turns: to the first popped of the goals, or if goals is None to each state."""
    heap, done, out = [(0, "", 0, start)], set(), {}
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns):
            if goals is None:
                out[state] = (cost, audit)
            elif state in goals:
                return {state: (cost, audit)}
        for initial, price, used, after in edges(state, turns[i] if i < len(turns) else None):
            if (i + used, after) not in done:
                heapq.heappush(heap, (cost + price, audit + initial, i + used, after))
    return out


def repaired(roles: list[str], texts: list[str], audit: str, state: int) -> list[str]:
    """`role:text` of each turn after the edits, from a state on."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            initial, role, text = roles[at][:1], roles[at], texts[at]
        else:
            initial = next(iter(NEXT[state].keys() & ROLES.keys()))
            role, text = ROLES[initial], "" if edit == "I" else texts[at]
        state = NEXT[state][initial]
        at += edit != "I"
        out.append(f"{role}:{text}")
    return out


class Piece:
    """Turns of one conversation that follow each other."""

    def __init__(self, conv_id: object):
        self.conv_id, self.roles, self.texts, self.faults, self.turns, self.size = conv_id, [], [], [], [], 0

    def add(self, turn: object, role: str, text: str, fault: int) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.turns.append(turn)
        self.size += len(text) + len(role)

    def full(self) -> bool:
        return len(self.roles) >= PIECE_ROWS or self.size >= PIECE_SIZE

    def counts(self) -> dict:
        initials = [r[:1] for r in self.roles]
        known = [t for t in self.turns if t is not None]
        return {
            "blank": self.faults.count(BLANK),
            "duplicate": self.faults.count(DUPLICATE),
            "truncated": self.faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "first_role": initials[0],
            "last_role": initials[-1],
            "low": min(known, default=None),
            "high": max(known, default=None),
            "n_turns": len(set(known)),
        }

    def lattice(self) -> list[tuple[str, int]]:
        return [(r[:1], f) for r, f in zip(self.roles, self.faults, strict=True)]


def bounded(x: int) -> int:
    return min(max(x, LOWEST), HIGHEST)


def gaps(low: int | None, high: int | None, n: int) -> int:
    return 0 if low is None else bounded(high - low + 1 - n)


WAYS = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
COUNTS = [("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("n_turns", pa.int64())]
PIECES = [("piece", pa.int64()), *COUNTS, ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()), ("ways", WAYS), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
PIECES_DDL = (
    "piece long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, low long, high long, n_turns long, cost long, audit string, sha string, "
    "ways array<struct<before: int, after: int, cost: bigint, audit: string>>, roles array<string>, texts array<string>"
)


def searcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, turn, role, text, fault) to pieces; a conversation that can't go on in another task and is one piece is finished."""
    number = TaskContext.get().partitionId() << 33
    held: list[dict] = []
    size = 0
    kind: pa.DataType | None = None

    def closed(p: Piece, whole: bool) -> dict:
        nonlocal number
        number += 1
        row = {"conv_id": p.conv_id, "piece": number, **p.counts(), "cost": None, "audit": None, "sha": None, "ways": None, "roles": None, "texts": None}
        if whole:
            row["cost"], row["audit"] = next(iter(cheapest(p.lattice()).values()))
            row["sha"] = hashlib.sha256("\n".join(repaired(p.roles, p.texts, row["audit"], 0)).encode("utf-8", "surrogatepass")).hexdigest()
        else:
            turns = p.lattice()
            row["ways"] = [{"before": s, "after": e, "cost": c, "audit": a} for s in range(len(NEXT)) for e, (c, a) in cheapest(turns, s, None).items()]
            row["roles"], row["texts"] = p.roles, p.texts
        return row

    def flush() -> pa.RecordBatch:
        nonlocal size
        fields = [("conv_id", kind), *PIECES]
        out = pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], t) for n, t in fields], [n for n, _ in fields])
        held.clear()
        size = 0
        return out

    now: Piece | None = None
    open_ = True  # the conversation may have begun before this piece
    for b in batches:
        kind = b.schema.field(0).type
        for conv, turn, role, text, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is not None and (conv != now.conv_id or now.full()):
                same = conv == now.conv_id
                held.append(closed(now, not open_ and not same))
                size += now.size if held[-1]["roles"] is not None else 0
                now, open_ = None, same
                if size >= PIECE_SIZE or len(held) >= 1000:
                    yield flush()
            if now is None:
                now = Piece(conv)
            now.add(turn, role, text, fault)
    if now is not None:
        held.append(closed(now, False))
        yield flush()


def joiner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (conv_id, piece, ways) of conversations, in order, to conv_id, cost, audit and the state before and after each piece.

    The search over pieces keeps one way to each state, so its memory is a few times the audit that it returns.
    """
    conv, best, seen = None, None, False

    def result(kind: pa.DataType) -> pa.RecordBatch:
        cost, audit, node = min((best[s] for s in ACCEPTING if s in best), key=lambda x: x[:2])
        steps = []
        while node is not None:
            steps.append(node[0])
            node = node[1]
        steps.reverse()
        cols = [([conv], kind), ([cost], pa.int64()), ([audit], pa.string()), ([[{"piece": p, "before": s, "after": e} for p, s, e in steps]], pa.list_(pa.struct([("piece", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])))]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in cols], ["conv_id", "cost", "audit", "steps"])

    kind = pa.int64()
    for b in batches:
        kind = b.schema.field(0).type
        for c, piece, ways in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if not seen or c != conv:
                if seen:
                    yield result(kind)
                conv, best, seen = c, {0: (0, "", None)}, True
            nxt: dict[int, tuple] = {}
            for w in ways:
                if w["before"] in best:
                    cost, audit, node = best[w["before"]]
                    cost, audit = cost + w["cost"], audit + w["audit"]
                    if w["after"] not in nxt or (cost, audit) < nxt[w["after"]][:2]:
                        nxt[w["after"]] = (cost, audit, ((piece, w["before"], w["after"]), node))
            best = nxt
    if seen:
        yield result(kind)


OUT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string())]
OUT_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha string"


def hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order with the state before and the audit of each to one row a conversation; texts stream through the digest."""
    conv, total, digest, first, seen = None, {}, None, True, False
    kind = pa.int64()

    def result() -> pa.RecordBatch:
        row = [total["gaps"], *(total[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost", "audit")), digest.hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), *(pa.array([x], t) for x, (_, t) in zip(row, OUT, strict=True))], ["conv_id", *(n for n, _ in OUT)])

    for b in batches:
        for i in range(b.num_rows):
            row = {n: b.column(j)[i].as_py() for j, n in enumerate(b.schema.names)}
            if not seen or row["conv_id"] != conv:
                if seen:
                    yield result()
                kind = b.schema.field(0).type
                conv, digest, first, seen = row["conv_id"], hashlib.sha256(), True, True
                total = {k: 0 for k in ("blank", "duplicate", "truncated", "illegal", "n_turns")} | {"cost": row["total_cost"], "audit": row["total_audit"], "low": None, "high": None, "last": None}
            for k in ("blank", "duplicate", "truncated", "illegal", "n_turns"):
                total[k] += row[k]
            if total["last"] is not None:
                total["illegal"] += total["last"] + row["first_role"] not in LEGAL
            total["last"] = row["last_role"]
            if row["low"] is not None:
                total["n_turns"] -= row["low"] == total["high"]  # a turn that goes on in the next piece
                total["low"], total["high"] = row["low"] if total["low"] is None else total["low"], row["high"]
            total["gaps"] = gaps(total["low"], total["high"], total["n_turns"])
            for line in repaired(row["roles"], row["texts"], row["way"], row["before"]):
                digest.update(("" if first else "\n").encode() + line.encode("utf-8", "surrogatepass"))
                first = False
    if seen:
        yield result()


def repair(turns: DataFrame, everyone: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conversation of everyone (conv_id; else of turns).

    turns: conv_id, turn, role, text, none of the last two null. Turns are read in order, nulls first; rows of one turn by role,
    then by the SHA-256 of conversation, role and text, so equal rows are neighbours. A turn that occurs again is the
    same row twice: the second is a duplicate. The null conv_id is a conversation. One without turns has zeros, an empty
    audit and the empty text's hash. An empty table gives no rows; other columns aren't read. Turns so far apart that
    gaps exceed a long show the largest one. Bytes that aren't UTF-8 are read as replacement characters.

    A conversation of any size is searched piece by piece over all tasks. Only its SHA-256, which is sequential, and
    its audit, which is one value, are put together in one task, through which pieces stream.
    """
    spark = turns.sparkSession
    small_batches(spark)
    kind = dict(turns.dtypes)["conv_id"]
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    rows = faults(turns).repartitionByRange(*order).sortWithinPartitions(*order)
    slim = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "fault")
    pieces = cut(slim.mapInArrow(searcher, f"conv_id {kind}, {PIECES_DDL}"), "pieces")
    n_gaps = F.when(F.col("low").isNull(), 0).otherwise(F.expr("cast(least(cast(high as decimal(38,0)) - low + 1 - n_turns, 9223372036854775807) as bigint)"))
    whole = pieces.where("ways is null").select("conv_id", n_gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha")
    parts = pieces.where("ways is not null")
    by_conv = lambda d: d.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    steps = "array<struct<piece: bigint, before: int, after: int>>"
    joined = cut(by_conv(parts.select("conv_id", "piece", "ways")).mapInArrow(joiner, f"conv_id {kind}, cost long, audit string, steps {steps}"), "joined")
    chosen = joined.select(F.col("cost").alias("total_cost"), F.col("audit").alias("total_audit"), F.posexplode("steps").alias("at", "s"))
    first = F.col("at") == 0
    chosen = chosen.select(F.when(first, F.col("total_cost")).alias("total_cost"), F.when(first, F.col("total_audit")).alias("total_audit"), "s.*")
    way = F.element_at(F.filter("ways", lambda w: (w["before"] == F.col("before")) & (w["after"] == F.col("after"))), 1)["audit"]
    edited = parts.drop("cost", "audit", "sha").join(chosen, "piece").withColumn("way", way).drop("ways", "after")
    slow = by_conv(edited.select("conv_id", *[c for c in edited.columns if c != "conv_id"])).mapInArrow(hasher, f"conv_id {kind}, {OUT_DDL}")
    found = whole.unionByName(slow)
    names = (everyone if everyone is not None else turns).select(F.col("conv_id").alias("name")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return names.join(found, F.col("name").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("name").alias("conv_id"),
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def conversation_repair(conversations: DataFrame) -> DataFrame:
    """repair() of a damaged copy of conversations; every conv_id comes back, also one that lost all turns."""
    return repair(damaged(conversations), conversations)
