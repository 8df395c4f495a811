"""SimHash near-duplicates by BK-trees.

Fingerprints within r bits share at least two of r + 2 blocks of bits exactly. So all fingerprints are
dealt into shards by the values of two blocks; each shard is a BK-tree, whose children are keyed by their
integer Hamming distance to the parent, and a search follows only edges within the radius. What a shard of
more than SLICE fingerprints has left of r + 1 further blocks deals it into smaller ones; what is still
larger is cut into parts, and each two parts meet in a task of their own, one as tree and one as queries.
Shards yield spanning edges, never all pairs; stars of those edges give the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach_groups, cut, own_columns, texts

BITS = 64
SEED = 42
#: Fingerprints of a tree at most, and queries that are put to it at once.
SLICE = 4096

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of each shingle of lower-cased (A-Z) words, repeats included; fewer words: the whole sequence."""
    words = text.lower().split()
    if not words:
        return []
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [h(b" ".join(words), SEED)]
    if width == 3:
        return [h(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:], strict=False)]
    return [h(b" ".join(words[i : i + width]), SEED) for i in range(len(words) - width + 1)]


def simhash(text: bytes, width: int = 3) -> int:
    """A bit is 1 if set in over half the hashes; no words: zero."""
    hashes = np.array(shingle_hashes(text, width), np.uint64)
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    out = 0
    for k in range(8):
        ones = np.bincount(lanes[:, k], minlength=256) @ _BYTE_BITS
        out |= int(np.packbits(2 * ones > len(hashes), bitorder="little")[0]) << (8 * k)
    return out


def simhash_udf(width: int = 3):
    @F.arrow_udf("bigint")
    def fingerprint(arr: pa.Array) -> pa.Array:
        out = np.array([simhash(t, width) for t in texts(arr)], np.uint64)
        return pa.array(out.view(np.int64), pa.int64())

    return fingerprint


class BKTree:
    """A BK-tree over distinct fingerprints, built and searched for many queries at once.

    Putting fingerprints in one by one gives the same tree: of those at one distance from a node,
    the first is its child and the others go below that child.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: list[list[tuple[int, int]]] = [[] for _ in values]
        todo = [np.arange(len(values))] if len(values) else []
        while todo:
            members = todo.pop()
            node, rest = members[0], members[1:]
            if not len(rest):
                continue
            away = np.bitwise_count(values[rest] ^ values[node])
            order = np.argsort(away, kind="stable")
            rest, away = rest[order], away[order]
            for group in np.split(rest, np.flatnonzero(np.diff(away)) + 1):
                self.children[node].append((int(np.bitwise_count(values[group[0]] ^ values[node])), int(group[0])))
                todo.append(group)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, places of the queries within the radius of it), for each node that has some."""
        todo = [(0, np.arange(len(queries)))] if len(self.values) and len(queries) else []
        while todo:
            node, asking = todo.pop()
            away = np.bitwise_count(queries[asking] ^ self.values[node]).astype(np.int16)
            near = asking[away <= radius]
            if len(near):
                yield node, near
            for edge, child in self.children[node]:
                down = asking[np.abs(away - edge) <= radius]
                if len(down):
                    todo.append((child, down))


def spanning_edges(values: np.ndarray, tree: np.ndarray, asking: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (places of values) that join what links between the fingerprints at the places `tree` and those at `asking` join."""
    if len(values) == 2:
        return [(0, 1)] if int(np.bitwise_count(values[0] ^ values[1])) <= radius else []
    parent = np.arange(len(values))

    def roots(x: np.ndarray) -> np.ndarray:
        r = parent[x]
        while (parent[r] != r).any():
            r = parent[r]
        parent[x] = r
        return r

    for node, near in BKTree(values[tree]).search(values[asking], radius):
        found = np.unique(roots(np.append(asking[near], tree[node])))
        parent[found] = found[0]
    ends = roots(np.arange(len(values)))
    return [(i, int(r)) for i, r in enumerate(ends.tolist()) if i != r]


def groups_of(batches: Iterator[pa.RecordBatch], keys: int, most: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, rows) of consecutive rows with equal values in the first `keys` columns; rows holds all columns as 64-bit integers.

    A group of more than `most` rows comes in pieces, all but its last of more than that.
    """
    carry, held, size = None, [], 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        table = np.stack([batch.column(k).cast(pa.int64()).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)], 1)
        own = table[:, :keys]
        starts = np.append(np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(1))), n).tolist()
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(own[s].tolist())
            if held and (key != carry or size > most):
                yield carry, np.concatenate(held)
                held, size = [], 0
            carry = key
            held.append(table[s:e])
            size += e - s
    if held:
        yield carry, np.concatenate(held)


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(edges, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])


def _shard_edges(radius: int, most: int):
    """Reads rows (block, value, fp) sorted by the first two; yields edges (u, v), or (block, fp) with `large` for shards that are too large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, edges = None, []
        for key, rows in groups_of(batches, 2, most):
            if len(rows) > most or key == last:
                last = key
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 2]), pa.array(np.ones(len(rows), bool))], ["u", "v", "large"])
            elif len(rows) > 1:
                prints = np.sort(rows[:, 2].view(np.uint64))
                places = np.arange(len(prints))
                signed = prints.view(np.int64).tolist()
                edges += [(signed[i], signed[j]) for i, j in spanning_edges(prints, places, places, radius)]
            if len(edges) >= most:
                yield _edge_batch(edges).append_column("large", pa.array(np.zeros(len(edges), bool)))
                edges = []
        if edges:
            yield _edge_batch(edges).append_column("large", pa.array(np.zeros(len(edges), bool)))

    return run


def _cell_edges(radius: int):
    """Reads rows (block, value, left, right, fp, part) sorted by the first four, the fingerprints of two parts or of one; yields edges (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, left, right), rows in groups_of(batches, 4, 1 << 62):
            rows = rows[np.argsort(rows[:, 4].view(np.uint64), kind="stable")]
            prints, parts = rows[:, 4].copy().view(np.uint64), rows[:, 5]
            found = spanning_edges(prints, np.flatnonzero(parts == left), np.flatnonzero(parts == right), radius)
            if found:
                signed = prints.view(np.int64).tolist()
                yield _edge_batch([(signed[i], signed[j]) for i, j in found])

    return run


def _bits(ranges: list[tuple[int, int]]) -> str:
    """The bits of fp in some ranges (from, to), one after the other."""
    out, size = [], 0
    for low, high in ranges:
        out.append(f"shiftleft(shiftrightunsigned(fp, {low}) & {(1 << (high - low)) - 1}L, {size})")
        size += high - low
    return " | ".join(out)


def cells(rows: DataFrame, keys: list[str], item: str, most: int) -> DataFrame:
    """rows with part, left and right: those of a group of at most `most` in one cell (0, 0); a larger group is cut into
    parts by a digest of `item`, and each two of them, and each by itself, are a cell."""
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_group")).where(F.col("in_group") > most)
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    rows = rows.join(large, keys, "left").withColumn("parts", F.coalesce(F.ceil(F.col("in_group") * 2 / most), F.lit(1)).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(item), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumn("left", F.least("part", "other")).withColumn("right", F.greatest("part", "other")).drop("in_group", "parts", "other")


def near_edges(nodes: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) whose components are those of all links of at most `radius` bits between nodes.fp."""
    n = radius + 2
    blocks = [(BITS * k // n, BITS * (k + 1) // n) for k in range(n)]
    pairs = list(combinations(range(n), 2))
    keys = ", ".join(f"struct({k} as block, {_bits([blocks[i] for i in pair])} as value)" for k, pair in enumerate(pairs))
    rows = nodes.selectExpr(f"inline(array({keys}))", "fp").select("block", "value", "fp")
    dealt = rows.repartition("block", "value").sortWithinPartitions("block", "value")
    found = cut(dealt.mapInArrow(_shard_edges(radius, SLICE), "u bigint, v bigint, large boolean"), "shard_edges")
    edges = found.where("not large").select("u", "v")
    large = found.where("large").selectExpr("cast(u as int) as block", "v as fp")
    if not large.limit(1).count():
        return edges

    # Of the bits that aren't in a large shard's key, radius + 1 blocks: two within the radius share one of them.
    def deeper(pair: tuple[int, int]) -> str:
        left = [b for k, b in enumerate(blocks) if k not in pair]
        bits = [k for low, high in left for k in range(low, high)]
        cuts = [len(bits) * k // (radius + 1) for k in range(radius + 2)]
        key = [blocks[i] for i in pair]
        return "array(" + ", ".join(f"struct({k} as below, {_bits([*key, *_runs(bits[a:b])])} as value)" for k, (a, b) in enumerate(zip(cuts, cuts[1:]))) + ")"

    chosen = "case block " + " ".join(f"when {k} then {deeper(pair)}" for k, pair in enumerate(pairs)) + " end"
    rows = large.selectExpr("block", "fp", f"inline({chosen})").select((F.col("block") * (radius + 1) + F.col("below")).alias("block"), "value", "fp")
    rows = cells(rows, ["block", "value"], "fp", SLICE).select("block", "value", "left", "right", "fp", "part")
    dealt = rows.repartition("block", "value", "left", "right").sortWithinPartitions("block", "value", "left", "right")
    return edges.unionByName(dealt.mapInArrow(_cell_edges(radius), "u bigint, v bigint"))


def _runs(bits: list[int]) -> list[tuple[int, int]]:
    """Ranges (from, to) of consecutive numbers."""
    out: list[tuple[int, int]] = []
    for k in bits:
        if out and out[-1][1] == k:
            out[-1] = (out[-1][0], k + 1)
        else:
            out.append((k, k + 1))
    return out


def settled(edges: DataFrame) -> DataFrame:
    """components() of edges (u, v); up to BROADCAST_ROWS of them are joined in one task, which saves the rounds."""
    edges = cut(edges.where("u <> v").distinct(), "edges")
    if edges.count() > BROADCAST_ROWS:
        return components(edges)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high = sorted((root(u), root(v)))
                parent[high] = low
        if parent:
            nodes = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "root"])

    return edges.coalesce(1).mapInArrow(join, "node bigint, root bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component; only nodes that have edges.

    Large-star and small-star steps, each round in a table of its own, until the edges stay the same. The
    centre of a large star is joined by broadcast, so that its rows stay where they are.
    """
    now = cut(edges.where("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "edges")
    mark = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before, after = None, mark(now)
    while after[0] and after != before:
        both = now.unionByName(now.selectExpr("v as u", "u as v"))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n_rows")).selectExpr("u", "least(u, m) as m", "n_rows"), "lows")
        large = cut(attach_groups(both.where("v > u"), low, "u").selectExpr("v as u", "m as v").where("u <> v").distinct(), "stars")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n_rows")), "lows")
        small = attach_groups(large, low, "u").where("v <> m").selectExpr("v as u", "m as v").unionByName(low.selectExpr("u", "m as v"))
        now = cut(small.distinct(), "stars")
        before, after = after, mark(now)
    return now.selectExpr("u as node", "v as root").unionByName(now.selectExpr("v as node", "v as root").distinct())


def linked_rows(rows: DataFrame, linked: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows (doc_id, fp and others) with component_id, the smallest doc_id that links of fp reach; linked: nodes (fp) to their components (node, root)."""
    slim = cut(rows, "simhash")
    nodes = cut(slim.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n_rows")), "nodes")
    stars = cut(linked(nodes.select("fp")), "components")
    joined = nodes.join(stars, nodes.fp == stars.node, "left").select("fp", "low", F.col("n_rows").alias("n"), F.coalesce("root", "fp").alias("root"))
    joined = cut(joined, "linked")
    lows = joined.groupBy("root").agg(F.min("low").alias("all_low"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    named = attach_groups(joined, cut(lows, "lows"), "root", "left")
    named = named.select("fp", F.col("n").alias("n_rows"), "root", F.when(F.col("n_rows").isNull(), F.col("low")).otherwise(F.col("all_low")).alias("component_id"))
    return attach_groups(slim, cut(named, "named"), "fp").drop("n_rows")


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of docs (doc_id, text).

    Fingerprints link at `radius` or fewer differing bits; component_id is the smallest doc_id that
    links reach. Null and empty texts have fingerprint zero and link like any other. Repeated rows are
    each returned; a null doc_id is never a component_id unless its component has no other id.
    An empty table gives no rows; columns other than doc_id and text aren't read.
    """
    rows = own_columns(docs, doc_id=F.col("doc_id"), fp=simhash_udf(width)(F.coalesce(F.col("text"), F.lit(""))))
    return linked_rows(rows, lambda nodes: settled(near_edges(nodes, radius))).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
