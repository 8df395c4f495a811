"""Near copies by SimHash, verified by exact similarity of word shingles.

Texts are sets of five-word shingles, each with a SimHash fingerprint. Texts of a similarity of 0.8 differ in
about 10 of 64 bits, too many to deal them into shards by blocks of bits, so bands of MinHashes deal them. Each
shard is a BK-tree with its smallest text as root: texts within the radius of a root are its candidates first, each
for one of its roots, then for others that this has not joined it with.
Only shards that this leaves in several components are searched further, with the least LEAST hashes of each shingle
set. Of texts with no more shingles than that these are the whole sets: the task that holds a shard compares them
exactly and gives the edges that join what is similar, at most one a text. Of longer texts they are an estimate: first
each text outside of the largest component is compared with its likeliest partner, then with all that may be similar.
A pair of candidates links only if the exact Jaccard similarity of its shingle sets reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach_groups, cut, own_columns, texts, without
from .simhash import BKTree, cells, groups_of, linked_rows, settled, shingle_hashes

WIDTH = 5
SIMILARITY = 0.8
#: Bits in which the fingerprints of candidates may differ; 0.01 percent of pairs at 0.8 differ in more.
RADIUS = 20
#: A pair at a similarity of s shares no shard with a probability of (1 - s**ROWS)**BANDS: 0.00007 at 0.8.
BANDS, ROWS = 18, 4
#: Texts of a tree at most, and queries that are put to it at once.
SLICE = 4096
#: The least hashes of a set that are kept, and by how much the estimate from them may fall short of the similarity:
#: 3.7 standard deviations, which 0.01 percent of pairs at 0.8 exceed.
LEAST, SHORT = 256, 0.0925
#: Shingles of a text that are hashed at once.
BLOCK = 2048
#: Pairs of one text that meet in a task.
PAIRS = 500

_rng = np.random.default_rng(20240229)
_ADD = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_TIMES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Hashes of the distinct shingles, sorted."""
    return np.unique(np.array(shingle_hashes(text, width), np.uint64))


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of two shingle sets; texts without words are equal."""
    shared = len(np.intersect1d(left, right, assume_unique=True))
    joint = len(left) + len(right) - shared
    return shared / joint if joint else 1.0


def lowest(hashes: np.ndarray, n: int) -> np.ndarray:
    """The lowest of some hashes under each of n permutations."""
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), BLOCK):
        low = np.minimum(low, ((hashes[at : at + BLOCK, None] ^ _ADD[:n]) * _TIMES[:n]).min(0))
    return low


def sketch(text: bytes, width: int = WIDTH) -> list[int]:
    """The number of distinct shingles, their SimHash, then one key for each band."""
    hashes = shingle_set(text, width)
    lanes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    own = np.packbits(2 * lanes.sum(0, dtype=np.int64) > len(hashes), bitorder="little").view(np.int64)
    rows = lowest(hashes, BANDS * ROWS).reshape(BANDS, ROWS)
    keys = np.array([xxhash.xxh64_intdigest(rows[k].tobytes(), k) for k in range(BANDS)], np.uint64)
    return [len(hashes), int(own[0]), *keys.view(np.int64).tolist()]


def least_udf(width: int):
    """The LEAST smallest hashes of the shingle set, sorted, eight bytes each; the whole set if it has no more."""

    @F.arrow_udf("binary")
    def least(arr: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t, width)[:LEAST].tobytes() for t in texts(arr)], pa.binary())

    return least


def sketch_udf(width: int):
    @F.arrow_udf("array<bigint>")
    def sketches(arr: pa.Array) -> pa.Array:
        return pa.array([sketch(t, width) for t in texts(arr)], pa.list_(pa.int64()))

    return sketches


def similar_udf(width: int, threshold: float):
    """Whether two texts are similar. Texts move, not hashes: those don't compress, and moving them took more memory than hashing again."""

    @F.arrow_udf("boolean")
    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, own = None, None
        for left, right in batches:
            out = []
            for u, v in zip(texts(left), texts(right), strict=True):
                if u != last:
                    last, own = u, shingle_set(u, width)
                out.append(similarity(own, shingle_set(v, width)) >= threshold)
            yield pa.array(out, pa.bool_())

    return similar


def verified(pairs: DataFrame, docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs (u, v) whose texts in docs (fp, text) are similar.

    Only texts of pairs are moved. A text of many pairs is copied for each PAIRS of them, so that no task gets
    all of one; texts are never broadcast.
    """
    pairs = cut(pairs.distinct(), "near_pairs")
    ends = pairs.groupBy(F.col("u").alias("fp")).count().unionByName(pairs.groupBy(F.col("v").alias("fp")).count())
    ends = cut(ends.groupBy("fp").agg(F.sum("count").alias("n_pairs")), "near_ends")
    held = docs.join(_small(ends), "fp").groupBy("fp", "n_pairs").agg(F.any_value("text").alias("text"))
    held = cut(held.withColumn("slices", F.expr(f"cast(ceil(n_pairs / {PAIRS}) as int)")), "near_texts")
    copies = held.select("fp", "text", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    often = _small(held.where("slices > 1").select("fp", "slices"))
    rows = pairs
    for end in ("v", "u"):
        rows = rows.join(often.withColumnRenamed("fp", end), end, "left")
        rows = rows.withColumn("slice", F.pmod(F.xxhash64("u", "v"), F.coalesce("slices", F.lit(1))).cast("int")).drop("slices")
        rows = rows.join(copies.select(F.col("fp").alias(end), F.col("text").alias(f"text_{end}"), "slice"), [end, "slice"]).drop("slice")
    return cut(rows.where(similar_udf(width, threshold)("text_u", "text_v")).select("u", "v"), "near_links")


def _small(slim: DataFrame) -> DataFrame:
    return F.broadcast(slim) if slim.count() <= BROADCAST_ROWS else slim


class Sets:
    """The least hashes of some texts' shingle sets, and the similarity of one text to others of them."""

    def __init__(self, least: list[bytes], n: np.ndarray):
        sizes = np.array([len(x) // 8 for x in least])
        _, places = np.unique(np.frombuffer(b"".join(least), np.uint64), return_inverse=True)
        self.sizes, self.whole = sizes, n <= sizes
        # Hashes as places among all of them, in the same order; what a shorter set lacks is a place of no hash.
        none = int(places.max(initial=-1)) + 1
        self.places = np.full((len(least), max(1, int(sizes.max(initial=0)))), none, np.int32)
        self.places[np.arange(self.places.shape[1]) < sizes[:, None]] = places
        # Up to here all hashes of a text are known.
        self.known = np.where(self.whole, none, self.places[np.arange(len(least)), np.maximum(sizes, 1) - 1])
        self.marked = np.zeros(none + 1, bool)

    def similarity(self, one: int, others: np.ndarray) -> np.ndarray:
        """Jaccard similarity of the sets below what both texts know: exact if both are whole."""
        own, theirs = self.places[one, : self.sizes[one]], self.places[others]
        self.marked[own] = True
        shared = self.marked[theirs].sum(1)
        self.marked[own] = False
        upto = np.minimum(self.known[one], self.known[others])
        in_theirs = np.where(self.known[others] <= upto, self.sizes[others], (theirs <= upto[:, None]).sum(1))
        joint = np.searchsorted(own, upto, "right") + in_theirs - shared
        return np.where(joint, shared / np.maximum(joint, 1), 1.0)


def _pairs_apart(radius: int, threshold: float, best: bool):
    """Reads rows (key, left, right, fp, print, n, root, main, part, least) sorted by the first three; yields pairs
    (u, v, sure) of texts of different roots, one of them outside of the main root.

    With `best`, sure pairs, which are similar and join all that the shard's whole sets join, and of each other text
    the likeliest partner; else all pairs that may be similar of which a set isn't whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, bytes] = {}

        def numbered() -> Iterator[pa.RecordBatch]:
            at = 0
            for batch in batches:
                held.update(enumerate(batch.column(9).to_pylist(), at))
                yield pa.RecordBatch.from_arrays([*batch.columns[:9], pa.array(range(at, at + batch.num_rows), pa.int64())], batch.schema.names)
                at += batch.num_rows

        for (_, left, right), rows in groups_of(numbered(), 3, 1 << 62):
            rows = rows[np.argsort(rows[:, 3], kind="stable")]
            sets = Sets([held.pop(k) for k in rows[:, 9].tolist()], rows[:, 5])
            fp, prints, n, part = rows[:, 3], rows[:, 4].copy().view(np.uint64), rows[:, 5], rows[:, 8]
            outside = rows[:, 6] != rows[:, 7]
            # Components of the shard's texts, as places of one of them; they grow with the sure pairs.
            _, first, root = np.unique(rows[:, 6], return_index=True, return_inverse=True)
            root = first[root]
            likeliest: dict[int, tuple[float, int]] = {}
            found: list[tuple[int, int, bool]] = []
            # Of two parts, all of one are the tree; those outside of the main root ask it, and the other way round.
            for tree, asking in ((left, right), (right, left))[: 1 + (left != right)]:
                members, asks = np.flatnonzero(part == tree), np.flatnonzero((part == asking) & outside)
                if not len(members) or not len(asks):
                    continue
                values, which = np.unique(prints[members], return_inverse=True)
                order = np.argsort(which, kind="stable")
                ends = np.append(np.searchsorted(which[order], np.arange(len(values))), len(order))
                for node, near in BKTree(values).search(prints[asks], radius):
                    x = asks[near]
                    for y in members[order[ends[node] : ends[node + 1]]].tolist():
                        some = x[(root[x] != root[y]) & (np.minimum(n[x], n[y]) >= np.maximum(n[x], n[y]) * threshold - 1e-9)]
                        some = some if best else some[~(sets.whole[some] & sets.whole[y])]
                        if not len(some):
                            continue
                        share = sets.similarity(y, some)
                        sure = sets.whole[some] & sets.whole[y]
                        for k in some[sure & (share >= threshold)].tolist():
                            if root[k] != root[y]:
                                found.append((k, y, True))
                                root[root == root[k]] = root[y]
                        likely = ~sure & (share >= threshold - SHORT)
                        if best:
                            for k, v in zip(some[likely].tolist(), share[likely].tolist(), strict=True):
                                likeliest[k] = max(likeliest.get(k, (0.0, -1)), (v, y))
                        else:
                            found += [(k, y, False) for k in some[likely].tolist()]
            found += [(k, y, False) for k, (_, y) in likeliest.items()]
            if found:
                u, v, sure = (np.array(side) for side in zip(*found, strict=True))
                u, v = np.minimum(fp[u], fp[v]), np.maximum(fp[u], fp[v])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(sure)], ["u", "v", "sure"])

    return run


def _apart(members: DataFrame, edges: DataFrame, least: DataFrame, threshold: float, best: bool) -> DataFrame:
    """Pairs (u, v, sure) of members (key, fp, n, print, first, n_rows) that share a shard which edges leave in several components."""
    stars = cut(settled(edges), "near_stars")
    rooted = members.join(stars, members.fp == stars.node, "left").select("key", "fp", "n", "print", "first", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted, "near_rooted")
    # All but the shard's largest component are compared, with all others.
    parts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    parts = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("n_rows"), F.max(F.struct("size", "root"))["root"].alias("main")).where("parts > 1")
    others = attach_groups(rooted, cut(parts, "near_open"), "key").where("fp <> first").select("key", "fp", "print", "n", "root", "main")
    rows = cells(cut(others, "near_others"), ["key"], "fp", SLICE).join(least, "fp")
    rows = rows.select("key", "left", "right", "fp", "print", "n", "root", "main", "part", "least")
    dealt = rows.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    return dealt.mapInArrow(_pairs_apart(RADIUS, threshold, best), "u bigint, v bigint, sure boolean")


def _between(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The pairs (u, v) that edges don't join, directly or over others."""
    stars = cut(settled(edges), "near_stars")
    for end in ("u", "v"):
        own = _small(stars.select(F.col("node").alias(f"node_{end}"), F.col("root").alias(f"root_{end}")))
        pairs = pairs.join(own, F.col(end) == F.col(f"node_{end}"), "left").drop(f"node_{end}")
    return pairs.where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")


def similar_edges(sketches: DataFrame, docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """Edges (u, v) whose components are those of all similar pairs that share a shard and are within the radius.

    sketches: (fp, sketch) and docs: (fp, text), rows of one fp alike.
    """
    nodes = sketches.groupBy("fp").agg(F.any_value("sketch").alias("sketch"))
    members = nodes.select("fp", F.col("sketch")[0].alias("n"), F.col("sketch")[1].alias("print"), F.explode(F.slice("sketch", 3, BANDS)).alias("key"))
    groups = members.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"), F.min(F.struct("fp", "n", "print")).alias("first")).where("n_rows > 1")
    members = cut(attach_groups(members, cut(groups, "near_bands"), "key"), "near_members")
    # Sets that differ more than this in size can't be similar.
    sizes = F.least("n", "first.n") >= F.greatest("n", "first.n") * threshold - 1e-9
    within = F.bit_count(F.col("print").bitwiseXOR(F.col("first.print"))) <= RADIUS
    firsts = cut(members.where((F.col("fp") != F.col("first.fp")) & sizes & within).selectExpr("first.fp as u", "fp as v").distinct(), "near_firsts")
    # One root of each text first, the smallest: in a large group of copies that is the same one for most. Of the other
    # roots only those in another component are compared.
    edges = verified(firsts.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), docs, width, threshold)
    edges = edges.unionByName(verified(_between(firsts, edges), docs, width, threshold))
    members = members.where("n_rows > 2").select("key", "fp", "n", "print", F.col("first.fp").alias("first"))
    # The least hashes of the texts whose shards the roots leave open.
    stars = cut(settled(edges), "near_stars")
    roots = members.join(stars, members.fp == stars.node, "left").groupBy("key").agg(F.count_distinct(F.coalesce("root", "fp")).alias("n")).where("n > 1")
    wanted = cut(members.join(_small(cut(roots.select("key"), "near_keys")), "key", "left_semi").select("fp").distinct(), "near_wanted")
    least = docs.join(_small(wanted), "fp", "left_semi").withColumn("least", least_udf(width)("text"))
    least = cut(least.groupBy("fp").agg(F.any_value("least").alias("least")), "near_least")
    for best in (True, False):
        found = cut(_apart(members, edges, least, threshold, best), "near_apart")
        edges = edges.unionByName(found.where("sure").select("u", "v"))
        edges = edges.unionByName(verified(found.where("not sure").select("u", "v"), docs, width, threshold))
    return edges


def drop_near_copies(docs: DataFrame, width: int = WIDTH, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each component the one with the smallest doc_id.

    Rows link if the similarity of their shingle sets is the threshold or more; texts without words, null ones
    too, are alike. Null ids come last; of rows with equal ids and different texts, one stays by a digest of the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(own_columns(docs, doc_id=F.col("doc_id"), digest=F.xxhash64(text), fp=F.xxhash64(text), sketch=sketch_udf(width)(text)), "near_sketches")
    edges = similar_edges(rows.select("fp", "sketch"), own_columns(docs, fp=F.xxhash64(text), text=text), width, threshold)
    found = cut(linked_rows(rows.drop("sketch"), lambda nodes: settled(edges)), "near_copies")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "digest")).alias("first"), F.count(F.lit(1)).alias("n_rows"))
    first = cut(first.where("n_rows > 1"), "near_groups")
    keys = attach_groups(found, first, "root").select("doc_id", "digest", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))).alias("kept"))
    keys = cut(keys.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("not kept or n > 1"), "near_copied")
    return without(docs, {"doc_id": F.col("doc_id"), "digest": F.xxhash64(text)}, keys.where("not kept"), keys.where("kept and n > 1"))
