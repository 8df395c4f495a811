"""Ingestion state: seen ids, selective checkpoints, coverage commits, resumable chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store
from .tables import settled
from .timewin import merge_intervals

#: Ids that a checkpoint remembers.
SEEN = 1000


def remember(seen: Column, new: Column, most: int = SEEN) -> Column:
    """Distinct ids in first order, the last `most` of them."""
    both = F.array_distinct(F.concat(F.coalesce(seen, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>"))))
    return F.slice(both, F.greatest(F.lit(1), F.size(both) - most + 1), most)


def selective(seen: Column, at: Column, new: Column, new_at: Column, done: Column) -> tuple[Column, Column]:
    """(ids, time): finished new ids are remembered; the time moves only if every new id is finished."""
    fresh = F.array_except(new, seen)
    kept = F.filter(F.array_distinct(F.concat(seen, new)), lambda x: F.array_contains(seen, x) | F.array_contains(done, x))
    return kept, F.when(F.size(F.array_except(fresh, done)) == 0, new_at).otherwise(at)


def commit_coverage(store: DataFrame, gaps: DataFrame, runs: DataFrame) -> DataFrame:
    """store (scope, s, e) after a run: the gaps (scope, s, e) join it if the scope's run (scope, complete, errors, filtered) was whole.

    All gaps of a scope or none; what overlaps or touches becomes one.
    """
    whole = runs.where("complete and errors = 0 and not filtered").select("scope")
    return merge_intervals(store.select("scope", "s", "e").unionByName(gaps.join(whole, "scope", "left_semi").select("scope", "s", "e")), "scope")


def save_coverage(store: Store, gaps: DataFrame, runs: DataFrame) -> list[int]:
    """commit_coverage() into a store of ranges by scope: the ranges of scopes whose run was whole are replaced, no others are read. Returns the buckets written."""
    scopes = runs.where("complete and errors = 0 and not filtered").select("scope").distinct()
    added = gaps.join(scopes, "scope", "left_semi").select("scope", "s", "e")
    scopes = settled(added.select("scope").distinct())
    there = store.matching(scopes).join(scopes, "scope", "left_semi")
    return store.replace(scopes, merge_intervals(there.unionByName(added), "scope"))


def proves(ranges: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """requests (key, a, b) with `proved`: one merged range holds the whole request."""
    merged = merge_intervals(ranges, key)
    held = requests.join(merged, key).where("s <= a and b <= e").select(key).distinct().withColumn("_h", F.lit(True))
    return requests.join(held, key, "left").withColumn("proved", F.coalesce("_h", F.lit(False))).drop("_h")


def pending_chunks(chunks: DataFrame, finished: DataFrame) -> DataFrame:
    """Chunks that no finished one matches in document, place, count, content, model and prompt version."""
    return chunks.join(finished, ["url", "chunk_index", "chunk_count", "chunk_sha256", "model", "prompt_version"], "left_anti")


def interrupted(status: Column) -> Column:
    """Runs that were queued or running when the process ended."""
    return F.when(status.isin("queued", "running"), "interrupted").otherwise(status)
