"""Collecting a window: timestamp and seen-id filters, exclusion, lanes, budget and the checkpoint that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import filings, timewin
from .relational import lanes


def day_of_id(external_id: Column) -> Column:
    """The day in an id's first fourteen digits, yyyyMMddHHmmss."""
    return F.to_date(F.try_to_timestamp(F.substring(external_id, 1, 14), F.lit("yyyyMMddHHmmss")))


def exact_disclosure(rows: DataFrame, external_id: str, ticker: str) -> DataFrame:
    """The one stock row with this id and ticker; none or several are an error."""
    found = rows.where((F.col("id2") == external_id) & (F.upper(F.trim("ticker")) == ticker.upper()) & F.coalesce("is_stock", F.lit(True)))
    if (n := found.limit(2).count()) != 1:
        raise LookupError(f"{'no' if not n else 'several'} disclosures with id {external_id}")
    return found


def accept_probe(raw: Column, distinct: Column, reported: Column, strict: bool) -> Column:
    """Whether a wide page proves a shard: by distinct rows if strict, else by raw ones."""
    return (distinct if strict else raw) >= reported


def collect_window(rows: DataFrame, seen: DataFrame, start: str, end: str, budget: int, scope: str) -> DataFrame:
    """rows (announcement_id, ticker, announced_at, is_stock, n_selected, missing) of the window with outcome and place.

    outcome: outside, seen, an exclusion reason, accepted or deferred; the first `budget` of each scope in
    lane order are accepted.
    """
    kind = dict(rows.dtypes)["announced_at"]
    inside = F.col("announced_at").between(F.lit(start).cast(kind), F.lit(end).cast(kind))
    known = seen.select("announcement_id").distinct().withColumn("_seen", F.lit(True))
    rows = rows.join(known, "announcement_id", "left")
    reason = filings.exclusion_reason(F.col("ticker"), F.col("is_stock"), F.col("n_selected"), F.col("missing"))
    rows = rows.withColumn("outcome", F.when(~inside, "outside").when(F.col("_seen"), "seen").otherwise(reason)).drop("_seen")
    left = lanes(rows.where("outcome is null"), [scope], "announced_at", "announcement_id")
    left = left.withColumn("outcome", F.when(F.col("place") <= budget, "accepted").otherwise("deferred"))
    return rows.where("outcome is not null").withColumn("place", F.lit(None).cast("int")).unionByName(left)


def diagnostics(collected: DataFrame, sample: int = 20) -> DataFrame:
    """(outcome, n, n_shown, ids): counts of each outcome, and the first ids of it."""
    counts = collected.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    turn = F.row_number().over(Window.partitionBy("outcome").orderBy("announcement_id"))
    some = collected.withColumn("_t", turn).where(F.col("_t") <= sample).groupBy("outcome").agg(F.array_sort(F.collect_list("announcement_id")).alias("ids"))
    return counts.join(some, "outcome").select("outcome", "n", F.least("n", F.lit(sample)).alias("n_shown"), "ids")


def uncovered_classified(rows: DataFrame, coverage: DataFrame, flags: DataFrame, start: str, end: str) -> DataFrame:
    """Announcements of a window that coverage (scope, s, e) of their scope leaves, with category and owner materiality."""
    from . import rules

    rows = timewin.in_window(rows, "announced_at", start, end)
    rows = timewin.contained(rows, "announced_at", timewin.merge_intervals(coverage, "scope"), ["scope"], "left_anti")
    rows = rows.withColumn("category", rules.title_category(F.col("title"))).join(flags, "announcement_id", "left")
    return rows.withColumn("materiality", rules.owner_materiality(F.col("category"), F.col("in_portfolio"), F.col("in_watchlist")))
