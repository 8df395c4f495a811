"""The disclosure store's writes and reads beside plain upserts: selection flips, deletes that cascade, watermarks, stale reads, library views, responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .relational import last_value, latest, upsert
from .store import Store
from .tables import settled

#: Events that a run keeps once it has more than so many.
RING, KEPT = 5000, 4000


def upsert_attachments(base: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base after the batch, the announcements whose selection flipped): rows (url, ..., selected, duplicate_of) by url.

    Of repeated batch rows the last by `_batch` holds. A written row is no duplicate any more. A flip is a row
    that was there with another selection; new rows flip nothing.
    """
    batch = last_value(batch, ["url"], "_batch").drop("_batch").withColumn("duplicate_of", F.lit(None).cast("string"))
    before = base.select("url", F.col("selected").alias("_was"))
    flips = batch.join(before, "url").where(F.col("selected") != F.col("_was")).select("announcement_id").distinct()
    return upsert(base, batch, ["url"]), flips


def write_attachments(store: Store, batch: DataFrame) -> DataFrame:
    """upsert_attachments() into a store of attachments by url: only the buckets of the batch's urls are read and written. Returns the announcements that flipped."""
    batch = settled(last_value(batch, ["url"], "_batch").drop("_batch").withColumn("duplicate_of", F.lit(None).cast("string")))
    before = store.matching(batch).select("url", F.col("selected").alias("_was"))
    flips = settled(batch.join(before, "url").where(F.col("selected") != F.col("_was")).select("announcement_id").distinct())
    store.upsert(batch)
    return flips


def delete_scope(rows: DataFrame, scopes: DataFrame, key: str) -> DataFrame:
    """rows without those of the given scopes."""
    return rows.join(scopes.select(key).distinct(), key, "left_anti")


def invalidated(changed: DataFrame, documents: DataFrame, announcements: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(document, announcement, window) summaries that stay when the sources of some urls change.

    changed: (url, announcement_id, ticker, announced_at). The summary of a url goes, so does that of its
    announcement, and those of windows (ticker, start_at, end_at) which hold the announcement's time.
    """
    keep_documents = documents.join(changed.select("url").distinct(), "url", "left_anti")
    keep_announcements = announcements.join(changed.select("announcement_id").distinct(), "announcement_id", "left_anti")
    at = changed.select(F.col("ticker").alias("_t"), "announced_at").distinct()
    hit = windows.join(at, (F.col("ticker") == F.col("_t")) & F.col("announced_at").between(F.col("start_at"), F.col("end_at")), "left_anti")
    return keep_documents, keep_announcements, hit


def advance(watermarks: DataFrame, polls: DataFrame) -> DataFrame:
    """watermarks (scope, poll_end, last_seen) after polls of the same columns; neither time ever moves back."""
    both = watermarks.unionByName(polls)
    return both.groupBy("scope").agg(F.max("poll_end").alias("poll_end"), F.max("last_seen").alias("last_seen"))


def current_versions(stored: DataFrame, model: str, version: str) -> tuple[DataFrame, DataFrame]:
    """(rows that a read with this model and version returns, rows that it deletes): stale ones are gone for good."""
    good = F.coalesce((F.col("model") == model) & (F.col("prompt_version") == version), F.lit(False))
    return stored.where(good), stored.where(~good)


def answered(sent: DataFrame, responses: DataFrame) -> DataFrame:
    """sent (external_id, ...) with internal_id and `partial`: whether the response left a row out."""
    got = responses.groupBy("external_id").agg(F.max("internal_id").alias("internal_id"))
    return sent.join(got, "external_id", "left").withColumn("partial", F.col("internal_id").isNull())


def attachment_state(wanted: DataFrame, attachments: DataFrame) -> DataFrame:
    """wanted (url) with the one stored row of each url, nulls where there is none."""
    return wanted.join(attachments, "url", "left")


def ring_start(last: int) -> int:
    """The least sequence number that a run whose events are numbered from 1 to last still holds."""
    if last <= RING:
        return 0
    trims = (last - RING - 1) // (RING - KEPT + 1)
    return RING + 1 + trims * (RING - KEPT + 1) - KEPT + 1


def ring(events: DataFrame, key: str, seq: str) -> DataFrame:
    """The events that a run still holds: it drops to its last KEPT each time it has more than RING."""
    n = F.max(seq).over(Window.partitionBy(key))
    # The first trim comes with event RING + 1, each later one after RING - KEPT + 1 more.
    trims = F.when(n > RING, F.floor((n - RING - 1) / (RING - KEPT + 1)) + 1).otherwise(0)
    last_trim = RING + 1 + (trims - 1) * (RING - KEPT + 1)
    return events.withColumn("_from", F.when(trims > 0, last_trim - KEPT + 1).otherwise(0)).where(F.col(seq) >= F.col("_from")).drop("_from")


def tail_lines(lines: DataFrame, key: str, number: str, text: str, n: int, schema: str) -> DataFrame:
    """The last n lines of each file, parsed; what isn't JSON of the schema is passed over."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.col(number).desc()))
    rows = lines.withColumn("_n", last).where(F.col("_n") <= n).drop("_n")
    return rows.withColumn("event", F.from_json(text, schema, {"mode": "PERMISSIVE"})).where(F.col("event").isNotNull() & F.json_object_keys(text).isNotNull()).drop(text)


def run_library(states: DataFrame, text: str) -> DataFrame:
    """One row of each run from its state as JSON: request and report fields with their fallbacks; bad states are passed over."""
    get = lambda p: F.get_json_object(text, p)
    full = lambda *ps: F.coalesce(*[F.nullif(get(p), F.lit("")) for p in ps])
    good = states.where(F.json_object_keys(text).isNotNull())
    return good.select(
        F.coalesce(full("$.run_id"), F.col("folder")).alias("run_id"),
        F.coalesce(full("$.status"), F.lit("unknown")).alias("status"),
        F.coalesce(full("$.request.mode", "$.report.mode"), F.lit("scrape")).alias("mode"),
        get("$.request.ticker").alias("ticker"),
        F.coalesce(get("$.last_seq").cast("bigint"), F.lit(0).cast("bigint")).alias("last_seq"),
        F.coalesce(F.nullif(get("$.report.company_summaries").cast("bigint"), F.lit(0).cast("bigint")), F.size(F.json_object_keys(get("$.summaries"))).cast("bigint"), F.lit(0).cast("bigint")).alias("company_summaries"),
        F.array_sort(F.coalesce(F.json_object_keys(get("$.artifact_paths")), F.array().cast("array<string>"))).alias("artifacts"),
    )


def library_windows(windows: DataFrame, announcements: DataFrame, summaries: DataFrame, n: int = 200) -> DataFrame:
    """(start_at, end_at, company_count, updated_at, tickers, announcement_count, announcement_summary_count), the newest n.

    windows: (ticker, start_at, end_at, updated_at). Counts come from prefix sums by time, so that no range
    meets each of its points: instants and both ends of every range are ranked together, once.
    """
    from .gates import limited
    from .timewin import range_counts

    rows = windows.groupBy("start_at", "end_at").agg(F.count(F.lit(1)).alias("company_count"), F.max("updated_at").alias("updated_at"), F.array_sort(F.collect_list("ticker")).alias("tickers"))
    rows = limited(rows, n, F.col("updated_at").desc(), "start_at", "end_at").withColumn("_id", F.concat_ws("|", "start_at", "end_at"))
    ranges = rows.select("_id", F.col("start_at").alias("s"), F.col("end_at").alias("e"))
    summed = summaries.join(announcements.select("announcement_id", "announced_at"), "announcement_id")
    for points, name in ((announcements, "announcement_count"), (summed, "announcement_summary_count")):
        rows = rows.join(range_counts(points, "announced_at", ranges, "_id").withColumnRenamed("n", name), "_id")
    return rows.drop("_id")


def company_library(windows: DataFrame, n: int = 2000) -> DataFrame:
    """(ticker, window_count, latest_updated_at, start_at, end_at, overview): of the first n tickers, with their latest window."""
    from .gates import limited

    counts = windows.groupBy("ticker").agg(F.count(F.lit(1)).alias("window_count"), F.max("updated_at").alias("latest_updated_at"))
    newest = latest(windows, ["ticker"], F.col("updated_at").desc(), F.col("start_at").desc()).select("ticker", "start_at", "end_at", F.coalesce("overview", F.lit("")).alias("overview"))
    return limited(counts, n, "ticker").join(newest, "ticker")


def window_funnel(announcements: DataFrame, attachments: DataFrame, documents: DataFrame, summaries: DataFrame, windows: DataFrame, audits: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row of six counts for a window: announcements, their attachments, documents summarised, announcements summarised, company summaries and audits of the very window."""
    inside = announcements.where(F.col("announced_at").between(start, end)).select("announcement_id")
    files = attachments.join(inside, "announcement_id", "left_semi")
    same = lambda d: d.where((F.col("start_at") == start) & (F.col("end_at") == end))
    one = lambda d, name: d.agg(F.count(F.lit(1)).alias(name))
    parts = [one(inside, "announcements"), one(files, "attachments"), one(documents.join(files.select("url"), "url", "left_semi"), "document_summaries"), one(summaries.join(inside, "announcement_id", "left_semi"), "announcement_summaries"), one(same(windows), "company_summaries"), one(same(audits), "audits")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


def refinement_plan(announcements: DataFrame, attachments: DataFrame, cached: DataFrame) -> DataFrame:
    """(announcement_id, url, filename, selected, reason, category, cached_file, cached_text, ready) for the financial reports among announcements.

    cached: (url, has_file, has_text). ready: every selected source of the announcement is there as a file or
    a text; otherwise no model is called for any of them.
    """
    from . import filings
    from .rules import any_phrase

    reports = announcements.where(any_phrase(filings.folded(F.col("title")), filings.FINANCIAL_TITLES)).select("announcement_id", "title")
    chosen = filings.select_attachments(attachments.join(reports, "announcement_id")).join(cached, "url", "left")
    rows = chosen.withColumns({"cached_file": F.coalesce("has_file", F.lit(False)), "cached_text": F.coalesce("has_text", F.lit(False))})
    lacking = F.max((F.col("selected") & ~F.col("cached_file") & ~F.col("cached_text")).cast("int")).over(Window.partitionBy("announcement_id"))
    return rows.withColumn("ready", lacking == 0).select("announcement_id", "url", "filename", "selected", "reason", "category", "cached_file", "cached_text", "ready")
