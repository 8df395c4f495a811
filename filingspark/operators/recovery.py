"""Recovery: manifest comparison, next actions, run outcomes, status histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The order of states that a disclosure goes through.
STATES = ("DISCOVERED", "EXTRACTING", "ANALYZING", "READY")
ENDS = ("PARTIAL", "FAILED")


#: The source that recovery is for, and what is said of each difference, in order.
SOURCE = "idx-website"
MISMATCHES = (
    "disclosure_id mismatch",
    "external_id mismatch",
    "ticker mismatch",
    "source_id is not idx-website",
    "processing_status changed since manifest",
    "updated_at concurrency guard changed",
    "disclosure is outside stock scope",
    "declared attachment count changed",
    "attachment hash metadata changed",
)
MISSING = "NOT_FOUND: disclosure row not found"
FILES = ("stored file belongs to another disclosure", "stored file count exceeds declared attachment count", "duplicate stored attachment source_url")
ANALYSED = "record already has a committed analysis"


def hashes(values: Column) -> Column:
    """Digests in their order, stripped and in lower case; null is none."""
    return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda h: F.lower(F.trim(h)))


def mismatches(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """(disclosure_id, reasons): how current rows differ from what a manifest expects, in fixed order.

    Rows meet by `row_id`, under which the store was asked. Tickers are compared in upper case, digests in
    their order. A row that isn't there is the only reason then.
    """
    m, c = manifest.alias("m"), current.alias("c")
    rows = m.join(c, F.col("m.disclosure_id") == F.col("c.row_id"), "left")
    differs = lambda a, b: ~F.col(f"m.{a}").eqNullSafe(F.col(f"c.{b}"))
    tests = (
        differs("disclosure_id", "disclosure_id"),
        differs("expected_external_id", "external_id"),
        ~F.upper("m.ticker").eqNullSafe(F.upper("c.ticker")),
        ~F.col("c.source_id").eqNullSafe(F.lit(SOURCE)),
        differs("expected_status", "processing_status"),
        differs("expected_updated_at", "updated_at"),
        ~F.coalesce("c.is_stock_scope", F.lit(False)),
        differs("declared_attachment_count", "declared_attachment_count"),
        hashes(F.col("c.attachment_hashes")) != hashes(F.col("m.expected_attachment_hashes")),
    )
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in zip(tests, MISMATCHES, strict=True)]))
    return rows.select(F.col("m.disclosure_id").alias("disclosure_id"), F.when(F.col("c.row_id").isNull(), F.array(F.lit(MISSING))).otherwise(found).alias("reasons"))


def file_facts(files: DataFrame) -> DataFrame:
    """Facts of the files (row_id, disclosure_id, source_url, sha256, download_status, extraction_status, extracted_text_ref, local_exists, local_sha256, expected hashes and count) of each record.

    A file is valid if it was downloaded and extracted, and either its local copy is there or a text is
    stored for its digest; a digest that the manifest lacks makes a local copy wrong and a stored one not valid. Others
    that were downloaded and are there locally are staged. local_exists is null for a file without a local path.
    """
    whole = F.size("expected_attachment_hashes") >= F.col("declared_attachment_count")
    known = lambda h: F.array_contains(hashes(F.col("expected_attachment_hashes")), h)
    done = F.coalesce((F.col("download_status") == "DOWNLOADED") & (F.col("extraction_status") == "EXTRACTED"), F.lit(False))
    local = F.coalesce("local_exists", F.lit(False))
    url = F.col("source_url")
    wrong = F.when(done & local & F.col("sha256").isNotNull() & (F.col("local_sha256") != F.lower("sha256")), F.concat(url, F.lit(": local cache hash mismatch")))
    wrong = wrong.when(done & local & whole & ~known(F.col("local_sha256")), F.concat(url, F.lit(": cache hash is not in manifest")))
    stored = F.coalesce((F.col("extracted_text_ref") != "") & (F.col("sha256") != "") & (~whole | known(F.lower("sha256"))), F.lit(False))
    valid = done & F.when(F.col("local_exists").isNull(), stored).otherwise(local & wrong.isNull())
    staged = ~valid & (F.col("download_status") == "DOWNLOADED") & local
    rows = files.withColumns({"wrong": wrong, "valid": valid, "staged": F.coalesce(staged, F.lit(False))})
    return rows.groupBy("row_id").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(~F.col("disclosure_id").eqNullSafe(F.col("row_id"))).alias("n_foreign"),
        F.count_distinct("source_url").alias("n_urls"),
        F.count_if("valid").alias("n_valid"),
        F.count_if("staged").alias("n_staged"),
        F.array_sort(F.collect_set("wrong")).alias("wrong"),
    )


def preflight(manifest: DataFrame, current: DataFrame, files: DataFrame) -> DataFrame:
    """(disclosure_id, outcome, action, reasons, attachments_needed, attachments_considered, source_requests, files_reused, ai_documents, analyses) of each record of a manifest.

    Differences, files that don't fit and wrong copies need a review; buckets E and F are held unless recovery
    is allowed; an analysis that is there ends the matter. Then what is missing decides the next step.
    """
    own = manifest.select(F.col("disclosure_id").alias("row_id"), "expected_attachment_hashes", "declared_attachment_count")
    facts = file_facts(files.join(own, "row_id"))
    rows = manifest.join(mismatches(manifest, current), "disclosure_id").join(facts, manifest.disclosure_id == facts.row_id, "left").drop("row_id")
    rows = rows.join(current.select(F.col("row_id").alias("disclosure_id"), F.coalesce("analysis_present", F.lit(False)).alias("analysed")), "disclosure_id", "left")
    rows = rows.fillna(0, ["n_files", "n_foreign", "n_urls", "n_valid", "n_staged"])
    c = F.col
    bad_files = F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in zip((c("n_foreign") > 0, c("n_files") > c("declared_attachment_count"), c("n_urls") != c("n_files")), FILES, strict=True)]))
    held = c("bucket").isin("E", "F") & ~F.coalesce("recovery_allowed", F.lit(False))
    none = F.array().cast("array<string>")
    reviewed = F.lit("MANUAL_REVIEW")
    needed = F.greatest(c("declared_attachment_count") - c("n_valid") - c("n_staged"), F.lit(0)) + c("n_files") - c("n_valid") - c("n_staged")
    rows = rows.withColumn("needed", needed)
    step = (
        F.when((c("n_valid") > 0) & (c("needed") == 0), "AI_ONLY_RETRY")
        .when(c("needed") > 0, "ATTACHMENT_DOWNLOAD")
        .when(c("n_staged") > 0, "EXTRACTION_RESUME")
        .when(c("expected_status") == "EXTRACTING", "METADATA_PROCESS_RESUME")
        .when(c("n_files") > 0, "EXTRACTION_RESUME")
        .otherwise("ATTACHMENT_DOWNLOAD")
    )
    ladder = (
        (F.size("reasons") > 0, "PRECONDITION_FAILED", reviewed, c("reasons")),
        (held, "HELD", F.lit("HELD"), F.array(F.concat(F.lit("bucket "), c("bucket"), F.lit(" requires explicit recovery_allowed=true")))),
        (F.size(bad_files) > 0, "PRECONDITION_FAILED", reviewed, bad_files),
        (c("analysed"), "ALREADY_READY", F.lit("NOOP"), F.array(F.lit(ANALYSED))),
        (F.size("wrong") > 0, "PRECONDITION_FAILED", reviewed, c("wrong")),
    )
    outcome, action, reasons = F.lit("READY"), step, none
    for test, o, what, why in reversed(ladder):
        outcome, action, reasons = F.when(test, o).otherwise(outcome), F.when(test, what).otherwise(action), F.when(test, why).otherwise(reasons)
    rows = rows.withColumns({"outcome": outcome, "action": action, "why": reasons})
    ready = c("outcome") == "READY"
    fetched = F.when(ready & c("action").isin("ATTACHMENT_DOWNLOAD", "METADATA_PROCESS_RESUME"), c("needed")).otherwise(0)
    considered = F.when(ready, c("n_files") + fetched).otherwise(0)
    return rows.select(
        "disclosure_id", "outcome", "action", c("why").alias("reasons"), fetched.alias("attachments_needed"), considered.alias("attachments_considered"),
        fetched.alias("source_requests"), F.when(ready, c("n_valid")).otherwise(0).alias("files_reused"),
        F.when(c("action") == "AI_ONLY_RETRY", c("n_valid")).otherwise(considered).alias("ai_documents"), F.when(ready, 1).otherwise(0).alias("analyses"),
    )


def first_cap(plan: DataFrame, caps: dict[str, int]) -> DataFrame:
    """One row: the sums of a plan's columns and the first cap that they exceed, or null."""
    sums = plan.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in caps])
    over = F.lit(None).cast("string")
    for c, most in reversed(list(caps.items())):
        over = F.when(F.col(c) > most, F.lit(c)).otherwise(over)
    return sums.withColumn("exceeded", over)


def file_status(error: Column, sha256: Column, size: Column, text_hash: Column) -> tuple[Column, Column]:
    """(download, extraction) status of a stored file: a failure is one of the extraction alone."""
    full = lambda c: F.coalesce(c != "", F.lit(False))
    failed = full(F.trim(error))
    good = full(F.trim(sha256)) & (F.length(F.trim(sha256)) == 64)
    return F.when(good & size.isNotNull(), "DOWNLOADED").otherwise("PENDING"), F.when(full(text_hash) & ~failed, "EXTRACTED").when(failed, "FAILED").otherwise("PENDING")


def outcome(errors: Column, partial: Column, proved: Column, allowed: Column, deadline: Column, limited: Column) -> tuple[Column, Column]:
    """(status, error code) of a run: processing first, then whether its window is proved, then whether it may commit coverage."""
    good = (errors == 0) & (partial == 0)
    code = F.when(~good, F.when(deadline, "AI_RUN_DEADLINE").when(limited, "AI_RATE_LIMITED").otherwise("SOURCE_PROCESSING_PARTIAL"))
    code = code.when(~proved, "SOURCE_COVERAGE_UNPROVEN").when(~allowed, "SOURCE_COVERAGE_NOT_AUTHORIZED")
    return F.when(good & proved & allowed, "COMPLETE").otherwise("PARTIAL"), code


def terminal_status(ok: Column, commits: Column, downloaded: Column, reused: Column) -> Column:
    """The end status of a recovery run: what has changed something can be resumed."""
    return F.when(ok, "COMPLETE").when((commits > 0) | (downloaded > 0) | (reused > 0), "PARTIAL").otherwise("FAILED")


def stale(status: Column, started: Column, now: Column, minutes: int = 85) -> Column:
    return (status == "RUNNING") & (now - started > F.expr(f"interval {minutes} minutes"))


def transitions(history: DataFrame, key: str, order: list[str], status: str) -> DataFrame:
    """history with `legal`: whether a status may follow the one before it; ends may follow any but an end."""
    before = F.lag(status).over(Window.partitionBy(key).orderBy(*order))
    place = lambda c: F.array_position(F.array(*map(F.lit, STATES)), c)
    forward = (place(before) > 0) & (place(F.col(status)) == place(before) + 1)
    end = F.col(status).isin(*ENDS) & before.isin(*STATES[:-1])
    start = before.isNull() & (F.col(status) == STATES[0])
    return history.withColumn("legal", start | F.coalesce(forward | end, F.lit(False)))


#: What the message of a failed transport contains, what that of a request which the company reducer tries again contains, in lower case.
TRANSPORT = ("timed out", "timeout", "network", "connection", "connecterror", "readerror", "writeerror", "name or service", "temporary failure", "nodename nor servname", "network is unreachable")
REDUCER = ("openrouter request failed", "connecterror", "connection", "timed out", "timeout", "temporary failure", "network", "429", "502", "503", "504")
PROVIDER = "openrouter request failed"


def _holds(text: Column, needles: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for n in needles:
        found = found | F.contains(text, F.lit(n))
    return F.coalesce(found, F.lit(False))


def transport_failure(text: Column) -> Column:
    """Whether an error's message says that the network is at fault."""
    return _holds(F.lower(text), TRANSPORT)


def reduced_again(text: Column, from_summary: Column) -> Column:
    """Whether the company reducer tries a request again: the message of a summary's error has one of its marks."""
    return F.coalesce(from_summary, F.lit(False)) & _holds(F.lower(text), REDUCER)


def retry_reason(text: Column, malformed: Column) -> Column:
    """Why a request is tried again, first match: malformed_json, rate_limited, timeout, provider_error (a failed request whose message has a 5), structured_output_error."""
    low = F.lower(F.coalesce(text, F.lit("")))
    failed = F.contains(low, F.lit(PROVIDER)) & F.contains(low, F.lit("5"))
    reasons = F.when(F.coalesce(malformed, F.lit(False)), "malformed_json").when(_holds(low, ("429", "rate limit", "throttl")), "rate_limited")
    return reasons.when(_holds(low, ("timeout", "timed out")), "timeout").when(failed, "provider_error").otherwise("structured_output_error")


def retryable(code: Column, text: Column) -> Column:
    """429, 408, 5xx, or a transport failure by its message."""
    return F.coalesce(code.isin(408, 429) | (code >= 500), F.lit(False)) | transport_failure(text)
