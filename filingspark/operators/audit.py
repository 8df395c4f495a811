"""Audit views: claim traces, evidence positions, process timelines, share exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import claim_tokens, strings
from .relational import top_two
from .scans import numbered

#: Words that don't count in claims.
STOP = ("yang", "dan", "atau", "dari", "pada", "untuk", "dengan", "dalam", "ini", "itu", "the", "and", "for", "from", "with", "this", "that", "sebagai", "akan", "telah", "oleh", "serta", "atas", "ke", "di", "a", "an", "of", "to", "is", "are")


def claim_scores(claims: DataFrame, sources: DataFrame, group: str) -> DataFrame:
    """(group, claim_id, source_id, score): the share of a claim's tokens that a source of its group has.

    Tokens of claims and sources meet by group and token, so that only sources which share one are scored.
    """
    c = claims.select(group, "claim_id", claim_tokens(F.col("claim"), STOP).alias("t")).withColumn("n", F.size("t"))
    c = c.select(group, "claim_id", "n", F.explode("t").alias("token"))
    s = sources.select(group, "source_id", F.explode(claim_tokens(F.col("text"), STOP)).alias("token"))
    return c.join(s, [group, "token"]).groupBy(group, "claim_id", "source_id").agg((F.count(F.lit(1)) / F.first("n")).alias("score"))


def claim_traces(claims: DataFrame, sources: DataFrame, group: str) -> DataFrame:
    """(group, claim_id, attribution, source_ids, score) of every claim (group, claim_id, claim, exact_ids or null).

    A claim names its sources; or its group has one; or the best one or two by shared tokens count.
    """
    n = sources.groupBy(group).agg(F.count(F.lit(1)).alias("n_sources"), F.min("source_id").alias("only"))
    own = claims.join(n, group, "left")
    best = top_two(claim_scores(claims, sources, group), [group, "claim_id"], "score", "source_id")
    best = best.groupBy(group, "claim_id").agg(F.array_sort(F.collect_list(F.struct("rank", "source_id", "score"))).alias("b"))
    rows = own.join(best, [group, "claim_id"], "left")
    named, single, found = F.col("exact_ids").isNotNull(), F.col("n_sources") == 1, F.col("b").isNotNull()
    return rows.select(
        group,
        "claim_id",
        F.when(named & (F.size("exact_ids") > 0), "exact_model_reference").when(named, "unresolved").when(single, "deterministic_single_announcement").when(found, "inferred_from_saved_summaries").otherwise("unresolved").alias("attribution"),
        F.when(named, F.col("exact_ids")).when(single, F.array("only")).when(found, F.transform("b", lambda x: x["source_id"])).alias("source_ids"),
        F.when(named, None).when(single, 1.0).when(found, F.col("b")[0]["score"]).alias("score"),
    )


def locate(text: Column, evidence: Column) -> Column:
    """(match, line, page, sheet): where evidence stands in a text; otherwise whether a beginning of it does, blanks apart.

    Evidence that is null or blank, or a null text, has no match at all.
    """
    folded, wanted = F.lower(text), F.lower(F.regexp_replace(evidence, r"(?U)^\s+|\s+$", ""))
    at = F.when(wanted != "", F.instr(folded, wanted)).otherwise(0)
    before = F.left(text, at - 1)
    squeezed = lambda c: F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))
    start = F.left(squeezed(evidence), F.lit(80))
    line = F.when(at > 0, F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1)
    last = lambda marks: F.when((at > 0) & (F.size(marks) > 0), F.element_at(marks, -1))
    pages = F.regexp_extract_all(before, F.lit(r"===== PAGE (\d+) ====="), F.lit(1))
    sheets = F.regexp_extract_all(before, F.lit(r"===== SHEET: (.*?) ====="), F.lit(1))
    match = F.when((F.coalesce(wanted, F.lit("")) == "") | text.isNull(), None).when(at > 0, "exact_text").when((F.length(start) >= 20) & (F.instr(squeezed(text), start) > 0), "normalized_text").otherwise("not_located")
    return F.struct(match.alias("match"), line.alias("line"), last(pages).cast("int").alias("page"), F.trim(last(sheets)).alias("sheet"))


def timeline(*parts: tuple[str, DataFrame, str]) -> DataFrame:
    """(scope, kind, at, ref, place) of several kinds of events (kind, rows (scope, ref, time), name of time), by time."""
    out = None
    for kind, rows, at in parts:
        one = rows.select("scope", F.lit(kind).alias("kind"), F.col(at).alias("at"), F.col("ref").cast("string").alias("ref")).where("at is not null")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("place", F.row_number().over(Window.partitionBy("scope").orderBy("at", "kind", "ref")))


EVENT = "scope string, at timestamp_ntz, stage string, label string, announcement_id string, url string, status string, elapsed double, prompt_tokens bigint, completion_tokens bigint, audit_id bigint, end_at timestamp_ntz"


def process(announcements: DataFrame, attachments: DataFrame, companies: DataFrame, calls: DataFrame) -> DataFrame:
    """What happened to each company's rows, of all eight kinds, with `place` by time within the scope (ties by stage, label, ids).

    announcements: scope, announcement_id, title, announced_at, fetched_at, summary_at; attachments: scope, announcement_id, url,
    filename, downloaded_at, extracted_at, summary_at; companies: scope, ticker, updated_at; calls of the model: scope, audit_id,
    stage, filename, announcement_id, status, started_at, finished_at, elapsed, prompt_tokens, completion_tokens. The first two events
    of an announcement, a company's and a call's are there even without a time, which comes first; others need one.
    """
    empty = announcements.sparkSession.createDataFrame([], EVENT)

    def event(at: str, stage: Column | str, label: Column | str, always: bool, **more: str) -> Column:
        cols = {"scope": F.col("scope"), "at": F.col(at), "stage": F.lit(stage) if isinstance(stage, str) else stage, "label": F.col(label) if isinstance(label, str) else label} | {n: F.col(c) for n, c in more.items()}
        fields = [cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema]
        return F.struct(*fields, (F.lit(always) | F.col(at).isNotNull()).alias("_there"))

    def events(rows: DataFrame, *some: Column) -> DataFrame:
        return rows.select(F.inline(F.array(*some))).where("_there").drop("_there")

    one, file = {"announcement_id": "announcement_id"}, {"announcement_id": "announcement_id", "url": "url"}
    companies = companies.withColumn("label", F.concat("ticker", F.lit(" company digest")))
    named = calls.join(companies.select(F.col("scope").alias("_s"), "ticker"), F.col("scope") == F.col("_s"), "left")
    llm = F.coalesce(F.nullif("filename", F.lit("")), F.nullif("announcement_id", F.lit("")), "ticker")
    # Each table is read, and what it comes from joined, once for all of its events.
    parts = [
        events(announcements, event("announced_at", "idx-announced", "title", True, **one), event("fetched_at", "metadata-saved", "title", True, **one), event("summary_at", "announcement-summary", "title", False, **one)),
        events(attachments, event("downloaded_at", "downloaded", "filename", False, **file), event("extracted_at", "extracted", "filename", False, **file), event("summary_at", "document-summary", "filename", False, **file)),
        events(companies, event("updated_at", "company-summary", "label", True)),
        events(named, event("started_at", F.concat(F.lit("llm-"), "stage"), llm, True, status="status", elapsed="elapsed", prompt_tokens="prompt_tokens", completion_tokens="completion_tokens", audit_id="audit_id", end_at="finished_at")),
    ]
    for p in parts:
        empty = empty.unionByName(p)
    keys = None
    for rows, times in ((announcements, 3), (attachments, 3), (companies, 1), (named, 1)):
        own = rows.groupBy("scope").agg((F.count(F.lit(1)) * times).alias("times")).withColumn("scope", F.col("scope").cast("string"))
        keys = own if keys is None else keys.unionByName(own)
    return numbered(empty, ["scope"], [F.col("at").asc_nulls_first(), "stage", "label", "announcement_id", "url", "audit_id"], "place", keys)


def prompt_status(companies: DataFrame, calls: DataFrame, legacy: str) -> DataFrame:
    """companies (scope, prompt_version) with where the shown prompt comes from: `status`, and `audit_id` of the call that it is read from.

    calls: scope, audit_id, stage, status, started_at. The last successful call of stage company is exact; without one the prompt is
    rebuilt from the legacy template if that made the digest, else from the current one.
    """
    exact = calls.where("stage = 'company' and status = 'succeeded'").groupBy("scope").agg(F.max_by("audit_id", F.struct("started_at", "audit_id")).alias("audit_id"))
    status = F.when(F.col("audit_id").isNotNull(), "exact_audit").when(F.coalesce(F.col("prompt_version") == legacy, F.lit(False)), "reconstructed_legacy_template").otherwise("reconstructed_current_template")
    return companies.join(exact, "scope", "left").withColumn("status", status)


#: The sections of a company digest in their order, with their headings; those shared unless others are asked for; title and notice.
SECTIONS = {
    "overview": "Overview",
    "timeline": "Timeline",
    "material_changes": "Material changes",
    "key_financial_figures": "Key financial figures",
    "corporate_actions": "Corporate actions",
    "expansion_projects": "Expansion projects",
    "management_or_control_changes": "Management / control changes",
    "capital_structure_events": "Capital structure",
    "listing_or_regulatory_events": "Listing / regulatory",
    "analytical_scenarios": "Analytical scenarios",
    "risks_or_uncertainties": "Risks / uncertainties",
    "items_to_monitor": "Items to monitor",
    "limitations": "Limitations",
}
SHARED = tuple(s for s in SECTIONS if s not in ("timeline", "limitations"))
TITLE = "IDX Signal Desk · Company Digests"
NOTICE = "Each ticker below is rendered from its own saved company digest. No cross-company LLM aggregation is performed."


def _full(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def _entries(key: str) -> Column:
    """The lines of a section of a company (struct fields as in the digest's schema), or none."""
    some = F.col(key)
    present = lambda c: _full(c) != ""
    if key == "overview":
        return F.when(present(some), F.array(_full(some))).otherwise(F.array().cast("array<string>"))
    if key == "timeline":
        head = lambda x: F.array_join(F.filter(F.array(_full(x["announced_at"]), _full(x["title"])), lambda p: p != ""), " · ")
        line = lambda x: F.when(present(x["summary"]), F.concat(F.lit("- **"), F.when(head(x) != "", head(x)).otherwise("Announcement"), F.lit(":** "), _full(x["summary"]))).when(head(x) != "", F.concat(F.lit("- **"), head(x), F.lit("**")))
    elif key == "key_financial_figures":
        period = lambda x: F.when(present(x["period"]), F.concat(F.lit(" ("), _full(x["period"]), F.lit(")"))).otherwise("")
        line = lambda x: F.when(present(x["value"]), F.concat(F.lit("- **"), F.when(present(x["metric"]), _full(x["metric"])).otherwise("Figure"), F.lit(":** "), _full(x["value"]), period(x)))
    elif key == "analytical_scenarios":

        def line(x: Column) -> Column:
            bits = F.array_join(F.filter(F.array(_full(x["classification"]), _full(x["confidence"])), lambda p: p != ""), ", ")
            first = F.concat(F.lit("- **"), F.when(present(x["topic"]), _full(x["topic"])).otherwise("Scenario"), F.lit("**"), F.when(bits != "", F.concat(F.lit(" ["), bits, F.lit("]"))).otherwise(""), F.lit(": "), _full(x["analysis"]))
            more = [F.when(F.size(strings(x[n])) > 0, F.concat(F.lit(f"  - {n.capitalize()}: "), F.array_join(strings(x[n]), "; "))) for n in ("basis", "assumptions", "caveats")]
            return F.concat_ws("\n", F.regexp_replace(first, r"(?U)\s+$", ""), *more)

    else:
        line = lambda x: F.when(present(x), F.concat(F.lit("- "), _full(x)))
    return F.filter(F.transform(F.coalesce(some, F.array()), line), lambda t: t.isNotNull())


def share_blocks(companies: DataFrame, sections: list[str]) -> DataFrame:
    """(ticker, block): each company (ticker, announcement_count, sections) as Markdown, sections that are null or empty left out.

    The overview is a text, timeline, figures and scenarios are arrays of structs, other sections arrays of texts.
    """
    parts = [F.array(F.lit("---"), F.lit(""), F.concat(F.lit("## "), F.col("ticker")), F.lit(""))]
    none = F.array().cast("array<string>")
    parts.append(F.when(F.col("announcement_count").isNotNull(), F.array(F.concat(F.lit("**Announcements:** "), F.col("announcement_count").cast("string")), F.lit(""))).otherwise(none))
    for s in (s for s in SECTIONS if s in sections):
        empty = (F.coalesce(F.col(s), F.lit("")) == "") if s == "overview" else (F.coalesce(F.size(s), F.lit(0)) <= 0)
        lines = _entries(s)
        shown = F.concat(F.array(F.lit(f"### {SECTIONS[s]}"), F.lit("")), lines, F.when(F.size(lines) > 0, F.array(F.lit(""))).otherwise(none))
        parts.append(F.when(empty, none).otherwise(shown))
    return companies.select("ticker", F.array_join(F.concat(*parts), "\n").alias("block"))


def share_header(start: str, end: str, n: Column, title: str = TITLE) -> Column:
    """What stands above the companies' blocks."""
    return F.concat(F.lit(f"# {title}\n\n**Window:** {start} → {end}\n**Companies:** "), n.cast("string"), F.lit(f"\n\n> {NOTICE}\n"))


def share_document(companies: DataFrame, start: str, end: str, sections: list[str]) -> DataFrame:
    """(markdown) of one bundle: the header, then each company's block by ticker; one row, for bundles that a person reads."""
    blocks = share_blocks(companies, sections)
    rows = blocks.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("ticker", "block"))).alias("b"))
    body = F.array_join(F.concat(F.array(share_header(start, end, F.col("n"))), F.transform("b", lambda x: x["block"])), "\n")
    return rows.select(F.concat(F.regexp_replace(body, r"(?U)\s+$", ""), F.lit("\n")).alias("markdown"))
