"""Contracts: field checks as violation rows, structured validation, provenance, structured analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_date, joined, json_string, strings, strip
from . import rules


def violations(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(key, violation) for each check that a row fails; a null outcome fails."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    return df.select(key, F.explode(failed).alias("violation"))


def text_between(c: Column, least: int, most: int) -> Column:
    return F.length(strip(c)).between(least, most)


def unique_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def parse_strict(df: DataFrame, column: str, schema: str) -> DataFrame:
    """df with `parsed` and `problem`: invalid JSON, unknown keys or missing ones; only rows without a problem are parsed."""
    fields = [x.split()[0].rstrip(":") for x in _split(schema)]
    keys = F.json_object_keys(column)
    named = F.array(*map(F.lit, fields))
    problem = (
        F.when(keys.isNull(), "invalid")
        .when(F.size(F.array_except(keys, named)) > 0, F.concat(F.lit("unknown:"), F.array_join(F.array_except(keys, named), ",")))
        .when(F.size(F.array_except(named, keys)) > 0, F.concat(F.lit("missing:"), F.array_join(F.array_except(named, keys), ",")))
    )
    out = df.withColumn("problem", problem)
    return out.withColumn("parsed", F.when(F.col("problem").isNull(), F.from_json(column, schema)))


def _split(schema: str) -> list[str]:
    """The top-level fields of a DDL schema."""
    out, depth = [""], 0
    for c in schema:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


#: Fixed value: the beginning of a made-up title.
UNTITLED = "IDX disclosure "


def title_of(title: Column, subject: Column, kind: Column, ticker: Column) -> tuple[Column, Column]:
    """(title, the field it came from): title, subject, kind, or made up."""
    full = lambda c: F.nullif(strip(F.coalesce(c, F.lit(""))), F.lit(""))
    made = F.concat(F.lit(UNTITLED), ticker)
    source = F.when(full(title).isNotNull(), "title").when(full(subject).isNotNull(), "subject").when(full(kind).isNotNull(), "type").otherwise("synthetic")
    return F.coalesce(full(title), full(subject), full(kind), made), source


def sections(requested: Column, known: tuple[str, ...]) -> Column:
    """Known sections in canonical order, each once; an unknown one is an error."""
    order = F.array(*map(F.lit, known))
    unknown = F.array_except(requested, order)
    return F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown sections: "), F.array_join(unknown, ",")))).otherwise(F.array_intersect(order, requested))


def provenance(metadata: Column, allowed: tuple[str, ...], hosts: Column) -> Column:
    """Only allowed keys of a map, and at most twenty distinct lower-case hosts."""
    keep = F.map_filter(metadata, lambda k, v: k.isin(*allowed) & v.isNotNull())
    return F.struct(keep.alias("metadata"), F.slice(F.array_distinct(F.transform(hosts, lambda h: F.lower(strip(h)))), 1, 20).alias("hosts"))


def claim_type(value: Column) -> Column:
    v = F.lower(strip(F.coalesce(value, F.lit(""))))
    return F.when(v.isin("explicit_fact", "derived_calculation"), F.upper(v)).otherwise("ANALYST_HYPOTHESIS")


def level(value: Column) -> Column:
    v = F.upper(strip(F.coalesce(value, F.lit(""))))
    return F.when(v.isin("HIGH", "MEDIUM", "LOW"), v)


def priority(in_portfolio: Column, in_watchlist: Column) -> Column:
    """P0 for owners, P1 for those who only watch, else P4, the lowest."""
    p, w = F.coalesce(in_portfolio, F.lit(False)), F.coalesce(in_watchlist, F.lit(False))
    return F.when(p, "P0").when(w, "P1").otherwise("P4")


#: What is said of a priority that doesn't fit.
OWNED, WATCHED = "open portfolio positions must be P0", "watchlist-only positions must be P1"


def priority_problem(in_portfolio: Column, in_watchlist: Column, given: Column) -> Column:
    """Why a given priority (0 to 4) breaks the contract, or null."""
    p, w = F.coalesce(in_portfolio, F.lit(False)), F.coalesce(in_watchlist, F.lit(False))
    return F.when(~F.coalesce(given.between(0, 4), F.lit(False)), "priority out of range").when(p & (given != 0), OWNED).when(~p & w & (given != 1), WATCHED)


SCENARIO = "struct<analysis:string,classification:string,confidence:string,basis:array<string>,assumptions:array<string>,caveats:array<string>>"
SUMMARY = f"category string, executive_summary string, material_facts array<string>, corporate_actions array<string>, expansion_projects array<string>, management_or_control_changes array<string>, capital_structure_events array<string>, listing_or_regulatory_events array<string>, possible_investor_relevance array<string>, risks_or_uncertainties array<string>, limitations array<string>, analytical_scenarios array<{SCENARIO}>, financial_figures array<struct<metric:string,value:string,period:string>>, dates_and_deadlines array<struct<date:string,event:string>>"


#: Fixed value: what an analysis by rules says of its limits.
RULES_LIMITATION = "This summary was produced by rule-based classification from IDX metadata only. The source document was not read."


def structured(rows: DataFrame, notes: tuple[str, ...] = (), anchored_note: str | None = None) -> DataFrame:
    """Structured analyses of rows (announcement_id, ticker, title, mode, summary as a struct of SUMMARY).

    notes join every analysis's limitations, anchored_note those whose category comes from the headline. problem says why a row has none: it lacks an executive summary.
    """
    s = lambda f: F.col(f"summary.{f}")
    facts = [s(f) for f in ("material_facts", "corporate_actions", "expansion_projects", "management_or_control_changes", "capital_structure_events", "listing_or_regulatory_events")]
    blob = F.concat_ws(" ", "title", s("category"), *[F.array_join(strings(f), " ") for f in facts])
    rows = rows.withColumn("tags", rules.taxonomy_tags(blob, s("expansion_projects"), s("management_or_control_changes"), s("listing_or_regulatory_events")))
    rows = rows.withColumn("anchored", rules.headline(F.col("title")).isNotNull()).withColumn("tags", rules.primary_first(F.col("title"), F.col("tags")))
    p = F.col("tags")[0]
    rows = rows.withColumn("materiality", rules.tag_materiality(F.when(F.col("anchored"), F.array(p)).otherwise(F.col("tags")), F.col("mode")))
    absent = F.lit(None).cast("string")
    stated = F.transform(strings(s("material_facts")), lambda x: F.struct(F.lit("EXPLICIT_FACT").alias("type"), x.alias("text"), *[absent.alias(n) for n in ("confidence", "basis", "assumptions", "caveats")]))
    thought = F.transform(
        F.filter(F.coalesce(s("analytical_scenarios"), F.array().cast(f"array<{SCENARIO}>")), lambda x: F.coalesce(strip(x["analysis"]), F.lit("")) != ""),
        lambda x: F.struct(claim_type(x["classification"]).alias("type"), strip(x["analysis"]).alias("text"), level(x["confidence"]).alias("confidence"), *[joined(strings(x[n])).alias(n) for n in ("basis", "assumptions", "caveats")]),
    )
    figures = F.filter(F.coalesce(s("financial_figures"), F.array().cast("array<struct<metric:string,value:string,period:string>>")), lambda x: (F.coalesce(strip(x["metric"]), F.lit("")) != "") & (F.coalesce(strip(x["value"]), F.lit("")) != ""))
    blank = lambda c: F.nullif(F.coalesce(strip(c), F.lit("")), F.lit(""))
    numbers = F.transform(figures, lambda x: F.struct(strip(x["metric"]).alias("metric"), strip(x["value"]).alias("value"), blank(x["period"]).alias("period")))
    dates = F.transform(
        F.filter(F.coalesce(s("dates_and_deadlines"), F.array().cast("array<struct<date:string,event:string>>")), lambda x: (F.coalesce(strip(x["date"]), F.lit("")) != "") & (F.coalesce(strip(x["event"]), F.lit("")) != "")),
        lambda x: F.struct(iso_date(x["date"]).alias("date"), strip(x["date"]).alias("text"), strip(x["event"]).alias("event")),
    )
    none = F.array().cast("array<string>")
    noted = F.array(*map(F.lit, notes)) if notes else none
    empty = F.coalesce(strip(s("executive_summary")), F.lit("")) == ""
    return rows.select(
        "announcement_id", "ticker", p.alias("primary_category"), "tags", "materiality", F.lit("UNCLEAR").alias("impact"),
        rules.confidence(p, F.col("anchored"), F.col("materiality")).alias("confidence"),
        strip(s("executive_summary")).alias("executive_summary"),
        F.coalesce(joined(strings(s("possible_investor_relevance")), " "), F.lit("No additional investor-relevance statement was identified in the compatibility analysis.")).alias("why_it_matters"),
        F.concat(stated, thought).alias("claims"), numbers.alias("numbers"), dates.alias("dates"),
        strings(s("risks_or_uncertainties")).alias("risks"),
        F.array_distinct(F.concat(strings(s("limitations")), noted, F.when(F.col("anchored") & F.lit(anchored_note is not None), F.array(F.lit(anchored_note))).otherwise(none))).alias("limitations"),
        F.when(empty, "announcement summary is missing executive_summary").alias("problem"),
    )


def rules_payload(ticker: Column, title: Column, announced_at: Column, category: Column, materiality: Column, in_portfolio: Column, in_watchlist: Column) -> Column:
    """The analysis of one disclosure from its metadata alone, as a struct of the published fields."""
    p, w = F.coalesce(in_portfolio, F.lit(False)), F.coalesce(in_watchlist, F.lit(False))
    who = F.when(p, "A stock you hold").when(w, "A stock on your watchlist").otherwise("A listed issuer")
    named = F.when(materiality != "ROUTINE", " published a disclosure classified as ").otherwise(" published a disclosure of category ")
    day = F.date_format(announced_at, "yyyy-MM-dd")
    none = F.array().cast("array<string>")
    fact = F.struct(
        F.lit("EXPLICIT_FACT").alias("claimType"),
        F.concat(ticker, F.lit(' published an announcement titled "'), title, F.lit('" on '), day, F.lit(".")).alias("text"),
        F.lit("HIGH").alias("confidence"),
        *[F.lit(None).cast("string").alias(n) for n in ("basis", "assumptions", "caveats", "sourceFileId")],
        F.lit(None).cast("int").alias("sourcePage"),
        F.lit(None).cast("string").alias("evidenceExcerpt"),
    )
    return F.struct(
        ticker.alias("ticker"),
        category.alias("primaryCategory"),
        F.array(category).alias("tags"),
        materiality.alias("materiality"),
        F.lit("UNCLEAR").alias("impact"),
        F.lit(1.0).alias("confidence"),
        F.concat(ticker, F.lit(" — "), F.initcap(F.lower(F.translate(category, "_", " "))), F.lit(". Announced "), day, F.lit(". Open the official document for details.")).alias("executiveSummary"),
        F.concat(who, named, category, F.lit(".")).alias("whyItMatters"),
        F.array(fact).alias("materialFacts"),
        none.alias("keyNumbers"),
        none.alias("importantDates"),
        none.alias("risks"),
        none.alias("thingsToWatch"),
        F.array(F.lit(RULES_LIMITATION)).alias("limitations"),
    )


def promoted_claims(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(announcement_id, claims): a single announcement's lists as claims (category, text), each once, in field order."""
    parts = [_named(f, category) for f, category in fields.items()]
    return rows.select("announcement_id", F.array_distinct(F.concat(*parts)).alias("claims"))


def _named(field: str, category: str) -> Column:
    return F.transform(strings(F.col(field)), lambda x: F.struct(F.lit(category).alias("category"), x.alias("text")))


def keyed_merge(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """Two attachment lists (group, ordinal, url, name, and others) as one: rows match by url, else by name;
    earlier fields stay unless empty, later ones fill gaps; in the order of first appearance."""
    full = lambda c: F.nullif(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(""))
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    # A row without a url, or whose url the other list lacks, goes by its name; urls name rows otherwise.
    shared = old.select(group, full("url").alias("_u")).join(new.select(group, full("url").alias("_u")), [group, "_u"], "inner").distinct().withColumn("_s", F.lit(True))
    rows = both.withColumn("_u", full("url")).join(shared, [group, "_u"], "left")
    key = F.when(F.col("_s"), F.concat(F.lit("u:"), "_u")).otherwise(F.concat(F.lit("n:"), F.lower(F.coalesce(full("name"), F.col("_u"), F.lit("")))))
    rows = rows.withColumn("_k", key)
    values = [c for c in old.columns if c not in (group, "ordinal")]
    order = F.struct("_side", "ordinal")
    out = rows.groupBy(group, "_k").agg(F.min(order).alias("_o"), *[F.min_by(full(c), F.when(full(c).isNotNull(), order)).alias(c) for c in values])
    return out.select(group, F.col("_o._side").alias("side"), F.col("_o.ordinal").alias("ordinal"), *values)
