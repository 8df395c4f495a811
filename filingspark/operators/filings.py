"""Attachment selection, exclusion reasons and triage of routine filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import suffix
from .rules import any_phrase

#: Phrases by which attachments are told apart.
FINANCIAL_TITLES = ("laporan keuangan", "financial statement", "financial statements")
ADMINISTRATIVE = ("checklist", "check list", "surat pernyataan", "pernyataan direksi", "pernyataan manajemen", "management statement", "director statement", "pengungkapan lk")
PRIMARY = ("laporan keuangan", "lap keuangan")
GENERIC = ("financial statement", "financialstatement")
SUPPORTED = (".pdf", ".xlsx", ".xlsm", ".docx", ".html", ".htm", ".txt", ".csv", ".json", ".xml")
SPREADSHEETS = (".xlsx", ".xlsm")

#: Signals that a routine filing hides a material change.
SIGNALS = (
    ("control-change", r"perubahan\s+(?:pemegang\s+saham\s+)?pengendali|pengambilalihan|menjadi\s+pengendali|tidak\s+lagi\s+menjadi\s+pengendali"),
    ("director-transaction", r"(?:direksi|direktur|komisaris).{0,120}(?:membeli|menjual|pembelian|penjualan|transaksi\s+saham|bertambah|berkurang)"),
    ("share-transaction", r"(?:transaksi\s+saham|pengalihan\s+saham|penjualan\s+saham|pembelian\s+saham)"),
    ("ownership-increase", r"(?:penambahan|kenaikan|bertambahnya)\s+(?:jumlah\s+)?kepemilikan"),
    ("ownership-decrease", r"(?:pengurangan|penurunan|berkurangnya)\s+(?:jumlah\s+)?kepemilikan"),
    ("free-float-breach", r"free\s*float.{0,120}(?:tidak\s+memenuhi|di\s+bawah|kurang\s+dari|pelanggaran)"),
    ("treasury-change", r"(?:saham\s+treasuri|treasury\s+stock).{0,120}(?:bertambah|berkurang|dialihkan|dijual|dibeli)"),
)
#: The title of routine filings, words about ownership, and percentages.
ROUTINE_TITLE = r"\blaporan\s+bulanan\s+registrasi\s+pemegang\s+efek\b"
OWNERSHIP = r"pemegang|kepemilikan|pengendali|direksi|direktur|komisaris|free\s*float|treasuri"
PERCENT = r"(?<!\d)(\d{1,3}(?:[.,]\d{1,4})?)\s*%"


#: Reasons that selection gives.
REASONS = {
    "lone": "fallback main PDF because no named financial-statement PDF was found",
    "zip": "machine/XBRL ZIP package",
    "general": "supported attachment",
    "spreadsheet": "financial-statement spreadsheet",
    "administrative": "administrative/supporting financial-report document",
    "primary": "primary human-readable financial-statement PDF",
    "fallback": "fallback financial-statement PDF because no LK/report PDF was found",
    "duplicate": "duplicate financial-statement PDF; preferred LK/report PDF is available",
    "held": "generic financial-statement PDF held as fallback",
    "other": "not a primary financial statement source",
}
UNSUPPORTED = "unsupported file type "
#: Reasons that triage gives.
TRIAGE = {
    "other": "not a supported routine disclosure",
    "none": "no extracted evidence available",
    "large": "routine evidence exceeds direct-analysis size guard",
    "sparse": "one or more routine sources are too sparse for safe direct analysis",
    "signals": "deterministic routine scan found material-change indicators; use full document pipeline",
    "direct": "routine registration report passed conservative deterministic scan; analyze all raw evidence in one structured call",
    "failed": "selected source extraction failed; conservative full pipeline retained",
}


def folded(text: Column) -> Column:
    """Lower case, underscores and hyphens as spaces, single spaces."""
    return F.trim(F.regexp_replace(F.translate(F.lower(F.coalesce(text, F.lit(""))), "_-", "  "), r"(?U)\s+", " "))


def select_attachments(rows: DataFrame, smart: bool = True) -> DataFrame:
    """rows (announcement_id, title, ordinal, filename, is_attachment) with selected, reason, category.

    In a financial report the spreadsheet and the readable report are taken; a generic statement only
    without such a report, and one main document of any name only if nothing else is named.
    """
    name, end = folded(F.col("filename")), suffix(F.col("filename"))
    financial = any_phrase(folded(F.col("title")), FINANCIAL_TITLES) if smart else F.lit(False)
    pdf = end == ".pdf"
    administrative = pdf & any_phrase(name, ADMINISTRATIVE)
    primary = pdf & (any_phrase(name, PRIMARY) | name.rlike(r"(^|\s)lk(?:tt)?(\s|$)"))
    generic = pdf & any_phrase(name, GENERIC)
    role = (
        F.when(end == ".zip", "zip")
        .when((end != "") & ~end.isin(*SUPPORTED), "unsupported")
        .when(~financial, "general")
        .when(end.isin(*SPREADSHEETS), "spreadsheet")
        .when(administrative, "administrative")
        .when(primary, "primary")
        .when(generic, "generic")
        .otherwise("supporting")
    )
    rows = rows.withColumn("role", role).withColumn("financial", financial)
    group = Window.partitionBy("announcement_id")
    count = lambda c: F.sum(c.cast("int")).over(group)
    r = F.col("role")
    rows = rows.withColumn("n_primary", count(r == "primary")).withColumn("n_generic", count(r == "generic"))
    main = pdf & ~any_phrase(name, ADMINISTRATIVE) & ~F.col("is_attachment")
    rows = rows.withColumn("main", main).withColumn("n_main", count(main))
    pick = F.row_number().over(Window.partitionBy("announcement_id", "role").orderBy(F.col("is_attachment").cast("int"), "ordinal"))
    rows = rows.withColumn("pick", pick)
    fallback = (r == "generic") & (F.col("n_primary") == 0) & (F.col("pick") == 1)
    lone = F.col("financial") & (F.col("n_primary") == 0) & (F.col("n_generic") == 0) & (F.col("n_main") == 1) & F.col("main")
    ladder = (
        (lone, True, REASONS["lone"], "financial_statement"),
        (r == "zip", False, REASONS["zip"], "machine_package"),
        (r == "unsupported", False, None, "unsupported"),
        (r == "general", True, REASONS["general"], "general_source"),
        (r == "spreadsheet", True, REASONS["spreadsheet"], "financial_statement"),
        (r == "administrative", False, REASONS["administrative"], "administrative"),
        (r == "primary", True, REASONS["primary"], "financial_statement"),
        (fallback, True, REASONS["fallback"], "financial_statement"),
        ((r == "generic") & (F.col("n_primary") > 0), False, REASONS["duplicate"], "financial_statement_duplicate"),
        (r == "generic", False, REASONS["held"], "financial_statement_duplicate"),
    )
    selected, reason, category = F.lit(False), F.lit(REASONS["other"]), F.lit("supporting")
    for test, take, why, kind in reversed(ladder):
        selected = F.when(test, F.lit(take)).otherwise(selected)
        reason = F.when(test, F.concat(F.lit(UNSUPPORTED), end) if why is None else F.lit(why)).otherwise(reason)
        category = F.when(test, F.lit(kind)).otherwise(category)
    return rows.withColumns({"selected": selected, "reason": reason, "category": category}).drop("role", "financial", "n_primary", "n_generic", "main", "n_main", "pick")


def exclusion_reason(ticker: Column, stock: Column, n_selected: Column, missing: Column) -> Column:
    """Why an announcement is left out, the first reason that holds, or null."""
    t = F.coalesce(F.trim(ticker), F.lit(""))
    return F.when(t == "", "blank_ticker").when(~t.rlike("^[A-Z0-9.]{1,10}$"), "bad_ticker").when(~stock, "non_stock").when(n_selected == 0, "no_attachment").when(missing, "attachment_missing")


def percent_delta(text: Column, least: float = 0.10) -> Column:
    """The first line about ownership with two percentages at least `least` apart: (line, low, high), or null."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda s: F.trim(F.regexp_replace(s, r"(?U)\s+", " ")))

    def measured(line: Column) -> Column:
        values = F.transform(F.regexp_extract_all(line, F.lit(PERCENT), F.lit(1)), lambda v: F.replace(v, F.lit(","), F.lit(".")).cast("double"))
        return F.struct(line.alias("line"), F.array_min(values).alias("low"), F.array_max(values).alias("high"), F.size(values).alias("n"))

    about = F.filter(lines, lambda s: (F.length(s) <= 1200) & s.rlike(f"(?i){OWNERSHIP}") & F.contains(s, F.lit("%")))
    hits = F.filter(F.transform(about, measured), lambda m: (m["n"] >= 2) & (m["high"] - m["low"] >= least))
    return F.get(hits, 0)


def signals(text: Column, least: float = 0.10) -> Column:
    """Sorted names of the signals in a text."""
    found = [F.when(F.coalesce(text, F.lit("")).rlike(f"(?is){p}"), F.lit(name)) for name, p in SIGNALS]
    found.append(F.when(percent_delta(text, least).isNotNull(), F.lit("ownership-percentage-delta")))
    return F.array_sort(F.array_compact(F.array(*found)))


def triage(rows: DataFrame, max_characters: int = 70_000, least: float = 0.10) -> DataFrame:
    """(announcement_id, mode, reason, signals, total, documents) from rows (announcement_id, title, text or null, ordinal).

    A text without a row of evidence has null. Routine filings that pass every test go direct, all others in
    full. Sizes decide first: only the texts of routine filings within the guard are gathered.
    """
    has = F.col("text").isNotNull()
    facts = rows.groupBy("announcement_id").agg(
        F.max("title").alias("title"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("total"),
        F.sum(has.cast("int")).alias("documents"),
        F.min(F.when(has, F.length(F.regexp_replace("text", r"(?U)^\s+|\s+$", "")))).alias("least"),
    )
    routine = F.coalesce(F.col("title"), F.lit("")).rlike(f"(?i){ROUTINE_TITLE}")
    facts = facts.withColumn("scanned", routine & (F.col("documents") > 0) & (F.col("total") <= max_characters) & (F.col("least") >= 120))
    texts = rows.where(has).join(facts.where("scanned").select("announcement_id"), "announcement_id", "left_semi")
    texts = texts.groupBy("announcement_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "text"))), lambda x: x["text"]), "\n").alias("combined"))
    none = F.array().cast("array<string>")
    facts = facts.join(texts, "announcement_id", "left").withColumn("found", F.when(F.col("scanned"), signals(F.col("combined"), least)).otherwise(none))
    ladder = (
        (~routine, "full", TRIAGE["other"], none),
        (F.col("documents") == 0, "full", TRIAGE["none"], F.array(F.lit("no-evidence"))),
        (F.col("total") > max_characters, "full", TRIAGE["large"], F.array(F.lit("large-evidence"))),
        (F.col("least") < 120, "full", TRIAGE["sparse"], F.array(F.lit("sparse-evidence"))),
        (F.size("found") > 0, "full", TRIAGE["signals"], F.col("found")),
    )
    mode, reason, named = F.lit("routine_direct"), F.lit(TRIAGE["direct"]), none
    for test, m, why, s in reversed(ladder):
        mode, reason, named = F.when(test, m).otherwise(mode), F.when(test, why).otherwise(reason), F.when(test, s).otherwise(named)
    return facts.select("announcement_id", mode.alias("mode"), reason.alias("reason"), named.alias("signals"), "total", "documents")


def after_failures(triaged: DataFrame, failures: Column) -> DataFrame:
    """triaged (mode, reason, signals) with what failed extractions (their number) change: nothing goes direct then."""
    override = (failures > 0) & (F.col("mode") == "routine_direct")
    return triaged.withColumns(
        {
            "signals": F.when(override, F.array_append("signals", F.lit("extraction-failure"))).otherwise(F.col("signals")),
            "reason": F.when(override, TRIAGE["failed"]).otherwise(F.col("reason")),
            "mode": F.when(override, "full").otherwise(F.col("mode")),
        }
    )
