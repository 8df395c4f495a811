"""Ordered rule chains: first match as one CASE column, all matches as an array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ordered phrases of headline categories; the first match wins.
TITLE_RULES = (
    ("PUBLIC_EXPOSE", ("paparan publik", "public expose", "public exposure", "investor meeting", "investor presentation", "pemaparan kinerja", "presentasi investor", "materi investor")),
    ("RUPS", ("rups", "rapat umum para pemegang saham", "rapat pemegang saham", "rapat umum pemegang saham")),
    ("CORRECTION", ("koreksi", "perbaikan atas")),
    ("FINANCIAL_REPORT", ("laporan keuangan", "financial statement")),
    ("DIVIDEND", ("dividen", "dividend")),
    ("BUYBACK", ("beli back", "beli-back", "buyback", "buy back", "pembelian kembali saham", "pembelian kembali")),
    ("RIGHTS_ISSUE", ("hak tagih", "rights issue", "metode hak tagih")),
    ("BOND", ("obligasi", "sukuk", "bond")),
    ("REGULATORY", ("pemeringkatan", "pemeringkat efek", "pefindo", "moody's", "s&p", "rating agen")),
    ("SHAREHOLDER_CHANGE", ("kepemilikan saham", "perubahan kepemilikan", "ownership")),
    ("LISTING", ("pencatatan saham", "pencatatan tambahan")),
    ("DELISTING", ("delisting", "penghapusan dari daftar", "go private")),
    ("MANAGEMENT_CHANGE", ("direksi", "komisaris", "manajemen", "komite nominasi")),
    ("ACQUISITION", ("akuisisi", "acquisition")),
    ("MERGER", ("penggabungan usaha", "merger", "konsolidasi usaha", "peleburan usaha")),
    ("ASSET_TRANSACTION", ("penjualan aset", "pengalihan aset")),
    ("LEGAL", ("perkara hukum", "tuntutan hukum", "gugatan", "legal", "litigasi")),
    ("REGULATORY", ("surat bebas tekanan", "regulasi", "surat pernyataan")),
    ("CLARIFICATION", ("klarifikasi atas", "tanggapan atas berita")),
    ("ROUTINE_REPORT", ("bulan", "kegiatan registrasi", "registrasi", "pemberitahuan", "iklan")),
)
FALLBACK = "ROUTINE_REPORT"
#: Headline categories that matter to an owner.
SIGNIFICANT = ("FINANCIAL_REPORT", "DIVIDEND", "RUPS", "RIGHTS_ISSUE", "BUYBACK", "BOND", "DEBT", "REVERSE_SPLIT", "STOCK_SPLIT", "ACQUISITION", "MERGER", "DELISTING", "SHAREHOLDER_CHANGE", "LISTING")

#: Ordered phrases of the taxonomy; all matches count.
TAXONOMY = (
    ("RIGHTS_ISSUE", ("rights issue", "hak memesan efek terlebih dahulu", "hmetd")),
    ("PRIVATE_PLACEMENT", ("private placement", "penambahan modal tanpa hak memesan efek terlebih dahulu", "pmthmetd")),
    ("BUYBACK", ("buyback", "pembelian kembali saham")),
    ("STOCK_SPLIT", ("stock split", "pemecahan nilai nominal")),
    ("REVERSE_SPLIT", ("reverse stock split", "penggabungan nilai nominal")),
    ("BONUS_SHARES", ("saham bonus", "bonus shares")),
    ("CONVERSION", ("konversi", "conversion")),
    ("ACQUISITION", ("akuisisi", "acquisition")),
    ("DIVESTMENT", ("divestasi", "divestment", "pelepasan aset", "penjualan aset")),
    ("MERGER", ("merger", "penggabungan usaha")),
    ("JOINT_VENTURE", ("joint venture", "ventura bersama")),
    ("RELATED_PARTY", ("pihak berelasi", "related party", "afiliasi")),
    ("ASSET_TRANSACTION", ("transaksi aset", "asset transaction")),
    ("CONTROLLER_CHANGE", ("perubahan pengendali", "change of control", "pengendali baru")),
    ("SHAREHOLDER_CHANGE", ("perubahan pemegang saham", "shareholder change")),
    ("MANAGEMENT_CHANGE", ("perubahan pengurus", "perubahan direksi", "perubahan komisaris", "management change", "subsidiary management", "pengelolaan perusahaan anak", "penyesuaian pengelolaan perusahaan anak")),
    ("TREASURY_SHARES", ("saham treasuri", "treasury shares", "treasury stock")),
    ("FREE_FLOAT", ("free float",)),
    ("RUPSLB", ("rupslb", "rapat umum pemegang saham luar biasa")),
    ("RUPS", ("rups", "rapat umum pemegang saham")),
    ("PUBLIC_EXPOSE", ("public expose", "paparan publik", "investor presentation")),
    ("SUSPENSION", ("suspensi", "suspension")),
    ("UNSUSPENSION", ("unsuspension", "pembukaan suspensi")),
    ("DELISTING", ("delisting", "penghapusan pencatatan")),
    ("LISTING", ("listing", "pencatatan saham")),
    ("DIVIDEND", ("dividen", "dividend")),
    ("REFINANCING", ("refinancing", "pembiayaan kembali")),
    ("BOND", ("obligasi", "bond", "sukuk")),
    ("DEBT", ("utang", "debt", "pinjaman", "loan facility")),
    ("EARNINGS", ("laba", "earnings", "profit")),
    ("FINANCIAL_REPORT", ("laporan keuangan", "financial statement", "financial report")),
    ("NEW_SUBSIDIARY", ("anak usaha baru", "new subsidiary", "pendirian anak usaha")),
    ("NEW_CAPACITY", ("kapasitas baru", "new capacity", "commissioning")),
    ("NEW_PROJECT", ("proyek baru", "new project")),
    ("CAPEX", ("capex", "capital expenditure", "belanja modal")),
    ("EXPANSION", ("ekspansi", "expansion")),
    ("NEW_BUSINESS", ("kegiatan usaha baru", "new business", "perubahan kegiatan usaha")),
    ("CLARIFICATION", ("klarifikasi", "clarification")),
    ("IDX_INQUIRY_RESPONSE", ("tanggapan atas permintaan penjelasan", "jawaban atas permintaan penjelasan", "idx inquiry")),
    ("CORRECTION", ("koreksi", "correction", "revisi")),
    ("ANNUAL_REPORT", ("laporan tahunan", "annual report")),
    ("ROUTINE_REPORT", ("laporan bulanan", "monthly report", "laporan registrasi pemegang efek")),
    ("LEGAL", ("gugatan", "perkara", "legal", "litigation")),
    ("REGULATORY", ("regulasi", "regulatory", "otoritas", "izin")),
)
#: Tags of high and of medium materiality.
HIGH = ("RIGHTS_ISSUE", "PRIVATE_PLACEMENT", "ACQUISITION", "DIVESTMENT", "MERGER", "CONTROLLER_CHANGE", "SUSPENSION", "DELISTING")
MEDIUM = ("DIVIDEND", "BUYBACK", "STOCK_SPLIT", "REVERSE_SPLIT", "BONUS_SHARES", "CONVERSION", "JOINT_VENTURE", "ASSET_TRANSACTION", "RELATED_PARTY", "EXPANSION", "CAPEX", "NEW_PROJECT", "NEW_CAPACITY", "NEW_SUBSIDIARY", "NEW_BUSINESS", "MANAGEMENT_CHANGE", "SHAREHOLDER_CHANGE", "TREASURY_SHARES", "FREE_FLOAT", "DEBT", "REFINANCING", "BOND", "REGULATORY", "LEGAL", "UNSUSPENSION")


def plain(text: Column) -> Column:
    """Lower case, white space as single spaces, none at the ends; null as empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " ")))


def let(value: Column, then) -> Column:
    """then(value), with the value computed once however often it is used: plans stay as small as they read."""
    return F.transform(F.array(value), then)[0]


def any_phrase(text: Column, phrases) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | F.contains(text, F.lit(p))
    return found


def first_match(text: Column, rules, fallback: str | None) -> Column:
    """The label of the first rule with a phrase in the text."""
    (label, phrases), *rest = rules
    out = F.when(any_phrase(text, phrases), F.lit(label))
    for label, phrases in rest:
        out = out.when(any_phrase(text, phrases), F.lit(label))
    return out.otherwise(F.lit(fallback))


def all_matches(text: Column, rules) -> Column:
    """The labels of all rules with a phrase in the text, in order."""
    return F.array_compact(F.array(*[F.when(any_phrase(text, phrases), F.lit(label)) for label, phrases in rules]))


def title_category(title: Column) -> Column:
    return let(plain(title), lambda t: first_match(t, TITLE_RULES, FALLBACK))


def document_class(title: Column) -> Column:
    """public_expose, financial_report or general."""
    return let(plain(title), lambda t: first_match(t, (("public_expose", TITLE_RULES[0][1]), ("financial_report", TITLE_RULES[3][1])), "general"))


def owner_materiality(category: Column, in_portfolio: Column, in_watchlist: Column) -> Column:
    """HIGH or MEDIUM for owners and watchers of significant categories, otherwise ROUTINE."""
    significant = category.isin(*SIGNIFICANT)
    return F.when(significant & F.coalesce(in_portfolio, F.lit(False)), "HIGH").when(significant & F.coalesce(in_watchlist, F.lit(False)), "MEDIUM").otherwise("ROUTINE")


def _some(facts: Column | None) -> Column:
    return F.lit(False) if facts is None else F.size(F.filter(F.coalesce(facts, F.array().cast("array<string>")), lambda x: F.trim(x) != "")) > 0


def taxonomy_tags(blob: Column, expansion: Column | None = None, management: Column | None = None, regulatory: Column | None = None) -> Column:
    """All tags of a text; facts of a kind that no tag names add that kind's usual one; OTHER if there is none."""
    tags = let(plain(blob), lambda t: all_matches(t, TAXONOMY))
    usual = (
        (expansion, ("EXPANSION", "CAPEX", "NEW_PROJECT", "NEW_CAPACITY", "NEW_SUBSIDIARY", "NEW_BUSINESS"), "EXPANSION"),
        (management, ("CONTROLLER_CHANGE", "MANAGEMENT_CHANGE", "BOARD_CHANGE"), "MANAGEMENT_CHANGE"),
        (regulatory, ("SUSPENSION", "UNSUSPENSION", "LISTING", "DELISTING", "REGULATORY", "LEGAL"), "REGULATORY"),
    )
    # The kinds share no tags, so each may look at the tags that the text names.
    none = F.array().cast("array<string>")
    added = [(_some(facts), F.array(*map(F.lit, named)), F.array(F.lit(tag))) for facts, named, tag in usual if facts is not None]

    def whole(found: Column) -> Column:
        parts = [F.when(some & ~F.arrays_overlap(found, named), tag).otherwise(none) for some, named, tag in added]
        return let(F.array_distinct(F.concat(found, *parts)) if parts else found, lambda t: F.when(F.size(t) == 0, F.array(F.lit("OTHER"))).otherwise(t))

    return let(tags, whole)


def headline(title: Column) -> Column:
    """The first taxonomy category that the headline names, or null."""
    return let(plain(title), lambda t: first_match(t, TAXONOMY, None))


def primary_first(title: Column, tags: Column) -> Column:
    """Tags with the headline's category, or else their first, in front."""
    head = headline(title)
    return let(tags, lambda t: let(F.coalesce(head, t[0]), lambda p: F.concat(F.array(p), F.array_remove(t, p))))


def tag_materiality(tags: Column, mode: Column) -> Column:
    def of(t: Column) -> Column:
        some = lambda names: F.arrays_overlap(t, F.array(*map(F.lit, names)))
        routine = F.coalesce(mode == "routine_direct", F.lit(False)) | (t == F.array(F.lit("ROUTINE_REPORT")))
        return F.when(some(HIGH), "HIGH").when(some(MEDIUM), "MEDIUM").when(routine, "ROUTINE").otherwise("LOW")

    return let(tags, of)


def confidence(primary: Column, anchored: Column, materiality: Column) -> Column:
    """0.75 for a category from the headline, 0.45 for OTHER, else 0.60; at least 0.65 if routine."""
    base = F.when(anchored, 0.75).when(primary == "OTHER", 0.45).otherwise(0.60)
    return F.when(materiality == "ROUTINE", F.greatest(base, F.lit(0.65))).otherwise(base)


def contains_sql(text: str, phrases) -> str:
    return "(" + " or ".join(f"contains({text}, '" + p.replace("'", "''") + "')" for p in phrases) + ")"


def first_match_sql(text: str, rules, fallback: str | None) -> str:
    other = "null" if fallback is None else f"'{fallback}'"
    return "case " + " ".join(f"when {contains_sql(text, p)} then '{label}'" for label, p in rules) + f" else {other} end"


def all_matches_sql(text: str, rules) -> str:
    return "list_filter([" + ", ".join(f"case when {contains_sql(text, p)} then '{label}' end" for label, p in rules) + "], lambda x: x is not null)"


PLAIN_SQL = r"lower(trim(regexp_replace(coalesce({0}, ''), '\s+', ' ', 'g')))"
