"""Offline snapshots of public pages, reference lists of any usual shape, and stores named by content or URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import host, host_allowed, safe_filename, safe_suffix, short_hash, strip, suffix

#: Kinds of snapshots, the beginnings of their ids, and the exchange's hosts and pages.
EXCHANGE_KIND, EXCHANGE_PREFIX = "idx-public-snapshot-v1", "idx-public-"
ISSUER_KIND, ISSUER_PREFIX = "issuer-public-snapshot-v1", "issuer-public-"
EXCHANGE_HOSTS = ("idx.id", "www.idx.id", "idx.co.id", "www.idx.co.id")
EXCHANGE_PAGES = ("/en/listed-companies/disclosure", "/id/perusahaan-tercatat/keterbukaan-informasi")
_ZONED = r"(?i)^\d{4}-\d{2}-\d{2}[T ].*(z|[+-]\d{2}:?\d{2})$"


def _first(*tests: tuple[Column, str]) -> Column:
    out = F.lit(None).cast("string")
    for test, name in reversed(tests):
        out = F.when(F.coalesce(test, F.lit(True)), name).otherwise(out)
    return out


def _zoned(text: Column) -> Column:
    t = strip(F.coalesce(text, F.lit("")))
    return t.rlike(_ZONED) & F.try_to_timestamp(t).isNotNull()


def exchange_problem(m: Column, claimed: Column) -> Column:
    """Why a manifest's metadata (a map) can't be a snapshot of the exchange's page, or null; claimed: it says that it is complete."""
    page = strip(F.coalesce(m["sourcePage"], F.lit("")))
    path = F.lower(F.rtrim(F.coalesce(F.try_parse_url(page, F.lit("PATH")), F.lit("")), F.lit("/")))
    official = (F.try_parse_url(page, F.lit("PROTOCOL")) == "https") & host(page).isin(*EXCHANGE_HOSTS)
    return _first(
        (m["sourceKind"] != EXCHANGE_KIND, "sourceKind"),
        (F.coalesce(claimed, F.lit(False)), "coverage"),
        (~F.coalesce(official, F.lit(False)), "sourcePage host"),
        (~(F.endswith(path, F.lit(EXCHANGE_PAGES[0])) | F.endswith(path, F.lit(EXCHANGE_PAGES[1]))), "sourcePage path"),
        (~_zoned(m["capturedAt"]), "capturedAt"),
    )


def issuer_host_problem(text: Column) -> Column:
    """Why a host of an issuer's list isn't a public host name, or null."""
    h = F.rtrim(F.lower(strip(F.coalesce(text, F.lit("")))), F.lit("."))
    address = h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    return _first((h == "", "empty"), (h.rlike("://|[/@:]"), "not a host name"), ((h == "localhost") | ~F.contains(h, F.lit(".")), "not public"), (address, "address"))


def issuer_problem(m: Column, hosts: Column, claimed: Column) -> Column:
    """Why a manifest's metadata can't be a snapshot of one issuer's page, or null; hosts: its list of hosts."""
    clean = F.transform(F.coalesce(hosts, F.array().cast("array<string>")), lambda h: F.rtrim(F.lower(strip(h)), F.lit(".")))
    return _first(
        (m["sourceKind"] != ISSUER_KIND, "sourceKind"),
        (F.coalesce(claimed, F.lit(False)), "coverage"),
        (~F.upper(strip(F.coalesce(m["issuerTicker"], F.lit("")))).rlike("^[A-Z0-9]{1,12}$"), "issuerTicker"),
        ((F.size(clean) == 0) | F.exists(clean, lambda h: issuer_host_problem(h).isNotNull()), "issuerHosts"),
        (~issuer_url(m["sourcePage"], clean), "sourcePage"),
        (~_zoned(m["capturedAt"]), "capturedAt"),
    )


def issuer_url(url: Column, hosts: Column) -> Column:
    """HTTPS without credentials, on one of the hosts or below one, on the usual port."""
    u = F.regexp_replace(strip(F.coalesce(url, F.lit(""))), r"^(https://[^/?#@:]+):443(?=[/?#]|$)", "$1")
    return host_allowed(u, hosts)


def exchange_disclosures(rows: DataFrame) -> DataFrame:
    """rows (external_id, source_url, metadata, page, captured_at) with `problem`, the page as the missing source, and what the snapshot adds to the metadata.

    Such a page proves no coverage: complete is always false.
    """
    from ..functions.values import overridden

    added = F.create_map(F.lit("snapshotSourcePage"), "page", F.lit("snapshotCapturedAt"), "captured_at", F.lit("snapshotAuthoritativeCoverage"), F.lit("false"))
    named = F.startswith("external_id", F.lit(EXCHANGE_PREFIX))
    return rows.withColumns({"problem": F.when(~named, "externalId"), "source_url": F.coalesce("source_url", "page"), "metadata": overridden(F.col("metadata"), added), "complete": F.lit(False)})


def issuer_disclosures(rows: DataFrame) -> DataFrame:
    """rows (external_id, ticker, source_url, attachment_urls, page, issuer, hosts) with `problem`: a foreign ticker, or a URL that isn't on the issuer's hosts."""
    urls = F.exists(F.coalesce("attachment_urls", F.array().cast("array<string>")), lambda u: ~issuer_url(u, F.col("hosts")))
    problem = _first(
        (~F.startswith("external_id", F.lit(ISSUER_PREFIX)), "externalId"),
        (F.upper(F.trim("ticker")) != F.col("issuer"), "ticker"),
        (F.col("source_url").isNotNull() & ~issuer_url(F.col("source_url"), F.col("hosts")), "sourceUrl"),
        (urls, "attachment sourceUrl"),
    )
    return rows.withColumns({"problem": problem, "source_url": F.coalesce("source_url", "page"), "complete": F.lit(False)})


#: Keys under which lists of securities come, and keys of a security's ticker.
CONTAINERS = ("Results", "results", "Profiles", "profiles", "Data", "data", "Replies", "replies")
NESTED = ("Results", "results", "Items", "items", "Data", "data")
TICKERS = ("KodeEmiten", "Kode_Emiten", "kodeEmiten", "Ticker", "ticker", "Code", "code", "Symbol", "symbol")


def reference_tickers(payloads: DataFrame, text: str, key: str) -> DataFrame:
    """(key, ticker): the tickers of each JSON payload: a list, an object with lists under usual keys, or an object keyed by ticker.

    Rows are codes, or objects with a code under one of the usual keys; codes have 2 to 8 letters, digits and hyphens.
    """
    none = F.array().cast("array<string>")
    body = F.ltrim(F.regexp_replace(F.col(text), r"^\s+", ""))
    as_list = lambda c: F.when(F.startswith(F.ltrim(c), F.lit("[")), F.from_json(c, "array<string>"))
    listed = []
    for k in CONTAINERS:
        inner = F.get_json_object(text, f"$.{k}")
        listed.append(F.coalesce(as_list(inner), F.concat(*[F.coalesce(as_list(F.get_json_object(inner, f"$.{n}")), none) for n in NESTED]), none))
    rows = payloads.select(key, F.when(F.startswith(body, F.lit("[")), F.from_json(text, "array<string>")).otherwise(F.concat(*listed)).alias("rows"), F.when(F.startswith(body, F.lit("{")), F.from_json(text, "map<string,string>")).alias("by_key"))
    rows = rows.withColumn("rows", F.coalesce("rows", none))
    keyed = F.when(F.size("rows") == 0, F.transform(F.filter(F.map_entries("by_key"), lambda e: F.startswith(F.ltrim(e["value"]), F.lit("{"))), lambda e: F.coalesce(_ticker(e["value"]), e["key"])))
    found = rows.select(key, F.explode(F.concat(F.transform("rows", lambda r: F.when(F.startswith(F.ltrim(r), F.lit("{")), _ticker(r)).otherwise(r)), F.coalesce(keyed, none))).alias("ticker"))
    found = found.select(key, F.upper(strip(F.col("ticker"))).alias("ticker"))
    return found.where(F.length("ticker").between(2, 8) & F.col("ticker").rlike("^[A-Z0-9-]+$") & F.col("ticker").rlike("[A-Z0-9]")).distinct()


def _ticker(row: Column) -> Column:
    return F.coalesce(*[F.nullif(F.get_json_object(row, f"$.{k}"), F.lit("")) for k in TICKERS])


def trusted_master(lists: DataFrame, key: str, least: int = 500) -> DataFrame:
    """(key, n, trusted): how many tickers a payload gave, and whether that is enough to be believed."""
    return lists.groupBy(key).agg(F.count_distinct("ticker").alias("n")).withColumn("trusted", F.col("n") >= least)


def stored_path(ticker: Column, announcement_id: Column, digest: Column, filename: Column, url: Column) -> Column:
    """Where a file of some content is kept: by ticker, announcement and the beginning of its digest; a name without a suffix takes the URL's."""
    name = safe_filename(filename)
    ends = F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), r"[^./](\.[^./]+)$", 1)
    name = F.when(suffix(name) == "", F.concat(name, ends)).otherwise(name)
    return F.concat_ws("/", F.lit("raw"), ticker, safe_filename(announcement_id), F.concat(F.left(digest, F.lit(12)), F.lit("_"), name))


def staged_path(url: Column, filename: Column) -> Column:
    """Where a URL's file is staged: by the digest of the URL, with a safe suffix."""
    return F.concat(short_hash(url, 64), safe_suffix(filename))


def stage(wanted: DataFrame, staged: DataFrame) -> DataFrame:
    """wanted (url, filename) with path and cache_hit: a staged file (path, size) that isn't empty is there already."""
    have = staged.where("size > 0").select("path").distinct().withColumn("cache_hit", F.lit(True))
    return wanted.withColumn("path", staged_path(F.col("url"), F.col("filename"))).join(have, "path", "left").withColumn("cache_hit", F.coalesce("cache_hit", F.lit(False)))


def written(files: DataFrame, existing: DataFrame) -> DataFrame:
    """files (path, ...) with status: written, or already-exists for content that is kept; of equal paths one row."""
    have = existing.select("path").distinct().withColumn("_there", F.lit(True))
    return files.dropDuplicates(["path"]).join(have, "path", "left").withColumn("status", F.when(F.col("_there"), "already-exists").otherwise("written")).drop("_there")
