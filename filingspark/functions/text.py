"""Scalar functions on text, files, URLs, dates and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Without white space at the ends; trim alone takes spaces only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def ticker(text: Column, missing: str = "UNKNOWN") -> Column:
    """Stripped and upper case; null or empty is `missing`, white space alone is empty."""
    return F.when(F.coalesce(text, F.lit("")) == "", missing).otherwise(F.upper(strip(text)))


def normalise(text: Column) -> Column:
    """NULs dropped, blanks and tabs as one space, four or more line ends as three, stripped."""
    t = F.regexp_replace(F.translate(text, "\x00", ""), "[ \t]+", " ")
    return strip(F.regexp_replace(t, "\n{4,}", "\n\n\n"))


def suffix(name: Column) -> Column:
    """The lower-case suffix with its dot; names that only begin with a dot have none."""
    return F.lower(F.regexp_extract(name, r"[^./](\.[^./]+)$", 1))


def safe_filename(name: Column, most: int = 180) -> Column:
    """Slashes and runs of other characters than letters, digits and a few marks as one underscore each; no blanks or dots at the ends; never empty."""
    clean = F.regexp_replace(F.translate(name, "/\\", "__"), r"[^A-Za-z0-9._() -]+", "_")
    clean = F.left(F.regexp_replace(clean, r"^[ .]+|[ .]+$", ""), F.lit(most))
    return F.when(clean == "", "attachment").otherwise(clean)


def slug(name: Column, most: int = 40) -> Column:
    """Lower-case letters and digits, all else as single hyphens; never empty."""
    clean = F.left(F.regexp_replace(F.regexp_replace(F.lower(strip(name)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(most))
    return F.when(clean == "", "profile").otherwise(clean)


def safe_suffix(name: Column) -> Column:
    """The suffix if it is up to ten letters and digits, else .bin."""
    own = suffix(name)
    return F.when(own.rlike(r"^\.[a-z0-9]{1,10}$"), own).otherwise(".bin")


#: Fixed value: the name of a file that has none.
NAMELESS = "idx-attachment.bin"


def display_filename(original: Column, stored: Column) -> Column:
    """What follows the last slash of the first name that isn't blank."""
    full = lambda c: F.nullif(strip(F.coalesce(c, F.lit(""))), F.lit(""))
    last = strip(F.substring_index(F.translate(F.coalesce(full(original), full(stored), F.lit(NAMELESS)), "\\", "/"), "/", -1))
    return F.coalesce(F.nullif(last, F.lit("")), F.lit(NAMELESS))


def url_filename(url: Column) -> Column:
    """The decoded last part of a URL's path."""
    last = F.substring_index(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/", -1)
    decoded = strip(F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last))
    return F.coalesce(F.nullif(decoded, F.lit("")), F.lit(NAMELESS))


def truncate(text: Column, most: int) -> Column:
    """Cut to `most` characters, the last an ellipsis."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 1)), F.lit("…"))).otherwise(text)


def claim_tokens(text: Column, stop: tuple[str, ...] = ()) -> Column:
    """Distinct tokens of three or more characters that aren't stop words."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[a-z0-9][a-z0-9._%/-]*"), F.lit(0)))
    out = F.filter(found, lambda t: F.length(t) > 2)
    return F.array_except(out, F.array(*map(F.lit, stop))) if stop else out


def strings(values: Column) -> Column:
    """An array's strings, stripped, without blanks; null as empty."""
    return F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: strip(x)), lambda x: x.isNotNull() & (x != ""))


def joined(values: Column, separator: str = "; ") -> Column:
    """Joined strings, or null if there are none."""
    return F.nullif(F.array_join(values, separator), F.lit(""))


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def host_allowed(url: Column, hosts: Column) -> Column:
    """HTTPS, and the host is one of `hosts` or below one; no port, no user."""
    own = host(url)
    bare = ~F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")).rlike("[:@]")
    return F.coalesce((F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) == "https") & bare & F.exists(hosts, lambda h: (own == h) | F.endswith(own, F.concat(F.lit("."), h))), F.lit(False))


def iso_date(text: Column) -> Column:
    """A strict yyyy-MM-dd date, or null."""
    t = strip(text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))


def utc_iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def short_hash(text: Column, n: int = 16) -> Column:
    return F.left(F.sha2(text.cast("binary"), 256), F.lit(n))


def json_string(text: Column) -> Column:
    """A JSON string literal."""
    return F.regexp_replace(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("x"))), r'^\{"x":|\}$', "")


def rules_hash(announcement_id: Column, title: Column, category: Column, materiality: Column) -> Column:
    """SHA-256 of a JSON object with sorted keys and ', ' and ': ' between its parts."""
    parts = {"announcementId": announcement_id, "materiality": materiality, "primaryCategory": category, "title": title}
    return F.sha2(json_object(parts).cast("binary"), 256)


def json_object(values: dict[str, Column], separators: tuple[str, str] = (", ", ": ")) -> Column:
    """A JSON object of texts, keys as they come; null is null."""
    part = lambda k, v: F.concat(F.lit(f'"{k}"{separators[1]}'), F.when(v.isNull(), "null").otherwise(json_string(v.cast("string"))))
    return F.concat(F.lit("{"), F.concat_ws(separators[0], *[part(k, v) for k, v in values.items()]), F.lit("}"))


def byte_size(n: Column) -> Column:
    """B, KiB, MiB, GiB or TiB, with one decimal above bytes; negative sizes are 0."""
    n = F.greatest(n.cast("double"), F.lit(0.0))
    out = F.when(n < 1024, F.concat(F.floor(n).cast("string"), F.lit(" B")))
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        shown = F.format_string(f"%.1f {unit}", F.bround(n / 1024**power, 1))
        out = out.when(n < 1024 ** (power + 1), shown) if unit != "TiB" else out.otherwise(shown)
    return out


def url_on_host(base: str, url: Column, hosts: tuple[str, ...], canonical: str) -> Column:
    """A URL, relative ones under `base`, on `canonical`; null unless it is HTTPS on one of `hosts`."""
    text = strip(url)
    whole = F.when(text.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), text).when(F.startswith(text, F.lit("//")), F.concat(F.lit("https:"), text))
    whole = whole.when(F.startswith(text, F.lit("/")), F.concat(F.lit(base.rstrip("/")), text)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), text))
    good = (F.lower(F.try_parse_url(whole, F.lit("PROTOCOL"))) == "https") & host(whole).isin(*hosts) & (text != "")
    return F.when(good, F.regexp_replace(whole, "^[A-Za-z]+://[^/?#]*", f"https://{canonical}"))


def http_url(url: Column) -> Column:
    """The stripped URL if it is http or https with a host, else null."""
    text = strip(F.coalesce(url, F.lit("")))
    good = F.lower(F.try_parse_url(text, F.lit("PROTOCOL"))).isin("http", "https") & (F.coalesce(F.try_parse_url(text, F.lit("AUTHORITY")), F.lit("")) != "")
    return F.when(good, text)
