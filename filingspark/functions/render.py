"""Templates, key names, plain text of Markdown, MIME types and backoff."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, suffix

_NAME = r"\{([A-Za-z_][A-Za-z0-9_]*)\}"
_SLOT = re.compile(_NAME)
#: MIME types by suffix.
MIME = {".pdf": "application/pdf", ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".html": "text/html", ".htm": "text/html", ".txt": "text/plain", ".csv": "text/csv", ".json": "application/json", ".xml": "application/xml", ".zip": "application/zip"}


def placeholders(template: Column) -> Column:
    """The distinct names in single braces, in the order of the template."""
    return F.array_distinct(F.regexp_extract_all(template, F.lit(_NAME), F.lit(1)))


def placeholder_problems(template: Column, allowed: Column, required: Column | None = None) -> Column:
    """(unknown, missing) names, sorted: those used but not allowed, and those required but not used."""
    found = placeholders(template)
    return F.struct(F.array_sort(F.array_except(found, allowed)).alias("unknown"), F.array_sort(F.array_except(allowed if required is None else required, found)).alias("missing"))


def render(template: Column, values: Column, allowed: Column | None = None) -> Column:
    """Fill a template from a map in one pass, so that values with braces stay as they are, and strip it.

    null is empty; names that aren't allowed stay as written; allowed ones without a value are an error.
    """

    @F.arrow_udf("string")
    def fill(templates: pa.Array, maps: pa.Array) -> pa.Array:
        out = []
        for t, v in zip(templates.to_pylist(), maps.to_pylist(), strict=True):
            given = dict(v or [])
            out.append(None if t is None else _SLOT.sub(lambda m, given=given: (given[m[1]] or "") if m[1] in given else m[0], t).strip())
        return pa.array(out, pa.string())

    if allowed is None:
        return fill(template, values)
    lacking = F.array_sort(F.array_except(allowed, F.map_keys(values)))
    known = F.map_filter(values, lambda k, _: F.array_contains(allowed, k))
    return F.when(F.size(lacking) > 0, F.raise_error(F.concat(F.lit("missing values: "), F.array_join(lacking, ", "))).cast("string")).otherwise(fill(template, known))


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(x.capitalize() for x in rest)


def plain_markdown(text: Column) -> Column:
    """Plain text of Markdown, line by line, without blank space at the end but for one line end.

    Headings of the first two levels become upper case, third-level ones lose their mark; ** and ` go, and a
    quote's mark after that. Fences go, the lines between them stay.
    """
    lines = F.split(F.regexp_replace(text, r"\r\n|[\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]", "\n"), "\n")
    start = F.struct(F.lit(False).alias("fenced"), F.array().cast("array<string>").alias("out"))

    def plain(line: Column) -> Column:
        shown = F.when(F.startswith(line, F.lit("# ")), F.upper(F.substring(line, 3, 1 << 30)))
        shown = shown.when(F.startswith(line, F.lit("## ")), F.upper(F.substring(line, 4, 1 << 30)))
        shown = shown.when(F.startswith(line, F.lit("### ")), F.substring(line, 5, 1 << 30)).otherwise(line)
        return F.regexp_replace(F.regexp_replace(shown, r"\*\*|`", ""), "^> ", "")

    def step(acc: Column, line: Column) -> Column:
        fence = F.startswith(line, F.lit("```"))
        kept = F.array_append(acc["out"], F.when(acc["fenced"], line).otherwise(plain(line)))
        return F.struct((acc["fenced"] != fence).alias("fenced"), F.when(fence, acc["out"]).otherwise(kept).alias("out"))

    joined = F.array_join(F.aggregate(lines, start, step, lambda acc: acc["out"]), "\n")
    return F.concat(F.regexp_replace(joined, r"(?U)\s+$", ""), F.lit("\n"))


def mime(name: Column, supplied: Column | None = None) -> Column:
    """The supplied type unless it is blank, else that of the name's suffix."""
    guessed = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv]), suffix(name)), F.lit("application/octet-stream"))
    return guessed if supplied is None else F.coalesce(F.nullif(strip(F.coalesce(supplied, F.lit(""))), F.lit("")), guessed)


def backoff(attempt: Column, first: float, most: float, retry_after: Column | None = None, jitter: Column | None = None) -> Column:
    """Seconds before another try: what the server asked for, else doubling from `first` with a share of jitter on top, at most `most`."""
    grown = F.lit(first) * F.pow(F.lit(2.0), F.greatest(attempt - 1, F.lit(0)))
    grown = grown if jitter is None else grown * (1 + jitter)
    return F.least(F.lit(most), F.coalesce(retry_after, grown) if retry_after is not None else grown)
