"""Scalar functions on loose values: safe casts, fallbacks, overrides, claim texts, ages, canonical JSON."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def safe_float(text: Column, default: float = 0.0) -> Column:
    """A number written as text, or the default."""
    return F.coalesce(strip(text).try_cast("double"), F.lit(default))


def safe_int(text: Column, default: int = 0) -> Column:
    """A whole number written as text, or the default; a fraction is none."""
    t = strip(text)
    return F.coalesce(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")), F.lit(default).cast("bigint"))


def first_full(*values: Column) -> Column:
    """The first value that isn't null or empty, as text."""
    return F.coalesce(*[F.nullif(v.cast("string"), F.lit("")) for v in values])


def overridden(base: Column, over: Column) -> Column:
    """A map with another's entries in place of its own of the same keys."""
    over = F.coalesce(over, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)


def claim_text(value: Column) -> Column:
    """A claim given as JSON: a text itself, an object's analysis, its metric, value and period, or else the object as canonical JSON."""

    @F.arrow_udf("string")
    def read(arr: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _claim(json.loads(t)) for t in arr.to_pylist()], pa.string())

    return read(value)


def _claim(value: object) -> str:
    if not isinstance(value, dict):
        return str(value).strip()
    if value.get("analysis"):
        return str(value["analysis"]).strip()
    parts = [value.get(k) for k in ("metric", "value", "period")]
    if any(parts[:2]):
        return " — ".join(str(p) for p in parts if p)
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no blanks; null for what isn't JSON."""

    @F.arrow_udf("string")
    def write(arr: pa.Array) -> pa.Array:
        out = []
        for t in arr.to_pylist():
            try:
                out.append(None if t is None else json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True, separators=(",", ":")))
            except ValueError:
                out.append(None)
        return pa.array(out, pa.string())

    return write(text)


def analysis_hash(announcement_id: Column, summary: Column, hashes: Column, schema_version: str, taxonomy_version: str) -> Column:
    """SHA-256 of an analysis's inputs: canonical JSON of its announcement, its summary (canonical JSON itself), its files' digests in order, and two versions."""
    from .text import json_string

    digests = F.array_sort(F.filter(hashes, lambda h: F.coalesce(h, F.lit("")) != ""))
    listed = F.concat(F.lit("["), F.array_join(F.transform(digests, json_string), ","), F.lit("]"))
    body = F.concat(
        F.lit('{"announcementId":'), json_string(announcement_id), F.lit(',"attachmentHashes":'), listed, F.lit(f',"bridgeSchemaVersion":{json.dumps(schema_version)},"summary":'),
        summary, F.lit(f',"taxonomyVersion":{json.dumps(taxonomy_version)}}}'),
    )
    return F.sha2(body.cast("binary"), 256)


def age_seconds(at: Column, now: Column) -> Column:
    """Seconds since an instant, none below 0."""
    return F.greatest(F.lit(0.0), (F.unix_micros(now.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / 1e6)


def fresh(at: Column, now: Column, hours: float) -> Column:
    """Whether something retrieved at an instant is still young enough; what has no instant is."""
    return at.isNull() | (age_seconds(at, now) <= hours * 3600)


def compact_day(at: Column) -> Column:
    """yyyyMMdd, as query parameters take it."""
    return F.date_format(at, "yyyyMMdd")


def overlapped(gap_start: Column, request_start: Column, days: float = 1.0) -> Column:
    """The start of a gap moved back by an overlap, not beyond the request's."""
    return F.greatest(request_start, gap_start - F.expr(f"make_dt_interval(0, 0, 0, {days * 86400})"))
