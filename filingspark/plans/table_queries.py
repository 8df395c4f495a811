"""Queries of tags, retries, audit views, publishing and streams over the given texts and times."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import audit, export, recovery, rules
from ..operators.tables import settled
from ..sources import shards, views as V
from ..streaming.state import shared_folder
from .filing_queries import PLAIN_TITLE
from .registry import query

#: What ends a document's text here, so that each reason is met; the text before it is scanned too.
MESSAGES = (
    "HTTP 429 Too Many Requests", "the provider throttled the call", "Rate limit reached", "Read timed out", "gateway Timeout", "OpenRouter request failed: 502", "OpenRouter request failed: bad gateway", "nodename nor servname provided",
    "Name or service not known", "ConnectError", "WriteError", "Temporary failure in name resolution", "Network is unreachable", "connection closed by peer", "status 503", "fields are missing", "service unavailable",
)
_MESSAGES = ", ".join(f"'{m}'" for m in MESSAGES)


def _holds_sql(names) -> str:
    return "(" + " or ".join(f"contains(t, '{n}')" for n in names) + ")"


@query(f"""
with r as (select doc_id, lower(coalesce(text, '') || ' ' || [{_MESSAGES}][doc_id % {len(MESSAGES)} + 1]) as t, doc_id % 11 = 0 as malformed, doc_id % 3 = 0 as summary, [200, 404, 408, 429, 500, 503, null][doc_id % 7 + 1] as code from documents)
select doc_id, {_holds_sql(recovery.TRANSPORT)} as transport, summary and {_holds_sql(recovery.REDUCER)} as reduced_again, code in (408, 429, 500, 503) is true or {_holds_sql(recovery.TRANSPORT)} as retry,
  case when malformed then 'malformed_json' when contains(t, '429') or contains(t, 'rate limit') or contains(t, 'throttl') then 'rate_limited' when contains(t, 'timeout') or contains(t, 'timed out') then 'timeout'
    when contains(t, '5') and contains(t, 'openrouter request failed') then 'provider_error' else 'structured_output_error' end as reason from r""")
def retry_reasons(spark, d):
    k = F.col("doc_id")
    message = F.element_at(F.array(*map(F.lit, MESSAGES)), (k % len(MESSAGES) + 1).cast("int"))
    code = F.get(F.array(*map(F.lit, (200, 404, 408, 429, 500, 503, None))), (k % 7).cast("int"))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), message)
    return V.load(spark, d, "documents").select(
        "doc_id",
        recovery.transport_failure(text).alias("transport"),
        recovery.reduced_again(text, k % 3 == 0).alias("reduced_again"),
        recovery.retryable(code, text).alias("retry"),
        recovery.retry_reason(text, k % 11 == 0).alias("reason"),
    )


_H, _M = (", ".join(f"'{x}'" for x in v) for v in (rules.HIGH, rules.MEDIUM))
_KINDS = (
    ("expansion", "EXPANSION", ("EXPANSION", "CAPEX", "NEW_PROJECT", "NEW_CAPACITY", "NEW_SUBSIDIARY", "NEW_BUSINESS")),
    ("management", "MANAGEMENT_CHANGE", ("CONTROLLER_CHANGE", "MANAGEMENT_CHANGE", "BOARD_CHANGE")),
    ("regulatory", "REGULATORY", ("SUSPENSION", "UNSUSPENSION", "LISTING", "DELISTING", "REGULATORY", "LEGAL")),
)
_USUAL = ", ".join(f"case when len(list_filter(coalesce({facts}, []), lambda x: trim(x) <> '')) > 0 and not list_has_any(found, [{', '.join(repr(n) for n in names)}]) then '{tag}' end" for facts, tag, names in _KINDS)


@query(f"""
with {V.ANN}, j as (select a.announcement_id, a.title, a.title || ' ' || coalesce(d.text, '') as blob, case when a.announcement_id % 4 = 0 then [d.lang] end as expansion,
    case when a.announcement_id % 5 = 0 then [' ', d.source] end as management, case when a.announcement_id % 6 = 0 then [case when a.announcement_id % 12 = 0 then d.source else '  ' end] end as regulatory,
    case when a.announcement_id % 10 = 3 then 'routine_direct' end as mode from ann a join documents d on d.doc_id = a.announcement_id),
p as (select *, {PLAIN_TITLE.replace("title", "blob")} as t, {PLAIN_TITLE} as h from j),
g as (select *, {rules.all_matches_sql('t', rules.TAXONOMY)} as found, {rules.first_match_sql('h', rules.TAXONOMY, None)} as head from p),
u as (select *, list_concat(found, list_filter([{_USUAL}], lambda x: x is not null)) as every_tag from g),
w as (select *, case when len(every_tag) = 0 then ['OTHER'] else every_tag end as tags from u),
q as (select *, head is not null as anchored, coalesce(head, tags[1]) as first from w),
m as (select *, case when len(list_filter(tags, lambda x: x in ({_H}))) > 0 then 'HIGH' when len(list_filter(tags, lambda x: x in ({_M}))) > 0 then 'MEDIUM' when mode is not null or tags = ['ROUTINE_REPORT'] then 'ROUTINE' else 'LOW' end as materiality from q)
select announcement_id, array_to_string(list_concat([first], list_filter(tags, lambda x: x <> first)), ',') as tags, materiality, (case when materiality = 'ROUTINE' then greatest(0.65, case when anchored then 0.75 when first = 'OTHER' then 0.45 else 0.6 end)
  else case when anchored then 0.75 when first = 'OTHER' then 0.45 else 0.6 end end)::double as confidence from m""")
def structured_tags(spark, d):
    a, docs = V.announcements(spark, d), V.load(spark, d, "documents").select("doc_id", "text", "lang", "source")
    k = F.col("announcement_id")
    rows = a.join(docs, k == F.col("doc_id"))
    regulatory = F.when(k % 6 == 0, F.array(F.when(k % 12 == 0, F.col("source")).otherwise("  ")))
    tags = rules.taxonomy_tags(F.concat("title", F.lit(" "), F.coalesce("text", F.lit(""))), F.when(k % 4 == 0, F.array("lang")), F.when(k % 5 == 0, F.array(F.lit(" "), F.col("source"))), regulatory)
    rows = rows.select("announcement_id", "title", rules.headline(F.col("title")).isNotNull().alias("anchored"), tags.alias("found"))
    rows = rows.select("announcement_id", "anchored", rules.primary_first(F.col("title"), F.col("found")).alias("tags"))
    rows = rows.withColumn("materiality", rules.tag_materiality(F.col("tags"), F.when(k % 10 == 3, "routine_direct")))
    return rows.select("announcement_id", F.array_join("tags", ",").alias("tags"), "materiality", rules.confidence(F.col("tags")[0], F.col("anchored"), F.col("materiality")).alias("confidence"))


AUDIT_SQL = f"""{V.ANN},
an as (select o_custkey as scope, o_orderkey::varchar as announcement_id, title, announced_at, announced_at + interval 1 hour as fetched_at, case when status = 'F' then announced_at + interval 2 day end as summary_at from ann join orders on o_orderkey = announcement_id),
fi as (select scope, announcement_id, 'u' || l_orderkey || '-' || l_linenumber as url, 'f' || l_linenumber || '.pdf' as filename, l_shipdate as downloaded_at, case when l_returnflag <> 'N' then l_shipdate + interval 1 minute end as extracted_at,
  case when l_linestatus = 'F' then l_shipdate + interval 1 hour end as summary_at from lineitem join an on announcement_id = l_orderkey::varchar),
co as (select c_custkey as scope, 'T' || c_custkey as ticker, case when c_nationkey % 3 > 0 then timestamp '1997-01-01' + interval 1 day * c_nationkey end as updated_at, c_mktsegment as prompt_version from customer),
ca as (select user_id as scope, event_id as audit_id, case event_type when 'purchase' then 'company' else event_type end as stage, case event_id % 3 when 0 then 'e' || event_id || '.pdf' when 1 then '' end as filename,
  case when event_id % 2 = 0 then event_id::varchar end as announcement_id, case when value > 20 then 'succeeded' else 'failed' end as status, ts as started_at, ts + interval 5 second as finished_at, value as elapsed, event_id % 1000 as prompt_tokens from events)"""


def _audit_tables(spark, d):
    a = V.announcements(spark, d).join(V.load(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("scope")), F.col("announcement_id") == F.col("o_orderkey"))
    at = F.col("announced_at")
    a = a.select("scope", F.col("announcement_id").cast("string").alias("announcement_id"), "title", "announced_at", (at + F.expr("interval 1 hour")).alias("fetched_at"), F.when(F.col("status") == "F", at + F.expr("interval 2 days")).alias("summary_at"))
    ship = F.col("l_shipdate")
    files = V.load(spark, d, "lineitem").withColumn("announcement_id", F.col("l_orderkey").cast("string")).join(a.select("scope", "announcement_id"), "announcement_id")
    files = files.select(
        "scope",
        "announcement_id",
        F.concat(F.lit("u"), "l_orderkey", F.lit("-"), "l_linenumber").alias("url"),
        F.concat(F.lit("f"), "l_linenumber", F.lit(".pdf")).alias("filename"),
        ship.alias("downloaded_at"),
        F.when(F.col("l_returnflag") != "N", ship + F.expr("interval 1 minute")).alias("extracted_at"),
        F.when(F.col("l_linestatus") == "F", ship + F.expr("interval 1 hour")).alias("summary_at"),
    )
    day = F.expr("timestamp_ntz '1997-01-01 00:00:00' + make_dt_interval(c_nationkey)")
    companies = V.load(spark, d, "customer").select(F.col("c_custkey").alias("scope"), F.concat(F.lit("T"), "c_custkey").alias("ticker"), F.when(F.col("c_nationkey") % 3 > 0, day).alias("updated_at"), F.col("c_mktsegment").alias("prompt_version"))
    k = F.col("event_id")
    calls = V.load(spark, d, "events").select(
        F.col("user_id").alias("scope"),
        k.alias("audit_id"),
        F.when(F.col("event_type") == "purchase", "company").otherwise(F.col("event_type")).alias("stage"),
        F.when(k % 3 == 0, F.concat(F.lit("e"), k, F.lit(".pdf"))).when(k % 3 == 1, "").alias("filename"),
        F.when(k % 2 == 0, k.cast("string")).alias("announcement_id"),
        F.when(F.col("value") > 20, "succeeded").otherwise("failed").alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.expr("interval 5 seconds")).alias("finished_at"),
        F.col("value").alias("elapsed"),
        (k % 1000).alias("prompt_tokens"),
        F.lit(None).cast("long").alias("completion_tokens"),
    )
    return a, files, companies, calls


@query(f"""with {AUDIT_SQL}, e as (
  select scope, announced_at as happened, 'idx-announced' as stage, title as label, announcement_id, null as url, null as status, null as elapsed, null as prompt_tokens, null as audit_id, null as end_at from an
  union all select scope, fetched_at, 'metadata-saved', title, announcement_id, null, null, null, null, null, null from an
  union all select scope, downloaded_at, 'downloaded', filename, announcement_id, url, null, null, null, null, null from fi where downloaded_at is not null
  union all select scope, extracted_at, 'extracted', filename, announcement_id, url, null, null, null, null, null from fi where extracted_at is not null
  union all select scope, summary_at, 'document-summary', filename, announcement_id, url, null, null, null, null, null from fi where summary_at is not null
  union all select scope, summary_at, 'announcement-summary', title, announcement_id, null, null, null, null, null, null from an where summary_at is not null
  union all select scope, updated_at, 'company-summary', ticker || ' company digest', null, null, null, null, null, null, null from co
  union all select ca.scope, started_at, 'llm-' || stage, coalesce(nullif(filename, ''), announcement_id, ticker), null, null, status, elapsed, prompt_tokens, audit_id, finished_at from ca left join co on co.scope = ca.scope)
select scope, happened as happened_at, stage, label, announcement_id, url, status, elapsed, prompt_tokens, audit_id, end_at,
  row_number() over (partition by scope order by happened nulls first, stage, label nulls first, announcement_id nulls first, url nulls first, audit_id nulls first) as place from e""")
def audit_process(spark, d):
    return audit.process(*_audit_tables(spark, d)).withColumnRenamed("at", "happened_at").withColumn("scope", F.col("scope").cast("long")).withColumn("place", F.col("place").cast("long")).drop("completion_tokens")


@query(f"""with {AUDIT_SQL}, x as (select scope, arg_max(audit_id, (started_at, audit_id)) as audit_id from ca where stage = 'company' and status = 'succeeded' group by scope)
select co.scope, audit_id, case when audit_id is not null then 'exact_audit' when prompt_version = 'BUILDING' then 'reconstructed_legacy_template' else 'reconstructed_current_template' end as status from co left join x on x.scope = co.scope""")
def prompt_statuses(spark, d):
    _, _, companies, calls = _audit_tables(spark, d)
    return audit.prompt_status(companies, calls, "BUILDING").select("scope", "audit_id", "status")


#: Days of events as shards of a paged source: pages of 50, dealt to three recordings; every fifth day reports one row more than it has.
RECORDED = """it as (select strftime(ts, '%Y-%m-%d') as shard, event_id, row_number() over w - 1 as place, count(*) over (partition by strftime(ts, '%Y-%m-%d')) as n, extract(day from ts) as day from events window w as (partition by strftime(ts, '%Y-%m-%d') order by event_id))"""


def _pages(spark, d):
    day = F.date_format("ts", "yyyy-MM-dd")
    w = Window.partitionBy("shard")
    items = V.load(spark, d, "events").select(day.alias("shard"), "event_id", F.dayofmonth("ts").alias("day"))
    items = items.withColumn("page", F.floor((F.row_number().over(w.orderBy("event_id")) - 1) / 50)).withColumn("n", F.count(F.lit(1)).over(w))
    reported = F.col("n") + F.when(F.col("day") % 5 == 0, 1).otherwise(0)
    pages = items.groupBy("shard", "day", "page", reported.alias("reported")).agg(F.array_sort(F.collect_list("event_id")).alias("ids"))
    page = F.to_json(F.struct(F.transform("ids", lambda i: F.struct(i.alias("event_id"))).alias("Replies"), F.col("reported").alias("ResultCount")))
    return pages.select(((F.col("page") + F.col("day")) % 3 + 1).cast("int").alias("seq"), "shard", page.alias("value"))


@query(f"with {RECORDED} select shard, event_id from it where day % 5 <> 0")
def incremental_pages(spark, d):
    """Read in three runs of one stream, each after another recording: shards that were incomplete are planned anew until they are whole."""
    folder = shared_folder(spark, "pages")
    spark.dataSource.register(shards.ShardSource)
    stream = lambda: spark.readStream.format("shards").load(f"{folder}/pages")
    pages = settled(_pages(spark, d))
    for k in (1, 2, 3):
        pages.where(F.col("seq") == k).repartition("shard").write.mode("append").partitionBy("seq", "shard").text(f"{folder}/pages")
        shards.read_recordings(stream(), f"{folder}/rows", f"{folder}/state")
    rows = spark.read.schema("shard string, seq long, ordinal int, reported long, payload string").parquet(f"{folder}/rows")
    return rows.select("shard", F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"))


def _remote(batch: list[dict]) -> list[dict]:
    """A remote that leaves some rows out of its answers and fails to commit some others."""
    out = []
    for r in batch:
        k = int(r["external_id"][1:])
        if k % 13:
            out.append({"external_id": r["external_id"], "internal_id": f"i{k}", "status": "PARTIAL" if k % 17 == 0 else "READY"})
    return out


def _broken(batch: list[dict]) -> list[dict]:
    if any(r["external_id"].endswith("77") for r in batch):
        raise ConnectionError("the remote is gone")
    return _remote(batch)


@query("""select 'a' as run, 'x' || o_orderkey as external_id, case when o_orderkey % 13 <> 0 then 'i' || o_orderkey end as internal_id, case when o_orderkey % 13 = 0 or o_orderkey % 17 = 0 then 'PARTIAL' else 'READY' end as status, 'PARTIAL' as run_status from orders
union all select 'b', 'x' || o_orderkey, null, 'FAILED', 'FAILED' from orders
union all select 'c', 'x' || o_orderkey, 'i' || o_orderkey, 'READY', 'COMPLETE' from orders where o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0""")
def publish_outcomes(spark, d):
    """Three runs: answers that leave rows out, a remote that breaks off, and one whose rows all arrive."""
    folder = shared_folder(spark, "published")
    orders = V.load(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    rows = export.batches(orders, ["k"], ["o_orderkey"], 10)
    rows = settled(rows.select(F.concat_ws("-", "k", "batch").alias("batch"), F.concat(F.lit("x"), "o_orderkey").alias("external_id"), F.col("o_orderkey").cast("string").alias("payload"), "o_orderkey"))
    out = None
    for run, some, remote in (("a", rows, _remote), ("b", rows, _broken), ("c", rows.where("o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0"), _remote)):
        status = shards.publish(some, folder, run, remote)
        one = shards.outcomes(some.select("external_id"), folder, run).select(F.lit(run).alias("run"), "external_id", "internal_id", "status", F.lit(status).alias("run_status"))
        out = one if out is None else out.unionByName(one)
    return out
