"""Queries of the disclosure operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, reduce, relational as R, rules, telemetry, timewin
from ..operators.scans import numbered
from ..operators.tables import settled
from ..sources import views as V
from .registry import query

START, END = "1995-01-01 00:00:00", "1996-12-31 23:59:59"
WINDOW_SQL = f"between timestamp '{START}' and timestamp '{END}'"


@query(f"with {V.ANN} select announcement_id, ticker, announced_at from ann where announced_at {WINDOW_SQL}")
def window_filter(spark, d):
    return timewin.in_window(V.announcements(spark, d), "announced_at", START, END).select("announcement_id", "ticker", "announced_at")


@query(f"with {V.ANN} select distinct ticker from ann where announced_at {WINDOW_SQL}")
def distinct_tickers(spark, d):
    return timewin.in_window(V.announcements(spark, d), "announced_at", START, END).select("ticker").distinct()


@query(f"with {V.ANN} select ticker, max(announced_at) as latest from ann group by ticker")
def latest_announcement(spark, d):
    return V.announcements(spark, d).groupBy("ticker").agg(F.max("announced_at").alias("latest"))


@query("select (select count(*) from orders) as announcements, (select count(*) from documents) as attachments, (select count(*) from lineitem) as summaries, (select count(*) from events) as audits, (select count(*) from conversations) as chunks, (select count(*) from pages) as pages")
def profile_counts(spark, d):
    tables = {"announcements": "orders", "attachments": "documents", "summaries": "lineitem", "audits": "events", "chunks": "conversations", "pages": "pages"}
    out = None
    for name, table in tables.items():
        n = V.load(spark, d, table).agg(F.count(F.lit(1)).alias(name))
        out = n if out is None else out.crossJoin(n)  # one row each
    return out


@query(f"with {V.ANN} select announcement_id, ticker, announced_at, title from ann qualify row_number() over (partition by ticker order by announced_at desc, announcement_id desc) = 1")
def latest_per_ticker(spark, d):
    ann = V.announcements(spark, d)
    return R.latest(ann, ["ticker"], F.col("announced_at").desc(), F.col("announcement_id").desc()).select("announcement_id", "ticker", "announced_at", "title")


LIBRARY = f"""
with {V.ANN}, {V.SUMS},
w as (select ticker, date_trunc('month', announced_at) as month, announcement_id, announced_at from ann)
select month, count(*) as n, max(announced_at) as updated_at, array_to_string(list_sort(list(distinct kind)), ',') as kinds
from (select w.month, w.announced_at, a.kind from w join ann a using (announcement_id)) group by month"""


@query(LIBRARY)
def library_windows(spark, d):
    ann = V.announcements(spark, d).withColumn("month", F.date_trunc("month", "announced_at").cast("timestamp_ntz"))
    return ann.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.max("announced_at").alias("updated_at"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))


@query("""
with e as (select user_id as scope, ts from events),
r as (select user_id as scope, min(ts) as s, min(ts) + interval 5 day as e from events group by user_id)
select r.scope, (select count(*) from e where e.ts between r.s and r.e) as n from r""")
def range_join_counts(spark, d):
    events = V.audits(spark, d)
    ranges = events.groupBy("scope").agg(F.min("started_at").alias("s")).withColumn("e", F.expr("s + interval 5 days"))
    return timewin.range_counts(events, "started_at", ranges, "scope")


@query(f"""
with {V.ANN}, {V.SUMS}, base as (select * from ann where announced_at {WINDOW_SQL})
select (select count(*) from base) as announcements, (select count(*) from sums join base using (announcement_id)) as summaries,
 (select count(distinct announcement_id) from sums join base using (announcement_id) where version = 'R') as stale,
 (select count(distinct ticker) from base) as companies""")
def funnel_counts(spark, d):
    base = timewin.in_window(V.announcements(spark, d), "announced_at", START, END)
    # One pass: summaries are counted by announcement before they meet the window.
    own = V.summaries(spark, d).groupBy("announcement_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("version") == "R").alias("stale"))
    rows = base.join(own, "announcement_id", "left")
    return rows.agg(F.count(F.lit(1)).alias("announcements"), F.coalesce(F.sum("n"), F.lit(0)).alias("summaries"), F.count_if("stale").alias("stale"), F.count_distinct("ticker").alias("companies"))


@query(f"with {V.ANN}, {V.SUMS} select a.announcement_id, a.ticker, coalesce(s.n, 0) as n, round(s.value, 2) as value from ann a left join sums s on a.announcement_id = s.announcement_id and s.version = 'A'")
def versioned_left_join(spark, d):
    sums = V.summaries(spark, d).drop("updated_at")
    return R.versioned_left_join(V.announcements(spark, d), sums, "announcement_id", version="A").select("announcement_id", "ticker", F.coalesce("n", F.lit(0)).alias("n"), F.round("value", 2).alias("value"))


@query(f"with {V.ANN}, {V.SUMS} select a.announcement_id, a.ticker, a.announced_at, s.n, s.version from ann a join sums s using (announcement_id) where a.announced_at {WINDOW_SQL} and s.version in ('A', 'N')")
def window_inner_join(spark, d):
    ann = timewin.in_window(V.announcements(spark, d), "announced_at", START, END)
    return ann.join(V.summaries(spark, d).where(F.col("version").isin("A", "N")), "announcement_id").select("announcement_id", "ticker", "announced_at", "n", "version")


@query(f"with {V.ANN}, {V.SUMS} select announcement_id, n, version from sums where announcement_id in (select announcement_id from ann where status = 'F' and announced_at {WINDOW_SQL})")
def semi_bundle(spark, d):
    wanted = timewin.in_window(V.announcements(spark, d), "announced_at", START, END).where("status = 'F'")
    return V.summaries(spark, d).join(wanted, "announcement_id", "left_semi").select("announcement_id", "n", "version")


@query(f"with {V.AUDIT} select audit_id, stage, scope from audit where stage = 'purchase' or scope in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def or_subquery_audits(spark, d):
    wanted = V.load(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("scope"))
    return R.either(V.audits(spark, d), F.col("stage") == "purchase", "scope", wanted).select("audit_id", "stage", "scope")


@query(f"with {V.SUMS} select announcement_id, count(*) as n, string_agg(n || ':' || version, ',' order by n, version) as bundle from sums group by announcement_id")
def nested_bundle(spark, d):
    rows = V.summaries(spark, d).groupBy("announcement_id").agg(F.array_sort(F.collect_list(F.struct("n", "version"))).alias("b"))
    return rows.select("announcement_id", F.size("b").cast("bigint").alias("n"), F.array_join(F.transform("b", lambda x: F.concat_ws(":", x["n"], x["version"])), ",").alias("bundle"))


@query(f"with {V.ANN} select announcement_id, ticker, announced_at from ann where not exists (select 1 from documents d where d.doc_id = ann.announcement_id)")
def anti_join_ids(spark, d):
    seen = V.load(spark, d, "documents").select(F.col("doc_id").alias("announcement_id"))
    return V.announcements(spark, d).join(seen, "announcement_id", "left_anti").select("announcement_id", "ticker", "announced_at")


@query("select c.c_custkey, coalesce(l.quality = 1, false) as in_portfolio, coalesce(l.toxic = 1, false) as in_watchlist from customer c left join labels l on c.c_custkey = l.doc_id")
def relevance_lookup(spark, d):
    flags = V.load(spark, d, "labels").select(F.col("doc_id").alias("c_custkey"), (F.col("quality") == 1).alias("p"), (F.col("toxic") == 1).alias("w"))
    rows = V.load(spark, d, "customer").select("c_custkey").join(flags, "c_custkey", "left")
    return rows.select("c_custkey", F.coalesce("p", F.lit(False)).alias("in_portfolio"), F.coalesce("w", F.lit(False)).alias("in_watchlist"))


MERGED = f"""{V.COV},
marked as (select *, case when s <= max(e) over (partition by scope order by s, e rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from cov),
isl as (select *, sum(fresh) over (partition by scope order by s, e rows unbounded preceding) as island from marked),
merged as (select scope, min(s) as s, max(e) as e from isl group by scope, island)"""


@query(f"with {MERGED} select scope, s, e from merged")
def interval_merge(spark, d):
    return timewin.merge_intervals(V.coverage(spark, d), "scope")


REQUESTS = "r as (select user_id as scope, date_trunc('day', min(ts)) as a, date_trunc('day', max(ts)) as b from events group by user_id)"


@query(f"""
with {MERGED}, {REQUESTS},
o as (select r.scope, r.a, r.b, m.s, m.e from r join merged m on m.scope = r.scope and m.e >= r.a and m.s <= r.b),
mid as (select scope, greatest(a, coalesce(lag(e) over (partition by scope order by s), a)) as lo, least(s, b) as hi from o),
tail as (select r.scope, greatest(r.a, coalesce(max(o.e), r.a)) as lo, r.b as hi, count(o.scope) as c from r left join o on o.scope = r.scope group by r.scope, r.a, r.b)
select scope, lo, hi from mid where hi > lo union all select scope, lo, hi from tail where lo < hi or (lo = hi and c = 0)""")
def interval_subtract(spark, d):
    day = lambda c: F.date_trunc("day", c).cast("timestamp_ntz")
    requests = V.audits(spark, d).groupBy("scope").agg(day(F.min("started_at")).alias("a"), day(F.max("started_at")).alias("b"))
    return timewin.subtract_intervals(requests, timewin.merge_intervals(V.coverage(spark, d), "scope"), "scope")


@query(f"with {MERGED} select event_id, user_id, ts + interval 3 hour as at from events e where not exists (select 1 from merged m where m.scope = e.user_id + 1 and e.ts + interval 3 hour between m.s and m.e)")
def uncovered_rows(spark, d):
    rows = V.load(spark, d, "events").select("event_id", "user_id", F.expr("ts + interval 3 hours").alias("at"), (F.col("user_id") + 1).alias("scope"))
    merged = timewin.merge_intervals(V.coverage(spark, d), "scope")
    return timewin.contained(rows, "at", merged, ["scope"], "left_anti").select("event_id", "user_id", "at")


@query(f"with {MERGED} select event_id, user_id from events e where exists (select 1 from merged m where m.scope = e.user_id + 1 and e.ts + interval 3 hour between m.s and m.e)")
def coverage_contains(spark, d):
    rows = V.load(spark, d, "events").select("event_id", "user_id", F.expr("ts + interval 3 hours").alias("at"), (F.col("user_id") + 1).alias("scope"))
    merged = timewin.merge_intervals(V.coverage(spark, d), "scope")
    return timewin.contained(rows, "at", merged, ["scope"], "left_semi").select("event_id", "user_id")


@query(f"""
with {V.AUDIT}, n as (select *, row_number() over (partition by scope order by started_at desc, audit_id) as dn, count(*) over (partition by scope) as c from audit),
p as (select *, c - dn + 1 as up, least(10, greatest(c - 6, 0)) as back from n)
select audit_id, scope, cast(case when dn <= 6 then dn when up <= back then 6 + up else dn + back end as integer) as place from p""")
def recovery_lanes(spark, d):
    return R.lanes(V.audits(spark, d), ["scope"], "started_at", "audit_id").select("audit_id", "scope", "place")


@query(f"with {V.AUDIT} select scope, stage, min(audit_id) as audit_id, arg_min(elapsed, audit_id) as elapsed from audit group by scope, stage")
def dedupe_first_wins(spark, d):
    return R.first_wins(V.audits(spark, d), ["scope", "stage"], "audit_id").select("scope", "stage", "audit_id", "elapsed")


@query(f"with {V.AUDIT} select scope, stage, min(audit_id) as audit_id, arg_max(elapsed, audit_id) as elapsed from audit group by scope, stage")
def dedupe_last_value(spark, d):
    return R.last_value(V.audits(spark, d), ["scope", "stage"], "audit_id").select("scope", "stage", "audit_id", "elapsed")


@query("""
with s as (select user_id, event_type, round(avg(value) / 100, 6) as score from events group by user_id, event_type),
r as (select *, row_number() over (partition by user_id order by score desc, event_type desc) as rank, max(score) over (partition by user_id) as best from s)
select user_id, event_type, score, cast(rank as integer) as rank from r where rank <= 2 and best >= 0.2 and (rank = 1 or score >= greatest(0.2, best - 0.08))""")
def top2_margin(spark, d):
    scores = V.load(spark, d, "events").groupBy("user_id", "event_type").agg(F.round(F.avg("value") / 100, 6).alias("score"))
    return R.top_two(scores, ["user_id"], "score", "event_type").select("user_id", "event_type", "score", "rank")


@query(f"with {V.ATT} select url, announcement_id, first_value(url) over (partition by announcement_id, sha256 order by ordinal) as first_url, count(*) over (partition by announcement_id, sha256) as copies from att")
def exact_duplicates(spark, d):
    att = V.attachments(spark, d)
    groups = att.groupBy("announcement_id", "sha256").agg(F.min_by("url", "ordinal").alias("first_url"), F.count(F.lit(1)).alias("copies"))
    return att.join(groups, ["announcement_id", "sha256"]).select("url", "announcement_id", "first_url", "copies")


TOKENS_SQL = "regexp_extract_all(lower(text), '[a-z0-9]+')"


@query(f"select doc_id, len({TOKENS_SQL}) as n_tokens, len(list_distinct({TOKENS_SQL})) as n_distinct from documents")
def attachment_tokens(spark, d):
    toks = dedup.tokens(F.col("text"))
    return V.load(spark, d, "documents").select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"), F.size(F.array_distinct(toks)).cast("bigint").alias("n_distinct"))


FEATURES_SQL = rf"""{V.ATT},
t as (select *, regexp_extract_all(lower(text), '[a-z0-9]+') as toks, lower(regexp_extract(filename, '[^./](\.[^./]+)$', 1)) as suffix from att),
f as (select *, len(toks) as n_tokens, array_to_string(toks, ' ') as normalized, row_number() over (partition by announcement_id order by is_attachment, len(toks) desc, lower(filename), ordinal) as rank,
  case when len(toks) >= 120 then list_distinct(list_transform(range(1, len(toks) - 3), lambda i: array_to_string(toks[i : i + 4], chr(31)))) end as shingles from t),
near as (select a.announcement_id, a.url as later, b.url as earlier,
  case when a.normalized = b.normalized then 1.0::double
    else greatest(case when contains(case when length(a.normalized) <= length(b.normalized) then b.normalized else a.normalized end, case when length(a.normalized) <= length(b.normalized) then a.normalized else b.normalized end)
      then least(length(a.normalized), length(b.normalized))::double / greatest(length(a.normalized), length(b.normalized)) else 0 end,
      len(list_intersect(a.shingles, b.shingles))::double / (len(a.shingles) + len(b.shingles) - len(list_intersect(a.shingles, b.shingles)))) end as similarity
  from f a join f b on a.announcement_id = b.announcement_id and a.suffix = b.suffix and b.rank < a.rank
    and a.n_tokens >= 120 and b.n_tokens >= 120 and least(a.n_tokens, b.n_tokens)::double / greatest(a.n_tokens, b.n_tokens) >= 0.94 and a.sha256 <> b.sha256)"""
#: Shingles of a text with over this many are taken by stride.
STRIDED = 6000
STRIDED_SQL = FEATURES_SQL.replace("range(1, len(toks) - 3)", f"range(1, len(toks) - 3, greatest(1, cast(ceil((len(toks) - 4) / {STRIDED}.0) as bigint)))")


@query(f"with {FEATURES_SQL} select later, earlier, round(similarity, 6) as similarity from near where similarity >= 0.7")
def near_dup_pairs(spark, d):
    rows = dedup.features(V.attachments(spark, d))
    return _named_pairs(rows, dedup.near_pairs(rows, 0.7))


def _named_pairs(rows, pairs):
    names = lambda n: rows.select("announcement_id", F.col("rank").alias(n), F.col("url").alias(f"{n}_url"))
    pairs = pairs.join(names("later"), ["announcement_id", "later"]).join(names("earlier"), ["announcement_id", "earlier"])
    return pairs.select(F.col("later_url").alias("later"), F.col("earlier_url").alias("earlier"), F.round("similarity", 6).alias("similarity"))


@query("with " + STRIDED_SQL.replace("from att)", "from (select * replace (left(url, 4) as announcement_id) from att))").replace("array_to_string(toks[i : i + 4], chr(31))", "hash(array_to_string(toks[i : i + 4], chr(31)))") + " select later, earlier, round(similarity, 6) as similarity from near where similarity >= 0.7")
def near_dup_pairs_by_suffix(spark, d):
    """All documents of a kind of file are one group."""
    rows = dedup.features(V.attachments(spark, d).withColumn("announcement_id", F.substring("url", 1, 4)), cap=STRIDED)
    return _named_pairs(rows, dedup.near_pairs(rows, 0.7))


GREEDY = f"""
with recursive {FEATURES_SQL},
near_rank as (select n.announcement_id, x.rank as later, y.rank as earlier, n.similarity from near n join f x on x.url = n.later join f y on y.url = n.earlier),
hits as (select announcement_id, later, earlier, 'near_duplicate' as category, similarity from near_rank where similarity >= 0.985
  union all select a.announcement_id, a.rank, b.rank, 'exact_duplicate', 1.0 from f a join f b on a.announcement_id = b.announcement_id and a.sha256 = b.sha256 and b.rank < a.rank),
listed as (select announcement_id, later, list({{'e': earlier, 'c': category, 's': similarity}} order by earlier, category) as es from hits group by all),
sizes as (select announcement_id, max(rank) as m from f group by all),
st as (select announcement_id, 0::bigint as k, []::bigint[] as gone, null::struct(e bigint, c varchar, s double) as hit from sizes
  union all
  select t.announcement_id, t.k + 1, case when t.h is null then t.gone else list_append(t.gone, t.k + 1) end, t.h from (
    select s.announcement_id, s.k, s.gone, list_filter(l.es, lambda x: not list_contains(s.gone, x.e))[1] as h from st s join sizes z on z.announcement_id = s.announcement_id and s.k < z.m
    left join listed l on l.announcement_id = s.announcement_id and l.later = s.k + 1) t)
select f.announcement_id, f.url, st.hit is null as keep, coalesce(st.hit.c, 'analysis_source') as category, e.url as duplicate_of_url, round(st.hit.s, 6) as similarity
from f join st on st.announcement_id = f.announcement_id and st.k = f.rank left join f e on e.announcement_id = f.announcement_id and e.rank = st.hit.e"""


@query(GREEDY)
def dedup_greedy(spark, d):
    return dedup.deduplicate(V.attachments(spark, d)).withColumn("similarity", F.round("similarity", 6))


PLAIN_TITLE = rules.PLAIN_SQL.format("title")


@query(f"with {V.ANN}, p as (select *, {PLAIN_TITLE} as t from ann) select announcement_id, {rules.first_match_sql('t', rules.TITLE_RULES, rules.FALLBACK)} as category, {rules.first_match_sql('t', (('public_expose', rules.TITLE_RULES[0][1]), ('financial_report', rules.TITLE_RULES[3][1])), 'general')} as class from p")
def classify_titles(spark, d):
    return V.announcements(spark, d).select("announcement_id", rules.title_category(F.col("title")).alias("category"), rules.document_class(F.col("title")).alias("class"))


_SIG = ", ".join(f"'{x}'" for x in rules.SIGNIFICANT)


@query(f"""
with {V.ANN}, p as (select *, {PLAIN_TITLE} as t from ann), c as (select announcement_id, {rules.first_match_sql('t', rules.TITLE_RULES, rules.FALLBACK)} as category from p)
select c.announcement_id, c.category, case when c.category not in ({_SIG}) then 'ROUTINE' when coalesce(l.quality, 0) = 1 then 'HIGH' when coalesce(l.toxic, 0) = 1 then 'MEDIUM' else 'ROUTINE' end as materiality
from c left join labels l on c.announcement_id = l.doc_id""")
def materiality(spark, d):
    flags = V.load(spark, d, "labels").select(F.col("doc_id").alias("announcement_id"), (F.col("quality") == 1).alias("p"), (F.col("toxic") == 1).alias("w"))
    rows = V.announcements(spark, d).select("announcement_id", rules.title_category(F.col("title")).alias("category")).join(flags, "announcement_id", "left")
    return rows.select("announcement_id", "category", rules.owner_materiality(F.col("category"), F.col("p"), F.col("w")).alias("materiality"))


TAGS = f"""{V.ANN}, p as (select *, {PLAIN_TITLE} as t from ann), g as (select announcement_id, t, {rules.all_matches_sql('t', rules.TAXONOMY)} as found, {rules.first_match_sql('t', rules.TAXONOMY, None)} as head from p),
tags as (select announcement_id, head, case when len(found) = 0 then ['OTHER'] else found end as tags from g)"""


@query(f"with {TAGS} select announcement_id, array_to_string(tags, ',') as tags from tags")
def taxonomy_tags(spark, d):
    return V.announcements(spark, d).select("announcement_id", F.array_join(rules.taxonomy_tags(F.col("title")), ",").alias("tags"))


_H, _M = (", ".join(f"'{x}'" for x in v) for v in (rules.HIGH, rules.MEDIUM))
TAGGED = f"""{TAGS}, q as (select announcement_id, head is not null as anchored, coalesce(head, tags[1]) as p, tags from tags),
m as (select *, case when len(list_filter(tags, lambda x: x in ({_H}))) > 0 then 'HIGH' when len(list_filter(tags, lambda x: x in ({_M}))) > 0 then 'MEDIUM' when tags = ['ROUTINE_REPORT'] then 'ROUTINE' else 'LOW' end as materiality from q)"""


@query(f"""with {TAGGED} select announcement_id, p as primary_category, array_to_string(list_concat([p], list_filter(tags, lambda x: x <> p)), ',') as tags, materiality,
 case when materiality = 'ROUTINE' then greatest(0.65, case when anchored then 0.75 when p = 'OTHER' then 0.45 else 0.6 end) else case when anchored then 0.75 when p = 'OTHER' then 0.45 else 0.6 end end::double as confidence from m""")
def tag_materiality(spark, d):
    rows = V.announcements(spark, d).select("announcement_id", "title", rules.taxonomy_tags(F.col("title")).alias("tags"))
    rows = rows.select("announcement_id", rules.headline(F.col("title")).isNotNull().alias("anchored"), rules.primary_first(F.col("title"), F.col("tags")).alias("tags"))
    rows = rows.withColumn("m", rules.tag_materiality(F.col("tags"), F.lit(None).cast("string")))
    p = F.col("tags")[0]
    return rows.select("announcement_id", p.alias("primary_category"), F.array_join("tags", ",").alias("tags"), F.col("m").alias("materiality"), rules.confidence(p, F.col("anchored"), F.col("m")).alias("confidence"))


@query(f"with {V.AUDIT} select stage, count(*) as n, round(sum(elapsed), 3) as total, round(avg(elapsed), 3) as average, round(max(elapsed), 3) as longest from audit group by stage")
def stage_timing(spark, d):
    return telemetry.stage_timing(V.audits(spark, d), "stage", "elapsed")


@query(f"with {V.AUDIT} select stage, count(*) as n, round(sum(elapsed), 3) as total, round(avg(elapsed), 3) as average, round(max(elapsed), 3) as longest from audit group by stage order by total desc, stage limit 5")
def slowest_stages(spark, d):
    return telemetry.slowest(telemetry.stage_timing(V.audits(spark, d), "stage", "elapsed"), "stage")


@query(f"""with {V.AUDIT} select scope, round(list_reduce(list_prepend(0.0::double, list(greatest(0, elapsed) order by started_at, audit_id)), lambda acc, x: case when acc <= 0 then x else 0.22 * x + 0.78 * acc end), 6) as ewma from audit group by scope""")
def ewma_latency(spark, d):
    return telemetry.ewma(V.audits(spark, d), "scope", ["started_at", "audit_id"], "elapsed").select("scope", F.round("ewma", 6).alias("ewma"))


@query("""
with recursive e as (select user_id as scope, row_number() over (partition by user_id order by ts, event_id) as k, case when event_id % 37 = 0 then 'throttle' when event_id % 11 = 0 then 'transient' else 'success' end as o from events),
s as (select distinct scope, 0::bigint as k, 4 as now, 0 as streak, 0 as throttles, 0 as ramps from e
  union all select s.scope, s.k + 1, case when e.o = 'throttle' then greatest(1, s.now // 2) when e.o = 'transient' then greatest(1, s.now - 1) when s.now < 4 and s.streak + 1 >= 2 * s.now then s.now + 1 else s.now end,
    case when e.o <> 'success' or (s.now < 4 and s.streak + 1 >= 2 * s.now) then 0 else s.streak + 1 end, s.throttles + case when e.o = 'throttle' then 1 else 0 end, s.ramps + case when e.o = 'success' and s.now < 4 and s.streak + 1 >= 2 * s.now then 1 else 0 end
  from s join e on e.scope = s.scope and e.k = s.k + 1)
select scope, arg_max(now, k)::integer as "limit", arg_max(throttles, k)::integer as throttles, arg_max(ramps, k)::integer as ramps from s group by scope""")
def adaptive_limit(spark, d):
    outcome = F.when(F.col("audit_id") % 37 == 0, "throttle").when(F.col("audit_id") % 11 == 0, "transient").otherwise("success")
    return telemetry.adaptive_limit(V.audits(spark, d).withColumn("outcome", outcome), "scope", ["started_at", "audit_id"], "outcome", step=2)


ADVICE = """
with r as (select user_id as run, count(*) as done, round(sum(value), 3) as elapsed, user_id % 9 as llm_max, user_id % 7 as llm_peak, user_id % 5 as workers, user_id % 6 as worker_peak,
  user_id % 12 as inflight_max, user_id % 11 as inflight_peak, user_id % 9 as provider_max, case when user_id % 3 = 0 then user_id % 4 else user_id % 9 end as provider_limit,
  user_id % 4 as waited, count(*) as answered, case when user_id % 10 = 0 then 1 else 0 end as throttles from events group by user_id),
b as (select *, greatest(1, llm_max) as lm, greatest(1, workers) as wk, greatest(greatest(1, workers), inflight_max) as fl, greatest(1, provider_max) as pm, greatest(1, provider_limit) as pl from r),
u as (select *, least(1.0, llm_peak / lm::double) as lu, least(1.0, worker_peak / wk::double) as wu, least(1.0, inflight_peak / fl::double) as bl, least(1.0, waited / greatest(1, answered)::double) as wt from b),
k as (select *, throttles > 0 or pl < pm as pressed, case when throttles > 0 or pl < pm then 'provider' when wt >= 0.25 and lu >= 0.75 then 'provider' when bl >= 0.85 and wu >= 0.75 then 'extraction'
  when lu >= 0.95 and wt < 0.10 and lm < 8 then 'llm-capacity' when lu < 0.5 and bl < 0.5 then 'preparation-or-source' else 'balanced' end as bottleneck from u),
s as (select *, case when bottleneck = 'extraction' and wk < 8 then wk + 1 else wk end as ew, case when pressed then greatest(1, least(lm, pl)) when bottleneck = 'llm-capacity' then lm + 1 else lm end as ls from k),
q as (select *, case when bottleneck = 'extraction' then least(32, greatest(fl, ew * 3)) else fl end as qu from s)
select run, round(case when elapsed > 0 then done / elapsed * 60 else 0 end, 3) as per_minute, bottleneck,
  case when bottleneck in ('provider', 'extraction') then 'high' when bottleneck = 'preparation-or-source' and done < 8 then 'low' else 'medium' end as confidence,
  round(lu, 3) as llm_ratio, round(bl, 3) as backlog_ratio, round(wt, 3) as wait_ratio, ls::integer as llm_slots, ew::integer as extraction_workers, qu::integer as queue, ls <> lm or ew <> wk or qu <> fl as changed from q"""


@query(ADVICE)
def performance_advice(spark, d):
    u = F.col("scope")
    runs = V.audits(spark, d).groupBy("scope").agg(F.count(F.lit(1)).alias("done"), F.round(F.sum("elapsed"), 3).alias("elapsed"))
    runs = runs.select(
        u.alias("run"), "done", "elapsed", (u % 9).alias("llm_max"), (u % 7).alias("llm_peak"), (u % 5).alias("workers"), (u % 6).alias("worker_peak"), (u % 12).alias("inflight_max"), (u % 11).alias("inflight_peak"),
        (u % 9).alias("provider_max"), F.when(u % 3 == 0, u % 4).otherwise(u % 9).alias("provider_limit"), (u % 4).alias("waited"), F.col("done").alias("answered"), F.when(u % 10 == 0, 1).otherwise(0).alias("throttles"),
    )
    return telemetry.advice(runs)


@query(f"""with {V.AUDIT}, c as (select *, sum(audit_id % 7) over w as total from audit window w as (partition by scope order by started_at, audit_id rows unbounded preceding)),
o as (select *, sum(case when total > 100 then 1 else 0 end) over (partition by scope order by started_at, audit_id rows unbounded preceding) as over_ from c)
select audit_id, scope, case when over_ = 0 then 'done' when over_ = 1 then 'over' else 'deferred' end as status from o""")
def budget_cutoff(spark, d):
    rows = V.audits(spark, d).withColumn("amount", F.col("audit_id") % 7)
    return R.running_cap(rows, ["scope"], ["started_at", "audit_id"], "amount", 100).select("audit_id", "scope", "status")


@query(f"""with {V.AUDIT}, f as (select *, audit_id % 29 = 0 as failed, sum(case when audit_id % 29 = 0 then 1 else 0 end) over (partition by scope order by started_at, audit_id rows unbounded preceding) as n from audit)
select audit_id, scope, case when n = 0 then 'done' when failed and n = 1 then 'failed' else 'deferred' end as status from f""")
def circuit_breaker(spark, d):
    return R.breaker(V.audits(spark, d), ["scope"], ["started_at", "audit_id"], F.col("audit_id") % 29 == 0).select("audit_id", "scope", "status")


@query(f"with {V.AUDIT} select audit_id, scope, cast(row_number() over (partition by scope order by started_at, audit_id) as integer) as turn from audit")
def fair_order(spark, d):
    return R.round_robin(V.audits(spark, d), "scope", ["started_at", "audit_id"]).select("audit_id", "scope", "turn")


@query(f"with {V.AUDIT}, s as (select *, row_number() over (partition by scope order by started_at, audit_id) as seq from audit) select scope, audit_id, cast(seq as integer) as seq from s where seq > 20")
def event_cursor(spark, d):
    rows = numbered(V.audits(spark, d), ["scope"], ["started_at", "audit_id"], "seq")
    return rows.where("seq > 20").select("scope", "audit_id", F.col("seq").cast("int").alias("seq"))


@query(r"""select doc_id, length(regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{4,}', chr(10) || chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) as n,
 md5(regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{4,}', chr(10) || chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) as digest from documents""")
def normalize_text(spark, d):
    t = T.normalise(F.col("text"))
    return V.load(spark, d, "documents").select("doc_id", F.length(t).cast("bigint").alias("n"), F.md5(t.cast("binary")).alias("digest"))


@query(rf"with {V.ATT} select url, lower(regexp_extract(filename, '[^./](\.[^./]+)$', 1)) as suffix, left(sha256(url), 16) as short_hash from att")
def file_names(spark, d):
    return V.attachments(spark, d).select("url", T.suffix(F.col("filename")).alias("suffix"), T.short_hash(F.col("url")).alias("short_hash"))


@query(r"select page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) as host, regexp_extract(url, '^([a-z]+)://', 1) as scheme from pages")
def url_parts(spark, d):
    return V.load(spark, d, "pages").select("page_id", T.host(F.col("url")).alias("host"), F.try_parse_url("url", F.lit("PROTOCOL")).alias("scheme"))


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_props(spark, d):
    return V.load(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query(f"""with {V.ANN} select announcement_id, sha256('{{"announcementId": "' || announcement_id || '", "materiality": "' || status || '", "primaryCategory": "' || kind || '", "title": "' || title || '"}}') as digest from ann""")
def rules_hash(spark, d):
    c = F.col
    return V.announcements(spark, d).select("announcement_id", T.rules_hash(c("announcement_id"), c("title"), c("kind"), c("status")).alias("digest"))


@query(f"""with {V.SUMS} select announcement_id, sha256('[' || string_agg('{{"n":' || n || ',"version":"' || version || '"}}', ',' order by n, version) || ']') as fingerprint from sums group by announcement_id""")
def group_fingerprint(spark, d):
    return reduce.fingerprint(V.summaries(spark, d), ["announcement_id"], ["n", "version"], ["n", "version"])
