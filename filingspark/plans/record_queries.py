"""Queries of paging, snapshots, gates, the store's ledger, loose values, files and dates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import render as X, text as T, values as U
from ..operators import collect, contracts, gates, ledger, reduce, relational as R, rules, schema, state, timewin
from ..operators.store import Store
from ..sources import paging, snapshots, views as V
from ..streaming.state import shared_folder
from .filing_queries import PLAIN_TITLE, _SIG
from .registry import query


def K():
    """The number that everything is dealt by; made on use, as a column needs a session."""
    return F.col("event_id")


def NULL():
    return F.lit(None).cast("string")


def _events(spark, d):
    return V.load(spark, d, "events")


def _pick(names, n):
    return F.element_at(F.array(*map(F.lit, names)), (n + 1).cast("int"))


def _list(names) -> str:
    return "[" + ", ".join("null" if x is None else "'" + x.replace("'", "''") + "'" for x in names) + "]"


def _dealt(names, n):
    return F.element_at(F.array(*[NULL() if x is None else F.lit(x) for x in names]), (n + 1).cast("int"))


# Paged sources: a range is a user's events by day, cut into pages of five; some totals are wrong, some pages empty.

PAGES_SQL = """
e as (select user_id as rid, event_id % 4 as d, event_id, row_number() over (partition by user_id, event_id % 4 order by event_id) - 1 as k, count(*) over (partition by user_id, event_id % 4) as n from events),
raw as (select rid, d, k // 5 as page, list(case when event_id % 23 = 0 then '' else 'e' || (event_id // 2) end order by k) as ids, max(n) as n from e group by all),
pages as (select rid, d, page, page * 5 as "offset", case when rid % 6 = 1 and page = 1 then [] else ids end as ids, case when rid % 6 = 2 then n + 40 when rid % 6 = 3 then null else n end::bigint as reported, case when rid % 6 = 2 then 4 else 5 end as page_size from raw),
m as (select *, len(ids) as c, coalesce(nullif(reported, 0), len(ids)) as total from pages),
w as (select *, c = 0 or c < page_size or "offset" + c >= total as ends, case when c = 0 then "offset" = 0 or "offset" >= total else true end as whole from m),
rd as (select * from (select *, coalesce(max(ends::int) over (partition by rid, d order by page rows between unbounded preceding and 1 preceding), 0) as past from w) where past = 0),
it as (select rid, d, id, min(page * 1000000 + pos) as ordinal from (select rid, d, page, unnest(ids) as id, generate_subscripts(ids, 1) - 1 as pos from rd) where id <> '' group by all)"""


def _pages(spark, d):
    from pyspark.sql.window import Window

    day = (K() % 4).alias("d")
    group = Window.partitionBy("rid", "d")
    e = _events(spark, d).select(F.col("user_id").alias("rid"), day, "event_id")
    e = e.withColumn("k", F.row_number().over(group.orderBy("event_id")) - 1).withColumn("n", F.count(F.lit(1)).over(group))
    name = F.when(K() % 23 == 0, "").otherwise(F.concat(F.lit("e"), F.floor(K() / 2).cast("string")))
    raw = e.groupBy("rid", "d", F.floor(F.col("k") / 5).cast("int").alias("page")).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", name.alias("id")))), lambda x: x["id"]).alias("ids"), F.max("n").alias("n"))
    kind = F.col("rid") % 6
    return raw.select("rid", "d", "page", (F.col("page") * 5).alias("offset"), F.when((kind == 1) & (F.col("page") == 1), F.array().cast("array<string>")).otherwise(F.col("ids")).alias("ids"), F.when(kind == 2, F.col("n") + 40).when(kind != 3, F.col("n")).cast("bigint").alias("reported"), F.when(kind == 2, 4).otherwise(5).alias("page_size"))


@query(f"""with {PAGES_SQL}, r as (select rid, d, bool_or(ends and whole) as complete, arg_max(total, page) as reported, count(*) as pages from rd group by rid, d)
select r.rid, r.d, coalesce(complete, false) as complete, reported::bigint as reported, (select count(*) from it where it.rid = r.rid and it.d = r.d) as collected, pages from r""")
def paged_ranges(spark, d):
    out = paging.range_reports(_pages(spark, d), ["rid", "d"])
    return out.withColumn("complete", F.coalesce("complete", F.lit(False)))


@query(f"with {PAGES_SQL} select rid, d, id, ordinal::bigint as ordinal from it")
def paged_items(spark, d):
    return paging.range_items(_pages(spark, d), ["rid", "d"]).withColumn("ordinal", F.col("ordinal").cast("bigint"))


@query("select event_id, case when coalesce(r, 0) <= 1000 then least(1000, greatest(200, coalesce(nullif(r, 0), 200))) end::bigint as size from (select event_id, case when event_id % 5 = 0 then null when event_id % 5 = 1 then 0 else event_id % 1500 end as r from events)")
def wide_probes(spark, d):
    reported = F.when(K() % 5 == 1, 0).when(K() % 5 != 0, K() % 1500)
    return _events(spark, d).select("event_id", paging.probe_size(reported).alias("size"))


CASCADE_SQL = """
lv as (select user_id as win, ['range', 'probe', 'day', 'day-probe', 'ticker'][event_id % 5 + 1] as level, case when event_id % 5 >= 2 then event_id % 3 end as day, case when event_id % 5 = 4 then 'T' || (event_id % 2) end as ticker, event_id from events),
rp as (select win, level, day, ticker, bool_and(event_id % 7 <> 0) and not (level = 'range' and win % 3 > 0) and not (level = 'probe' and win % 3 > 1) as complete, count(*) + case when win % 5 = 0 and level like '%probe' then 1 else 0 end as reported, count(*) as collected from lv group by win, level, day, ticker),
g as (select *, complete and (level not like '%probe' or collected >= reported) as good from rp),
ws as (select win, case when bool_or(level = 'range' and good) then 'range' when bool_or(level = 'probe' and good) then 'probe' else 'days' end as src from g group by win),
ds as (select win, day, case when bool_or(level = 'day' and good) then 'day' when bool_or(level = 'day-probe' and good) then 'day-probe' when bool_or(level = 'ticker') then 'ticker' end as src, bool_and(good) filter (where level = 'ticker') as t from g where day is not null group by win, day),
dw as (select ds.win, ds.day, ds.src, case when ds.src = 'ticker' then t else ds.src is not null end as whole from ds join ws on ws.win = ds.win and ws.src = 'days'),
st as (select ws.win, case when ws.src = 'range' then 'pagination' when ws.src = 'probe' then 'wide-page-probe' when coalesce((select bool_and(whole) from dw where dw.win = ws.win), true) then 'date-shards' else 'date-shards-partial' end as strategy from ws),
its as (select win, level, day, ticker, 'e' || (event_id // 3) as id, event_id from lv),
ch as (select i.win, i.id, i.level, i.day, i.ticker, i.event_id from its i join ws on ws.win = i.win and ws.src = i.level union all select i.win, i.id, i.level, i.day, i.ticker, i.event_id from its i join dw on dw.win = i.win and dw.day = i.day and dw.src = i.level),
la as (select win, id, max(day) as day, count(*) as n from ch group by win, id)"""


def _cascade(spark, d):
    level = _pick(("range", "probe", "day", "day-probe", "ticker"), K() % 5)
    lv = _events(spark, d).select(F.col("user_id").alias("window"), level.alias("level"), F.when(K() % 5 >= 2, K() % 3).alias("day"), F.when(K() % 5 == 4, F.concat(F.lit("T"), (K() % 2).cast("string"))).alias("ticker"), "event_id")
    w = F.col("window")
    reports = lv.groupBy("window", "level", "day", "ticker").agg(F.bool_and(K() % 7 != 0).alias("ok"), F.count(F.lit(1)).alias("collected"))
    lost = ((F.col("level") == "range") & (w % 3 > 0)) | ((F.col("level") == "probe") & (w % 3 > 1))
    more = F.when((w % 5 == 0) & F.col("level").endswith("probe"), 1).otherwise(0)
    reports = reports.select("window", "level", "day", "ticker", (F.col("ok") & ~lost).alias("complete"), (F.col("collected") + more).alias("reported"), "collected")
    items = lv.select("window", "level", "day", "ticker", F.concat(F.lit("e"), F.floor(K() / 3).cast("string")).alias("id"), F.col("event_id").cast("string").alias("stamp"))
    return paging.cascade(reports, items)


@query(f"with {CASCADE_SQL} select win, strategy, strategy <> 'date-shards-partial' as complete from st")
def completeness_strategy(spark, d):
    return _cascade(spark, d)[1].withColumnRenamed("window", "win")


@query(f"with {CASCADE_SQL} select win, id, coalesce(day, -1) as day from la")
def completeness_items(spark, d):
    return _cascade(spark, d)[0].select(F.col("window").alias("win"), "id", F.coalesce("day", F.lit(-1)).cast("bigint").alias("day"))


LOOKUP_SQL = """
st as (select case when o_orderkey % 9 = 0 then 'bad-' || o_orderkey else strftime(date_trunc('month', o_orderdate), '%Y%m%d') || '101112-' || (o_orderkey % 700) end as id2, 'T' || (o_orderkey % 3) as ticker, o_orderkey % 4 <> 0 as is_stock, case when o_orderkey % 11 = 0 then date_trunc('month', o_orderdate)::date + 1 else date_trunc('month', o_orderdate)::date end as day from orders),
wt as (select distinct id2 as external_id, ' t' || (length(id2) % 3) || ' ' as ticker from st)"""


@query(f"""with {LOOKUP_SQL} select external_id, ticker, case when not regexp_matches(external_id, '^[0-9]{{14}}') then 'invalid' else case (select count(*) from st where st.id2 = wt.external_id and upper(trim(st.ticker)) = upper(trim(wt.ticker)) and is_stock and day = try_strptime(left(external_id, 8), '%Y%m%d')::date) when 0 then 'missing' when 1 then 'found' else 'several' end end as state from wt""")
def exact_lookup(spark, d):
    k = F.col("o_orderkey")
    own = F.when(k % 9 == 0, F.concat(F.lit("bad-"), k.cast("string"))).otherwise(F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01101112-"), (k % 700).cast("string")))
    rows = V.load(spark, d, "orders").select(own.alias("id2"), F.concat(F.lit("T"), (k % 3).cast("string")).alias("ticker"), (k % 4 != 0).alias("is_stock"), F.when(k % 11 == 0, F.date_add(F.trunc("o_orderdate", "month"), 1)).otherwise(F.trunc("o_orderdate", "month")).alias("day"))
    wanted = rows.select(F.col("id2").alias("external_id"), F.concat(F.lit(" t"), (F.length("id2") % 3).cast("string"), F.lit(" ")).alias("ticker")).distinct()
    return paging.exact_lookup(rows, wanted)


# Snapshots of public pages: metadata dealt by number, each rule broken by some.

KINDS = ("idx-public-snapshot-v1", "issuer-public-snapshot-v1", "other", None)
SITES = ("https://www.idx.id/id/perusahaan-tercatat/keterbukaan-informasi/", "https://idx.co.id/EN/listed-companies/disclosure", "http://www.idx.id/en/listed-companies/disclosure", "https://www.idx.id.example.com/en/listed-companies/disclosure", "https://www.idx.id/en/other", None, " ")
CAPTURED = ("2027-01-02T03:04:05Z", "2027-01-02T03:04:05+07:00", "2027-01-02T03:04:05", "yesterday", None)


@query(f"""with r as (select event_id, {_list(KINDS)}[event_id % 4 + 1] as kind, event_id % 17 = 0 as claimed, {_list(SITES)}[event_id // 4 % 7 + 1] as page, {_list(CAPTURED)}[event_id // 28 % 5 + 1] as captured from events)
select event_id, case when coalesce(kind <> 'idx-public-snapshot-v1', true) then 'sourceKind' when claimed then 'coverage' when not coalesce(regexp_matches(trim(page), '^https://(www\\.)?idx\\.(id|co\\.id)/'), false) then 'sourcePage host'
  when not regexp_matches(lower(rtrim(trim(page), '/')), '(/en/listed-companies/disclosure|/id/perusahaan-tercatat/keterbukaan-informasi)$') then 'sourcePage path' when not coalesce(regexp_matches(captured, '(Z|\\+07:00)$'), false) then 'capturedAt' end as problem from r""")
def exchange_snapshots(spark, d):
    m = F.create_map(F.lit("sourceKind"), _dealt(KINDS, K() % 4), F.lit("sourcePage"), _dealt(SITES, F.floor(K() / 4) % 7), F.lit("capturedAt"), _dealt(CAPTURED, F.floor(K() / 28) % 5))
    return _events(spark, d).select("event_id", snapshots.exchange_problem(m, K() % 17 == 0).alias("problem"))


HOSTS = ("Emiten.co.id.", "localhost", "10.1.2.3", "https://emiten.co.id", "emiten", "a@emiten.co.id", " ", "files.emiten.co.id")
PAGES = ("https://emiten.co.id/a", "https://www.emiten.co.id:443/a", "https://www.emiten.co.id:8443/a", "https://user@emiten.co.id/a", "http://emiten.co.id/a", "https://notemiten.co.id/a", None)


@query(f"""with r as (select event_id, {_list(HOSTS)}[event_id % 8 + 1] as h, {_list(PAGES)}[event_id // 8 % 7 + 1] as page, case when event_id % 13 = 0 then 'TOO-LONG' when event_id % 13 = 1 then null else ' abcd' end as ticker, event_id % 19 = 0 as claimed, event_id % 23 = 0 as other from events),
n as (select *, case when trim(h) = '' then 'empty' when regexp_matches(h, '://|[/@:]') then 'not a host name' when h in ('localhost', 'emiten') then 'not public' when h = '10.1.2.3' then 'address' end as hp, coalesce(case rtrim(lower(trim(h)), '.') when 'emiten.co.id' then page in ('https://emiten.co.id/a', 'https://www.emiten.co.id:443/a') else false end, false) as good from r)
select event_id, hp as host_problem, case when other then 'sourceKind' when claimed then 'coverage' when coalesce(not regexp_matches(upper(trim(ticker)), '^[A-Z0-9]{{1,12}}$'), true) then 'issuerTicker' when hp is not null then 'issuerHosts' when not good then 'sourcePage' end as problem, good from n""")
def issuer_snapshots(spark, d):
    h, page = _dealt(HOSTS, K() % 8), _dealt(PAGES, F.floor(K() / 8) % 7)
    ticker = F.when(K() % 13 == 0, "TOO-LONG").when(K() % 13 != 1, " abcd")
    m = F.create_map(F.lit("sourceKind"), F.when(K() % 23 == 0, "x").otherwise(snapshots.ISSUER_KIND), F.lit("issuerTicker"), ticker, F.lit("sourcePage"), page, F.lit("capturedAt"), F.lit(CAPTURED[0]))
    good = snapshots.issuer_url(page, F.array(F.rtrim(F.lower(F.trim(h)), F.lit("."))))
    return _events(spark, d).select("event_id", snapshots.issuer_host_problem(h).alias("host_problem"), snapshots.issuer_problem(m, F.array(h), K() % 19 == 0).alias("problem"), (good & h.isin(HOSTS[0])).alias("good"))


@query("""select event_id, case when event_id % 5 = 0 then 'externalId' end as problem, coalesce(case when event_id % 3 = 0 then 'u' end, 'p') as source_url, 'p' as page, case when event_id % 2 = 0 then 'c' else 'own' end as captured, 'false' as authoritative, false as complete from events""")
def snapshot_disclosures(spark, d):
    rows = _events(spark, d).select("event_id", F.when(K() % 5 == 0, "x").otherwise(F.concat(F.lit(snapshots.EXCHANGE_PREFIX), K().cast("string"))).alias("external_id"), F.when(K() % 3 == 0, "u").alias("source_url"), F.create_map(F.lit("snapshotSourcePage"), F.lit("old"), F.lit("k"), F.lit("v")).alias("metadata"), F.lit("p").alias("page"), F.when(K() % 2 == 0, "c").otherwise("own").alias("captured_at"))
    out = snapshots.exchange_disclosures(rows)
    m = F.col("metadata")
    return out.select("event_id", "problem", "source_url", m["snapshotSourcePage"].alias("page"), m["snapshotCapturedAt"].alias("captured"), m["snapshotAuthoritativeCoverage"].alias("authoritative"), "complete")


@query("""with r as (select event_id, event_id % 5 = 0 as a, event_id % 7 = 0 as b, event_id % 11 as c, event_id % 3 as e from events)
select event_id, case when a then 'externalId' when b then 'ticker' when c = 1 then 'sourceUrl' when e = 1 then 'attachment sourceUrl' end as problem, case when c = 0 then 'https://emiten.co.id/page' when c = 1 then 'https://other.id/x' else 'https://emiten.co.id/x' end as source_url from r""")
def issuer_disclosures(spark, d):
    url = F.when(K() % 11 == 1, "https://other.id/x").when(K() % 11 != 0, "https://emiten.co.id/x")
    files = F.when(K() % 3 == 0, F.array(F.lit("https://www.emiten.co.id/f"))).when(K() % 3 == 1, F.array(F.lit("https://emiten.co.id/f"), NULL())).otherwise(F.array().cast("array<string>"))
    rows = _events(spark, d).select("event_id", F.when(K() % 5 == 0, "x").otherwise(F.lit(snapshots.ISSUER_PREFIX + "1")).alias("external_id"), F.when(K() % 7 == 0, "ZZ").otherwise(" abc").alias("ticker"), url.alias("source_url"), files.alias("attachment_urls"), F.lit("https://emiten.co.id/page").alias("page"), F.lit("ABC").alias("issuer"), F.array(F.lit("emiten.co.id")).alias("hosts"))
    return snapshots.issuer_disclosures(rows).select("event_id", "problem", "source_url")


#: Payloads of reference lists in each of their shapes, with codes by number.
@query("""with p as (select n_nationkey as k, n_nationkey % 5 as s, 'A' || n_nationkey as a, 'bb' || n_nationkey as b from nation)
select k, upper(a) as ticker from p union all select k, upper(b) from p where s <> 4 union all select k, 'KEYED' from p where s = 4""")
def reference_lists(spark, d):
    k = F.col("n_nationkey")
    a, b = F.concat(F.lit("A"), k.cast("string")), F.concat(F.lit("bb"), k.cast("string"))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    shapes = (
        F.concat(F.lit(" ["), q(a), F.lit(', {"Kode_Emiten": "", "code": '), q(b), F.lit('}, "x", 7.5, "too-long-code"]')),
        F.concat(F.lit('{"Results": [{"KodeEmiten": '), q(F.concat(a, F.lit("  "))), F.lit('}], "data": ['), q(b), F.lit("]}")),
        F.concat(F.lit('{"Data": {"items": ['), q(a), F.lit('], "results": [{"symbol": '), q(b), F.lit('}]}, "total": 2}')),
        F.concat(F.lit('{"replies": [{"Ticker": '), q(a), F.lit("}, "), q(b), F.lit(', null]}')),
        F.concat(F.lit("{"), q(a), F.lit(': {"name": "n"}, "zz": {"ticker": "keyed"}, "total": 3}')),
    )
    text = F.element_at(F.array(*shapes), (k % 5 + 1).cast("int"))
    return snapshots.reference_tickers(V.load(spark, d, "nation").select(k.alias("k"), text.alias("t")), "t", "k")


@query("""with s as (select user_id as k, event_id % 60 as t from events) select k, count(distinct t) as n, count(distinct t) >= 45 as trusted from s group by k""")
def trusted_lists(spark, d):
    rows = _events(spark, d).select(F.col("user_id").alias("k"), F.concat(F.lit("T"), (K() % 60).cast("string")).alias("ticker"))
    return snapshots.trusted_master(rows, "k", 45)


FILES = ("Laporan (1).pdf", "a/b\\c.xlsx", "tanpa akhiran", "  .hidden ", "aneh?*.PDF", "x.veryverylongsuffix", "")
URLS = ("https://h.id/f/a%20b+c.pdf?x=1", "https://h.id/", "https://h.id/x/y.docx", "h")
_SAFE = r"(case when regexp_replace(regexp_replace(translate(f, '/\', '__'), '[^A-Za-z0-9._() -]+', '_', 'g'), '^[ .]+|[ .]+$', '', 'g') = '' then 'attachment' else left(regexp_replace(regexp_replace(translate(f, '/\', '__'), '[^A-Za-z0-9._() -]+', '_', 'g'), '^[ .]+|[ .]+$', '', 'g'), 180) end)"


@query(rf"""with r as (select event_id, {_list(FILES)}[event_id % 7 + 1] as f, {_list(URLS)}[event_id // 7 % 4 + 1] as u, sha256(event_id::varchar) as h from events),
s as (select *, {_SAFE} as safe, lower(regexp_extract({_SAFE}, '[^./](\.[^./]+)$', 1)) as own, regexp_extract(u, 'h\.id[^?]*[^./](\.[^./?]+)(\?|$)', 1) as ends from r)
select event_id, safe, case when regexp_matches(lower(regexp_extract(f, '[^./](\.[^./]+)$', 1)), '^\.[a-z0-9]{{1,10}}$') then lower(regexp_extract(f, '[^./](\.[^./]+)$', 1)) else '.bin' end as safe_suffix,
  coalesce(nullif(trim(string_split(replace(coalesce(nullif(trim(f), ''), '{T.NAMELESS}'), '\', '/'), '/')[-1]), ''), '{T.NAMELESS}') as display,
  case event_id // 7 % 4 when 0 then 'a b+c.pdf' when 2 then 'y.docx' when 3 then 'h' else '{T.NAMELESS}' end as url_name, coalesce(nullif(left(trim(regexp_replace(lower(trim(f)), '[^a-z0-9]+', '-', 'g'), '-'), 40), ''), 'profile') as slug,
  'raw/T/' || 'a' || event_id || '/' || left(h, 12) || '_' || case when own = '' then safe || ends else safe end as path from s""")
def stored_names(spark, d):
    f, u = _dealt(FILES, K() % 7), _dealt(URLS, F.floor(K() / 7) % 4)
    h = F.sha2(K().cast("string").cast("binary"), 256)
    return _events(spark, d).select("event_id", T.safe_filename(f).alias("safe"), T.safe_suffix(f).alias("safe_suffix"), T.display_filename(f, NULL()).alias("display"), T.url_filename(u).alias("url_name"), T.slug(f).alias("slug"), snapshots.stored_path(F.lit("T"), F.concat(F.lit("a"), K().cast("string")), h, f, u).alias("path"))


@query("""select event_id, case when event_id % 6 = 1 or event_id % 6 = 3 then 'already-exists' else 'written' end as status, event_id % 6 = 3 as cache_hit from events""")
def staged_files(spark, d):
    wanted = _events(spark, d).select("event_id", F.concat(F.lit("https://h.id/"), K().cast("string")).alias("url"), F.lit("a.pdf").alias("filename"))
    path = snapshots.staged_path(F.col("url"), F.col("filename"))
    there = wanted.where("event_id % 6 in (1, 3)").select(path.alias("path"), F.when(K() % 6 == 3, 9).otherwise(0).alias("size"))
    return snapshots.written(snapshots.stage(wanted, there), there).select("event_id", "status", "cache_hit")


# Gates.

@query("""with m as (select distinct 'T' || c_custkey as t from customer where c_custkey % 3 <> 0), r as (select o_orderkey, case when o_orderkey % 10 = 0 then ' ' when o_orderkey % 10 = 1 then null else ' t' || o_custkey end as ticker from orders)
select o_orderkey, coalesce(trim(ticker), '') as ticker from r where coalesce(trim(ticker), '') = '' or upper(trim(ticker)) in (select t from m)""")
def allow_list(spark, d):
    k = F.col("o_orderkey")
    rows = V.load(spark, d, "orders").select("o_orderkey", F.when(k % 10 == 0, " ").when(k % 10 != 1, F.concat(F.lit(" t"), "o_custkey")).alias("ticker"))
    master = V.load(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.concat(F.lit("t"), "c_custkey", F.lit(" ")).alias("ticker"))
    return gates.listed(rows, "ticker", master).select("o_orderkey", F.trim(F.coalesce("ticker", F.lit(""))).alias("ticker"))


@query("""with r as (select 'T' || o_custkey as grp, case when o_orderkey % 9 = 0 then 'X' || (o_orderkey % 2) when o_orderkey % 9 = 1 then '' else 't' || o_custkey end as named from orders)
select grp, array_to_string(list_sort(list(distinct named)), ',') as "foreign" from r where named <> '' and upper(named) <> grp group by grp""")
def foreign_tickers(spark, d):
    k = F.col("o_orderkey")
    rows = V.load(spark, d, "orders").select(F.concat(F.lit("T"), "o_custkey").alias("grp"), F.when(k % 9 == 0, F.concat(F.lit("X"), (k % 2).cast("string"))).when(k % 9 == 1, "").otherwise(F.concat(F.lit("t"), "o_custkey")).alias("named"))
    return gates.foreign_tickers(rows, "grp", "named").select("grp", F.array_join("foreign", ",").alias("foreign"))


@query(f"""select event_id, case when event_id % 7 = 0 then '{gates.POLICY[0].replace("'", "''")}' when event_id % 5 = 0 then '{gates.POLICY[1].replace("'", "''")}' when event_id % 3 = 0 then '{gates.POLICY[2].replace("'", "''")}' when value < 0.5 then '{gates.POLICY[3]}' end as problem,
  event_type not in ('error', 'signup') and event_id % 4 <> 0 and event_id % 6 <> 0 as healthy from events""")
def policy_and_health(spark, d):
    problem = gates.policy_problem(F.when(K() % 7 == 0, "browser").otherwise(" HTTP "), K() % 5 == 0, K() % 3 == 0, F.col("value"))
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "BLOCKED").when(K() % 2 == 0, "COMPLETE")
    return _events(spark, d).select("event_id", problem.alias("problem"), gates.healthy(status, F.when(K() % 4 == 0, False).when(K() % 8 == 1, True), F.when(K() % 6 != 0, "c")).alias("healthy"))


@query("""with g as (select user_id, count(*) as n, user_id % 5 as kind from events group by user_id)
select user_id, case when kind = 0 then null when kind = 1 then 'schema' when kind = 2 then 'seenIds' when kind = 3 then 'id' end as problem from g""")
def checkpoint_checks(spark, d):
    u = F.col("user_id")
    ids = F.when(u % 5 == 2, F.transform(F.sequence(F.lit(1), F.lit(1001)), lambda x: x.cast("string"))).when(u % 5 == 3, F.array(F.lit("a"), F.lit(""))).when(u % 5 == 4, F.array(F.lit("a")))
    made = F.when(u % 5 == 1, "v0").when(u % 5 > 1, "v1")
    return _events(spark, d).select("user_id").distinct().select("user_id", gates.checkpoint_problem(made, ids, NULL(), "v1").alias("problem"))


#: Announcement summaries: whole ones, and others broken in one place each.
BREAKS = (
    ("", None), ('"title": "t"', '"title": " "'), ('"limitations": ["l"]', '"limitations": ["l", 5]'), ('"confidence": "high"', '"confidence": "sure"'), ('"category": null, ', ""), ('"url": "u"', '"url": "u", "z": 1'),
    ('"material_facts": ["f"]', '"material_facts": "f"'), ("{", "["),
)
WHOLE = '{"ticker": "T", "announcement_id": "1", "announced_at": "a", "title": "t", "executive_summary": "s", "category": null, "material_facts": ["f"], "financial_figures": [{"metric": "m", "value": "v", "period": null}], "corporate_actions": [], "expansion_projects": [], "management_or_control_changes": [], "capital_structure_events": [], "listing_or_regulatory_events": [], "analytical_scenarios": [{"classification": "explicit_fact", "topic": "x", "analysis": "y", "basis": [], "assumptions": [], "confidence": "high", "caveats": []}], "dates_and_deadlines": [], "risks_or_uncertainties": [], "possible_investor_relevance": [], "source_files": [{"filename": "f", "url": "u"}], "limitations": ["l"]}'
PROBLEMS = (None, "$.title: empty", "$.limitations[1]: type", "$.analytical_scenarios[0].confidence: enum", "$: missing category", "$.source_files[0]: unexpected z", "$.material_facts: type", "$: invalid")


@query(f"select event_id, {_list(PROBLEMS)}[event_id % 8 + 1] as problem, event_id % 8 = 0 as valid from events")
def summary_validity(spark, d):
    texts = [WHOLE if b is None else WHOLE.replace(a, b, 1) for a, b in BREAKS]
    rows = _events(spark, d).select("event_id", _dealt(texts, K() % 8).alias("t"))
    return rows.select("event_id", schema.problem(F.col("t"), schema.ANNOUNCEMENT).alias("problem"), schema.valid_announcement(F.col("t")).alias("valid"))


#: Values for a nested schema with least lengths, least values, lists and enumerations.
SHAPE = schema.record(n={"type": "integer", "minimum": 2}, k=schema.one_of("a", "b"), xs=schema.many(schema.record(t=schema.FULL)))
SHAPES = ('{"n": 2, "k": "a", "xs": [{"t": "x"}]}', '{"n": 1, "k": "a", "xs": []}', '{"n": true, "k": "a", "xs": []}', '{"n": 3, "k": "c", "xs": []}', '{"n": 3, "k": "b", "xs": [{"t": "x"}, {"t": "  "}]}', '{"n": 3, "k": "b"}', '{"n": 3, "k": "b", "xs": [], "y": 0}', "[1]", "nope", None)
SHAPE_PROBLEMS = (None, "$.n: minimum", "$.n: type", "$.k: enum", "$.xs[1].t: empty", "$: missing xs", "$: unexpected y", "$: type", "$: invalid", "$: invalid")


@query(f"select event_id, {_list(SHAPE_PROBLEMS)}[event_id % 10 + 1] as problem, case when event_id % 10 = 0 then 2 end::bigint as n from events")
def strict_json(spark, d):
    rows = _events(spark, d).select("event_id", _dealt(SHAPES, K() % 10).alias("t"))
    rows = rows.withColumn("problem", schema.problem(F.col("t"), SHAPE))
    return rows.select("event_id", "problem", F.when(F.col("problem").isNull(), F.from_json("t", "n bigint, k string, xs array<struct<t:string>>")["n"]).alias("n"))


@query("""select c_custkey, case when l.quality = 1 then 'P0' when l.toxic = 1 then 'P1' else 'P4' end as priority,
  case when c_custkey % 7 > 4 then 'priority out of range' when coalesce(l.quality = 1, false) and c_custkey % 7 <> 0 then 'open portfolio positions must be P0' when not coalesce(l.quality = 1, false) and coalesce(l.toxic = 1, false) and c_custkey % 7 <> 1 then 'watchlist-only positions must be P1' end as problem
  from customer left join labels l on c_custkey = doc_id""")
def owner_priority(spark, d):
    flags = V.load(spark, d, "labels").select(F.col("doc_id").alias("c_custkey"), (F.col("quality") == 1).alias("p"), (F.col("toxic") == 1).alias("w"))
    rows = V.load(spark, d, "customer").join(flags, "c_custkey", "left")
    given = F.col("c_custkey") % 7
    return rows.select("c_custkey", contracts.priority(F.col("p"), F.col("w")).alias("priority"), contracts.priority_problem(F.col("p"), F.col("w"), given).alias("problem"))


# The store's ledger.

@query("""with base as (select 'u' || doc_id as url, doc_id // 5 as announcement_id, doc_id % 2 = 0 as selected, 'old' as duplicate_of from documents), batch as (select 'u' || (doc_id * 2) as url, doc_id * 2 // 5 as announcement_id, doc_id % 3 = 0 as selected from documents)
select coalesce(b.url, a.url) as url, coalesce(b.announcement_id, a.announcement_id) as announcement_id, coalesce(b.selected, a.selected) as selected, case when b.url is null then a.duplicate_of end as duplicate_of,
  coalesce(max((a.url is not null and b.url is not null and a.selected <> b.selected)::int) over (partition by coalesce(b.announcement_id, a.announcement_id)), 0) = 1 as flipped from base a full join batch b using (url)""")
def attachment_upsert(spark, d):
    docs, k = V.load(spark, d, "documents"), F.col("doc_id")
    row = lambda n, keep: (F.concat(F.lit("u"), n.cast("string")).alias("url"), F.floor(n / 5).alias("announcement_id"), keep.alias("selected"))
    base = docs.select(*row(k, k % 2 == 0), F.lit("old").alias("duplicate_of"))
    # Each batch row comes twice, the last one holds.
    batch = docs.select(*row(k * 2, k % 3 == 0), F.lit(1).alias("_batch")).unionByName(docs.select(*row(k * 2, k % 3 != 0), F.lit(0).alias("_batch")))
    store = Store(spark, shared_folder(spark, "attachments"), ["url"], "url string, announcement_id bigint, selected boolean, duplicate_of string", 16)
    store.upsert(base)
    flips = ledger.write_attachments(store, batch)
    return store.read().join(flips.withColumn("flipped", F.lit(True)), "announcement_id", "left").select("url", "announcement_id", "selected", "duplicate_of", F.coalesce("flipped", F.lit(False)).alias("flipped"))


INVALID_SQL = """
ch as (select 'u' || l_orderkey || '-' || l_linenumber as url, l_orderkey as announcement_id, 'T' || o_custkey as ticker, o_orderdate as announced_at from lineitem join orders on o_orderkey = l_orderkey where l_orderkey % 40 = 0),
wn as (select 'T' || o_custkey as ticker, date_trunc('year', o_orderdate) as start_at, date_trunc('year', o_orderdate) + interval 1 year as end_at from orders group by all)"""


@query(f"""with {INVALID_SQL} select 'document' as kind, (select count(*) from lineitem) - (select count(*) from ch) as n union all select 'announcement', (select count(*) from orders where o_orderkey not in (select announcement_id from ch))
union all select 'window', (select count(*) from wn where not exists (select 1 from ch where ch.ticker = wn.ticker and ch.announced_at between wn.start_at and wn.end_at))""")
def invalidation(spark, d):
    orders, items = V.load(spark, d, "orders"), V.load(spark, d, "lineitem")
    url = F.concat(F.lit("u"), "l_orderkey", F.lit("-"), "l_linenumber").alias("url")
    ann = orders.select(F.col("o_orderkey").alias("announcement_id"), F.concat(F.lit("T"), "o_custkey").alias("ticker"), F.col("o_orderdate").alias("announced_at"))
    documents = items.select(url, F.col("l_orderkey").alias("announcement_id"))
    year = F.date_trunc("year", "announced_at").cast("timestamp_ntz")
    windows = ann.select("ticker", year.alias("start_at")).distinct().withColumn("end_at", F.expr("start_at + interval 1 year"))
    kept = ledger.invalidated(documents.join(ann, "announcement_id").where("announcement_id % 40 = 0"), documents, ann.select("announcement_id"), windows)
    out = None
    for kind, rows in zip(("document", "announcement", "window"), kept, strict=True):
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""with w as (select user_id as scope, max(ts) filter (where event_id % 2 = 0) as a, max(ts) filter (where event_id % 3 = 0) as b, max(ts) filter (where event_id % 5 = 0) as c from events group by user_id)
select scope, case when a is null then c when c is null then a else greatest(a, c) end as poll_end, b as last_seen from w where scope % 4 <> 1""")
def poll_watermarks(spark, d):
    ev = _events(spark, d)
    at = lambda n, name: F.max(F.when(K() % n == 0, F.col("ts"))).alias(name)
    held = ev.groupBy(F.col("user_id").alias("scope")).agg(at(2, "poll_end"), at(3, "last_seen"))
    # A later poll may report less than what is held; scopes given up are deleted.
    polls = ev.groupBy(F.col("user_id").alias("scope")).agg(at(5, "poll_end"), F.min(F.when(K() % 3 == 0, F.col("ts"))).alias("last_seen"))
    gone = held.where("scope % 4 = 1").select("scope")
    return ledger.delete_scope(ledger.advance(held, polls), gone, "scope")


@query("select event_id, event_id % 3 = 0 and event_id % 4 = 0 as served from events")
def stale_reads(spark, d):
    stored = _events(spark, d).select("event_id", F.when(K() % 3 == 0, "m").otherwise("old").alias("model"), F.when(K() % 4 == 0, "v").when(K() % 4 == 1, "w").alias("prompt_version"))
    kept, gone = ledger.current_versions(stored, "m", "v")
    return kept.select("event_id", F.lit(True).alias("served")).unionByName(gone.select("event_id", F.lit(False).alias("served")))


@query("select event_id, case when event_id % 6 <> 0 then 'i' || event_id end as internal_id, event_id % 6 = 0 as partial, event_id // 100 as batch from events")
def publish_responses(spark, d):
    from ..operators import export

    sent = export.batches(_events(spark, d).select("event_id", F.lit(0).alias("g"), F.floor(K() / 100).alias("hundred")), ["hundred"], ["event_id"], 100).withColumn("batch", F.col("hundred"))
    sent = sent.withColumn("external_id", F.concat(F.lit("x"), K().cast("string")))
    back = sent.where("event_id % 6 <> 0").select("external_id", F.concat(F.lit("i"), K().cast("string")).alias("internal_id"))
    return ledger.answered(sent, back.unionByName(back)).select("event_id", "internal_id", "partial", "batch")


@query("select o_orderkey, d.lang as state from orders left join documents d on d.doc_id = o_orderkey")
def attachment_states(spark, d):
    wanted = V.load(spark, d, "orders").select("o_orderkey", F.concat(F.lit("doc:"), "o_orderkey").alias("url"))
    stored = V.load(spark, d, "documents").select(F.concat(F.lit("doc:"), "doc_id").alias("url"), F.col("lang").alias("state"))
    return ledger.attachment_state(wanted, stored).select("o_orderkey", "state")


@query("""with s as (select o_orderstatus as run, o_orderkey, row_number() over (partition by o_orderstatus order by o_orderkey) as seq, count(*) over (partition by o_orderstatus) as n from orders)
select o_orderkey, seq::integer as seq from s where n <= 5000 or seq >= 5001 + ((n - 5001) // 1001) * 1001 - 3999""")
def event_ring(spark, d):
    from pyspark.sql.window import Window

    rows = V.load(spark, d, "orders").withColumn("seq", F.row_number().over(Window.partitionBy("o_orderstatus").orderBy("o_orderkey")))
    return ledger.ring(rows, "o_orderstatus", "seq").select("o_orderkey", "seq")


@query("""with l as (select user_id, event_id, row_number() over (partition by user_id order by event_id desc) as back from events) select user_id, event_id from l where back <= 20 and event_id % 9 <> 0""")
def event_tail(spark, d):
    line = F.when(K() % 9 == 0, F.concat(F.lit("{broken "), K().cast("string"))).otherwise(F.concat(F.lit('{"seq": '), K().cast("string"), F.lit("}")))
    rows = _events(spark, d).select("user_id", F.col("event_id").alias("number"), line.alias("line"))
    return ledger.tail_lines(rows, "user_id", "number", "line", 20, "seq bigint").select("user_id", F.col("event.seq").alias("event_id"))


@query("""select case when n_nationkey % 3 = 0 then 'r' || n_nationkey else n_name end as run_id, case when n_nationkey % 2 = 0 then 'completed' else 'unknown' end as status, case n_nationkey % 4 when 0 then 'reduce' when 1 then 'recover' else 'scrape' end as mode,
  case when n_nationkey % 5 = 0 then 'T' end as ticker, case when n_nationkey % 2 = 0 then n_nationkey else 0 end::bigint as last_seq, case n_nationkey % 3 when 0 then 4 when 1 then 2 else 0 end::bigint as company_summaries, case when n_nationkey % 2 = 0 then 'log,report' else '' end as artifacts from nation where n_nationkey % 11 <> 7""")
def run_archive(spark, d):
    k, q = F.col("n_nationkey"), lambda s: F.lit(s)
    part = lambda test, text: F.when(test, text)
    fields = F.concat_ws(
        ", ", part(k % 3 == 0, F.concat(q('"run_id": "r'), k.cast("string"), q('"'))), part(k % 2 == 0, F.concat(q('"status": "completed", "last_seq": '), k.cast("string"), q(', "artifact_paths": {"report": "b", "log": "a"}'))),
        F.concat(q('"request": {'), F.concat_ws(", ", part(k % 4 == 0, q('"mode": "reduce"')), part(k % 5 == 0, q('"ticker": "T"'))), q("}")),
        F.concat(q('"report": {"mode": "'), F.when(k % 4 == 1, "recover").otherwise(""), q('"'), F.when(k % 3 == 0, ', "company_summaries": 4').otherwise(', "company_summaries": 0'), q("}")), part(k % 3 == 1, q('"summaries": {"A": {}, "B": {}}')),
    )
    states = V.load(spark, d, "nation").select(F.col("n_name").alias("folder"), F.when(k % 11 == 7, "{bad").otherwise(F.concat(q("{"), fields, q("}"))).alias("state"))
    return ledger.run_library(states, "state").withColumn("artifacts", F.array_join("artifacts", ","))


WINDOWS_SQL = """
wn as (select 'T' || o_custkey as ticker, date_trunc('month', o_orderdate) as start_at, date_trunc('month', o_orderdate) + interval 1 month as end_at, max(o_orderdate) as updated_at, 'o' || max(o_orderkey) as overview from orders group by 1, 2, 3)"""


def _windows(spark, d):
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    rows = V.load(spark, d, "orders").groupBy(F.concat(F.lit("T"), "o_custkey").alias("ticker"), month.alias("start_at")).agg(F.max("o_orderdate").alias("updated_at"), F.concat(F.lit("o"), F.max("o_orderkey").cast("string")).alias("overview"))
    return rows.withColumn("end_at", F.expr("start_at + interval 1 month"))


@query(f"""with {WINDOWS_SQL}, g as (select start_at, end_at, count(*) as company_count, max(updated_at) as updated_at, md5(string_agg(ticker, ',' order by ticker)) as tickers from wn group by all order by max(updated_at) desc, start_at, end_at limit 30)
select g.*, (select count(*) from orders where o_orderdate between start_at and end_at) as announcement_count, (select count(*) from lineitem join orders on o_orderkey = l_orderkey where o_orderdate between start_at and end_at) as announcement_summary_count from g""")
def library_views(spark, d):
    ann = V.load(spark, d, "orders").select(F.col("o_orderkey").alias("announcement_id"), F.col("o_orderdate").alias("announced_at"))
    sums = V.load(spark, d, "lineitem").select(F.col("l_orderkey").alias("announcement_id"))
    out = ledger.library_windows(_windows(spark, d), ann, sums, 30)
    return out.withColumn("tickers", F.md5(F.array_join("tickers", ",").cast("binary")))


@query(f"""with {WINDOWS_SQL} select ticker, count(*) as window_count, max(updated_at) as latest_updated_at, arg_max(start_at, updated_at) as start_at, arg_max(end_at, updated_at) as end_at, arg_max(overview, updated_at) as overview from wn group by ticker order by ticker limit 200""")
def company_library(spark, d):
    return ledger.company_library(_windows(spark, d), 200)


@query("""with b as (select o_orderkey from orders where o_orderdate between timestamp '1995-01-01' and timestamp '1996-01-01'), f as (select l_orderkey, l_linenumber from lineitem where l_orderkey in (select o_orderkey from b))
select (select count(*) from b) as announcements, (select count(*) from f) as attachments, (select count(*) from f where l_linenumber % 2 = 0) as document_summaries, (select count(*) from b where o_orderkey % 3 = 0) as announcement_summaries, (select count(*) from customer where c_custkey % 2 = 0) as company_summaries, (select count(*) from events where event_id % 5 = 0) as audits""")
def window_funnel(spark, d):
    start, end = F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1996-01-01").cast("timestamp_ntz")
    ann = V.load(spark, d, "orders").select(F.col("o_orderkey").alias("announcement_id"), F.col("o_orderdate").alias("announced_at"))
    url = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("url")
    files = V.load(spark, d, "lineitem").select(url, F.col("l_orderkey").alias("announcement_id"), "l_linenumber")
    window = lambda rows, mine: rows.select(F.when(mine, start).otherwise(end).alias("start_at"), end.alias("end_at"))
    return ledger.window_funnel(ann, files.select("url", "announcement_id"), files.where("l_linenumber % 2 = 0").select("url"), ann.where("announcement_id % 3 = 0").select("announcement_id"), window(V.load(spark, d, "customer"), F.col("c_custkey") % 2 == 0), window(_events(spark, d), K() % 5 == 0), start, end)


REFINE_NAMES = ("LK ABCD 2027.pdf", "FinancialStatement-2027.xlsx", "Checklist.pdf", "instance.zip", "lain.pdf")


@query(f"""with f as (select doc_id, doc_id // 5 as a, {_list(REFINE_NAMES)}[doc_id % 5 + 1] as name, doc_id % 7 = 0 as has_file, doc_id % 3 <> 0 as has_text from documents where (doc_id // 5) % 3 <> 0),
s as (select *, doc_id % 5 < 2 as selected, case doc_id % 5 when 0 then 'financial_statement' when 1 then 'financial_statement' when 2 then 'administrative' when 3 then 'machine_package' else 'supporting' end as category from f)
select doc_id, selected, category, has_file as cached_file, has_text as cached_text, max((selected and not has_file and not has_text)::int) over (partition by a) = 0 as ready from s""")
def refinement_plan(spark, d):
    docs, k = V.load(spark, d, "documents"), F.col("doc_id")
    group = F.floor(k / 5)
    ann = docs.select(group.alias("announcement_id")).distinct().withColumn("title", F.when(F.col("announcement_id") % 3 == 0, "Keterbukaan").otherwise("Laporan_Keuangan 2027"))
    files = docs.select(group.alias("announcement_id"), k.alias("ordinal"), k.cast("string").alias("url"), _dealt(REFINE_NAMES, k % 5).alias("filename"), F.lit(True).alias("is_attachment"))
    cached = docs.select(k.cast("string").alias("url"), (k % 7 == 0).alias("has_file"), (k % 3 != 0).alias("has_text"))
    return ledger.refinement_plan(ann, files, cached).select(F.col("url").cast("bigint").alias("doc_id"), "selected", "category", "cached_file", "cached_text", "ready")


# Orders, prefixes, unions.

@query("""select doc_id, row_number() over (partition by source order by doc_id % 2, lang, doc_id)::integer as place, row_number() over (partition by source order by coalesce(case when doc_id % 9 <> 0 then left(text, 8) end, '') desc, doc_id)::integer as newest from documents""")
def attachment_places(spark, d):
    docs = V.load(spark, d, "documents").select("doc_id", "source", (F.col("doc_id") % 2 == 1).alias("is_attachment"), F.col("lang").alias("filename"), F.col("doc_id").alias("url"), F.when(F.col("doc_id") % 9 != 0, F.left("text", F.lit(8))).alias("stamp"))
    out = gates.newest_first(gates.attachment_order(docs, "source").withColumnRenamed("place", "own"), "source", "stamp", "doc_id")
    return out.select("doc_id", F.col("own").alias("place"), F.col("place").alias("newest"))


@query("""select event_id from (select event_id, user_id, row_number() over (partition by user_id order by event_id) as n from events) where n <= 12""")
def source_prefix(spark, d):
    return gates.prefix(_events(spark, d), "user_id", "event_id", 12).select("event_id")


@query("select user_id, n from (select user_id, count(*) as n from events group by user_id) order by n desc, user_id limit 1")
def limit_floor(spark, d):
    return gates.limited(_events(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), 0, F.col("n").desc(), F.col("user_id"))


@query("""with g as (select event_id % 700 as id, 0 as gap, event_id as ord from events where event_id % 3 = 0 union all select event_id % 700, 1, event_id from events where event_id % 4 = 0)
select id, arg_min(gap, (gap, ord)) as gap, min((gap, ord))[2]::bigint as ord from g group by id""")
def gap_union(spark, d):
    one = lambda n, gap: _events(spark, d).where(K() % n == 0).select((K() % 700).alias("id"), F.lit(gap).alias("gap"), F.col("event_id").alias("ord"))
    rows = one(3, 0).unionByName(one(4, 1)).withColumn("place", F.struct("gap", "ord"))
    return R.first_wins(rows, ["id"], "place").select("id", "gap", "ord")


# Loose values and dates.

NUMBERS = ("3.7", " 12 ", "abc", "", None, "-4", "1e3", "+9")


@query(f"select event_id, coalesce(case event_id % 8 when 0 then 3.7 when 1 then 12 when 5 then -4 when 6 then 1000 when 7 then 9 end, 0.5)::double as f, coalesce(case event_id % 8 when 1 then 12 when 5 then -4 when 7 then 9 end, -1)::bigint as i, case event_id % 3 when 0 then 'a' when 1 then 'b' else 'c' end as first from events")
def loose_values(spark, d):
    t = _dealt(NUMBERS, K() % 8)
    first = U.first_full(F.when(K() % 3 == 0, "a").otherwise(""), F.when(K() % 3 == 1, "b"), F.lit("c"))
    return _events(spark, d).select("event_id", U.safe_float(t, 0.5).alias("f"), U.safe_int(t, -1).alias("i"), first.alias("first"))


@query("select event_id, case when event_id % 2 = 0 then 'new' else 'old' end as a, 'kept' as b, case when event_id % 2 = 0 then 'added' end as c from events")
def map_override(spark, d):
    base = F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.lit("kept"))
    m = U.overridden(base, F.when(K() % 2 == 0, F.create_map(F.lit("a"), F.lit("new"), F.lit("c"), F.lit("added"))))
    return _events(spark, d).select("event_id", m["a"].alias("a"), m["b"].alias("b"), m["c"].alias("c"))


CLAIMS = ('" a claim "', '{"analysis": " why ", "metric": "m"}', '{"metric": "Laba", "value": "5", "period": null}', '{"value": "5", "period": "2027"}', '{"z": "é", "a": [1, 2]}', "7")
CLAIM_TEXTS = ("a claim", "why", "Laba — 5", "5 — 2027", '{"a": [1, 2], "z": "é"}', "7")


@query(f"select event_id, {_list(CLAIM_TEXTS)}[event_id % 6 + 1] as claim from events")
def claim_texts(spark, d):
    return _events(spark, d).select("event_id", U.claim_text(_dealt(CLAIMS, K() % 6)).alias("claim"))


@query("""select event_id, sha256('{"announcementId":"' || event_id || '","attachmentHashes":["a","b' || event_id || '"],"bridgeSchemaVersion":"s1","summary":{"a":"é","n":' || event_id || '},"taxonomyVersion":"t1"}') as digest from events""")
def analysis_hashes(spark, d):
    summary = U.canonical_json(F.concat(F.lit('{"n": '), K().cast("string"), F.lit(', "a": "é"}')))
    hashes = F.array(F.concat(F.lit("b"), K().cast("string")), F.lit(""), NULL(), F.lit("a"))
    return _events(spark, d).select("event_id", U.analysis_hash(K().cast("string"), summary, hashes, "s1", "t1").alias("digest"))


@query("""select event_id, greatest(0, epoch_us(timestamp '2024-01-15') - epoch_us(ts)) / 1e6 as age, epoch_us(timestamp '2024-01-15') - epoch_us(ts) <= 24 * 3600 * 1000000::bigint as young, strftime(ts, '%Y%m%d') as day, greatest(ts - interval 1 day, timestamp '2024-01-10') as gap_start from events""")
def ages_and_days(spark, d):
    now = F.lit("2024-01-15").cast("timestamp_ntz")
    return _events(spark, d).select("event_id", U.age_seconds(F.col("ts"), now).alias("age"), U.fresh(F.col("ts"), now, 24).alias("young"), U.compact_day(F.col("ts")).alias("day"), U.overlapped(F.col("ts"), F.lit("2024-01-10").cast("timestamp_ntz")).alias("gap_start"))


SIZES = (-5, 0, 1023, 1024, 1280, 1 << 20, 1_572_864, 5 << 30, 3 << 40, 5000 << 40)
SHOWN = ("0 B", "0 B", "1023 B", "1.0 KiB", "1.2 KiB", "1.0 MiB", "1.5 MiB", "5.0 GiB", "3.0 TiB", "5000.0 TiB")
TYPED = ("a.PDF", "b.xlsx", "c.unknown", "d", "e.zip")
_MIMES = ("application/pdf", X.MIME[".xlsx"], "application/octet-stream", "application/octet-stream", "application/zip")


@query(f"select event_id, {_list(SHOWN)}[event_id % 10 + 1] as size, case when event_id % 4 = 0 then 'text/x' else {_list(_MIMES)}[event_id % 5 + 1] end as mime from events")
def sizes_and_types(spark, d):
    n = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in SIZES]), (K() % 10 + 1).cast("int"))
    return _events(spark, d).select("event_id", T.byte_size(n).alias("size"), X.mime(_dealt(TYPED, K() % 5), F.when(K() % 4 == 0, " text/x ").when(K() % 4 == 1, "  ")).alias("mime"))


TEXTS = ("  abc ", "", None, "kode-lama", "\tX Y\n")


@query(f"""with r as (select event_id, {_list(TEXTS[:4])}[event_id % 5 + 1] as t, event_id % 5 = 4 as tabbed from events)
select event_id, case when tabbed then 'X Y' when coalesce(t, '') = '' then 'UNKNOWN' else upper(trim(t)) end as ticker, case when event_id % 5 = 3 then 'kod…' when tabbed then chr(9) || 'X ' || '…' when t is null then null when length(t) > 4 then left(t, 3) || '…' else t end as short, case when event_id % 5 = 0 then 'abc; x' when event_id % 5 = 3 then 'kode-lama; x' when tabbed then 'X Y; x' else 'x' end as joined,
  ['EXPLICIT_FACT', 'DERIVED_CALCULATION', 'ANALYST_HYPOTHESIS', 'ANALYST_HYPOTHESIS'][event_id % 4 + 1] as claim_type, case event_id % 4 when 0 then 'HIGH' when 1 then 'LOW' end as level from r""")
def text_helpers(spark, d):
    t = _dealt(TEXTS, K() % 5)
    kind = _dealt((" Explicit_Fact", "derived_calculation", "other", None), K() % 4)
    return _events(spark, d).select("event_id", T.ticker(t).alias("ticker"), T.truncate(t, 4).alias("short"), T.joined(T.strings(F.array(t, F.lit(" "), F.lit("x")))).alias("joined"), contracts.claim_type(kind).alias("claim_type"), contracts.level(_dealt(("high ", "LOW", "sure", None), K() % 4)).alias("level"))


DATES = ("2027-02-28", "2027-02-30", " 2027-01-05 ", "2027-1-5", None)


@query(f"""select event_id, case event_id % 5 when 0 then date '2027-02-28' when 2 then date '2027-01-05' end as iso, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as utc,
  case event_id % 4 when 0 then timestamp '2027-03-03 17:00:00' when 1 then timestamp '2027-03-04 01:02:03' when 2 then timestamp '2027-03-04 01:02:03' end as lower_bound, case event_id % 4 when 0 then timestamp '2027-03-04 16:59:59.999999' when 1 then timestamp '2027-03-04 01:02:03' when 2 then timestamp '2027-03-04 01:02:03' end as upper_bound from events""")
def date_parsing(spark, d):
    given = _dealt(("2027-03-04", "2027-03-04T08:02:03", "2027-03-04T01:02:03Z", "soon"), K() % 4)
    ntz = lambda c: c.cast("timestamp").cast("timestamp_ntz")
    return _events(spark, d).select("event_id", T.iso_date(_dealt(DATES, K() % 5)).alias("iso"), T.utc_iso(F.col("ts")).alias("utc"), ntz(timewin.boundary(given)).alias("lower_bound"), ntz(timewin.boundary(given, True)).alias("upper_bound"))


@query("""with r as (select event_id, ts, case event_id % 4 when 0 then null when 1 then ts - interval 40 hour when 2 then ts - interval 1 hour else ts + interval 3 minute end as ck from events)
select event_id, greatest(ts - interval 48 hour, least(ts - interval 30 hour, coalesce(ck - interval 24 hour, ts - interval 30 hour))) as daily, least(ts + interval 5 hour, timestamp '2024-01-15') as poll_end, case when ts + interval 5 hour > timestamp '2024-01-15' then greatest(ts, timestamp '2024-01-15') end as put_off from r""")
def daily_windows(spark, d):
    ts, snap = F.col("ts"), F.lit("2024-01-15").cast("timestamp_ntz")
    check = F.when(K() % 4 == 1, F.expr("ts - interval 40 hours")).when(K() % 4 == 2, F.expr("ts - interval 1 hour")).when(K() % 4 == 3, F.expr("ts + interval 3 minutes"))
    end, later = timewin.poll_split(ts, F.expr("ts + interval 5 hours"), snap)
    return _events(spark, d).select("event_id", timewin.daily_window(ts, check).alias("daily"), end.alias("poll_end"), later.alias("put_off"))


LINKS = ("https://www.idx.id/a.pdf", "/Portals/b c.pdf", "docs/c.pdf", "https://other.id/d.pdf", "http://idx.co.id/e.pdf", "https://IDX.co.id/f.pdf?x=1", " ", None)


@query("""select event_id, ['https://www.idx.id/a.pdf', 'https://www.idx.id/Portals/b c.pdf', 'https://www.idx.id/docs/c.pdf', null, null, 'https://www.idx.id/f.pdf?x=1', null, null][event_id % 8 + 1] as official, ['https://www.idx.id/a.pdf', null, null, 'https://other.id/d.pdf', 'http://idx.co.id/e.pdf', 'https://IDX.co.id/f.pdf?x=1', null, null][event_id % 8 + 1] as web from events""")
def official_urls(spark, d):
    u = _dealt(LINKS, K() % 8)
    # A blank in a path is not part of a valid URL for the JVM's parser; it is escaped and shown again.
    escaped = F.replace(u, F.lit("b c"), F.lit("b%20c"))
    official = F.replace(T.url_on_host("https://www.idx.id", escaped, snapshots.EXCHANGE_HOSTS, "www.idx.id"), F.lit("%20"), F.lit(" "))
    return _events(spark, d).select("event_id", official.alias("official"), T.http_url(u).alias("web"))


# Templates and plain text.

@query("select n_nationkey, 'Nation ' || n_name || ' in {region}: ' || n_regionkey || ' {other} {Z9}' as text, 'z' as unknown, 'none' as missing from nation")
def render_template(spark, d):
    values = F.create_map(F.lit("Name_1"), F.concat("n_name", F.lit(" in {region}")), F.lit("region"), F.col("n_regionkey").cast("string"), F.lit("none"), NULL(), F.lit("Z9"), F.lit("not allowed"))
    allowed = F.array(*map(F.lit, ("Name_1", "region", "none")))
    problems = X.placeholder_problems(F.lit("{region} {z} {Name_1} {z} {9x}"), allowed)
    text = X.render(F.lit("  Nation {Name_1}: {region}{none} {other} {Z9}\n"), values, allowed)
    return V.load(spark, d, "nation").select("n_nationkey", text.alias("text"), F.array_join(problems["unknown"], ",").alias("unknown"), F.array_join(problems["missing"], ",").alias("missing"))


@query(r"""select n_nationkey, 'HEAD ' || upper(n_name) || chr(10) || 'SUB X' || chr(10) || 'Third ' || n_name || chr(10) || '- item __b__ c' || chr(10) || 'quoted' || chr(10) || '# **kept** `as is`' || chr(10) || '#### four' || chr(10) as text from nation""")
def markdown_plain(spark, d):
    parts = ("# Head **", "**\n## sub `x`\n### Third ", "\n- item __b__ **c**\n> quoted\n```json\n# **kept** `as is`\n```\n#### four  \n\n")
    text = F.concat(F.lit(parts[0]), "n_name", F.lit(parts[1]), "n_name", F.lit(parts[2]))
    return V.load(spark, d, "nation").select("n_nationkey", X.plain_markdown(text).alias("text"))


@query("select event_id, round(least(60.0, case when event_id % 7 = 0 then value else 2.0 * power(2, greatest(event_id % 9 - 1, 0)) * (1 + (event_id % 5) / 10) end), 6)::double as seconds from events")
def retry_backoff(spark, d):
    asked = F.when(K() % 7 == 0, F.col("value"))
    return _events(spark, d).select("event_id", F.round(X.backoff(K() % 9, 2.0, 60.0, asked, (K() % 5) / 10), 6).alias("seconds"))


@query(f"""with {V.ANN} select announcement_id, case announcement_id % 4 when 0 then trim(title) when 1 then 'S' || announcement_id when 2 then kind else 'IDX disclosure ' || ticker end as title, ['title', 'subject', 'type', 'synthetic'][announcement_id % 4 + 1] as origin from ann where announcement_id % 4 <> 0 or trim(title) <> ''""")
def title_fallback(spark, d):
    k = F.col("announcement_id")
    title, origin = contracts.title_of(F.when(k % 4 == 0, F.col("title")).otherwise(" "), F.when(k % 4 == 1, F.concat(F.lit(" S"), k.cast("string"))), F.when(k % 4 <= 2, F.col("kind")), F.col("ticker"))
    rows = V.announcements(spark, d).where((k % 4 != 0) | (F.trim("title") != ""))
    return rows.select("announcement_id", title.alias("title"), origin.alias("origin"))


@query(f"""with {V.ANN}, p as (select *, {PLAIN_TITLE} as t from ann), c as (select *, {rules.first_match_sql('t', rules.TITLE_RULES, rules.FALLBACK)} as category, announcement_id % 5 = 0 as p, announcement_id % 3 = 0 as w from p),
m as (select *, case when category not in ({_SIG}) then 'ROUTINE' when p then 'HIGH' when w then 'MEDIUM' else 'ROUTINE' end as materiality, strftime(announced_at, '%Y-%m-%d') as day from c)
select announcement_id, materiality, category as tags, ticker || ' — ' || array_to_string(list_transform(string_split(lower(category), '_'), lambda x: upper(x[1]) || x[2:]), ' ') || '. Announced ' || day || '. Open the official document for details.' as summary,
  case when p then 'A stock you hold' when w then 'A stock on your watchlist' else 'A listed issuer' end || case when materiality <> 'ROUTINE' then ' published a disclosure classified as ' else ' published a disclosure of category ' end || category || '.' as why,
  ticker || ' published an announcement titled "' || title || '" on ' || day || '.' as fact, 14 as n_fields from m""")
def rules_payloads(spark, d):
    k = F.col("announcement_id")
    rows = V.announcements(spark, d).withColumn("category", rules.title_category(F.col("title"))).withColumns({"p": k % 5 == 0, "w": k % 3 == 0})
    rows = rows.withColumn("m", rules.owner_materiality(F.col("category"), F.col("p"), F.col("w")))
    c = F.col
    rows = rows.withColumn("a", contracts.rules_payload(c("ticker"), c("title"), c("announced_at"), c("category"), c("m"), c("p"), c("w")))
    return rows.select("announcement_id", c("a.materiality").alias("materiality"), F.array_join("a.tags", ",").alias("tags"), c("a.executiveSummary").alias("summary"), c("a.whyItMatters").alias("why"), c("a.materialFacts")[0]["text"].alias("fact"), F.size(F.json_object_keys(F.to_json("a", {"ignoreNullFields": "false"}))).alias("n_fields"))


# Recovery, resume, retries.

@query("select event_id, event_type = 'error' and event_id % 3 <> 0 as stale, event_id % 8 in (0, 1, 2) or event_id % 6 = 0 as retry from events")
def stale_and_retry(spark, d):
    from ..operators import recovery

    status = F.when(F.col("event_type") == "error", "RUNNING").otherwise("COMPLETE")
    now = F.col("ts") + F.when(K() % 3 == 0, F.expr("interval 85 minutes")).otherwise(F.expr("interval 86 minutes"))
    code = F.when(K() % 8 == 0, 429).when(K() % 8 == 1, 503).when(K() % 8 == 2, 408).when(K() % 8 == 3, 404)
    return _events(spark, d).select("event_id", recovery.stale(status, F.col("ts"), now).alias("stale"), recovery.retryable(code, F.when(K() % 6 == 0, "Connection reset by peer").otherwise("bad request")).alias("retry"))


@query("select event_id from events where not (event_id % 2 = 0 and event_id % 5 <> 0 and event_id % 7 <> 0)")
def pending_chunks(spark, d):
    row = lambda sha, model: (F.col("user_id").cast("string").alias("url"), F.col("event_id").alias("chunk_index"), F.lit(9).alias("chunk_count"), sha.alias("chunk_sha256"), model.alias("model"), F.lit("p").alias("prompt_version"))
    chunks = _events(spark, d).select("event_id", *row(F.lit("h"), F.lit("m")))
    # What is finished of them: some with other content, some by another model.
    finished = _events(spark, d).where(K() % 2 == 0).select(*row(F.when(K() % 5 == 0, "x").otherwise("h"), F.when(K() % 7 == 0, "n").otherwise("m")))
    return state.pending_chunks(chunks, finished).select("event_id")


@query("""with t as (select event_id, user_id, row_number() over (partition by event_type order by ts, event_id) as turn, event_type from events where event_type in ('click', 'view', 'purchase'))
select event_id, (case event_type when 'click' then (turn - 1) // 3 * 6 + (turn - 1) % 3 when 'view' then (turn - 1) // 2 * 6 + 3 + (turn - 1) % 2 else (turn - 1) * 6 + 5 end)::bigint as place from t""")
def weighted_stages(spark, d):
    rows = _events(spark, d).where("event_type in ('click', 'view', 'purchase')")
    return R.weighted_order(rows, "event_type", {"click": 3, "view": 2, "purchase": 1}, ["ts", "event_id"]).select("event_id", "place")


@query("""with l as (select user_id, event_id, round(value * 10) as v from events) select user_id, count(*) as n, round(sum(value), 4) as total, round(avg(value), 4) as average, max(value) as longest, arg_max(value, (ts, event_id)) as last from events group by user_id""")
def latency_statistics(spark, d):
    from ..operators import telemetry

    out = telemetry.latency(_events(spark, d), "user_id", ["ts", "event_id"], "value")
    return out.select("user_id", "n", F.round("total", 4).alias("total"), F.round("average", 4).alias("average"), "longest", "last")


@query("select n_regionkey, count(*) as n, string_agg(n_name, ',' order by n_nationkey) as names, bool_or(n_nationkey % 5 = 0) as usable from nation group by n_regionkey")
def usable_summaries(spark, d):
    rows = V.load(spark, d, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("names"), F.max(F.when(F.col("n_nationkey") % 5 == 0, " x").otherwise(" ")).alias("t"))
    return rows.select("n_regionkey", "n", F.array_join("names", ",").alias("names"), reduce.usable(F.col("t"), lists=(F.array().cast("array<string>"),)).alias("usable"))


@query("select event_id, case when event_id % 3 = 0 then 'x' || event_id end as a, 'y' as b from events")
def provenance_fields(spark, d):
    meta = F.create_map(F.lit("a"), F.when(K() % 3 == 0, F.concat(F.lit("x"), K().cast("string"))), F.lit("b"), F.lit("y"), F.lit("secret"), F.lit("z"))
    kept = contracts.provenance(meta, ("a", "b"), F.array(F.lit("H.id ")))["metadata"]
    return _events(spark, d).select("event_id", kept["a"].alias("a"), kept["b"].alias("b"))


@query("select event_id, case event_id % 3 when 0 then 'overview,timeline' when 1 then 'limitations' else 'material_changes,limitations' end as sections from events")
def section_lists(spark, d):
    from ..operators import audit

    asked = F.when(K() % 3 == 0, F.array(F.lit("timeline"), F.lit("overview"), F.lit("timeline"))).when(K() % 3 == 1, F.array(F.lit("limitations"))).otherwise(F.array(F.lit("limitations"), F.lit("material_changes")))
    return _events(spark, d).select("event_id", F.array_join(contracts.sections(asked, tuple(audit.SECTIONS)), ",").alias("sections"))


@query("select event_id, case when event_id % 4 = 0 then null else strptime('2027030410' || lpad((event_id % 60)::varchar, 2, '0') || '00', '%Y%m%d%H%M%S')::date end as day, event_id % 3 >= event_id % 2 as accepted from events")
def ids_and_probes(spark, d):
    own = F.when(K() % 4 == 0, "x").otherwise(F.concat(F.lit("2027030410"), F.lpad((K() % 60).cast("string"), 2, "0"), F.lit("00-A")))
    return _events(spark, d).select("event_id", collect.day_of_id(own).alias("day"), collect.accept_probe(F.lit(0), K() % 3, K() % 2, True).alias("accepted"))
