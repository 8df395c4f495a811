"""Queries of collection, contract and rendering operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import render as X
from ..operators import collect, contracts, relational as R, rules
from ..sources import views as V
from .filing_queries import END, MERGED, PLAIN_TITLE, START, WINDOW_SQL, _SIG
from .registry import query

COLLECT = f"""
with {V.ANN}, r as (select *, announcement_id % 7 <> 0 as is_stock, announcement_id % 5 as n_selected, announcement_id % 19 = 0 as missing from ann),
o as (select *, case when not (announced_at {WINDOW_SQL}) then 'outside' when exists (select 1 from documents d where d.doc_id = announcement_id) then 'seen' when not is_stock then 'non_stock' when n_selected = 0 then 'no_attachment' when missing then 'attachment_missing' end as outcome from r),
p as (select *, row_number() over (partition by kind order by announced_at desc, announcement_id) as dn, count(*) over (partition by kind) as c from o where outcome is null),
q as (select *, case when dn <= 6 then dn when c - dn + 1 <= least(10, greatest(c - 6, 0)) then 6 + c - dn + 1 else dn + least(10, greatest(c - 6, 0)) end as place from p),
a as (select announcement_id, outcome, null::integer as place from o where outcome is not null union all select announcement_id, case when place <= 100 then 'accepted' else 'deferred' end, place::integer from q)"""


def _collected(spark, d):
    k = F.col("announcement_id")
    rows = V.announcements(spark, d).withColumns({"is_stock": k % 7 != 0, "n_selected": k % 5, "missing": k % 19 == 0})
    seen = V.load(spark, d, "documents").select(F.col("doc_id").alias("announcement_id"))
    return collect.collect_window(rows, seen, START, END, 100, "kind")


@query(COLLECT + " select announcement_id, outcome, coalesce(place, 0) as place from a")
def collect_window(spark, d):
    return _collected(spark, d).select("announcement_id", "outcome", F.coalesce("place", F.lit(0)).alias("place"))


@query(COLLECT + " select outcome, count(*) as n, least(count(*), 20) as n_shown, array_to_string(list_sort(list(announcement_id))[1:20], ',') as ids from a group by outcome")
def collect_diagnostics(spark, d):
    return collect.diagnostics(_collected(spark, d)).select("outcome", "n", F.col("n_shown").cast("bigint").alias("n_shown"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(f"""
with {MERGED}, {V.ANN}, p as (select *, announcement_id % 150 as scope, {PLAIN_TITLE} as t from ann where announced_at {WINDOW_SQL}),
c as (select *, {rules.first_match_sql('t', rules.TITLE_RULES, rules.FALLBACK)} as category from p where not exists (select 1 from merged m where m.scope = p.scope and p.announced_at between m.s and m.e))
select c.announcement_id, c.ticker, c.category, case when c.category not in ({_SIG}) then 'ROUTINE' when coalesce(l.quality, 0) = 1 then 'HIGH' when coalesce(l.toxic, 0) = 1 then 'MEDIUM' else 'ROUTINE' end as materiality from c left join labels l on c.announcement_id = l.doc_id""")
def uncovered_classified(spark, d):
    rows = V.announcements(spark, d).withColumn("scope", F.col("announcement_id") % 150)
    flags = V.load(spark, d, "labels").select(F.col("doc_id").alias("announcement_id"), (F.col("quality") == 1).alias("in_portfolio"), (F.col("toxic") == 1).alias("in_watchlist"))
    return collect.uncovered_classified(rows, V.coverage(spark, d), flags, START, END).select("announcement_id", "ticker", "category", "materiality")


@query("""
with r as (select p_partkey as k, p_name, p_brand, p_size, p_retailprice from part)
select k, 'name' as violation from r where not length(trim(p_name)) between 1 and 20 union all select k, 'size' from r where not p_size between 1 and 40 union all select k, 'brand' from r where not regexp_full_match(p_brand, 'Brand#[1-3][0-9]') union all select k, 'price' from r where not p_retailprice < 1500""")
def contract_violations(spark, d):
    rows = V.load(spark, d, "part").withColumnRenamed("p_partkey", "k")
    return contracts.violations(rows, "k", {"name": contracts.text_between(F.col("p_name"), 1, 20), "size": F.col("p_size").between(1, 40), "brand": F.col("p_brand").rlike("^Brand#[1-3][0-9]$"), "price": F.col("p_retailprice") < 1500})


@query("""
with o as (select o_custkey as grp, o_orderkey as ordinal, case when o_orderkey % 3 = 0 then '' else 'u' || o_orderkey end as url, 'N' || o_orderkey as name, case when o_orderkey % 2 = 0 then '' else o_orderstatus end as v from orders),
n as (select o_custkey as grp, o_orderkey as ordinal, case when o_orderkey % 5 = 0 then '' else 'u' || o_orderkey end as url, 'n' || o_orderkey as name, o_orderpriority as v from orders where o_orderkey % 4 <> 1)
select o.grp, o.ordinal, coalesce(nullif(o.url, ''), nullif(n.url, '')) as url, o.name, coalesce(nullif(o.v, ''), n.v) as v from o left join n on n.ordinal = o.ordinal""")
def attachment_merge(spark, d):
    k, o = F.col("o_orderkey"), V.load(spark, d, "orders")
    made = lambda rows, gap, prefix, v: rows.select(F.col("o_custkey").alias("grp"), k.alias("ordinal"), F.when(k % gap == 0, "").otherwise(F.concat(F.lit("u"), k)).alias("url"), F.concat(F.lit(prefix), k).alias("name"), v.alias("v"))
    old = made(o, 3, "N", F.when(k % 2 == 0, "").otherwise(F.col("o_orderstatus")))
    new = made(o.where(k % 4 != 1), 5, "n", F.col("o_orderpriority"))
    return contracts.keyed_merge(old, new, "grp").select("grp", "ordinal", "url", "name", "v")


@query("""select user_id, count(*) as n, count(*) filter (where event_type = 'click') as clicks, sum(case when event_id % 2 = 0 then 1 else 0 end)::bigint as created, bool_and(value >= 0) as complete, round(sum(value), 4) as reported from events group by user_id""")
def publish_counters(spark, d):
    return V.load(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.count_if(F.col("event_id") % 2 == 0).alias("created"), F.bool_and(F.col("value") >= 0).alias("complete"), F.round(F.sum("value"), 4).alias("reported"))


@query(f"with {V.ANN} select ticker, count(*) as n, string_agg(announcement_id, ',' order by announced_at, announcement_id) as ids from ann group by ticker")
def ordered_lists(spark, d):
    rows = V.announcements(spark, d).groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("announced_at", "announcement_id"))).alias("a"))
    return rows.select("ticker", F.size("a").cast("bigint").alias("n"), F.array_join(F.transform("a", lambda x: x["announcement_id"].cast("string")), ",").alias("ids"))


@query("select conv_id, max(turn) as last_turn, arg_max(role, turn) as last_role, arg_min(text, turn) as first_text from conversations group by conv_id")
def latest_status(spark, d):
    return V.load(spark, d, "conversations").groupBy("conv_id").agg(F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role"), F.min_by("text", "turn").alias("first_text"))


@query("select n_name as ticker from nation where n_regionkey in (select r_regionkey from region) except select n_name from nation where n_nationkey % 3 = 0")
def set_difference(spark, d):
    nation = V.load(spark, d, "nation")
    return nation.select(F.col("n_name").alias("ticker")).exceptAll(nation.where("n_nationkey % 3 = 0").select("n_name")).distinct()


@query("select doc_id, n_prior, n_all from (select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as n_prior, count(*) over (partition by source) as n_all from documents) t where n_prior < 10")
def first_rows_by_source(spark, d):
    docs = V.load(spark, d, "documents").select("doc_id", "source")
    turn = F.row_number().over(R.Window.partitionBy("source").orderBy("doc_id"))
    totals = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_all"))
    return docs.withColumn("t", turn).where("t <= 10").join(totals, "source").select("doc_id", (F.col("t") - 1).cast("bigint").alias("n_prior"), "n_all")
