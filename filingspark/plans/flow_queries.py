"""Queries of live tails, reduction in levels, streamed digests and counts of stages over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reduce, telemetry
from ..operators.scans import numbered
from ..sources import views as V
from ..streaming import tail
from ..streaming.state import shared_folder
from .registry import query


@query("""with s as (select o_orderstatus as run, o_orderkey, row_number() over (partition by o_orderstatus order by o_orderkey) as seq, count(*) over (partition by o_orderstatus) as n from orders),
held as (select * from s where n <= 5000 or seq >= 5001 + ((n - 5001) // 1001) * 1001 - 3999),
late as (select distinct run, n, client, case when client = 'all' then 0 else n - 100 end as after from s, (values ('all'), ('some')) as c(client))
select l.run, client, h.seq as id, 'update' as event, h.o_orderkey::varchar as data from late l join held h on h.run = l.run and h.seq > l.after
union all select run, client, n, 'done', 'completed' from late where run = 'F'""")
def live_tail(spark, d):
    """Orders of a status are a run's events, given as a stream; then two clients come, and one run has ended."""
    folder, source = shared_folder(spark, "tail"), shared_folder(spark, "happenings")
    null = lambda t: F.lit(None).cast(t)
    orders = V.load(spark, d, "orders").select("o_orderstatus", "o_orderkey")
    placed = numbered(orders, ["o_orderstatus"], ["o_orderkey"], "seq")
    events = placed.select(F.col("o_orderstatus").alias("run"), F.lit("event").alias("kind"), F.col("seq").cast("bigint").alias("seq"), F.col("o_orderkey").cast("string").alias("data"), null("string").alias("client"), null("bigint").alias("cursor"), F.timestamp_seconds(F.lit(1_000_000_000)).alias("at"))
    runs = placed.groupBy(F.col("o_orderstatus").alias("run")).agg(F.count(F.lit(1)).alias("n")).withColumn("at", F.timestamp_seconds(F.lit(1_000_000_001)))
    clients = runs.select("run", "at", F.inline(F.array(F.struct(F.lit("all").alias("client"), null("bigint").alias("cursor")), F.struct(F.lit("some").alias("client"), (F.col("n") - 100).alias("cursor")))))
    late = clients.select("run", F.lit("subscribe").alias("kind"), null("bigint").alias("seq"), null("string").alias("data"), "client", "cursor", "at")
    ended = runs.where("run = 'F'").select("run", F.lit("status").alias("kind"), null("bigint").alias("seq"), F.lit("completed").alias("data"), null("string").alias("client"), null("bigint").alias("cursor"), "at")
    for rows in (events, late.unionByName(ended)):
        rows.write.option("maxRecordsPerFile", 1_000_000).mode("append").parquet(source)
        stream = spark.readStream.schema(tail.HAPPENINGS).option("maxFilesPerTrigger", 64).parquet(source)
        frames = tail.drain(tail.follow(stream, late="1 day"), folder)
    return frames


def _ends(texts: list[str]) -> str:
    return f"{texts[0].split()[0]} {texts[-1].split()[-1]}"


@query("""with e as (select event_type, event_id from events union all select 'one ' || event_id, event_id from events where event_id % 97 = 0)
select event_type, count(*)::integer as n, min(event_id) || ' ' || max(event_id) as summary, case when min(event_id) = max(event_id) then 'single' end as problem from e group by event_type""")
def reduce_in_levels(spark, d):
    """Events of a type are reduced fifty at a time, level by level."""
    events = V.load(spark, d, "events").select("event_type", "event_id")
    rows = events.unionByName(events.where("event_id % 97 = 0").withColumn("event_type", F.concat(F.lit("one "), F.col("event_id").cast("string"))))
    check = lambda s: "single" if len(set(s.split())) == 1 else None
    return reduce.reduce_groups(rows.withColumn("t", F.col("event_id").cast("string")), "event_type", "event_id", "t", _ends, 50, check)


@query("""select event_type, sha256('[' || string_agg('{"event_id":' || event_id || ',"user_id":' || coalesce(user_id::varchar, 'null') || '}', ',' order by event_id) || ']') as fingerprint from events group by event_type""")
def streamed_fingerprint(spark, d):
    return reduce.fingerprint(V.load(spark, d, "events"), ["event_type"], ["event_id"], ["user_id", "event_id"])


@query(f"""with {V.AUDIT}, a as (select * from audit where scope % 2 = 0), b as (select * from a where elapsed >= 20)
select 'read' as stage, count(*) as n, max(audit_id) as last from audit union all select 'own', count(*), max(audit_id) from a union all select 'slow', count(*), max(audit_id) from b""")
def observed_stages(spark, d):
    """What leaves each stage, counted in the run that makes the last one's rows."""
    stages = [("read", lambda x: x), ("own", lambda x: x.where("scope % 2 = 0")), ("slow", lambda x: x.where("elapsed >= 20"))]
    _, counts = telemetry.observed(V.audits(spark, d), stages, {"last": F.max("audit_id")})
    return spark.createDataFrame([(c["stage"], c["n"], c["last"]) for c in counts], "stage string, n bigint, last bigint")
