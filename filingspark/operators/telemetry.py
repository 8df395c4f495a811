"""Run telemetry: stage times, latency averages, adaptive limits and tuning advice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scans import Scan
from .tables import settled

#: Rows of a key that are summed up together first.
BLOCK = 1000


def stage_timing(events: DataFrame, stage: str, elapsed: str) -> DataFrame:
    """count, total, average and longest of each stage, to three decimals."""
    return events.groupBy(stage).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(elapsed), 3).alias("total"),
        F.round(F.avg(elapsed), 3).alias("average"),
        F.round(F.max(elapsed), 3).alias("longest"),
    )


def observed(df: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], measures: dict[str, Column], sink: Callable[[dict], None] | None = None) -> tuple[DataFrame, list[dict]]:
    """(rows, counts): the rows after all stages, in a table, and per stage its name, n and measures of what left it.

    Counts are taken as the one run passes by, without a second pass. Each also goes to the sink; one that fails
    breaks nothing. A stage after a limit or a shuffle that is read in part counts only what was read.
    """
    watches = []
    for name, stage in stages:
        watches.append((name, Observation(name)))
        df = stage(df).observe(watches[-1][1], F.count(F.lit(1)).alias("n"), *[c.alias(m) for m, c in measures.items()])
    rows = settled(df)
    counts = [{"stage": name, **watch.get} for name, watch in watches]
    for c in counts if sink else ():
        try:
            sink(c)
        except Exception:  # whoever listens must not stop the run
            continue
    return rows, counts


def slowest(timing: DataFrame, stage: str, n: int = 5) -> DataFrame:
    return timing.orderBy(F.col("total").desc(), stage).limit(n)


def ordered_fold(df: DataFrame, key: str, order: str, values: list[str], zero: Column, step, finish=None) -> DataFrame:
    """(key, state): a fold over each key's rows in order."""
    rows = F.array_sort(F.collect_list(F.struct(order, *values)))
    args = [F.col("_rows"), zero, step] + ([finish] if finish else [])
    return df.groupBy(key).agg(rows.alias("_rows")).select(key, F.aggregate(*args).alias("state"))


def ewma(df: DataFrame, key: str, order: list[str], value: str, new: float = 0.22) -> DataFrame:
    """(key, ewma): `new` of each value and the rest of the state; a state of 0 or less takes the value.

    Values below 0 count as 0, so the state is 0 up to the first value above 0, which it takes, and above 0 from
    there on. Each later value then adds its part, less by the same factor for each row after it: a sum, over blocks
    of rows first, which needs no fold over a key's rows. (A fold in floating point would fall to 0 after some 3,000 values of 0.)
    """
    low = F.greatest(F.lit(0.0), F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    scan = Scan(df.select(key, F.struct(*order).alias("_order"), low.alias("_v")), [key], ["_order"])
    rows = scan.running("_place", F.lit(1)).running("_above", (F.col("_v") > 0).cast("int")).done()
    part = F.when((F.col("_above") == 1) & (F.col("_v") > 0), F.col("_v")).otherwise(new * F.col("_v"))
    end = (F.floor((F.col("_place") - 1) / BLOCK) + 1) * BLOCK
    kept = lambda n: F.pow(F.lit(1 - new), n)
    blocks = rows.groupBy(key, end.alias("_end")).agg(F.sum(part * kept(end - F.col("_place"))).alias("_sum"), F.max("_place").alias("_last"))
    n = F.max("_last").over(Window.partitionBy(key))
    return blocks.withColumn("_n", n).groupBy(key).agg(F.sum(F.col("_sum") * kept(F.col("_n") - F.col("_end"))).alias("ewma"))


def latency(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, n, total, average, longest, last, ewma) of each key's latencies."""
    place = F.struct(*order)
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("average"), F.max(value).alias("longest"), F.max_by(value, place).alias("last"))
    return out.join(ewma(df, key, order, value), key)


def adaptive_limit(df: DataFrame, key: str, order: list[str], outcome: str, most: int = 4, step: int = 6) -> DataFrame:
    """(key, limit, throttles, ramps): a throttle halves the limit, a transient failure takes one, and
    step * limit successes in a row add one up to the most."""
    state = "struct<now:int,streak:int,throttles:int,ramps:int>"
    zero = F.struct(F.lit(most).alias("now"), F.lit(0).alias("streak"), F.lit(0).alias("throttles"), F.lit(0).alias("ramps")).cast(state)

    def move(acc: Column, x: Column) -> Column:
        made = lambda now, streak, throttles, ramps: F.struct(now.cast("int").alias("now"), streak.cast("int").alias("streak"), throttles.cast("int").alias("throttles"), ramps.cast("int").alias("ramps"))
        up = (acc["now"] < most) & (acc["streak"] + 1 >= step * acc["now"])
        good = F.when(up, made(acc["now"] + 1, F.lit(0), acc["throttles"], acc["ramps"] + 1)).otherwise(made(acc["now"], acc["streak"] + 1, acc["throttles"], acc["ramps"]))
        o = x[outcome]
        return (
            F.when(o == "success", good)
            .when(o == "throttle", made(F.greatest(F.lit(1), F.floor(acc["now"] / 2)), F.lit(0), acc["throttles"] + 1, acc["ramps"]))
            .when(o == "transient", made(F.greatest(F.lit(1), acc["now"] - 1), F.lit(0), acc["throttles"], acc["ramps"]))
            .otherwise(made(acc["now"], F.lit(0), acc["throttles"], acc["ramps"]))
        )

    out = ordered_fold(df.select(key, F.struct(*order).alias("_o"), outcome), key, "_o", [outcome], zero, move)
    return out.select(key, F.col("state.now").alias("limit"), F.col("state.throttles").alias("throttles"), F.col("state.ramps").alias("ramps"))


def advice(runs: DataFrame) -> DataFrame:
    """One row of advice for each run (run, done, elapsed, llm_max, llm_peak, workers, worker_peak, inflight_max,
    inflight_peak, provider_max, provider_limit, waited, answered, throttles): the first bottleneck that holds."""
    c = F.col
    ratio = lambda a, b: F.least(F.lit(1.0), a / F.greatest(F.lit(1), b))
    llm_max, workers = F.greatest(F.lit(1), c("llm_max")), F.greatest(F.lit(1), c("workers"))
    inflight = F.greatest(workers, c("inflight_max"))
    provider, limit = F.greatest(F.lit(1), c("provider_max")), F.greatest(F.lit(1), c("provider_limit"))
    llm_use, worker_use, backlog = ratio(c("llm_peak"), llm_max), ratio(c("worker_peak"), workers), ratio(c("inflight_peak"), inflight)
    wait = ratio(c("waited"), c("answered"))
    bottleneck = (
        F.when((c("throttles") > 0) | (limit < provider), "provider")
        .when((wait >= 0.25) & (llm_use >= 0.75), "provider")
        .when((backlog >= 0.85) & (worker_use >= 0.75), "extraction")
        .when((llm_use >= 0.95) & (wait < 0.10) & (llm_max < 8), "llm-capacity")
        .when((llm_use < 0.50) & (backlog < 0.50), "preparation-or-source")
        .otherwise("balanced")
    )
    pressed = (c("throttles") > 0) | (limit < provider)
    b = F.col("bottleneck")
    slots = F.when(pressed, F.greatest(F.lit(1), F.least(llm_max, limit))).when(b == "llm-capacity", llm_max + 1).otherwise(llm_max)
    more = F.when((b == "extraction") & (workers < 8), workers + 1).otherwise(workers)
    queue = F.when(b == "extraction", F.least(F.lit(32), F.greatest(inflight, F.col("extraction_workers") * 3))).otherwise(inflight)
    confidence = F.when(b.isin("provider", "extraction"), "high").when((b == "preparation-or-source") & (c("done") < 8), "low").otherwise("medium")
    out = runs.withColumn("bottleneck", bottleneck).withColumn("extraction_workers", more).withColumn("llm_slots", slots).withColumn("queue", queue)
    return out.select(
        "run",
        F.round(F.when(c("elapsed") > 0, c("done") / c("elapsed") * 60).otherwise(0.0), 3).alias("per_minute"),
        "bottleneck",
        confidence.alias("confidence"),
        F.round(llm_use, 3).alias("llm_ratio"),
        F.round(backlog, 3).alias("backlog_ratio"),
        F.round(wait, 3).alias("wait_ratio"),
        F.col("llm_slots").cast("int").alias("llm_slots"),
        F.col("extraction_workers").cast("int").alias("extraction_workers"),
        F.col("queue").cast("int").alias("queue"),
        ((F.col("llm_slots") != llm_max) | (F.col("extraction_workers") != workers) | (F.col("queue") != inflight)).alias("changed"),
    )
