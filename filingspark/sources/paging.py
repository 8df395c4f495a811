"""Completeness of paged sources: pages to ranges, wide probes, and the cascade of days and tickers, over recorded pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Page size, and sizes of a wide probe.
PAGE, PROBE, PROBE_MOST = 50, 200, 1000


def range_pages(pages: DataFrame, key: list[str]) -> DataFrame:
    """The pages (key, page, offset, ids, reported, page_size) of each range that are read: up to the first that ends it, with `ends` and `whole`.

    A page ends a range if it is empty, shorter than the page size, or reaches the reported total, which is
    the page's own count if null or 0. An empty page proves the end only at the start or past that total.
    """
    n = F.size("ids")
    total = F.coalesce(F.nullif(F.col("reported"), F.lit(0)), n.cast("bigint"))
    rows = pages.withColumn("n", n).withColumn("total", total)
    done = (F.col("n") == 0) | (F.col("n") < F.col("page_size")) | (F.col("offset") + F.col("n") >= F.col("total"))
    whole = F.when(F.col("n") == 0, (F.col("offset") == 0) | (F.col("offset") >= F.col("total"))).otherwise(True)
    before = Window.partitionBy(*key).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ends", done).withColumn("whole", whole)
    return rows.withColumn("past", F.coalesce(F.max(F.col("ends").cast("int")).over(before), F.lit(0))).where("past = 0").drop("past")


def range_items(pages: DataFrame, key: list[str]) -> DataFrame:
    """(key, id, ordinal): the ids of each range that aren't empty, each at its first place."""
    rows = range_pages(pages, key).select(*key, "page", F.posexplode("ids").alias("pos", "id")).where("id <> ''")
    return rows.groupBy(*key, "id").agg(F.min(F.col("page") * 1_000_000 + F.col("pos")).alias("ordinal"))


def range_reports(pages: DataFrame, key: list[str]) -> DataFrame:
    """(key, complete, reported, collected, pages) of each range."""
    read = range_pages(pages, key)
    out = read.groupBy(*key).agg(F.max(F.col("ends") & F.col("whole")).alias("complete"), F.max_by("total", "page").alias("reported"), F.count(F.lit(1)).alias("pages"))
    found = range_items(pages, key).groupBy(*key).agg(F.count(F.lit(1)).alias("collected"))
    return out.join(found, key, "left").select(*key, "complete", "reported", F.coalesce("collected", F.lit(0)).alias("collected"), "pages")


def probe_size(reported: Column, page: int = PAGE, base: int = PROBE, most: int = PROBE_MOST) -> Column:
    """How large a first page is asked for when a range broke off; null if that is of no use."""
    if most <= page:
        return F.lit(None).cast("bigint")
    wanted = F.greatest(F.lit(base), F.coalesce(F.nullif(reported, F.lit(0)), F.lit(base)))
    return F.when(F.coalesce(reported, F.lit(0)) <= most, F.least(F.lit(most), wanted)).cast("bigint")


def cascade(reports: DataFrame, items: DataFrame, fan_out: bool = True) -> tuple[DataFrame, DataFrame]:
    """((window, id, level, day, ticker, stamp), (window, strategy, complete)): which ranges a window's rows come from.

    reports: (window, level, day, ticker, complete, reported, collected), level being range, probe, day,
    day-probe or ticker; items: (window, level, day, ticker, id, stamp). A probe counts only if it holds all
    that it reports. A window comes from its whole range; else from its probe; else each day from itself, its
    probe, or, with fan_out, its tickers, where a day is complete if all of them are. Of an id that several
    days or tickers give, the last one holds.
    """
    probe = F.col("level").isin("probe", "day-probe")
    good = F.col("complete") & (~probe | (F.col("collected") >= F.coalesce("reported", F.lit(0))))
    marked = reports.withColumn("good", good)
    has = lambda level: F.max(F.when(F.col("level") == level, F.col("good").cast("int")))
    windows = marked.groupBy("window").agg(has("range").alias("r"), has("probe").alias("p"))
    windows = windows.withColumn("from", F.when(F.col("r") == 1, "range").when(F.col("p") == 1, "probe").otherwise("days")).select("window", "from")
    days = marked.where(F.col("level").isin("day", "day-probe", "ticker")).groupBy("window", "day")
    tickers = F.min(F.when(F.col("level") == "ticker", F.col("good").cast("int")))
    days = days.agg(has("day").alias("d"), has("day-probe").alias("q"), tickers.alias("t"))
    source = F.when(F.col("d") == 1, "day").when(F.col("q") == 1, "day-probe").when(F.lit(fan_out) & F.col("t").isNotNull(), "ticker")
    days = days.select("window", "day", source.alias("source"), F.when(source == "ticker", F.col("t") == 1).otherwise(source.isNotNull()).alias("whole"))
    days = days.join(windows.where(F.col("from") == "days"), "window", "left_semi")
    state = windows.join(days.groupBy("window").agg(F.min(F.col("whole").cast("int")).alias("all")), "window", "left")
    complete = (F.col("from") != "days") | (F.coalesce("all", F.lit(1)) == 1)
    strategy = F.when(F.col("from") == "range", "pagination").when(F.col("from") == "probe", "wide-page-probe").when(complete, "date-shards").otherwise("date-shards-partial")
    state = state.select("window", strategy.alias("strategy"), complete.alias("complete"))
    at_once = items.join(windows, "window").where(F.col("level") == F.col("from")).drop("from")
    by_day = items.join(days.select("window", "day", "source"), ["window", "day"]).where(F.col("level") == F.col("source")).drop("source")
    rows = at_once.unionByName(by_day.select(at_once.columns))
    last = Window.partitionBy("window", "id").orderBy(F.col("day").desc_nulls_last(), F.col("ticker").desc_nulls_last())
    rows = rows.where("id <> ''").withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    return rows.select("window", "id", "level", "day", "ticker", "stamp"), state


def iterate(rows: DataFrame, *order: str):
    """A window's rows one by one, newest first, without all of them on the driver at once."""
    yield from rows.orderBy(*[F.col(c).desc() for c in order]).toLocalIterator()


def exact_lookup(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (external_id, ticker) with found, missing or several, by rows (id2, ticker, is_stock) of the day that the id begins with.

    An id without such a day is invalid.
    """
    from ..operators.collect import day_of_id

    stock = rows.where(F.coalesce("is_stock", F.lit(True))).select(F.col("id2").alias("external_id"), F.upper(F.trim("ticker")).alias("_t"), "day")
    found = stock.join(wanted.select("external_id", F.upper(F.trim("ticker")).alias("_t")).distinct(), ["external_id", "_t"], "left_semi").where(F.col("day") == day_of_id(F.col("external_id")))
    counts = found.groupBy("external_id", "_t").agg(F.count(F.lit(1)).alias("n"))
    out = wanted.withColumn("_t", F.upper(F.trim("ticker"))).join(counts, ["external_id", "_t"], "left")
    state = F.when(day_of_id(F.col("external_id")).isNull(), "invalid").when(F.coalesce("n", F.lit(0)) == 1, "found").when(F.col("n") > 1, "several").otherwise("missing")
    return out.select("external_id", "ticker", state.alias("state"))
