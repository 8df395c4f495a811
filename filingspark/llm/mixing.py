"""Mixing sources to target weights over a tree of domains, languages and sources.

A budget of tokens goes down the tree by weight. A node never gets more than its leaves hold in
max_epochs; what it can't take goes to its siblings first, and only a parent whose children are all full
passes less, so that a shortage reaches the parent's siblings last. Each leaf then gives the first tokens
of its seeded epochs, cut exactly at its budget. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, own_columns

#: Slices of a leaf's epoch, by hash: budgets are cut inside one slice, so no task sorts a whole leaf.
SLICES = 4096
#: Levels of the tree, from the root down.
LEVELS = ("domain", "lang", "source")
BIG = "decimal(38,0)"


def token_count(text: Column) -> Column:
    """Words parted by ASCII white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds `given` to nodes (parent columns, name, weight, cap, budget), budget being the parent's.

    Children are taken by rising cap / weight. A child is full if its cap is at most its share of what the
    fuller ones left over; the others share the rest by weight, in whole tokens, and the tokens that
    rounding leaves go one each to the first of them by name. Weights are whole and not negative;
    children of weight 0 get nothing.
    """
    live = nodes.where("weight > 0 and cap > 0")
    # Exact order of cap / weight without division: equal ratios are full together, so ties don't matter.
    by_ratio = Window.partitionBy(*parent).orderBy((F.col("cap") / F.col("weight").cast("double")), F.col("cap"), F.col(name))
    past = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    zero = F.lit(0).cast(BIG)
    live = live.withColumn("caps", F.coalesce(F.sum("cap").over(past), zero).cast(BIG)).withColumn("weights", F.sum("weight").over(rest).cast(BIG))
    full = F.expr(f"cast(cap * weights as {BIG}) <= cast(greatest(cast(budget - caps as {BIG}), cast(0 as {BIG})) * weight as {BIG})")
    live = live.withColumn("full", full)
    group = Window.partitionBy(*parent)
    live = live.withColumn("used", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), zero).cast(BIG))
    live = live.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(group).cast(BIG))
    # Whole tokens of (budget - used) * weight / open.
    live = live.withColumn("part", F.expr(f"if(full, cap, cast((cast(budget - used as {BIG}) * weight) div open as {BIG}))").cast(BIG))
    left = F.col("budget") - F.sum("part").over(group)
    turn = F.row_number().over(Window.partitionBy(*parent).orderBy("full", name))
    live = live.withColumn("left", left.cast(BIG)).withColumn("turn", turn)
    given = F.expr(f"cast(part + if(not full and turn <= left, 1, 0) as {BIG})")
    return live.withColumn("given", given).drop("caps", "weights", "full", "used", "open", "part", "left", "turn")


def budgets(leaves: DataFrame, weights: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) of each leaf (domain, lang, source, tokens).

    weights: (domain, lang, source, weight), whole numbers; a row with null source weighs a language in a
    domain, one with null lang too a domain. Nodes without a row have weight 1.
    """
    def weighed(nodes: DataFrame, level: int) -> DataFrame:
        own = weights
        for deeper in LEVELS[level + 1 :]:
            own = own.where(F.col(deeper).isNull())
        own = own.where(F.col(LEVELS[level]).isNotNull()).select(*LEVELS[: level + 1], F.col("weight").cast(BIG).alias("w"))
        return nodes.join(own, list(LEVELS[: level + 1]), "left").withColumn("weight", F.coalesce("w", F.lit(1)).cast(BIG)).drop("w")

    leaves = leaves.withColumn("cap", (F.col("tokens").cast(BIG) * max_epochs).cast(BIG))
    budget = F.lit(total).cast(BIG)
    out = None
    for level in range(3):
        path = list(LEVELS[: level + 1])
        nodes = weighed(leaves.groupBy(*path).agg(F.sum("cap").cast(BIG).alias("cap")), level)
        if out is None:
            room = Window.partitionBy(F.lit(0))
            nodes = nodes.withColumn("budget", F.least(budget, F.sum("cap").over(room)).cast(BIG)).withColumn("root", F.lit(0))
            out = share_out(nodes, ["root"], LEVELS[0]).select(*path, F.col("given").alias("budget"))
        else:
            out = share_out(nodes.join(out, path[:-1]), path[:-1], path[-1]).select(*path, F.col("given").alias("budget"))
    return leaves.join(out, list(LEVELS)).select(*LEVELS, "tokens", F.col("budget").cast("bigint").alias("budget"))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """The place of a document in an epoch of its leaf: a digest of seed, epoch and id."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def mix(docs: DataFrame, weights: DataFrame, total: int | None = None, fraction: float | None = None, max_epochs: int = 4, seed: int = 17, slices: int = SLICES) -> DataFrame:
    """doc_id, domain, lang, source, epoch, n_tokens, taken: the tokens that each document gives in each epoch.

    docs: (doc_id, domain, lang, source, text). total: the budget in tokens, or fraction of all tokens
    there are. Epochs count from 1; epoch k of a leaf is its documents in the order of a seeded digest,
    and the last one ends with the prefix of a document that fills the budget. Null domains, languages and
    sources are the node ''. Texts without words give nothing. Repeated rows count each; ties of
    the digest (equal ids) go by token count. An empty table gives no rows; other columns aren't read.
    """
    level = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    slim = cut(own_columns(docs, doc_id=F.col("doc_id"), **{c: level(c) for c in LEVELS}, n_tokens=token_count(F.col("text"))).where("n_tokens > 0"), "tokens")
    leaves = cut(slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    if total is None:
        whole = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        total = int(whole * (1 if fraction is None else fraction))
    plan = cut(budgets(leaves, weights, total, max_epochs), "budgets").where("budget > 0")
    plan = plan.withColumn("rounds", F.expr("cast(budget div tokens as int)")).withColumn("rest", F.expr("budget % tokens"))
    # Leaves are as many as there are sources in languages and domains; their size is checked before a broadcast.
    rows = _by_leaf(slim, plan)
    full = rows.where("rounds > 0").select("doc_id", *LEVELS, F.explode(F.expr("sequence(1, rounds)")).alias("epoch"), "n_tokens", F.col("n_tokens").alias("taken"))
    part = rows.where("rest > 0").withColumn("epoch", F.col("rounds") + 1)
    part = part.withColumn("place", order_key(seed, F.col("epoch"), F.col("doc_id")))
    part = part.withColumn("slice", (F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") * slices / F.lit(1 << 32)).cast("int"))
    sums = part.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("in_slice"))
    before = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut(sums.withColumn("start", F.coalesce(F.sum("in_slice").over(before), F.lit(0)).cast("bigint")), "slices")
    starts = sums.withColumnRenamed("slice", "s").join(plan.select(*LEVELS, "rest"), list(LEVELS))
    edge = cut(starts.where("start < rest").groupBy(*LEVELS).agg(F.max_by("s", "start").alias("edge"), F.max("start").alias("start")), "edges")
    part = _by_leaf(part, edge).where("slice <= edge")
    inside = part.where("slice < edge").withColumn("taken", F.col("n_tokens"))
    run = Window.partitionBy(*LEVELS).orderBy("place", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    last = part.where("slice = edge").withColumn("taken", F.least(F.col("n_tokens"), F.col("rest") - F.col("start") - F.coalesce(F.sum("n_tokens").over(run), F.lit(0))).cast("bigint"))
    names = ["doc_id", *LEVELS, "epoch", "n_tokens", "taken"]
    return full.select(names).unionByName(inside.select(names)).unionByName(last.where("taken > 0").select(names))


def _by_leaf(rows: DataFrame, leaves: DataFrame, limit: int = 100_000, salts: int = 64) -> DataFrame:
    """Join by leaf: a broadcast while there are few leaves, otherwise by shuffle, with each leaf in `salts` copies that share its rows."""
    if leaves.count() <= limit:
        return rows.join(F.broadcast(leaves), list(LEVELS))
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in LEVELS]), F.lit(salts)).alias("salt")
    copies = leaves.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")).alias("salt"))
    return rows.select("*", salt).join(copies, [*LEVELS, "salt"]).drop("salt")
