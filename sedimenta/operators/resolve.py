"""Evidence resolution and ranking: one winner per key, conflicts kept, group facts, timelines.

All operators take frames and plain column names, are lazy, and leave join and aggregation strategy to the planner. Where an operator
needs one row per key it uses ``min_by`` / ``max_by`` over a struct (map-side aggregation, no sort of a hot key); window functions
are used only where every row of the partition is wanted back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.sources.tables import checkpointed


def attach(df: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner", most: int = 500_000, salts: int = 16) -> DataFrame:
    """``df`` joined to a frame with unique ``keys``, safe for hot keys.

    A frame of up to ``most`` rows (counted) is sent to every task; a larger one is repeated ``salts`` times, so that a key holding a third of all rows is
    shared out. The rows of ``df`` are never multiplied.
    """
    if dim.limit(most + 1).count() <= most:
        return df.join(F.broadcast(dim), keys, how)
    spread = [c for c, t in df.dtypes if "map<" not in t]
    d = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return df.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).join(d, [*keys, "__salt"], how).drop("__salt")


def _ranged(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` in value ranges ``__p`` with the 1-based global rank ``out``: ranked inside each range, shifted by the sizes of the ranges before.

    Written once to the shared folder, for ranges must not move between their uses.
    """
    n = max(2, df.sparkSession.sparkContext.defaultParallelism)
    ranged = checkpointed(df.repartitionByRange(n, *order).withColumn("__p", F.spark_partition_id()))
    sizes = {r["__p"]: r["count"] for r in ranged.groupBy("__p").count().collect()}  # one row per range
    table, before = [], 0
    for p in sorted(sizes):
        table += [F.lit(p), F.lit(before)]
        before += sizes[p]
    offset = F.try_element_at(F.create_map(*table), F.col("__p")) if table else F.lit(0)
    return ranged.withColumn(out, (F.row_number().over(Window.partitionBy("__p").orderBy(*order)) + offset).cast("long"))


def rank_all(df: DataFrame, order: list[Column], out: str = "rank_all") -> DataFrame:
    """``df`` with its 1-based global rank, without a task that sees all rows; the order must be total for a stable result."""
    return _ranged(df, order, out).drop("__p")


def best_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by the ``order`` columns ascending (negate or rank for descending). Null order parts come first."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__b"))
    return best.select(*keys, *[F.col(f"__b.{c}").alias(c) for c in rest])


def conflicts(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Rows that lost and disagree with the winner of their key, with ``winner_value``."""
    win = best_row(df.select(*keys, value, *[o.alias(f"__o{i}") for i, o in enumerate(order)]), keys, [F.col(f"__o{i}") for i in range(len(order))])
    w = win.select(*keys, F.col(value).alias("winner_value"), F.lit(True).alias("__w"))
    return df.join(w, keys).drop("__w").where(~F.col(value).eqNullSafe(F.col("winner_value")))


def top_n(df: DataFrame, part: list[str], order: list[Column], n: int, rank: str = "rn") -> DataFrame:
    """The first ``n`` rows of each partition; the planner inserts a group limit before the exchange."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col(rank) <= n)


def share_within(df: DataFrame, part: list[str], value: str, out: str = "share") -> DataFrame:
    """``value`` over the sum of its partition, null where the sum is 0."""
    return df.withColumn(out, F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*part))))


def union_prefer(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union aligned by name; per key the frame named first wins (its smallest row if it has several)."""
    tagged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("__src", F.lit(i)) for i, f in enumerate(frames)])
    rest = [c for c in tagged.columns if c not in keys and c != "__src"]
    return best_row(tagged, keys, [F.col("__src"), *[F.col(c) for c in rest]]).drop("__src")


def union_found_by(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """One row per key over named slices, with the sorted ``;`` list of slices that hold it."""
    tagged = reduce(lambda a, b: a.unionByName(b), [f.select(key).withColumn("slice", F.lit(n)) for n, f in frames.items()])
    return tagged.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("slice")), ";").alias("found_by"))


def expand_group(statements: DataFrame, members: DataFrame, have: DataFrame, group: str, entity: str, field: str, order: list[Column]) -> DataFrame:
    """The best statement per (group, field) copied to every member of the group that has no value for the field."""
    best = best_row(statements, [group, field], order)
    fan = members.select(group, entity).distinct().join(best, group)
    return fan.join(have.select(entity, field).distinct(), [entity, field], "left_anti")


def group_stat(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Group statistics attached to every row, by an aggregate joined back (works for distinct counts too)."""
    return attach(df, df.groupBy(*keys).agg(*aggs), keys)


def degenerate(df: DataFrame, group: str, key: str, most: int = 200, big: int = 40, few: int = 5, rows: int = 50) -> DataFrame:
    """``df`` with ``is_degenerate``: key shared by more than ``most`` rows, by more than half of a group of over ``big``, one of at most
    ``few`` keys in a group of over ``rows``, or one character long."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(group, key).agg(F.count(F.lit(1)).alias("__n"))
    per_group = per_key.groupBy(group).agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__ids"))
    bad = (
        (F.col("__n") > most)
        | ((F.col("__rows") > big) & (F.col("__n") * 2 > F.col("__rows")))
        | ((F.col("__ids") <= few) & (F.col("__rows") > rows))
        | (F.length(F.col(key).cast("string")) <= 1)
    )
    flags = per_key.join(per_group, group).select(group, key, bad.alias("is_degenerate"))
    return attach(df, flags, [group, key], "left").withColumn("is_degenerate", F.coalesce("is_degenerate", F.lit(False)))


def timeline(df: DataFrame, subject: str, bases: list[str], least: int = 2) -> DataFrame:
    """Dense position of each row on its subject's time line.

    The basis is the first of ``bases`` filled in at least ``least`` and half of the subject's rows; a lone row is position 1; without a basis the
    position is null. ``basis`` names the column used.
    """
    w = Window.partitionBy(subject)
    n = F.count(F.lit(1)).over(w)
    basis = F.lit(None).cast("string")
    for b in reversed(bases):
        c = F.count(b).over(w)
        basis = F.when((c >= least) & (c * 2 >= n), F.lit(b)).otherwise(basis)
    out = df.withColumn("__n", n).withColumn("basis", F.when(F.col("__n") == 1, F.lit("single")).otherwise(basis))
    pos = F.when(F.col("__n") == 1, F.lit(1))
    for b in bases:
        r = F.dense_rank().over(Window.partitionBy(subject).orderBy(F.col(b).asc_nulls_last()))
        pos = pos.when((F.col("basis") == b) & F.col(b).isNotNull(), r)
    return out.withColumn("position", pos).drop("__n")


def stratified_head(df: DataFrame, strata: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each stratum: a deterministic stratified sample."""
    return top_n(df, strata, order, k, "__r").drop("__r")


def encode_topk(df: DataFrame, col: str, cap: int, other: str = "other") -> DataFrame:
    """``code``: the label of the ``cap`` most frequent values (ties by value), else ``other``; ``missing`` for null."""
    top = df.where(F.col(col).isNotNull()).groupBy(col).count().orderBy(F.desc("count"), col).limit(cap)
    codes = F.broadcast(top.select(F.col(col).alias("__v")))  # at most cap rows
    j = df.join(codes, F.col(col) == F.col("__v"), "left")
    return j.withColumn("code", F.when(F.col(col).isNull(), "missing").otherwise(F.coalesce("__v", F.lit(other)))).drop("__v")


def bh(df: DataFrame, p: str, key: str, groups: list[str] | None = None) -> DataFrame:
    """Benjamini-Hochberg ``q``: the reverse cumulative minimum of p * n / rank, ties ordered by ``key``; null p values are left out.

    With ``groups`` each group is one window. Without, values are ranked in ranges, and each range needs only the least value of the ranges behind it.
    """
    d = df.where(F.col(p).isNotNull())
    if groups:
        w = Window.partitionBy(*groups).orderBy(F.col(p).desc(), F.col(key).desc())
        up = Window.partitionBy(*groups).orderBy(p, key)
        r = d.withColumn("__r", F.row_number().over(up)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*groups)))
        raw = F.col(p) * F.col("__n") / F.col("__r")
        return r.withColumn("q", F.least(F.lit(1.0), F.min(raw).over(w.rowsBetween(Window.unboundedPreceding, 0)))).drop("__r", "__n")
    r = _ranged(d, [F.col(p).asc(), F.col(key).asc()], "__r")
    n = r.count()
    r = r.withColumn("__raw", F.col(p) * F.lit(n) / F.col("__r"))
    lows = {x["__p"]: x.m for x in r.groupBy("__p").agg(F.min("__raw").alias("m")).collect()}  # one row per range
    table, behind = [], float("inf")
    for x in sorted(lows, reverse=True):
        table += [F.lit(x), F.lit(behind)]
        behind = min(behind, lows[x])
    later = F.try_element_at(F.create_map(*table), F.col("__p")) if table else F.lit(1.0)
    w = Window.partitionBy("__p").orderBy(F.col(p).desc(), F.col(key).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return r.withColumn("q", F.least(F.lit(1.0), F.min("__raw").over(w), later)).drop("__r", "__raw", "__p")


def first_last(df: DataFrame, key: str, order: list[Column], value: str) -> DataFrame:
    """First and last value of each key by an order."""
    o = F.struct(*order)
    return df.groupBy(key).agg(F.min_by(value, o).alias("first_value"), F.max_by(value, o).alias("last_value"))


def follow_choice(choices: DataFrame, details: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """(keys, kept, detail): for each kept choice the first detail row of the same key that arrives after it; choices without one are left out.

    Both are laid end to end and read backwards once per key with a running minimum, so the work is linear in both.
    """
    c = choices.select(*keys, F.col(ordinal).alias("__o"), F.lit(0).alias("__side"))
    d = details.select(*keys, F.col(ordinal).alias("__o"), F.lit(1).alias("__side"))
    w = Window.partitionBy(*keys).orderBy(F.col("__o").desc(), "__side").rowsBetween(Window.unboundedPreceding, 0)
    x = c.unionByName(d).withColumn("detail", F.min(F.when(F.col("__side") == 1, F.col("__o"))).over(w))
    return x.where("__side = 0 and detail is not null").select(*keys, F.col("__o").alias("kept"), "detail").distinct()


def widen(df: DataFrame, key: list[str], field: str, fields: list[str], value: str) -> DataFrame:
    """Long to wide, one column per listed field; the frame must hold one row per (key, field). Listing the fields saves a pass over the data."""
    return df.groupBy(*key).pivot(field, fields).agg(F.min(value))


def merge_routes(df: DataFrame, keys: list[str], route: str, ranks: list[str], conf: str, value: str, tie: str) -> DataFrame:
    """Winner per key by (route rank, confidence descending, tie) with the number of routes and whether another route's best row disagrees."""
    rank = F.lit(len(ranks))
    for i, r in enumerate(ranks):
        rank = F.when(F.col(route) == r, i).otherwise(rank)
    order = [rank, -F.coalesce(F.col(conf), F.lit(-1.0)), F.col(tie)]
    per_route = best_row(df, [*keys, route], order)
    o = F.struct(*[x.alias(f"o{i}") for i, x in enumerate([rank, -F.coalesce(F.col(conf), F.lit(-1.0)), F.col(tie)])])
    g = per_route.groupBy(*keys).agg(
        F.min_by(F.struct(route, value, conf, tie), o).alias("w"), F.count(F.lit(1)).alias("routes"), F.collect_set(value).alias("vals")
    )  # at most one row per route in a group
    return g.select(
        *keys, F.col(f"w.{tie}").alias(tie), F.col(f"w.{route}").alias(route), F.col(f"w.{value}").alias(value), "routes", (F.size("vals") > 1).alias("disputed")
    )


def replicate_union(df: DataFrame, keys: list[str], conf: str, replicate: str) -> DataFrame:
    """Identical statements collapse: greatest confidence, the sorted set of replicates."""
    return df.groupBy(*keys).agg(F.max(conf).alias(conf), F.array_join(F.array_sort(F.collect_set(F.col(replicate).cast("string"))), ";").alias("replicates"))


def weighted_vote(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value with most rows per key (smallest on a tie), with its votes and share."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("votes"))
    g = n.groupBy(*keys).agg(F.min_by(F.struct(value, "votes"), F.struct((-F.col("votes")).alias("a"), F.col(value).alias("b"))).alias("w"), F.sum("votes").alias("all_votes"))
    return g.select(*keys, F.col(f"w.{value}").alias(value), F.col("w.votes").alias("votes"), (F.col("w.votes") / F.col("all_votes")).alias("share"))
