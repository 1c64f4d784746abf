"""Aggregations: lists, top-k labels, modes, weighted and nested statistics, hierarchies, dissimilarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_distinct(c: Column, cap: int | None = None, sep: str = ";") -> Column:
    """Non-empty distinct values sorted, capped and joined; use it where a group has few distinct values."""
    a = F.array_sort(F.collect_set(F.when(c != "", c)))
    return F.array_join(F.slice(a, 1, cap) if cap else a, sep)


def join_first_seen(df: DataFrame, keys: list[str], value: str, ordinal: str, cap: int = 25, sep: str = " | ") -> DataFrame:
    """Distinct values in order of first arrival, at most ``cap``, joined. Values are reduced to one row each before they are gathered."""
    first = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.min(ordinal).alias("__o"))
    w = Window.partitionBy(*keys).orderBy("__o", value)
    kept = first.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= cap)
    return kept.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", value))), lambda x: x[value]), sep).alias("joined"))


def topk(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """(keys, value, n, rn): the ``k`` most frequent values per key, ties by value."""
    n = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc(value))
    return n.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def topk_json(df: DataFrame, keys: list[str], value: str, k: int, clip: int = 120) -> DataFrame:
    """The ``k`` most frequent values as a JSON object in order of rank, names clipped."""
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("rn", F.substring(value, 1, clip).alias("v"), "n"))),
        lambda x: F.concat(F.lit('"'), F.regexp_replace(x["v"], r'(["\\])', r"\\$1"), F.lit('":'), x["n"].cast("string")),
    )
    return topk(df, keys, value, k).groupBy(*keys).agg(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("counts"))


def topk_label(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """``value(count)`` of the ``k`` most frequent values, joined."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("rn", value, "n"))), lambda x: F.concat(x[value], F.lit("("), x["n"].cast("string"), F.lit(")")))
    return topk(df, keys, value, k).groupBy(*keys).agg(F.array_join(parts, "; ").alias("label"))


def mode_or(df: DataFrame, keys: list[str], value: str, default: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest on a tie, else ``default``."""
    n = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    order = F.when(F.col(value).isNotNull(), F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))
    return n.groupBy(*keys).agg(F.coalesce(F.min_by(value, order), F.lit(default)).alias("mode"))


def wmean(x: Column, w: Column) -> Column:
    """Weighted mean, the plain mean where the weights sum to 0."""
    return F.when(F.sum(w) > 0, F.sum(x * w) / F.sum(w)).otherwise(F.avg(x))


def shannon(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Entropy (natural logarithm) of the shares of positive values: ln S - sum(v ln v) / S, one partial aggregate."""
    v = F.when(F.col(value) > 0, F.col(value))
    return df.groupBy(*keys).agg((F.ln(F.sum(v)) - F.sum(v * F.ln(v)) / F.sum(v)).alias("entropy"))


def coverage(df: DataFrame, keys: list[str], fields: list[str], digits: int = 3) -> DataFrame:
    """Share of non-null values per field, all in one pass."""
    return df.groupBy(*keys).agg(*[F.round(F.avg(F.col(f).isNotNull().cast("double")), digits).alias(f) for f in fields])


def nested(df: DataFrame, inner: list[str], outer: list[str], value: str, least: int) -> DataFrame:
    """Mean per inner group of ``least`` rows or more, then the exact median over the inner groups of each outer group."""
    g = df.groupBy(*dict.fromkeys([*outer, *inner])).agg(F.avg(value).alias("m"), F.count(value).alias("n")).where(F.col("n") >= least)
    return g.groupBy(*outer).agg(F.percentile("m", F.lit(0.5)).alias("median_of_means"), F.count(F.lit(1)).alias("groups"))


def majority_mixed(df: DataFrame, keys: list[str], value: str, rest: float = 0.2) -> DataFrame:
    """The top class, or ``mixed`` where the others hold ``rest`` or more; ties by class."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    g = n.groupBy(*keys).agg(F.sum("n").alias("t"), F.min_by(F.struct(value, "n"), F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias("w"))
    return g.select(*keys, F.when((F.col("t") - F.col("w.n")) / F.col("t") >= rest, "mixed").otherwise(F.col(f"w.{value}")).alias("majority"))


def crosstab_share(df: DataFrame, a: str, b: str, top: int) -> DataFrame:
    """(a, b, n, share): counts over row totals, all but the ``top`` most frequent columns folded to ``other``."""
    keep = df.where(F.col(b).isNotNull()).groupBy(b).count().orderBy(F.desc("count"), b).limit(top).select(F.col(b).alias("__b"))
    j = df.where(F.col(a).isNotNull()).join(F.broadcast(keep), F.col(b) == F.col("__b"), "left")  # at most top rows
    n = j.groupBy(F.col(a), F.coalesce("__b", F.lit("other")).alias(b)).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(a)))


def bray_curtis(df: DataFrame, group: str, item: str, feature: str, value: str, most_items: int = 5_000) -> DataFrame:
    """(group, a, b, dissimilarity) for the items of each group that share a feature.

    Uses sum|x-y| = sum x + sum y - 2 sum min(x, y), so only shared features are joined; pairs sharing none have dissimilarity 1 and are not listed.
    The result is pairs by definition, so groups must be small: one of more than ``most_items`` items (counted) is an error, never cut.
    """
    v = df.groupBy(group, item, feature).agg(F.sum(value).alias("v"))
    t = v.groupBy(group, item).agg(F.sum("v").alias("t"))
    largest = t.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    if largest > most_items:
        raise ValueError(f"a group of {largest} items; pairs are made for at most {most_items}")
    a = v.select(group, feature, F.col(item).alias("a"), F.col("v").alias("va"))
    b = v.select(group, feature, F.col(item).alias("b"), F.col("v").alias("vb"))
    m = a.join(b, [group, feature]).where("a < b").groupBy(group, "a", "b").agg(F.sum(F.least("va", "vb")).alias("m"))
    ta = t.select(group, F.col(item).alias("a"), F.col("t").alias("ta"))
    tb = t.select(group, F.col(item).alias("b"), F.col("t").alias("tb"))
    return m.join(ta, [group, "a"]).join(tb, [group, "b"]).select(group, "a", "b", (F.lit(1.0) - 2 * F.col("m") / (F.col("ta") + F.col("tb"))).alias("dissimilarity"))


def content_hash(df: DataFrame) -> DataFrame:
    """(rows, h1, h2): a digest of the multiset of rows, independent of row order, in one partial aggregate."""
    cols = sorted(df.columns)
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in cols])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("h1"), F.sum(h.cast("decimal(38,0)")).alias("h2"))


def facet(df: DataFrame, col: str, sep: str | None, key: str, amount: str) -> DataFrame:
    """Distinct keys and summed amount per value of a (list) column."""
    v = F.explode(F.array_distinct(F.split(F.col(col), sep))) if sep else F.col(col)
    return df.withColumn("__v", v).where("__v <> ''").groupBy(F.col("__v").alias("facet_value")).agg(F.countDistinct(key).alias("keys"), F.sum(amount).alias("amount"))


def funnel(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Nested predicate counts: each step counts rows that pass it and all steps before, in one pass."""
    passed, cols = F.lit(True), []
    for name, p in steps:
        passed = passed & F.coalesce(p, F.lit(False))
        cols.append(F.count_if(passed).alias(name))
    return df.agg(*cols)


def rollup_ranks(df: DataFrame, keys: list[str], lineage: str, value: str, sep: str = "; ") -> DataFrame:
    """(keys, node, depth, total): values summed to every ancestor of a lineage. Leaves are summed before they are exploded."""
    leaf = df.groupBy(*keys, lineage).agg(F.sum(value).alias("__v"))
    parts = F.split(F.col(lineage), sep)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, 1, n), sep).alias("node"), n.alias("depth")))
    x = leaf.select(*keys, "__v", F.explode(prefixes).alias("p"))
    return x.groupBy(*keys, F.col("p.node").alias("node"), F.col("p.depth").alias("depth")).agg(F.sum("__v").alias("total"))


def normalise(profile: DataFrame, keys: list[str], depths: int, epsilon: float = 1e-9) -> DataFrame:
    """(keys, depth, node, share) of rolled-up totals: share of the root, with what a depth leaves over as ``unassigned``."""
    root = profile.where("depth = 1").groupBy(*keys).agg(F.sum("total").alias("__root"))
    rows = profile.select(*keys, "depth", "node", "total")
    per = profile.groupBy(*keys, "depth").agg(F.sum("total").alias("__s"))
    grid = root.withColumn("depth", F.explode(F.sequence(F.lit(1), F.lit(depths))))
    left = grid.join(per, [*keys, "depth"], "left").withColumn("total", F.greatest(F.col("__root") - F.coalesce("__s", F.lit(0.0)), F.lit(0.0)))
    rest = left.where(F.col("total") > epsilon * F.col("__root")).select(*keys, "depth", F.lit("unassigned").alias("node"), "total")
    return rows.unionByName(rest).join(root, keys).select(*keys, "depth", "node", F.try_divide("total", "__root").alias("share"))


def prevalence_cube(df: DataFrame, feature: str, dims: list[str], item: str, value: str, sizes: DataFrame, threshold: float = 0.0) -> DataFrame:
    """(feature, dim, group, present, mean_share): for the feature over all and per group of each dimension; absent items count as 0.

    ``sizes`` is (dim, group, n) with the number of items; means divide by it, not by the rows present.
    """
    v = df.groupBy(feature, item, *dims).agg(F.sum(value).alias("v"))
    one = F.array(
        F.struct(F.lit("all").alias("dim"), F.lit("all").alias("group")), *[F.struct(F.lit(x).alias("dim"), F.col(x).cast("string").alias("group")) for x in dims]
    )
    x = v.withColumn("g", F.explode(one)).groupBy(feature, F.col("g.dim").alias("dim"), F.col("g.group").alias("group"))
    g = x.agg(F.count_if(F.col("v") > threshold).alias("present"), F.sum("v").alias("s"))
    return g.join(sizes, ["dim", "group"]).select(feature, "dim", "group", "present", (F.col("s") / F.col("n")).alias("mean_share"))
