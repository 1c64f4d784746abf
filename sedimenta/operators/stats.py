"""Group-level statistics: effects within groups, rank tests, correlation, variance explained, trends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.resolve import attach, rank_all


def within_effect(df: DataFrame, group: str, arm: str, value: str, least: int = 20) -> DataFrame:
    """(groups, median_effect, agreement, pooled_effect): mean differences (true minus false arm) inside groups with ``least`` rows in both arms."""
    yes, no = F.when(F.col(arm), F.col(value)), F.when(~F.col(arm), F.col(value))
    g = df.groupBy(group).agg(F.avg(yes).alias("m1"), F.avg(no).alias("m0"), F.count(yes).alias("n1"), F.count(no).alias("n0"), F.sum(yes).alias("s1"), F.sum(no).alias("s0"))
    g = g.where((F.col("n1") >= least) & (F.col("n0") >= least)).withColumn("e", F.col("m1") - F.col("m0"))
    up = F.avg((F.col("e") > 0).cast("double"))
    return g.agg(
        F.count(F.lit(1)).alias("groups"), F.percentile("e", F.lit(0.5)).alias("median_effect"), F.greatest(up, 1 - up).alias("agreement"),
        (F.sum("s1") / F.sum("n1") - F.sum("s0") / F.sum("n0")).alias("pooled_effect"),
    )


def average_ranks(df: DataFrame, parts: list[str], value: str, out: str) -> DataFrame:
    """Average ranks within partitions. Values are counted first, so ties and repeated rows shrink before the window."""
    n = df.where(F.col(value).isNotNull()).groupBy(*parts, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*parts).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    r = n.withColumn(out, F.sum("__n").over(w) - (F.col("__n") - 1) / 2.0).drop("__n")
    return attach(df, r, [*parts, value])


def mann_whitney(df: DataFrame, parts: list[str], arm: str, value: str) -> DataFrame:
    """(parts, n1, n0, u, superiority, z): two-sided U statistic of the true arm, P(superiority), and tie-corrected normal score.

    Everything follows from counts per (value, arm): U sums, per value, the true rows times the false rows below plus half of those equal.
    """
    v = df.where(F.col(value).isNotNull() & F.col(arm).isNotNull()).groupBy(*parts, value).agg(F.count_if(F.col(arm)).alias("a"), F.count_if(~F.col(arm)).alias("b"))
    w = Window.partitionBy(*parts).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    v = v.withColumn("below", F.coalesce(F.sum("b").over(w), F.lit(0)))
    t = (F.col("a") + F.col("b")).cast("double")
    g = v.groupBy(*parts).agg(F.sum("a").alias("n1"), F.sum("b").alias("n0"), F.sum(F.col("a") * (F.col("below") + F.col("b") / 2.0)).alias("u"), F.sum(t * t * t - t).alias("ties"))
    n = F.col("n1") + F.col("n0")
    sd = F.sqrt(F.col("n1") * F.col("n0") / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    mid = F.col("n1") * F.col("n0") / 2.0
    return g.select(*parts, "n1", "n0", "u", F.try_divide("u", F.col("n1") * F.col("n0")).alias("superiority"), F.try_divide(F.col("u") - mid, sd).alias("z"))


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p value, by a rational approximation of the error function (error below 1.5e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + F.lit(0.3275911) * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def spearman(df: DataFrame, parts: list[str], x: str, y: str) -> DataFrame:
    """(parts, n, rho): correlation of average ranks."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*parts, x, y)
    r = average_ranks(average_ranks(d, parts, x, "rx"), parts, y, "ry")
    return r.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.corr("rx", "ry").alias("rho"))


def variance_explained(df: DataFrame, factor: str, vector: str, dims: int) -> DataFrame:
    """(n, ss_total, ss_within, r2) of vectors by a factor: sums of squares around centroids, no distance matrix.

    SS = sum |x|^2 - |sum x|^2 / n per group and in all; one partial aggregate per factor level, then a tiny one.
    """
    parts = [F.sum(F.get(vector, i).cast("double")).alias(f"s{i}") for i in range(dims)]
    sq = F.sum(F.aggregate(vector, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))).alias("q")
    g = df.groupBy(factor).agg(F.count(F.lit(1)).alias("n"), sq, *parts)
    norm = lambda cols: sum((c * c for c in cols), F.lit(0.0))
    within = F.sum(F.col("q") - norm([F.col(f"s{i}") for i in range(dims)]) / F.col("n"))
    total = F.sum("q") - norm([F.sum(f"s{i}") for i in range(dims)]) / F.sum("n")
    t = g.agg(F.sum("n").alias("n"), total.alias("ss_total"), within.alias("ss_within"))
    return t.withColumn("r2", 1 - F.try_divide("ss_within", "ss_total"))


def permuted(df: DataFrame, factor: str, row_id: str, seed: int) -> DataFrame:
    """``df`` with the values of ``factor`` dealt anew: the row at each place of one hash order takes the value at that place of another."""
    order = lambda salt: [F.xxhash64(F.lit(seed), F.lit(salt), row_id), F.col(row_id)]
    rows = rank_all(df.drop(factor), order(1), "__place")
    return rows.join(rank_all(df.select(row_id, factor), order(2), "__place").select("__place", factor), "__place").drop("__place")


def variance_baseline(df: DataFrame, factor: str, vector: str, dims: int, row_id: str, seeds: list[int]) -> DataFrame:
    """(n, ss_total, ss_within, r2, ``baseline``): the variance explained by a factor beside its mean under permuted factors, one per seed."""
    real, base = variance_explained(df, factor, vector, dims), None
    for seed in seeds:
        one = variance_explained(permuted(df.select(row_id, factor, vector), factor, row_id, seed), factor, vector, dims).select("r2")
        base = one if base is None else base.unionByName(one)
    return real.crossJoin(base.agg(F.avg("r2").alias("baseline")))  # one row each


def contrast_cards(df: DataFrame, group: str, cards: dict[str, Column], features: list[str], least: int = 20) -> DataFrame:
    """(card, feature, groups, median_effect, agreement, pooled_effect): ``within_effect`` for every card (a mask that is true, false or null) and feature in one pass.

    Rows are unpivoted to (card, feature) and reduced to one row per group by partial sums before the exchange; rows where the mask is null stay out of its card.
    """
    arms = F.explode(F.array(*[F.struct(F.lit(n).alias("card"), m.alias("arm")) for n, m in cards.items()])).alias("c")
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])).alias("f")
    x = df.select(group, *features, arms).select(group, "c.card", "c.arm", values).select(group, "card", "arm", "f.feature", "f.v").where("arm is not null and v is not null")
    yes, no = F.when(F.col("arm"), F.col("v")), F.when(~F.col("arm"), F.col("v"))
    g = x.groupBy("card", "feature", group).agg(F.sum(yes).alias("s1"), F.sum(no).alias("s0"), F.count(yes).alias("n1"), F.count(no).alias("n0"))
    g = g.where((F.col("n1") >= least) & (F.col("n0") >= least)).withColumn("e", F.col("s1") / F.col("n1") - F.col("s0") / F.col("n0"))
    up = F.avg((F.col("e") > 0).cast("double"))
    return g.groupBy("card", "feature").agg(
        F.count(F.lit(1)).alias("groups"), F.percentile("e", F.lit(0.5)).alias("median_effect"), F.greatest(up, 1 - up).alias("agreement"),
        (F.sum("s1") / F.sum("n1") - F.sum("s0") / F.sum("n0")).alias("pooled_effect"),
    )


def dominant_share(df: DataFrame, group: str, value: str, least: int = 20, share: float = 0.8) -> DataFrame:
    """Groups of ``least`` rows or more with one value on ``share`` of them."""
    n = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    g = n.groupBy(group).agg(F.sum("c").alias("n"), F.max_by(value, F.struct("c", value)).alias("top"), F.max("c").alias("c"))
    return g.where((F.col("n") >= least) & (F.col("c") >= share * F.col("n"))).select(group, F.col("top").alias(value), "n")


def trend(df: DataFrame, group: str, period: str, value: str, least: int = 3) -> DataFrame:
    """(group, periods, rho): rank correlation of period medians for groups with ``least`` periods."""
    m = df.groupBy(group, period).agg(F.percentile(value, F.lit(0.5)).alias("m"))
    return spearman(m, [group], period, "m").where(F.col("n") >= least).withColumnRenamed("n", "periods")


def trajectory(df: DataFrame, stage: str, group: str, value: str, threshold: float) -> DataFrame:
    """Per ordered stage: pooled mean, prevalence, and the median over group means."""
    g = df.groupBy(stage, group).agg(F.sum(value).alias("s"), F.count(value).alias("n"), F.count_if(F.col(value) > threshold).alias("p"))
    return g.groupBy(stage).agg((F.sum("s") / F.sum("n")).alias("pooled"), (F.sum("p") / F.sum("n")).alias("prevalence"), F.percentile(F.col("s") / F.col("n"), F.lit(0.5)).alias("median_of_means"))


def run_all(cards: dict[str, Callable[[], DataFrame]], folder: str, least: int = 1) -> DataFrame:
    """(card, status, rows, message): every card planned and run on its own, its rows written to ``folder``/card as Parquet.

    A card that fails, while planned or while it runs, is ``failed`` with its message; one of fewer than ``least`` rows is ``skipped``; neither stops the others.
    """
    spark, out = None, []
    for name, make in cards.items():
        try:
            df = make()
            spark = df.sparkSession
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            n = spark.read.schema(df.schema).parquet(f"{folder}/{name}").count()
            out.append((name, "done" if n >= least else "skipped", n, None))
        except Exception as e:  # noqa: BLE001  (the record of the failure is the result)
            out.append((name, "failed", None, str(e).split("\n")[0][:200]))
    from pyspark.sql import SparkSession

    return (spark or SparkSession.active()).createDataFrame(out, "card string, status string, rows long, message string")
