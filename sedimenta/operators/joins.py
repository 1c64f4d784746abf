"""Joins with semantics of their own: cascades, fuzzy identifiers, intervals, components, propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.resolve import attach, best_row
from sedimenta.sources.tables import checkpointed


def lookup(df: DataFrame, dim: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Left join to a dimension reduced to one row per key (smallest values), so the rows never multiply."""
    one = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*cols)).alias("__d"))
    return attach(df, one, [key], "left").select(*df.columns, *[F.col(f"__d.{c}").alias(c) for c in cols])


def snapshot_diff(prev: DataFrame, new: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """(key, change): added, removed or changed between two frames with unique keys, null-safe."""
    p = prev.select(*key, F.struct(*cols).alias("__p"), F.lit(1).alias("__in_p"))
    n = new.select(*key, F.struct(*cols).alias("__n"), F.lit(1).alias("__in_n"))
    j = p.join(n, key, "full_outer")
    kind = F.when(F.col("__in_p").isNull(), "added").when(F.col("__in_n").isNull(), "removed").when(~F.col("__p").eqNullSafe(F.col("__n")), "changed")
    return j.select(*key, kind.alias("change")).where("change is not null")


def missing_in(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of ``a`` with no row in ``b`` equal in all of ``cols``, null equal to null."""
    r = b.select(*[F.col(c).alias(f"__{c}") for c in cols]).distinct()
    cond = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols]
    return a.join(r, cond, "left_anti")


def carry_release(cur: DataFrame, prev: DataFrame, key: list[str], release: str) -> DataFrame:
    """Stamps carried from the previous snapshot; vanished rows appended as retired by ``release``; earlier retirements kept."""
    live = prev.where("release_retired is null")
    old = live.select(*key, F.col("release_added").alias("__a"))
    now = cur.join(old, key, "left").withColumn("release_added", F.coalesce("__a", F.lit(release))).withColumn("release_retired", F.lit(None).cast("string")).drop("__a")
    gone = live.join(cur.select(*key), key, "left_anti").withColumn("release_retired", F.lit(release))
    past = prev.where("release_retired is not null")
    return now.unionByName(gone.unionByName(past), allowMissingColumns=True)


def cascade(df: DataFrame, keys: list[str], dims: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """``resolved`` and ``resolved_by``: the first of several keys that its dimension (frame, key, value) knows.

    Each dimension is reduced to one row per key, so a key column with duplicates does not multiply rows.
    """
    out = df
    for i, (key, (dim, dkey, value)) in enumerate(zip(keys, dims)):
        one = dim.where(F.col(dkey).isNotNull()).groupBy(F.col(dkey).alias(f"__k{i}")).agg(F.min(value).alias(f"__v{i}"))
        out = out.join(one, F.col(key) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
    vals = [F.col(f"__v{i}") for i in range(len(keys))]
    by = F.lit(None).cast("string")
    for k, v in reversed(list(zip(keys, vals))):
        by = F.when(v.isNotNull(), F.lit(k)).otherwise(by)
    return out.withColumn("resolved", F.coalesce(*vals)).withColumn("resolved_by", by).drop(*[f"__v{i}" for i in range(len(keys))])


def id_forms(c: Column) -> list[tuple[str, Column]]:
    """Normal forms of an identifier from strict to loose."""
    low = F.lower(F.trim(c))
    bare = F.regexp_replace(low, "[^a-z0-9]", "")
    return [
        ("exact", F.trim(c)),
        ("casefold", low),
        ("alnum", bare),
        ("no_zeros", F.regexp_replace(bare, "(^|[a-z])0+([0-9])", "$1$2")),
        ("digits", F.regexp_replace(F.regexp_replace(low, "[^0-9]", ""), "^0+", "")),
    ]


def id_match(ids: DataFrame, targets: DataFrame, id_col: str, target_col: str) -> DataFrame:
    """(id, target, level): each foreign id matched through the strictest normal form that names exactly one target.

    Both sides are exploded into (level, form); forms that stand for several targets are dropped; one equi-join, one ``min_by``.
    """

    def forms(df: DataFrame, c: str, name: str) -> DataFrame:
        f = [F.struct(F.lit(i).alias("lv"), F.lit(n).alias("level"), x.alias("form")) for i, (n, x) in enumerate(id_forms(F.col(name)))]
        return df.select(F.col(c).alias(name)).distinct().select(name, F.explode(F.array(*f)).alias("x")).select(name, "x.*").where("form <> ''")

    t = forms(targets, target_col, "target").groupBy("lv", "form").agg(F.min("target").alias("target"), F.count_distinct("target").alias("n")).where("n = 1")
    i = forms(ids, id_col, "id")
    j = i.join(t, ["lv", "form"])
    return j.groupBy("id").agg(F.min_by(F.struct("target", "level"), "lv").alias("m")).select("id", "m.target", "m.level")


def joinability(df: DataFrame, columns: list[str], keys: DataFrame, key: str, least: int = 3, share: float = 0.5, top: int = 3) -> DataFrame:
    """(column, hits, n, share): which columns of a table match a key, among those unique and short enough, best first."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.trim(F.col(c).cast("string")).alias("v")) for c in columns])).alias("x")).select("x.*")
    v = long.where("v <> ''").groupBy("column", "v").agg(F.count(F.lit(1)).alias("c"))
    k = keys.select(F.trim(F.col(key).cast("string")).alias("v")).distinct().withColumn("hit", F.lit(1))
    g = v.join(k, "v", "left").groupBy("column").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("distinct_n"), F.sum(F.coalesce("hit", F.lit(0))).alias("hits"), F.avg((F.length("v") <= 40).cast("double")).alias("short")
    )
    ok = g.where((F.col("distinct_n") >= 0.5 * F.col("n")) & (F.col("short") >= 0.8) & (F.col("hits") >= F.greatest(F.lit(least), F.ceil(F.col("distinct_n") * share))))
    return ok.orderBy(F.desc("hits"), "column").limit(top).select("column", "hits", "n")


def interval_bins(x: Column, bins: list[tuple[str, float | None, float | None]]) -> Column:
    """The label of the closed interval that holds ``x``; null bounds are open. One expression, no join."""
    out = F.lit(None).cast("string")
    for label, lo, hi in reversed(bins):
        ok = x.isNotNull()
        ok = ok & (x >= lo) if lo is not None else ok
        ok = ok & (x <= hi) if hi is not None else ok
        out = F.when(ok, label).otherwise(out)
    return out


def expand_targets(statements: DataFrame, members: DataFrame, group: str, entity: str, label: str, name: str, keep: list[str], direct: float = 0.8, inferred: float = 0.6) -> DataFrame:
    """(group, entity, ``keep``, ``kind``, ``confidence``): group statements expanded to the members they target.

    ``kind`` of a statement is ``all``, ``label`` (its ``target`` equals the member's label without case and outer blanks) or ``regex`` (its ``target`` is found in the member's name).
    Confidence is capped at ``direct``, at ``inferred`` where a target was inferred. Two equi-joins, and for patterns a join on the group with the pattern as condition.
    """
    m = members.select(group, entity, F.lower(F.trim(label)).alias("__label"), F.col(name).alias("__name"))
    s = statements.select(group, "kind", "target", F.col("confidence").alias("__c"), *keep)
    every = s.where("kind = 'all'").join(m, group)
    by_label = s.where("kind = 'label'").withColumn("__label", F.lower(F.trim("target"))).join(m, [group, "__label"])
    p = s.where("kind = 'regex'").withColumnRenamed(group, "__g")
    by_name = m.join(p, (F.col(group) == F.col("__g")) & F.rlike(F.col("__name"), F.col("target"))).drop("__g")
    cap = lambda df, c: df.select(group, entity, *keep, "kind", F.least(F.coalesce("__c", F.lit(c)), F.lit(c)).alias("confidence"))
    return cap(every, direct).unionByName(cap(by_label, inferred)).unionByName(cap(by_name, inferred))


def nearest(points: DataFrame, places: DataFrame, key: str, reach_km: float) -> DataFrame:
    """(key, place, km): the nearest place within ``reach_km`` of each point, by haversine distance, anywhere on the globe.

    Places fall into bands of latitude as high as the reach and, within a band, into as many equal cells of longitude as keep a cell at least as wide as the
    reach on the band's (and its neighbours') shorter side; points look into the cells beside them in three bands, around the 180th meridian too.
    Near a pole a band has a single cell. Inputs have ``lat`` and ``lon``; places have ``place``. Ties go to the smaller name; points without a
    place in reach, and rows without coordinates, are left out.
    """
    height = reach_km / 111.0  # degrees of latitude; a degree is a little longer
    band = lambda lat: F.floor(lat / height)

    def cells(b: Column) -> Column:
        """Cells of a band: counted at its latitude farthest from the equator, one band beyond, so that all three bands of a search agree on the reach."""
        far = F.least(F.greatest(F.abs(b - 1), F.abs(b + 2)) * height, F.lit(90.0))
        return F.greatest(F.floor(F.lit(360.0) * F.cos(F.radians(far)) / height) - 1, F.lit(1)).cast("long")

    cell = lambda lon, n: F.pmod(F.floor((lon + 180.0) / (F.lit(360.0) / n)), n)
    p = points.where("lat is not null and lon is not null").withColumn("gy", F.explode(F.array(*[band(F.col("lat")) + i for i in (-1, 0, 1)])))
    n = cells(F.col("gy"))
    p = p.withColumn("gx", F.explode(F.array_distinct(F.array(*[F.pmod(cell(F.col("lon"), n) + i, n) for i in (-1, 0, 1)]))))
    q = places.where("lat is not null and lon is not null").select("place", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), band(F.col("lat")).alias("gy"))
    q = q.withColumn("gx", cell(F.col("lon2"), cells(F.col("gy"))))
    j = p.join(q, ["gx", "gy"]).withColumn("km", haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).where(F.col("km") <= reach_km)
    return j.groupBy(key).agg(F.min(F.struct("km", "place")).alias("m")).select(key, "m.place", "m.km")


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * 6371.0088) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): connected components, root = the smallest node. Large-star and small-star label rounds until nothing changes.

    Each round is a few group-bys; lineage is cut by a checkpoint in the shared folder. Rounds grow with the logarithm of the longest path.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    nodes = e.select(F.col("u").alias("node")).union(e.select(F.col("v").alias("node"))).distinct()
    e = checkpointed(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    digest = lambda x: x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = digest(e)
    while True:  # until a round changes nothing; every round before brings labels down
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = attach(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = attach(large, low, ["u"]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = checkpointed(small.where("u <> v").distinct())
        now = digest(e)
        if now == seen:
            break
        seen = now
    root = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))


def infer_unit(df: DataFrame, group: str, x: str, sibling: str, factors: dict[str, float], least: int = 5, share: float = 0.9) -> DataFrame:
    """(group, unit): the unit whose conversion of ``x`` agrees with a sibling column within 3 % on ``share`` of at least ``least`` rows."""
    r = F.col(x)
    cols = [F.avg(((r * f / F.col(sibling)).between(0.97, 1.03)).cast("double")).alias(u) for u, f in factors.items()]
    g = df.where((F.col(sibling) != 0) & r.isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), *cols).where(F.col("n") >= least)
    best = F.array_max(F.array(*[F.struct(F.col(u).alias("s"), F.lit(u).alias("u")) for u in factors]))
    return g.select(group, "n", best.alias("b")).where(F.col("b.s") >= share).select(group, F.col("b.u").alias("unit"), "n")


def consistent(groups: DataFrame, members: DataFrame, key: list[str], value: str, least: int = 5, rate: float = 0.2) -> DataFrame:
    """Group statements without those that ``least`` or more member values contradict at more than ``rate``."""
    m = members.select(*key, F.col(value).alias("__m")).where("__m is not null")
    j = groups.join(m, key)
    bad = j.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(value) != F.col("__m")).cast("double")).alias("r"))
    return groups.join(bad.where((F.col("n") >= least) & (F.col("r") > rate)).select(*key), key, "left_anti")


def score_against(det: DataFrame, gold: DataFrame, key: list[str], by: str, value: str) -> DataFrame:
    """(by, gold_n, covered, agreeing): determinations held against gold values."""
    d = det.select(*key, F.col(value).alias("__v"))
    j = gold.join(d, key, "left")
    g = j.groupBy(by).agg(F.count(F.lit(1)).alias("gold_n"), F.count("__v").alias("covered"), F.count_if(F.col(value) == F.col("__v")).alias("agreeing"))
    return g.withColumn("precision", F.try_divide("agreeing", "covered")).withColumn("recall", F.try_divide("agreeing", "gold_n"))


def gate(attempts: DataFrame, key: str) -> DataFrame:
    """The accepted attempt per key (rate of 0.5 with 3 hits, or 20 exact hits), best by rate, hits and name; with a status for the others."""
    ok = (F.col("rate") >= 0.5) & (F.col("hits") >= 3) | (F.col("level") == "exact") & (F.col("hits") >= 20)
    status = F.when(F.col("n") < 3, "too_few_rows").when(F.col("hits") == 0, "no_match").when(ok, "mapped").otherwise("below_gate")
    a = attempts.withColumn("status", status)
    return best_row(a, [key], [F.when(F.col("status") == "mapped", 0).otherwise(1), -F.col("rate"), -F.col("hits"), F.col("column")])


def asof(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, cols: list[str], parts: int = 0) -> DataFrame:
    """Each left row with the latest right row of the same key at or before it: one union, one exchange by key, one running ``last``.

    Linear in both inputs, unlike a range join. The key must spread the rows: one key is one task's sort.
    """
    l = left.select(*left.columns, F.col(left_time).alias("__t"), F.lit(1).alias("__side"))
    r = right.select(*[F.col(c) for c in by], F.col(right_time).alias("__t"), F.lit(0).alias("__side"), F.struct(*cols, F.col(right_time).alias("matched_time")).alias("__r"))
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    u = l.unionByName(r, allowMissingColumns=True).withColumn("__m", F.last("__r", ignorenulls=True).over(w)).where("__side = 1")
    return u.select(*left.columns, *[F.col(f"__m.{c}").alias(f"matched_{c}") for c in cols], F.col("__m.matched_time").alias("matched_time"))
