"""Release versioning: stamps, seeding, retirement, timelines, findings, corrections, overrides, appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.aggregate import content_hash


def stamp(df: DataFrame, release: str, package: str) -> DataFrame:
    """Release columns at the end; the data columns stay as they are."""
    return df.withColumns({"release_added": F.lit(release), "release_retired": F.lit(None).cast("string"), "package_added": F.lit(package)})


def release_positions(releases: DataFrame) -> DataFrame:
    """(t, k): lower-case release id and its place by date, not by text."""
    a = releases.agg(F.array_sort(F.collect_list(F.struct("release_date", "release_id"))).alias("a"))  # a list of publications
    return a.select(F.posexplode("a").alias("i", "s")).select(F.lower("s.release_id").alias("t"), (F.col("i") + 1).alias("k"))


def seed_incremental(cur: DataFrame, prior: DataFrame, prev: DataFrame, key: list[str], diff: list[str], release: str) -> DataFrame:
    """``cur`` with ``release_added``: carried where the row is unchanged in the diff columns, ``release`` where new or changed."""
    p = prev.select(*key, F.struct(*diff).alias("__p")).join(prior.select(*key, F.col("release_added").alias("__r")), key, "left")
    j = cur.join(p, key, "left")
    same = F.col("__p").eqNullSafe(F.struct(*diff)) & F.col("__p").isNotNull()
    return j.withColumn("release_added", F.when(same, F.coalesce("__r", F.lit(release))).otherwise(F.lit(release))).drop("__p", "__r")


def retire(prev: DataFrame, cur: DataFrame, key: list[str], diff: list[str], release: str) -> DataFrame:
    """Previous rows that are gone or changed, with ``release_retired`` and ``retired_reason``."""
    c = cur.select(*key, F.struct(*diff).alias("__c"))
    j = prev.join(c, key, "left")
    reason = F.when(F.col("__c").isNull(), "gone").when(~F.col("__c").eqNullSafe(F.struct(*diff)), "changed")
    return j.withColumn("retired_reason", reason).where("retired_reason is not null").withColumn("release_retired", F.lit(release)).drop("__c")


def diff_report(prev: DataFrame, cur: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """(metric, v): added, removed, changed and unchanged rows."""
    p, c = prev.select(*key, F.struct(*cols).alias("__p")), cur.select(*key, F.struct(*cols).alias("__c"))
    j = p.join(c, key, "full_outer")
    kind = F.when(F.col("__p").isNull(), "added").when(F.col("__c").isNull(), "removed").when(F.col("__p").eqNullSafe(F.col("__c")), "unchanged").otherwise("changed")
    counts = j.groupBy(kind.alias("metric")).agg(F.count(F.lit(1)).alias("v"))
    names = prev.sparkSession.createDataFrame([(x,) for x in ("added", "removed", "changed", "unchanged")], "metric string")
    return names.join(counts, "metric", "left").withColumn("v", F.coalesce("v", F.lit(0)))


def value_timeline(df: DataFrame, keys: list[str], retired: str, rank: str, tie: str) -> DataFrame:
    """Place of each row on its key's timeline: current first, then retired, newest first."""
    w = Window.partitionBy(*keys).orderBy(F.col(retired).isNotNull(), F.col(rank).desc_nulls_last(), F.col(tie))
    return df.select(*keys, tie, F.row_number().over(w).alias("place"))


def apply_findings(det: DataFrame, findings: DataFrame, key: list[str], value: str, ordinal: str) -> DataFrame:
    """(key, value, status): the last finding per key applied; ``supersede`` needs an existing row, ``add`` none. Replaced rows stay as ``superseded``."""
    last = findings.groupBy(*key).agg(F.max_by(F.struct("action", value), F.struct(F.col(ordinal), F.expr("-ascii(action)"), F.expr(f"-ascii({value})"))).alias("f"))
    j = det.select(*key, F.col(value).alias("__old"), F.lit(True).alias("__have")).join(last, key, "full_outer")
    applies = F.col("f").isNotNull() & ((F.col("f.action") == "add") | F.coalesce("__have", F.lit(False)))
    out = F.array_compact(
        F.array(
            F.when(applies, F.struct(F.col(f"f.{value}").alias("v"), F.lit("current").alias("status"))),
            F.when(F.coalesce("__have", F.lit(False)), F.struct(F.col("__old").alias("v"), F.when(applies, "superseded").otherwise("current").alias("status"))),
        )
    )
    return j.select(*key, F.explode(out).alias("x")).select(*key, F.col("x.v").alias(value), "x.status")


def apply_corrections(det: DataFrame, corrections: DataFrame, entity: str, value: str, row_id: str) -> DataFrame:
    """Rows retired or recoded by (study, field[, entity][, old value]), with ``correction``: null, or the id of the correction that made the row.

    ``corrections`` has ``correction_id``, ``study_accession``, ``field_name``, ``entity``, ``old``, ``action`` and ``new``; an empty entity or old value is a
    wildcard. A row that a ``retire`` matches is dropped. All rows that a ``recode`` matches are dropped and one row per correction and entity takes their
    place: the matched row with the smallest ``row_id``, with the new value. A row matched by several recodes goes to the most specific (entity and
    old value, entity, old value, neither), then to the smallest correction id. Hash joins on (study, field); nulls match wildcards only.
    """
    c = corrections.select(*[F.col(x).alias(f"__{x}") for x in ("correction_id", "study_accession", "field_name", "entity", "old", "action", "new")])
    any_entity, any_old = F.coalesce(F.col("__entity"), F.lit("")) == "", F.coalesce(F.col("__old"), F.lit("")) == ""
    hit = [
        F.col("study_accession") == F.col("__study_accession"),
        F.col("field_name") == F.col("__field_name"),
        any_entity | (F.col("__entity") == F.col(entity)),
        any_old | (F.col("__old") == F.col(value)),
    ]
    kept = det.join(c.where("__action = 'retire'"), hit, "left_anti")
    rank = F.struct(any_entity.cast("int") + any_entity.cast("int") + any_old.cast("int"), F.col("__correction_id"))
    recode = kept.select(row_id, entity, "study_accession", "field_name", value).join(c.where("__action = 'recode'"), hit)
    chosen = recode.groupBy(row_id, entity).agg(F.min_by(F.struct("__correction_id", "__new"), rank).alias("__c"))
    first = chosen.groupBy(entity, F.col("__c.__correction_id").alias("__id")).agg(F.min(row_id).alias(row_id), F.first("__c.__new").alias("__new"))
    untouched = kept.join(chosen.select(row_id), row_id, "left_anti").withColumn("correction", F.lit(None).cast(corrections.schema["correction_id"].dataType))
    made = kept.join(first.select(row_id, "__id", "__new"), row_id).withColumn(value, F.col("__new")).withColumn("correction", F.col("__id"))
    return untouched.unionByName(made.drop("__id", "__new"))


def conditional_recode(det: DataFrame, group: str, value: str, placeholders: list[str], known: DataFrame, known_value: str, note: str = "recode_note") -> DataFrame:
    """Placeholder classes replaced by the one class known for the row's group, with a note; other rows, and groups without a known class, stay.

    ``known`` may repeat a group; it counts only where all its rows agree.
    """
    one = known.where(F.col(known_value).isNotNull()).groupBy(F.col(group).alias("__g")).agg(F.min(known_value).alias("__lo"), F.max(known_value).alias("__hi")).where("__lo = __hi")
    j = det.join(one, F.col(group) == F.col("__g"), "left")
    swap = F.coalesce(F.lower(F.trim(value)).isin(*placeholders), F.lit(True)) & F.col("__lo").isNotNull()
    told = F.when(swap, F.concat(F.lit("was "), F.coalesce(F.col(value), F.lit("null")), F.lit("; class of its group")))
    return j.withColumn(note, told).withColumn(value, F.when(swap, F.col("__lo")).otherwise(F.col(value))).drop("__g", "__lo", "__hi")


def build_facts(specs: list[dict], release: str, package: str) -> dict[str, DataFrame]:
    """Each fact table stamped and versioned by its specification, all in the same way.

    A specification has ``name``, ``current``, optionally ``previous`` (stamped rows of the release before), ``key``, ``diff`` and ``overrides``: rows of key and diff
    columns that replace current values; one that matches no or several rows of its table is an error. Result by name: current rows with carried or new
    stamps, then rows retired by this release, then those retired before.
    """
    out = {}
    for spec in specs:
        name, cur, key, diff = spec["name"], spec["current"], spec["key"], spec["diff"]
        over = spec.get("overrides")
        if over is not None:
            hits = over.select(*key).distinct().join(cur.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")), key, "left")
            bad = hits.where("coalesce(__n, 0) <> 1").select(*key).limit(3).collect()
            if bad:
                raise ValueError(f"{name}: overrides must match exactly one row each: {[tuple(r) for r in bad]}")
            o = over.select(*key, *[F.col(c).alias(f"__{c}") for c in diff], F.lit(True).alias("__hit"))
            cur = cur.join(o, key, "left").withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in diff}).drop("__hit", *[f"__{c}" for c in diff])
        if spec.get("previous") is None:
            out[name] = stamp(cur, release, package)
            continue
        prev = spec["previous"]
        live = prev.where("release_retired is null")
        old = live.select(*key, F.struct(*diff).alias("__p"), F.col("release_added").alias("__r"), F.col("package_added").alias("__k"))
        j = cur.join(old, key, "left")
        same = F.coalesce(F.col("__p").eqNullSafe(F.struct(*[F.col(c) for c in diff])), F.lit(False)) & F.col("__r").isNotNull()
        now = j.withColumns(
            {"release_added": F.when(same, F.col("__r")).otherwise(F.lit(release)), "release_retired": F.lit(None).cast("string"), "package_added": F.when(same, F.col("__k")).otherwise(F.lit(package))}
        ).drop("__p", "__r", "__k")
        gone = retire(live, cur, key, diff, release).drop("retired_reason")
        out[name] = now.unionByName(gone, allowMissingColumns=True).unionByName(prev.where("release_retired is not null"), allowMissingColumns=True)
    return out


def release_registry(history: DataFrame, published: DataFrame, current: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The ordered release rows: published ones as they are, historical ones where none was published, the current row where it is in neither.

    ``place`` counts from 1 by ``order``. A list of publications, so one sorted array holds it.
    """
    cols = published.columns
    pick = lambda df, p: df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(published.schema[c].dataType).alias(c) for c in cols], F.lit(p).alias("__p"))
    every = pick(published, 0).unionByName(pick(history, 1)).unionByName(pick(current, 2))
    rest = [c for c in cols if c != key]
    one = every.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("__p", *rest)).alias("b"))
    rows = one.select(key, *[F.col(f"b.{c}").alias(c) for c in rest])
    a = rows.agg(F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*order, key])], F.struct(*cols).alias("r")))).alias("a"))
    return a.select(F.posexplode("a").alias("i", "x")).select((F.col("i") + 1).alias("place"), "x.r.*")


def derive_codes(df: DataFrame, code_map: DataFrame, key: str, value: str, code: str) -> DataFrame:
    """``code`` by (key, value), else by value alone where all keys agree on it."""
    m = code_map.select(key, value, F.col(code).alias("__exact"))
    by_value = code_map.groupBy(value).agg(F.min(code).alias("__v"), F.countDistinct(code).alias("__n")).where("__n = 1").drop("__n")
    j = df.join(m, [key, value], "left").join(by_value, value, "left")
    return j.withColumn(code, F.coalesce("__exact", "__v")).drop("__exact", "__v")


def overrides(df: DataFrame, key: str, base: str, layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """(key, verdict, stage): the first layer (name, frame with key and ``v``) that has the key, else the base value."""
    out, names = df, []
    for i, (name, layer) in enumerate(layers):
        out = out.join(layer.select(key, F.col("v").alias(f"__v{i}")), key, "left")
        names.append((name, F.col(f"__v{i}")))
    stage = F.lit("base")
    for name, v in reversed(names):
        stage = F.when(v.isNotNull(), name).otherwise(stage)
    return out.select(key, F.coalesce(*[v for _, v in names], F.col(base)).alias("verdict"), stage.alias("stage"))


def append_only(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """(rows_before, rows_after, collisions) of an append; raises if a new key exists already, so nothing is overwritten."""
    clash = new.join(old.select(*key), key, "left_semi").limit(1).count()
    if clash:
        raise ValueError("new rows repeat existing keys; nothing was appended")
    before = content_hash(old).select(F.col("rows").alias("rows_before"))
    after = content_hash(old.unionByName(new)).select(F.col("rows").alias("rows_after"))
    return before.crossJoin(after).withColumn("collisions", F.lit(clash))  # one row each


def append_verdicts(universe: DataFrame, verdicts: DataFrame, key: str, verdict: str, allowed: list[str], valid: Column) -> DataFrame:
    """(key, verdict, ``stage``): the universe with verdicts for keys it does not hold; only allowed, valid ones, of several the smallest."""
    new = verdicts.where(F.col(verdict).isin(*allowed) & F.coalesce(valid, F.lit(False)) & F.col(key).isNotNull()).groupBy(key).agg(F.min(verdict).alias(verdict))
    unseen = new.join(universe.select(key), key, "left_anti")
    return universe.select(key, verdict, F.lit("old").alias("stage")).unionByName(unseen.select(key, verdict, F.lit("append").alias("stage")))


def rewide(wide: DataFrame, touched: DataFrame, key: str, excluded: DataFrame) -> DataFrame:
    """The wide table with touched cells overwritten and excluded keys left out."""
    cols = [c for c in wide.columns if c != key]
    t = touched.select(key, *[F.col(c).alias(f"__{c}") for c in cols])
    j = wide.join(t, key, "left").join(excluded.select(key).distinct(), key, "left_anti")
    return j.select(key, *[F.coalesce(f"__{c}", c).alias(c) for c in cols])


def complete(entities: DataFrame, entity: str, field: str, fields: list[str], have: DataFrame) -> DataFrame:
    """(entity, field) pairs without a value: the grid is exploded from a literal list, then an anti-join."""
    grid = entities.withColumn(field, F.explode(F.array(*[F.lit(f) for f in fields])))
    return grid.join(have.distinct(), [entity, field], "left_anti")


def split_outcomes(df: DataFrame, keys: list[str], order: list[Column], checks: list[tuple[str, Column]]) -> DataFrame:
    """``outcome`` and ``message``: rejected with the first failing check, else accepted (first per key) or superseded."""
    message = F.coalesce(*[F.when(bad, F.lit(m)) for m, bad in checks])
    x = df.withColumn("message", message)
    w = Window.partitionBy(*keys, F.col("message").isNotNull()).orderBy(*order)
    place = F.row_number().over(w)
    return x.withColumn("outcome", F.when(F.col("message").isNotNull(), "rejected").when(place == 1, "accepted").otherwise("superseded"))
