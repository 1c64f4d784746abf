"""Drivers that compose the operators: a scope from its sources, and a group's new members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.texts import ladder
from sedimenta.operators.resolve import best_row, conflicts, expand_group, widen
from sedimenta.operators.versioned import apply_corrections
from sedimenta.sources.tables import checkpointed

DETERMINATION = ["det_id", "entity", "study_accession", "field_name", "value", "confidence", "route"]


def build_scope(
    sources: list[DataFrame],
    statements: DataFrame,
    members: DataFrame,
    corrections: DataFrame,
    fields: dict[str, Column],
    routes: list[str],
    previous: DataFrame | None,
    release: str,
    cut_lineage: bool = True,
) -> dict[str, DataFrame]:
    """The flagship pipeline as one lazy graph: sources -> validate -> correct -> resolve -> expand -> widen -> coverage -> carry.

    ``sources`` hold ``DETERMINATION`` columns; ``fields`` maps a field to the check its value must pass (a null check fails). Per (entity, field) the row with the best route, then
    confidence, then smallest id wins. ``statements`` (``DETERMINATION`` without entity) speak for a whole study and fill members (study, entity) without a value, at a confidence of
    0.6 at most. ``previous`` wide rows give their release stamp to unchanged ones. Result: ``rejected``, ``resolved``, ``conflicts``, ``wide`` (one column per field, ``release_added``,
    ``release_retired``), ``coverage`` per study. Resolved rows are read by four outputs, so their lineage is cut once in the shared folder.
    """
    every = None
    for s in sources:
        one = s.select(*DETERMINATION)
        every = one if every is None else every.unionByName(one)
    ok = F.lit(False)
    for f, check in fields.items():
        ok = ok | ((F.col("field_name") == f) & F.coalesce(check, F.lit(False)))
    ok = ok & F.col("entity").isNotNull() & F.coalesce(F.col("confidence").between(0, 1), F.lit(False))
    rejected = every.where(~ok)
    good = apply_corrections(every.where(ok), corrections, "entity", "value", "det_id").drop("correction")
    place = F.lit(len(routes))
    for i, r in enumerate(routes):
        place = F.when(F.col("route") == r, i).otherwise(place)
    order = [place, -F.col("confidence"), F.col("det_id")]
    won = best_row(good, ["entity", "field_name"], order)
    stated = statements.select(*[c for c in DETERMINATION if c != "entity"]).withColumn("confidence", F.least("confidence", F.lit(0.6)))
    filled = expand_group(stated, members, won, "study_accession", "entity", "field_name", [-F.col("confidence"), F.col("det_id")])
    resolved = won.select(*DETERMINATION).unionByName(filled.select(*DETERMINATION))
    resolved = checkpointed(resolved) if cut_lineage else resolved
    wide = members.select("entity", "study_accession").dropDuplicates(["entity"]).join(widen(resolved, ["entity"], "field_name", list(fields), "value"), "entity", "left")
    cols = ["study_accession", *fields]
    if previous is None:
        stamped = wide.withColumns({"release_added": F.lit(release), "release_retired": F.lit(None).cast("string")})
    else:
        live = previous.where("release_retired is null")
        old = live.select("entity", F.struct(*cols).alias("__p"), F.col("release_added").alias("__r"))
        j = wide.join(old, "entity", "left")
        same = F.coalesce(F.col("__p").eqNullSafe(F.struct(*cols)), F.lit(False)) & F.col("__r").isNotNull()
        now = j.withColumns({"release_added": F.when(same, F.col("__r")).otherwise(F.lit(release)), "release_retired": F.lit(None).cast("string")}).drop("__p", "__r")
        gone = live.join(wide.select("entity"), "entity", "left_anti").withColumn("release_retired", F.lit(release))
        stamped = now.unionByName(gone.select(*now.columns)).unionByName(previous.where("release_retired is not null").select(*now.columns))
    coverage = wide.groupBy("study_accession").agg(F.count(F.lit(1)).alias("members"), *[F.round(F.avg(F.col(f).isNotNull().cast("double")), 6).alias(f) for f in fields])
    return {"rejected": rejected, "resolved": resolved, "conflicts": conflicts(good, ["entity", "field_name"], order, "value"), "wide": stamped, "coverage": coverage}


def new_members(known: DataFrame, delivered: DataFrame, looked_up: DataFrame, determinations: DataFrame, entity: str, study: str, fields: list[str], horizon: str) -> dict[str, DataFrame]:
    """What a delivery adds to studies: ``rows`` (one wide row per new entity, with ``age_scope``), ``missed`` (with the reason) and ``counters`` per study.

    ``delivered`` is (entity, study, ``first_public``), ``looked_up`` (entity, ``status``), ``determinations`` (entity, ``field_name``, ``value``). A new entity without determinations is missed for the first
    of: ``not found``, ``after horizon`` (public later than ``horizon``), ``no attributes``. ``age_scope`` is infant below 1,096 days, adult from 6,574, child between, unknown without an age.
    """
    new = delivered.where(F.col(entity).isNotNull()).dropDuplicates([entity]).join(known.select(entity), entity, "left_anti")
    d = determinations.where(F.col("value").isNotNull()).groupBy(entity, "field_name").agg(F.min("value").alias("value"))
    w = widen(d, [entity], "field_name", fields, "value")
    status = looked_up.groupBy(entity).agg(F.min("status").alias("__status"))
    j = new.join(status, entity, "left").join(w.withColumn("__have", F.lit(True)), entity, "left")
    reason = ladder([(F.coalesce(F.col("__status"), F.lit("missing")) != "found", "not found"), (F.col("first_public") > horizon, "after horizon")], "no attributes")
    age = F.col("age_at_collection_days").try_cast("double") if "age_at_collection_days" in fields else F.lit(None).cast("double")
    rows = j.where("__have").withColumn("age_scope", ladder([(age < 1096, "infant"), (age >= 6574, "adult"), (age.isNotNull(), "child")], "unknown"))
    missed = j.where("__have is null").select(entity, study, reason.alias("reason"))
    counters = j.groupBy(study).agg(F.count(F.lit(1)).alias("new"), F.count("__have").alias("with_data"))
    return {"rows": rows.select(entity, study, *fields, "age_scope"), "missed": missed, "counters": counters}


def audit(ids: DataFrame, key: str, blocks: dict[str, tuple[DataFrame, str, list[str]]], gaps: tuple[DataFrame, str, str, list[str]]) -> DataFrame:
    """(key, ``n_<block>``, ``<block>``.., ``gaps``): what the tables say of each identifier.

    ``blocks`` maps a name to (frame, its key column, columns shown of its smallest row); ``gaps`` is (frame, its key column, field column, wanted fields): the sorted list of fields without a
    value. Each table is reduced to one row per identifier before it is joined; identifiers nothing is known of stay with zero counts.
    """
    out = ids.select(key).where(F.col(key).isNotNull()).distinct()
    for name, (df, k, cols) in blocks.items():
        g = df.where(F.col(k).isNotNull()).groupBy(F.col(k).alias(key)).agg(F.count(F.lit(1)).alias(f"n_{name}"), F.min(F.struct(*cols)).alias("__b"))
        out = out.join(g, key, "left").withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0))).withColumn(name, F.to_json("__b")).drop("__b")
    df, k, field, wanted = gaps
    have = df.where(F.col(field).isin(*wanted)).groupBy(F.col(k).alias(key)).agg(F.collect_set(field).alias("__have"))
    missing = F.array_except(F.array(*[F.lit(f) for f in sorted(wanted)]), F.coalesce("__have", F.array().cast("array<string>")))
    return out.join(have, key, "left").withColumn("gaps", F.array_join(missing, ";")).drop("__have")
