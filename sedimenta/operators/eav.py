"""Attribute-value rows into wide typed tables, and what the attribute operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.keys import entity_key, is_placeholder, normal_key
from sedimenta.functions.quantities import DIMENSIONS, dimension, parse_quantity, unit_of
from sedimenta.functions.times import keep, let, parse_time
from sedimenta.sources.tables import checkpointed

#: A field map longer than this is not broadcast.
MAX_BROADCAST_KEYS = 20_000
#: Most columns of a wide table; a longer list of keys is an error, never cut.
MOST_COLUMNS = 20_000


def small(df: DataFrame, limit: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, else as it is (the planner then shuffles)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def attributes(rows: DataFrame, field_map: DataFrame) -> DataFrame:
    """Attribute rows of mapped keys, keys and entities in normal form, with ``parser``, ``field_name``, ``unit_default``, ``note``.

    A null ``attr_key_norm`` is completed from ``attr_key``. Keys outside the map and those with parser ``SKIP`` are left out; a key
    listed twice in the map takes its first parser in order. Null entities or keys match nothing.
    """
    m = (
        field_map.where("attr_key_norm is not null")
        .groupBy("attr_key_norm")
        .agg(F.min(F.struct("parser", "field_name", "unit_default", "note")).alias("m"))
        .select(F.col("attr_key_norm").alias("__k"), "m.*")
        .where("coalesce(upper(parser), 'SKIP') <> 'SKIP'")
    )
    r = rows.select(
        "attr_id",
        entity_key(F.col("sample_key")).alias("sample_key"),
        "study_accession",
        F.coalesce(F.lower(F.trim("attr_key_norm")), normal_key(F.col("attr_key"))).alias("attr_key_norm"),
        "value",
        "attr_units",
        "harvested_at",
    )
    return r.join(small(m), F.col("attr_key_norm") == F.col("__k")).drop("__k")


def typed(rows: DataFrame) -> DataFrame:
    """``rows`` whose value is no placeholder and fits its column, with ``as_number``, ``as_time`` and ``as_text``.

    Quantity parsers want a quantity (the number as written, or the amount the text fixes), ``timestamp_text`` a valid calendar day
    under either order of day and month (microseconds of the text's own clock), all others take any text.
    """
    r = rows.where(~is_placeholder(F.col("value")))
    dim, no_number, no_time = dimension(F.col("parser")), F.lit(None).cast("double"), F.lit(None).cast("long")

    def cell(number: Column, time: Column, text: Column) -> Column:
        return F.struct(number.alias("as_number"), time.alias("as_time"), text.alias("as_text"))

    no_text = F.lit(None).cast("string")
    number = let(parse_quantity(F.col("value"), dim), lambda q: F.when(q.isNotNull(), cell(F.coalesce(q["amount"], q["common"]), no_time, no_text)))
    time = let(parse_time(F.col("value"), F.lit("any")), lambda t: F.when(t.isNotNull(), cell(no_number, t["local_us"], no_text)))
    made = F.when(dim.isNotNull(), number).when(F.lower("parser") == "timestamp_text", time).otherwise(cell(no_number, no_time, F.col("value")))
    return keep(r, "__c", made).select("*", "__c.as_number", "__c.as_time", "__c.as_text").drop("__c")


def wide_cells(rows: DataFrame, keys: list[str], entity: str, key: str, order: list[Column], row_id: str) -> DataFrame:
    """(``entity``, ``cells``): one row per entity; ``cells[i]`` is the typed row of ``typed`` that fills attribute ``keys[i]``, or null.

    Per entity and attribute the row with the greatest ``order`` fills the cell. The entity's cells are gathered and the
    entity-by-attribute grid is completed in place: for every position the gathered cells are looked up (the left join of
    the grid to the values, done inside the row, so no grid of entities times attributes is shuffled) and the array comes out
    sorted by attribute position, ready for fixed indices. Rows with a null entity or an attribute not in ``keys`` are
    left out. The first aggregation is partial, so a hot entity or repeated rows shrink to one row per cell before the
    exchange, and an entity's array has at most ``len(keys)`` cells.
    """
    pos = F.create_map(*[F.lit(x) for i, k in enumerate(keys) for x in (k, i)]) if keys else F.create_map().cast("map<string,int>")
    best = (
        rows.where(F.col(entity).isNotNull())
        .withColumn("__p", F.try_element_at(pos, F.col(key)))
        .where("__p is not null")
        .groupBy(F.col(entity), "__p")
        .agg(F.max_by(F.struct(F.col(row_id).alias("row_id"), "as_number", "as_time", "as_text"), F.struct(*order)).alias("__c"))
    )
    got = best.groupBy(entity).agg(F.map_from_entries(F.collect_list(F.struct("__p", "__c"))).alias("__m"))
    grid = F.sequence(F.lit(0), F.lit(max(0, len(keys) - 1)))
    return got.select(entity, F.transform(grid, lambda p: F.try_element_at(F.col("__m"), p)).alias("cells"))


def wide_table(cells: DataFrame, keys: list[str], parsers: list[str], entity: str) -> DataFrame:
    """One row per entity with one typed column per attribute, from ``wide_cells``."""
    kinds = [_kind(p) for p in parsers]
    return cells.select(
        entity, *[F.get("cells", i)[f"as_{kind}"].try_cast(kind_type).alias(k) for i, (k, (kind, kind_type)) in enumerate(zip(keys, kinds))]
    )


def _kind(parser: str) -> tuple[str, str]:
    if parser.lower().startswith(tuple(DIMENSIONS)):
        return "number", "double"
    return ("time", "bigint") if parser.lower() == "timestamp_text" else ("text", "string")


def told_units(rows: DataFrame, companions: DataFrame) -> DataFrame:
    """``rows`` with ``dim``, ``q`` and ``told_unit``: from the text, else ``attr_units``, else a companion row, else note and default.

    ``companions`` are the attribute rows whose key ends in ``_units``; per sample and key the latest harvest that names a unit of
    the dimension counts. Only rows still without a unit are joined to them. A ``note`` of the form ``values < n -> unit`` applies to unmarked
    numbers before ``unit_default``.
    """
    r = rows.withColumn("dim", dimension(F.col("parser"))).where("dim is not null")
    r = keep(r.where(~is_placeholder(F.col("value"))), "q", parse_quantity(F.col("value"), F.col("dim")))
    r = r.withColumn("u1", F.coalesce(F.col("q.unit"), unit_of(F.col("attr_units"), F.col("dim"))))
    r = r.withColumn("marked", F.col("u1").isNotNull() | F.col("q.common").isNotNull())
    # Texts are read and parsed once; what follows reads a narrow table of the quantities.
    r = checkpointed(r.select("attr_id", "sample_key", "study_accession", "attr_key_norm", "field_name", "unit_default", "note", "dim", "q", "u1", "marked"))
    lone = r.where("not marked")
    comp = (
        companions.withColumn("__dim", F.explode(F.array(*[F.lit(d) for d in ("time", "mass", "length", "temp")])))
        .withColumn("__u", unit_of(F.col("value"), F.col("__dim")))
        .where("__u is not null")
        .groupBy(F.col("sample_key").alias("__s"), F.regexp_replace("attr_key_norm", "_units$", "").alias("__k"), "__dim")
        .agg(F.max_by("__u", F.struct("harvested_at", "attr_id")).alias("u2"))
    )
    lone = lone.join(comp, (F.col("sample_key") == F.col("__s")) & (F.col("attr_key_norm") == F.col("__k")) & (F.col("dim") == F.col("__dim")), "left")
    pattern = r"values?\s*([<>])\s*(\d+(?:\.\d+)?)\s*->\s*(\S+)"
    op, bound = F.regexp_extract("note", pattern, 1), F.regexp_extract("note", pattern, 2)
    limit = F.when(bound != "", bound).try_cast("double")
    under = ((op == "<") & (F.col("q.amount") < limit)) | ((op == ">") & (F.col("q.amount") > limit))
    noted = F.when(under, unit_of(F.regexp_extract("note", pattern, 3), F.col("dim")))
    default = unit_of(F.col("unit_default"), F.col("dim"))
    lone = lone.withColumn("told_unit", F.coalesce("u2", noted, default)).drop("__s", "__k", "__dim", "u2")
    return r.where("marked").withColumn("told_unit", F.col("u1")).unionByName(lone)
