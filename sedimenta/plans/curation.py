"""The p-queries of the core operators: timestamps, snapshots, history, wide tables and units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.keys import canonical_value, entity_key, folded, release_ranks, with_release_rank
from sedimenta.functions.times import keep, parse_time, utc_text
from sedimenta.operators import eav, history, snapshots, timestamps, units
from sedimenta.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every time-valued row as one UTC instant."""
    meta, zones = table(spark, d, "study_meta"), table(spark, d, "center_zones")
    attrs = eav.attributes(table(spark, d, "sample_attributes_new"), table(spark, d, "attribute_field_map"))
    attrs = attrs.where(F.lower("parser") == "timestamp_text")
    centre = zones.groupBy(F.trim("center_name").alias("__c")).agg(F.min(F.struct("zone_id", "date_order")).alias("__cz"))
    centre = eav.small(centre)
    stated = meta.where("study_accession is not null and center_name is not null")
    of_study = stated.groupBy(F.trim("study_accession").alias("study")).agg(F.min(F.trim("center_name")).alias("center"))
    a = attrs.select(F.lit("sample_attributes_new").alias("table_name"), F.col("attr_id").alias("row_id"), "value", F.trim("study_accession").alias("study"))
    a = timestamps.salted_lookup(a, of_study, "study", F.col("row_id")).select("table_name", "row_id", "value", "center")
    m = meta.select(F.lit("study_meta").alias("table_name"), F.col("meta_id").alias("row_id"), F.col("first_public").alias("value"), F.trim("center_name").alias("center"))
    rows = m.unionByName(a).join(centre, F.col("center") == F.col("__c"), "left")
    texts = meta.select(F.col("first_public").alias("value")).unionByName(attrs.select("value"))
    named = texts.where("value like '%[%]%'").select(F.regexp_extract("value", r"\[([^\]]+)\]\s*$", 1).alias("zone_id")).distinct()
    rows = keep(rows, "p", parse_time(F.col("value"), F.coalesce(F.col("__cz.date_order"), F.lit("dmy"))))
    names = zones.select("zone_id").unionByName(spark.createDataFrame([("UTC",)], "zone_id string"))
    out = timestamps.resolve_local(
        rows, timestamps.zone_years(names.unionByName(named), "zone_id"), "p", F.coalesce(F.col("__cz.zone_id"), F.lit("UTC")), "utc_us"
    )
    return out.where("utc_us is not null").select("table_name", "row_id", utc_text(F.col("utc_us")).alias("utc_text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """What was added, removed or changed from one delivered snapshot to the next."""
    rows = table(spark, d, "determination_snapshots")
    releases = table(spark, d, "releases")
    ranks = release_ranks(releases)
    named = rows.withColumn("__t", folded(F.col("release_id"))).drop("release_id").join(eav.small(ranks), F.col("__t") == F.col("release_text"))
    previous = snapshots.consecutive(named, F.col("release_id"), ranks)
    out = snapshots.snapshot_changes(
        named,
        F.col("release_id"),
        previous,
        [entity_key(F.col("sample_key")), folded(F.col("field_name"))],
        canonical_value(F.col("value_normalized")),
        F.col("delivered_at"),
    )
    return out.select(F.col("snapshot").alias("release_id"), F.col("k0").alias("sample_key"), F.col("k1").alias("field_name"), "change_kind")


def _history(spark: SparkSession, d: str) -> DataFrame:
    releases = table(spark, d, "releases")
    rows = table(spark, d, "sample_determinations_all").select(
        "det_id",
        entity_key(F.col("sample_key")).alias("sample_key"),
        folded(F.col("field_name")).alias("field_name"),
        folded(F.col("src_track")).alias("src_track"),
        canonical_value(F.col("value_normalized")).alias("v"),
        "release_added",
        "package_added",
        "release_retired",
    )
    rows = with_release_rank(rows, releases, "release_added", "r1")
    rows = with_release_rank(rows, releases, "package_added", "r2")
    rows = with_release_rank(rows, releases, "release_retired", "r3")
    # A retirement that names no known release leaves the row open.
    return history.versions(
        rows.where("sample_key is not null and field_name is not null and src_track is not null"),
        ["sample_key", "field_name", "src_track"],
        F.col("v"),
        F.coalesce("r1", "r2"),
        F.col("r3"),
        F.col("det_id"),
    )


def p4_versions(spark: SparkSession, d: str) -> DataFrame:
    """The history with the value of each version."""
    names = release_ranks(table(spark, d, "releases")).select("release_id", "release_rank").distinct()
    starts = names.select(F.col("release_rank").alias("start"), F.col("release_id").alias("valid_from"))
    ends = names.select(F.col("release_rank").alias("end"), F.col("release_id").alias("valid_to"))
    v = _history(spark, d).join(eav.small(starts), "start").join(eav.small(ends), "end", "left")
    return v.select("sample_key", "field_name", "src_track", "version_value", "valid_from", F.coalesce("valid_to", F.lit("")).alias("valid_to"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The versions per sample, field and track."""
    return p4_versions(spark, d).drop("version_value")


def _used_keys(spark: SparkSession, d: str) -> tuple[list[str], list[str]]:
    """The map's used keys in order with their parsers: the columns of the wide table, so a list of bounded length."""
    m = table(spark, d, "attribute_field_map").where("attr_key_norm is not null").groupBy("attr_key_norm").agg(F.min("parser").alias("parser"))
    rows = m.where("coalesce(upper(parser), 'SKIP') <> 'SKIP'").orderBy("attr_key_norm").limit(eav.MOST_COLUMNS + 1).collect()
    if len(rows) > eav.MOST_COLUMNS:
        raise ValueError(f"more than {eav.MOST_COLUMNS} used keys; a wide table has a column for each")
    return [r.attr_key_norm for r in rows], [r.parser for r in rows]


def _cells(spark: SparkSession, d: str) -> tuple[DataFrame, list[str], list[str]]:
    rows = eav.attributes(table(spark, d, "sample_attributes_new"), table(spark, d, "attribute_field_map"))
    rows = eav.typed(rows)
    keys, parsers = _used_keys(spark, d)
    order = [F.col("harvested_at"), F.col("attr_id")]
    return eav.wide_cells(rows, keys, "sample_key", "attr_key_norm", order, "attr_id"), keys, parsers


def p5_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per sample with one typed column per used key."""
    cells, keys, parsers = _cells(spark, d)
    return eav.wide_table(cells, keys, parsers, "sample_key")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The row that fills each cell of the wide table."""
    cells, keys, _ = _cells(spark, d)
    names = F.array(*[F.lit(k) for k in keys])
    x = cells.select("sample_key", F.posexplode("cells").alias("i", "c")).where("c is not null")
    return x.select("sample_key", F.get(names, F.col("i")).alias("attr_key_norm"), F.col("c.row_id").alias("attr_id"))


def _quantities(spark: SparkSession, d: str) -> DataFrame:
    raw, field_map = table(spark, d, "sample_attributes_new"), table(spark, d, "attribute_field_map")
    rows = eav.attributes(raw, field_map)
    any_key = raw.select(
        "attr_id",
        entity_key(F.col("sample_key")).alias("sample_key"),
        F.coalesce(F.lower(F.trim("attr_key_norm")), eav.normal_key(F.col("attr_key"))).alias("attr_key_norm"),
        "value",
        "harvested_at",
    )
    return eav.told_units(rows, any_key.where("attr_key_norm like '%\\_units'"))


def p6_units(spark: SparkSession, d: str) -> DataFrame:
    """Every quantity with its decoded unit and its value in the common unit."""
    return units.decode_units(_quantities(spark, d), ["study_accession", "attr_key_norm"], "attr_id", "field_name", "dim", "q", F.col("told_unit"))


def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Per field, how often the model recovers units it is not told: those of a tenth of the told rows (by a hash of the id) are hidden."""
    rows = _quantities(spark, d)
    hidden = F.pmod(F.xxhash64(F.lit("hidden"), "attr_id"), F.lit(10)) == 0
    u = units.decode_units(rows, ["study_accession", "attr_key_norm"], "attr_id", "field_name", "dim", "q", F.when(~hidden, F.col("told_unit")))
    true = rows.where(hidden & F.col("told_unit").isNotNull() & F.col("q.common").isNull()).select(F.col("attr_id").alias("row_id"), F.col("told_unit").alias("true_unit"))
    j = u.where("not told").join(true, "row_id")
    return j.groupBy(F.col("field").alias("field_name")).agg(F.count(F.lit(1)).alias("hidden"), F.count_if(F.col("unit") == F.col("true_unit")).alias("recovered"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every row of a quantity key whose unit can be told, in the common unit, as a whole number."""
    u = units.convert_told(_quantities(spark, d), "attr_id", "field_name", "dim", "q", F.col("told_unit"))
    return u.select(F.col("row_id").alias("attr_id"), F.round("common").cast("bigint").alias("common_value"))


QUERIES = {
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_versions": p4_versions,
    "p5_found": p5_found,
    "p5_wide": p5_wide,
    "p6_found": p6_found,
    "p6_units": p6_units,
    "p6_decoded": p6_decoded,
}

#: White space at the ends of keys and values, for DuckDB's trim.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"
NAMES = f"""rel as (select release_id, package_version, row_number() over (order by release_date, release_id) as k from releases), names as (select lower(trim(release_id)) as t, k from rel
union select lower(trim(package_version)), k from rel union select 'v' || lower(trim(package_version)), k from rel),"""
VALUE = f"coalesce((case when regexp_matches(trim(value_normalized, {BLANKS}), '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$') then try_cast(trim(value_normalized, {BLANKS}) as double) + 0.0 end)::varchar, lower(trim(value_normalized, {BLANKS})))"

SQL: dict[str, str] = {
    "p3_found": f"""with {NAMES} one as (select n.k, upper(trim(sample_key, {BLANKS})) as s, lower(trim(field_name, {BLANKS})) as f, max_by(struct_pack(v := {VALUE}), delivered_at).v as v from determination_snapshots d join names n on n.t = lower(trim(d.release_id, {BLANKS})) group by 1, 2, 3),
ks as (select k, lead(k) over (order by k) as nk from (select distinct k from one)), cur as (select k, s, f, v from one), prev as (select ks.nk as k, s, f, v from one join ks using (k) where ks.nk is not null),
j as (select coalesce(c.k, p.k) as k, coalesce(c.s, p.s) as s, coalesce(c.f, p.f) as f, case when p.s is null then 'added' when c.s is null then 'removed' when c.v is distinct from p.v then 'changed' end as change_kind
from cur c full join prev p on c.k = p.k and c.s = p.s and c.f = p.f)
select rel.release_id, s as sample_key, f as field_name, change_kind from j join rel using (k) where change_kind is not null and k > (select min(k) from ks)""",
    "p4_found": f"""with {NAMES} r as (select upper(trim(sample_key, {BLANKS})) as s, lower(trim(field_name, {BLANKS})) as f, lower(trim(src_track, {BLANKS})) as t, {VALUE} as v, coalesce(a.k, p.k) as b, e.k as e, det_id
from sample_determinations_all d left join names a on a.t = lower(trim(d.release_added, {BLANKS})) left join names p on p.t = lower(trim(d.package_added, {BLANKS})) left join names e on e.t = lower(trim(d.release_retired, {BLANKS}))),
one as (select * from r where v is not null and b is not null and (e is null or e > b) and s is not null and f is not null and t is not null qualify row_number() over (partition by s, f, t, b order by det_id desc) = 1),
cut as (select *, least(e, lead(b) over w) as e2 from one window w as (partition by s, f, t order by b)),
mark as (select *, case when lag(v) over w = v and lag(e2) over w = b then 0 else 1 end as new from cut window w as (partition by s, f, t order by b)),
grp as (select *, sum(new) over (partition by s, f, t order by b rows unbounded preceding) as g from mark),
ver as (select s, f, t, min(b) as b, case when count(e2) = count(*) then max(e2) end as e from grp group by s, f, t, g)
select s as sample_key, f as field_name, t as src_track, x.release_id as valid_from, coalesce(y.release_id, '') as valid_to from ver join rel x on x.k = ver.b left join rel y on y.k = ver.e""",

    "p4_versions": f"""with {NAMES} r as (select upper(trim(sample_key, {BLANKS})) as s, lower(trim(field_name, {BLANKS})) as f, lower(trim(src_track, {BLANKS})) as t, {VALUE} as v, coalesce(a.k, p.k) as b, e.k as e, det_id
from sample_determinations_all d left join names a on a.t = lower(trim(d.release_added, {BLANKS})) left join names p on p.t = lower(trim(d.package_added, {BLANKS})) left join names e on e.t = lower(trim(d.release_retired, {BLANKS}))),
one as (select * from r where v is not null and b is not null and (e is null or e > b) and s is not null and f is not null and t is not null qualify row_number() over (partition by s, f, t, b order by det_id desc) = 1),
cut as (select *, least(e, lead(b) over w) as e2 from one window w as (partition by s, f, t order by b)),
mark as (select *, case when lag(v) over w = v and lag(e2) over w = b then 0 else 1 end as new from cut window w as (partition by s, f, t order by b)),
grp as (select *, sum(new) over (partition by s, f, t order by b rows unbounded preceding) as g from mark),
ver as (select s, f, t, any_value(v) as v, min(b) as b, case when count(e2) = count(*) then max(e2) end as e from grp group by s, f, t, g)
select s as sample_key, f as field_name, t as src_track, v as version_value, x.release_id as valid_from, coalesce(y.release_id, '') as valid_to from ver join rel x on x.k = ver.b left join rel y on y.k = ver.e""",
}
