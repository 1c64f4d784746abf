"""Foreign tables joined to entities: attribute index, composite keys, gates, column extraction, matrix detection, run re-keying, mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.quantities import parse_quantity, to_common, unit_of
from sedimenta.functions.texts import ladder
from sedimenta.functions.times import keep, let
from sedimenta.operators.joins import id_forms
from sedimenta.operators.resolve import best_row

#: Numeric columns beyond this, without a header that tells of metadata, make a table a matrix of measurements.
MATRIX_COLUMNS = 200
# Words of headers that tell of metadata.
METADATA_WORDS = r"(?i)\b(?:sample|subject|patient|age|sex|gender|date|time ?point|visit|group|diet|delivery|country|host)\b"


def is_matrix(cells: DataFrame, table: str, header: str, value: str, row: str, first: int = 50) -> DataFrame:
    """(table, ``numeric_columns``, ``metadata_columns``, ``is_matrix``) of raw tables in long form (one row per cell).

    A column is numeric if nine of ten of its filled cells in the ``first`` rows are numbers. A table with more than ``MATRIX_COLUMNS`` numeric columns and no
    metadata header is a matrix of measurements.
    """
    c = cells.where((F.col(row) < first) & (F.trim(F.col(value)) != ""))
    per = c.groupBy(table, header).agg(F.avg(F.trim(F.col(value)).rlike(r"^[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?$").cast("double")).alias("__n"))
    g = per.groupBy(table).agg(F.count_if(F.col("__n") >= 0.9).alias("numeric_columns"), F.count_if(F.col(header).rlike(METADATA_WORDS)).alias("metadata_columns"))
    return g.withColumn("is_matrix", (F.col("numeric_columns") > MATRIX_COLUMNS) & (F.col("metadata_columns") == 0))


def _forms(df: DataFrame, value: str, keep: list[str]) -> DataFrame:
    f = [F.struct(F.lit(i).alias("level_no"), F.lit(n).alias("level"), x.alias("form")) for i, (n, x) in enumerate(id_forms(F.col(value)))]
    return df.withColumn("__x", F.explode(F.array(*f))).select(*keep, "__x.*").where("form <> ''")


def attribute_index(attributes: DataFrame, group: str, entity: str, key: str, value: str) -> DataFrame:
    """(group, key, level_no, level, form, ``target``, ``entities``): every attribute value of a group by normal form, where it can serve as an identifier.

    A key serves if it has two values or more and is not made of short numbers only. A form that stands for several entities under one key has no single
    ``target`` (null) and ``entities`` counts them: a subject's own values. Built per distinct value; an exploded row per normal form.
    """
    a = attributes.where(F.col(entity).isNotNull() & (F.trim(F.col(value)) != "")).select(group, entity, key, value).distinct()
    stats = a.groupBy(group, key).agg(F.count_distinct(value).alias("__d"), F.min(F.trim(F.col(value)).rlike(r"^[0-9]{1,3}$").cast("int")).alias("__short"))
    usable = a.join(stats.where("__d >= 2 and __short = 0").select(group, key), [group, key], "left_semi")
    f = _forms(usable, value, [group, entity, key])
    g = f.groupBy(group, key, "level_no", "level", "form").agg(F.count_distinct(entity).alias("entities"), F.min(entity).alias("target"))
    return g.withColumn("target", F.when(F.col("entities") == 1, F.col("target")))


def column_attempts(cells: DataFrame, index: DataFrame, group: str, table: str, header: str, row: str, value: str, key: str) -> DataFrame:
    """(table, group, header, key, level_no, level, ``n``, ``hits``, ``targets``, ``rate``, ``subject_level``): how each column of a table fares as a key of the group's attributes.

    A cell hits through a key and level if its form is in the index; ``subject_level`` attempts hit forms of several entities. One equi-join on (group, level, form).
    """
    filled = cells.where(F.trim(F.col(value)) != "")
    n = filled.groupBy(table, group, header).agg(F.count(F.lit(1)).alias("n"))
    f = _forms(filled, value, [table, group, header, row])
    j = f.join(index, [group, "level_no", "level", "form"])
    g = j.groupBy(table, group, header, key, "level_no", "level", F.col("target").isNull().alias("subject_level")).agg(F.count_distinct(row).alias("hits"), F.count_distinct("target").alias("targets"))
    return g.join(n, [table, group, header]).withColumn("rate", F.col("hits") / F.col("n"))


def choose_attempt(attempts: DataFrame, tables: DataFrame, table: str, header: str, rows: str, largest: int = 100_000) -> DataFrame:
    """(table, ``status``, header, level, hits, rate): the best way to join each table.

    Accepted is an attempt that hits half of the rows and three at least (``mapped``), or twenty rows exactly and one to one (``mapped_pooled``). Accepted ones are ordered by
    entity before subject level, own before pooled, exact before normalised, then rate and hits. A table without one is ``below_gate`` (its best attempt is shown), ``no_match``,
    ``too_few_rows`` (fewer than three) or ``too_large``. Ties by header.
    """
    own = (F.col("rate") >= 0.5) & (F.col("hits") >= 3)
    pooled = ~F.col("subject_level") & (F.col("level") == "exact") & (F.col("hits") >= 20) & (F.col("targets") == F.col("hits"))
    a = attempts.withColumn("__own", own).withColumn("__ok", own | pooled)
    exact = F.when(F.col("level").isin("exact", "casefold"), 0).otherwise(1)
    order = [~F.col("__ok"), F.when(F.col("__ok"), F.col("subject_level").cast("int")).otherwise(0), ~F.col("__own"), F.when(F.col("__ok"), exact).otherwise(0), -F.col("rate"), -F.col("hits"), F.col(header), F.col("level_no")]
    best = best_row(a.select(table, header, "level", "level_no", "hits", "rate", "__ok", "__own", *[o.alias(f"__o{i}") for i, o in enumerate(order)]), [table], [F.col(f"__o{i}") for i in range(len(order))])
    j = tables.select(table, rows).join(best, table, "left")
    status = ladder(
        [(F.col(rows) < 3, "too_few_rows"), (F.col(rows) > largest, "too_large"), (F.col("__own"), "mapped"), (F.col("__ok"), "mapped_pooled"), (F.col("hits") > 0, "below_gate")], "no_match"
    )
    return j.select(table, status.alias("status"), header, "level", F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("rate", F.lit(0.0)).alias("rate"))


def composite(hits: DataFrame, second: DataFrame, attributes: DataFrame, row: str, subject: str, entity: str, value: str) -> DataFrame:
    """(row, entity): subject-level hits narrowed by a second column to the one entity of the subject that has its value.

    ``hits`` is (row, subject), ``second`` (row, value), ``attributes`` (subject, entity, value). Values are compared without case and signs; rows for which no or several
    entities qualify are left out. Equi-joins only.
    """
    form = lambda c: F.regexp_replace(F.lower(F.trim(F.col(c))), "[^a-z0-9]", "")
    a = attributes.select(subject, entity, form(value).alias("__f")).where("__f <> ''").distinct()
    s = second.select(row, form(value).alias("__f")).where("__f <> ''").distinct()
    j = hits.select(row, subject).distinct().join(s, row).join(a, [subject, "__f"])
    return j.groupBy(row).agg(F.min(entity).alias(entity), F.count_distinct(entity).alias("__n")).where("__n = 1").drop("__n")


def extract_columns(cells: DataFrame, hits: DataFrame, columns: DataFrame, legend: DataFrame, table: str, row: str, header: str, value: str, entity: str) -> DataFrame:
    """(entity, ``field_name``, ``value_normalized``, ``confidence``, ``locator``): values of classified columns of gated tables.

    ``columns`` is (table, header, ``field_name``, ``dim``, ``unit``, ``lo``, ``hi``, ``is_static``); ``hits`` (table, row, entity, ``subject_level``) may give a row several entities; ``legend`` (table,
    header, value, ``meaning``) translates codes first. Columns with a dimension are parsed with their own or the column's unit and kept within [lo, hi]; ranges and
    groups are rejected. Subject-level hits fill static fields only. Confidence is 0.9, 0.8 at subject level.
    """
    c = cells.join(F.broadcast(columns), [table, header])  # classified columns: a handful per table
    leg = legend.groupBy(table, header, F.lower(F.trim(F.col(value))).alias("__v")).agg(F.min("meaning").alias("__m"))
    c = c.withColumn("__v", F.lower(F.trim(F.col(value)))).join(leg, [table, header, "__v"], "left")
    one = ~F.col(value).rlike(r"[0-9]\s*(?:-|–|to|/)\s*[0-9]|[;|]")
    dim, unit = F.col("dim"), unit_of(F.col("unit"), F.col("dim"))
    amount = let(F.struct(F.when(one, parse_quantity(F.col(value), dim)).alias("q")), lambda x: F.round(to_common(x["q"], F.coalesce(x["q"]["unit"], unit), dim), 4))
    inside = let(amount, lambda x: F.when((x >= F.coalesce(F.col("lo"), x)) & (x <= F.coalesce(F.col("hi"), x)), x))
    text = F.coalesce("__m", F.when(F.col("__v") != "", F.col("__v")))
    c = keep(c, "value_normalized", F.when(dim.isNotNull(), inside.cast("string")).otherwise(text))
    j = c.join(hits.select(table, row, entity, "subject_level"), [table, row]).where("is_static or not subject_level")
    locator = F.concat_ws("/", F.col(table), F.col(header), F.col(row).cast("string"))
    return j.select(entity, "field_name", "value_normalized", F.when(F.col("subject_level"), 0.8).otherwise(0.9).alias("confidence"), locator.alias("locator"))


def rekey_runs(accepted: DataFrame, runs: DataFrame, legend: DataFrame, entity: str, run: str, foreign: str) -> DataFrame:
    """(run, ``field_name``, ``value_normalized``): accepted rows of an entity moved to those of its runs that their foreign id names.

    ``accepted`` is (entity, foreign id, ``field_name``, ``raw``); ``runs`` (entity, run, alias). The strictest normal form that names exactly one run of the entity decides; ``legend`` (``field_name``,
    ``raw``, ``meaning``) holds what values were learnt to mean. Rows whose id names no single run stay out.
    """
    r = _forms(runs.where("alias is not null"), "alias", [entity, run]).groupBy(entity, "level_no", "form").agg(F.min(run).alias(run), F.count_distinct(run).alias("__n")).where("__n = 1")
    a = _forms(accepted.select(entity, foreign).distinct(), foreign, [entity, foreign])
    m = a.join(r, [entity, "level_no", "form"]).groupBy(entity, foreign).agg(F.min_by(run, "level_no").alias(run))
    leg = legend.groupBy("field_name", "raw").agg(F.min("meaning").alias("__m"))
    j = accepted.join(m, [entity, foreign]).join(leg, ["field_name", "raw"], "left")
    return j.select(run, "field_name", F.coalesce("__m", "raw").alias("value_normalized")).distinct()


# Wording of own and of reused data, and the sections in which authors state their own.
OWN = r"(?i)\b(?:we|our|this study)\b[^.]{0,80}\b(?:deposited|submitted|generated|sequenced|uploaded)|have been deposited|are available (?:at|in|under|from)"
REUSE = r"(?i)\b(?:previously published|publicly available|downloaded|retrieved|obtained from|re-?analy[sz]ed|reused)\b"
OWN_SECTIONS = ["data_availability", "methods"]


def link_mentions(mentions: DataFrame, studies: DataFrame, paper: str, contexts: int = 3, alike: float = 0.6) -> DataFrame:
    """(paper, study_accession, ``n_mentions``, ``accessions``, ``sections``, ``contexts``, ``relation``): accession mentions of papers mapped to studies.

    ``mentions`` is (paper, accession, section, context), ``studies`` (accession, study_accession). Up to ``contexts`` contexts are kept, own sections first, each sharing less than
    ``alike`` of its words (Jaccard) with those before. ``relation``: ``own`` where an own section has own wording and none of reuse, ``reused`` where reuse is worded and ownership is not,
    ``contested`` where both are or several studies are owned in wording alone, else ``cited``. The contexts of a pair are bounded by the paper's mentions.
    """
    m = mentions.join(studies.select("accession", "study_accession").distinct(), "accession")
    place = F.when(F.col("section") == "data_availability", 0).when(F.col("section") == "methods", 1).otherwise(2)
    flag = lambda p: F.bool_or(F.coalesce(F.col("context").rlike(p), F.lit(False)))
    g = m.groupBy(paper, "study_accession").agg(
        F.count(F.lit(1)).alias("n_mentions"),
        F.array_join(F.array_sort(F.collect_set("accession")), ";").alias("accessions"),
        F.array_join(F.array_sort(F.collect_set("section")), ";").alias("sections"),
        flag(OWN).alias("own"),
        flag(REUSE).alias("reuse"),
        F.bool_or(F.col("section").isin(*OWN_SECTIONS)).alias("own_section"),
        F.array_sort(F.collect_set(F.struct(place.alias("p"), F.col("context").alias("c")))).alias("__c"),
    )
    ws = lambda c: F.array_distinct(F.split(F.lower(c), r"\s+"))
    overlap = lambda a, b: F.size(F.array_intersect(ws(a), ws(b))) / F.greatest(F.size(F.array_union(ws(a), ws(b))), F.lit(1))
    text = F.filter(F.transform("__c", lambda x: x["c"]), lambda c: c.isNotNull())
    pick = F.aggregate(
        text,
        F.array().cast("array<string>"),
        lambda acc, c: F.when((F.size(acc) < contexts) & F.forall(acc, lambda k: overlap(c, k) < alike), F.array_append(acc, c)).otherwise(acc),
    )
    relation = ladder([(F.col("own") & F.col("reuse"), "contested"), (F.col("own") & F.col("own_section"), "own"), (F.col("reuse"), "reused"), (F.col("own"), "contested")], "cited")
    return g.select(paper, "study_accession", "n_mentions", "accessions", "sections", F.array_join(pick, " || ").alias("contexts"), relation.alias("relation"))
