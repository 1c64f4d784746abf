"""Subjects of samples: ids by precedence, roles, family links, composite ids, timelines, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.texts import ladder, parse_name
from sedimenta.operators.resolve import degenerate, timeline

# How mothers and infants are worded in ids and names.
MOTHER = r"(?i)\b(?:mother|mom|mum|maternal)\b|(?:^|[^a-z])(?:mo|mat)[-_ .]?\d"
INFANT = r"(?i)\b(?:infant|baby|child|neonate|newborn)\b|(?:^|[^a-z])(?:inf|ch|bb)[-_ .]?\d"
ROLE_TOKENS = r"(?i)mothers?|moms?|mums?|maternal|infants?|bab(?:y|ies)|child(?:ren)?|neonates?|newborns?|(?:^|[^a-z])(?:mo|mat|inf|ch|bb)(?=[-_ .]?\d)|[-_ .]"


def core_id(c: Column) -> Column:
    """An id without role words and signs, leading zeros dropped: what mother and infant share."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, ROLE_TOKENS, "")), r"^0+(?=[0-9a-z])", "")


def link_roles(df: DataFrame, group: str, entity: str, subject: str, role: str, family: str, most: int = 3) -> DataFrame:
    """(group, entity, ``linked``, ``basis``): mothers with the subjects of the infants of their group, by family id, else by core id.

    A link is accepted if it names one to ``most`` infants; ``linked`` is their sorted ``;`` list, ``basis`` the key that gave it. Infants are reduced to distinct subjects per key
    first, so a key is no longer than the infants that share it, and keys beyond ``most`` are dropped before anything is joined.
    """
    infants = df.where(F.col(role) == "infant").select(group, F.col(subject).alias("__s"), F.col(family).alias("__fam"), core_id(F.col(subject)).alias("__core")).where("__s is not null")

    def of(key: str) -> DataFrame:
        few = infants.where(f"{key} <> ''").groupBy(group, key).agg(F.count_distinct("__s").alias("__n")).where(F.col("__n") <= most)
        return infants.join(few, [group, key]).groupBy(group, key).agg(F.array_join(F.array_sort(F.collect_set("__s")), ";").alias(f"__l{key}"))

    mothers = df.where(F.col(role) == "mother").select(group, entity, F.col(family).alias("__fam"), core_id(F.col(subject)).alias("__core")).distinct()
    j = mothers.join(of("__fam"), [group, "__fam"], "left").join(of("__core"), [group, "__core"], "left")
    out = j.select(group, entity, F.coalesce("__l__fam", "__l__core").alias("linked"), F.when(F.col("__l__fam").isNotNull(), "family").when(F.col("__l__core").isNotNull(), "core").alias("basis"))
    return out.where("linked is not null")


def composite_ids(df: DataFrame, group: str, entity: str, family: str, member: str, name: str, existing: DataFrame, least: float = 0.5) -> DataFrame:
    """(group, entity, ``subject_id``): family and member attributes joined to one id, in the groups where that form is in use.

    A group qualifies if half of its composite ids match ids known for it (``existing``: group, id) and half stand in the record's name, signs apart.
    """
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    x = df.where(F.col(family).isNotNull() & F.col(member).isNotNull()).withColumn("subject_id", F.concat_ws("-", F.trim(family), F.trim(member)))
    known = existing.select(F.col(group).alias("__g"), bare(F.col("id")).alias("__id")).distinct().withColumn("__known", F.lit(1.0))
    j = x.join(known, (F.col(group) == F.col("__g")) & (bare(F.col("subject_id")) == F.col("__id")), "left")
    j = j.select(group, entity, "subject_id", F.coalesce("__known", F.lit(0.0)).alias("__known"), F.coalesce(bare(F.col(name)).contains(bare(F.col("subject_id"))), F.lit(False)).cast("double").alias("__named"))
    good = j.groupBy(group).agg(F.avg("__known").alias("k"), F.avg("__named").alias("n")).where((F.col("k") >= least) & (F.col("n") >= least))
    return j.join(good.select(group), group, "left_semi").select(group, entity, "subject_id")


def resolve_subjects(df: DataFrame, group: str, entity: str, ids: list[tuple[str, str]], name: str, age: str, order: str) -> DataFrame:
    """One row per entity: ``subject_id``, ``subject_source``, ``role``, ``is_degenerate``, ``position`` and ``basis`` on the subject's time line.

    ``ids`` lists (column, label) by precedence; without any the ordinal in the entity's name counts. An id shared by nearly a whole group is degenerate and taken away. The role is
    mother or infant as worded in id or name, infant below three years of ``age`` (days), else unknown. Positions follow ``age``, else ``order``. Entities repeated take one row.
    """
    parsed = parse_name(F.col(name))
    ordinal = F.when(parsed["subject_no"].isNotNull(), F.concat(F.lit("subject"), parsed["subject_no"].cast("string")))
    source = ladder([(F.trim(F.col(c)) != "", label) for c, label in ids] + [(ordinal.isNotNull(), "name")], None)
    subject = F.coalesce(*[F.when(F.trim(F.col(c)) != "", F.trim(F.col(c))) for c, _ in ids], ordinal)
    x = df.where(F.col(entity).isNotNull()).dropDuplicates([entity]).withColumn("subject_id", subject).withColumn("subject_source", source)
    text = F.concat_ws(" ", "subject_id", F.col(name))
    x = x.withColumn("role", ladder([(text.rlike(MOTHER), "mother"), (text.rlike(INFANT), "infant"), (F.col(age) < 1096, "infant")], "unknown"))
    x = degenerate(x, group, "subject_id")
    x = x.withColumn("subject_id", F.when(~F.col("is_degenerate"), F.col("subject_id"))).withColumn("subject_source", F.when(~F.col("is_degenerate"), F.col("subject_source")))
    x = x.withColumn("__key", F.coalesce(F.concat_ws("|", group, "subject_id", "role"), F.col(entity).cast("string")))
    x = x.withColumn("__key", F.when(F.col("subject_id").isNull(), F.concat(F.lit("entity|"), F.col(entity).cast("string"))).otherwise(F.col("__key")))
    t = timeline(x, "__key", [age, order])
    return t.select(group, entity, "subject_id", "subject_source", "role", "is_degenerate", "position", "basis", age)


def subject_summary(resolved: DataFrame, group: str, age: str) -> DataFrame:
    """(group, subject_id, role, ``samples``, ``first_age``, ``last_age``, ``is_longitudinal``) of resolved subjects."""
    g = resolved.where("subject_id is not null").groupBy(group, "subject_id", "role").agg(F.count(F.lit(1)).alias("samples"), F.min(age).alias("first_age"), F.max(age).alias("last_age"))
    return g.withColumn("is_longitudinal", (F.col("samples") > 1) & F.coalesce(F.col("last_age") > F.col("first_age"), F.lit(False)))
