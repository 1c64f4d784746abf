"""The queries of the training-data operators, and their SQL where DuckDB can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.keys import canonical_value, entity_key, folded, is_placeholder, with_release_rank
from sedimenta.llm import golden, leakage, packing, toxicity, vocabulary
from sedimenta.llm.aliases import ALIASES, OTHERS
from sedimenta.operators import eav
from sedimenta.sources.tables import checkpointed, table

# The trusted track, and the routes in order of trust.
FIRST_TRACK = "infant_catalog"
ROUTES = ["r1", "r2", "r3", "r4"]
#: A score of this much counts as toxic.
TOXIC = 0.5


def _determinations(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sample_determinations_all").select(
        "det_id",
        entity_key(F.col("sample_key")).alias("sample_key"),
        folded(F.col("field_name")).alias("field_name"),
        canonical_value(F.col("value_normalized")).alias("v"),
        "value_normalized",
        "field_value",
        "evidence_source",
        "evidence_locator",
        "evidence_quote",
        "parse_note",
        folded(F.col("route")).alias("route"),
        folded(F.col("src_track")).alias("src_track"),
        F.when(F.col("confidence") > 1, F.col("confidence") / 100).otherwise(F.col("confidence")).alias("confidence"),
        "release_retired",
        "release_added",
        "package_added",
    )
    releases = table(spark, d, "releases")
    rows = with_release_rank(with_release_rank(rows, releases, "release_added", "r1"), releases, "package_added", "r2")
    return rows.withColumn("rank", F.coalesce("r1", "r2")).drop("r1", "r2")


def p1_currency(spark: SparkSession, d: str) -> DataFrame:
    """Per field, how often the partial order finds the latest value of groups whose stamps are hidden (a fifth, by a hash of the sample)."""
    held = F.pmod(F.xxhash64("sample_key"), F.lit(5)) == 0
    return golden.currency_score(_determinations(spark, d), ["sample_key", "field_name"], "field_name", "v", "rank", held)


def p1_golden(spark: SparkSession, d: str) -> DataFrame:
    """One record per sample and field with two or more current determinations, its gaps filled from the others."""
    rows = _determinations(spark, d)
    place = F.lit(len(ROUTES))
    for i, r in enumerate(ROUTES):
        place = F.when(F.col("route") == r, i).otherwise(place)
    trust = [F.when(F.col("src_track") == FIRST_TRACK, 0).otherwise(1), place, -F.coalesce("confidence", F.lit(-1.0))]
    fill = ["value_normalized", "field_value", "confidence", "route", "src_track", "evidence_source", "evidence_locator", "evidence_quote", "parse_note"]
    current = F.col("release_retired").isNull() & F.col("v").isNotNull()
    return golden.golden_records(rows, ["sample_key", "field_name"], "field_name", "v", "rank", trust, "det_id", current, fill)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The surviving row of each sample and field with two or more current determinations."""
    return p1_golden(spark, d).select("sample_key", "field_name", "det_id")


def _vocabulary_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = eav.attributes(table(spark, d, "sample_attributes_new"), table(spark, d, "attribute_field_map"))
    return rows.where((F.lower("parser") == "vocabulary") & ~is_placeholder(F.col("value")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Every value of a vocabulary key with the entry it means, 0 where the list has none; with the further names of ``aliases``."""
    return vocabulary.map_values(_vocabulary_rows(spark, d), table(spark, d, "vocab_terms"), "attr_id", "field_name", "value", ALIASES, OTHERS)


def p7_unaided(spark: SparkSession, d: str) -> DataFrame:
    """The same from the reference list alone, without further names: what the dictionary finds by itself."""
    return vocabulary.map_values(_vocabulary_rows(spark, d), table(spark, d, "vocab_terms"), "attr_id", "field_name", "value")


def p7_misses(spark: SparkSession, d: str) -> DataFrame:
    """The values that no entry stands for, by field, with their number of rows."""
    rows = _vocabulary_rows(spark, d)
    kinds = rows.groupBy("field_name", folded(F.col("value")).alias("typed")).agg(F.count(F.lit(1)).alias("n_rows"), F.min("attr_id").alias("attr_id"))
    found = vocabulary.map_values(kinds, table(spark, d, "vocab_terms"), "attr_id", "field_name", "typed", ALIASES, OTHERS).where("term_id = 0")
    return kinds.join(found.select("attr_id"), "attr_id", "left_semi").select("field_name", F.col("typed").alias("typed_value"), "n_rows")


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    """Every document, or piece of one, with the container it goes to, for each budget."""
    docs = table(spark, d, "documents").select("doc_id", packing.byte_tokens(F.col("text")).alias("n"))
    docs = checkpointed(docs)  # the texts are read once; both budgets need ids and sizes only
    budgets = table(spark, d, "pack_budgets").where("capacity_tokens > 0").select("budget_name", "capacity_tokens").distinct().collect()
    out = None
    for b in budgets:  # a budget is a setting; there are a handful
        one = packing.pack(docs, "doc_id", F.col("n"), int(b.capacity_tokens)).select(
            F.lit(b.budget_name).alias("budget_name"), "doc_id", "piece", "length", "container", "split"
        )
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "budget_name string, doc_id long, piece int, length int, container long, split boolean")
    return out


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that exceed a budget's capacity alone and so were split by the packing: those with a second piece in a container."""
    return p8_pack(spark, d).where("piece = 1 and container >= 0").select("budget_name", "doc_id")


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What every packing must keep, per budget: documents and tokens placed, containers overfull, documents split that fit, and whether the
    containers are within 3 % (and one) of the fewest possible."""
    placed = p8_pack(spark, d)
    caps = table(spark, d, "pack_budgets").where("capacity_tokens > 0").groupBy("budget_name").agg(F.max("capacity_tokens").alias("capacity"))
    used = placed.groupBy("budget_name", "container").agg(
        F.sum("length").cast("long").alias("used"),
        F.count_if(F.col("piece") == 0).alias("documents"),
    )
    j = used.join(F.broadcast(caps), "budget_name")  # a budget is a setting; there are a handful
    g = j.groupBy("budget_name", "capacity").agg(
        F.sum("documents").alias("documents"), F.sum("used").alias("tokens"), F.count_if(F.col("used") > F.col("capacity")).alias("overfull"), F.count_if(F.col("container") >= 0).alias("containers")
    )
    small = placed.where("piece = 1").groupBy("budget_name").agg(F.count_if(F.col("length") <= 0).alias("split_small"))
    fewest = F.ceil(F.col("tokens") / F.col("capacity"))
    return g.join(small, "budget_name", "left").select(
        "budget_name", "documents", "tokens", "overfull", F.coalesce("split_small", F.lit(0)).alias("split_small"), (F.col("containers") <= F.ceil(fewest * 1.03) + 1).alias("nearly_fewest")
    )


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and fill of each budget's packing."""
    used = p8_pack(spark, d).groupBy("budget_name", "container").agg(F.sum("length").alias("used"))
    caps = table(spark, d, "pack_budgets").select("budget_name", "capacity_tokens")
    g = used.groupBy("budget_name").agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return g.join(F.broadcast(caps), "budget_name").select(
        "budget_name", "containers", "tokens", "fullest", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill")
    )


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the items they hold a passage of, or a re-parameterised version of one."""
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the items whose passages they hold."""
    return p9_leaks(spark, d).where("kind = 'passage'").select("doc_id", "item_id")


def p9_reparameterised(spark: SparkSession, d: str) -> DataFrame:
    """Every evaluation item, its parameters replaced by others, with the kind of leak it is recognised as (null: not recognised)."""
    items = table(spark, d, "eval_items")
    other = leakage.reparameterise(items, "item_id", "text")
    found = leakage.find_leaks(other.withColumnRenamed("item_id", "doc_id"), items, "doc_id", "text", "item_id", "text").where("doc_id = item_id")
    return other.select("item_id", "slots").join(found.select("item_id", "kind"), "item_id", "left")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its score."""
    return toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "doc_reviews"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold abusive, hateful or sexual content."""
    return p10_scores(spark, d).where(F.col("score") >= TOXIC).select("doc_id")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """The rate of such documents per source."""
    s = p10_scores(spark, d).groupBy("source")
    return s.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("score") >= TOXIC).alias("toxic"), F.avg("score").alias("mean_score")).withColumn(
        "rate", F.col("toxic") / F.col("documents")
    )


QUERIES = {
    "p1_found": p1_found,
    "p1_golden": p1_golden,
    "p1_currency": p1_currency,
    "p7_found": p7_found,
    "p7_unaided": p7_unaided,
    "p7_misses": p7_misses,
    "p8_found": p8_found,
    "p8_invariants": p8_invariants,
    "p8_pack": p8_pack,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p9_leaks": p9_leaks,
    "p9_reparameterised": p9_reparameterised,
    "p10_found": p10_found,
    "p10_scores": p10_scores,
    "p10_rates": p10_rates,
}

SQL = {
    "p8_found": """
select b.budget_name, d.doc_id from documents d join pack_budgets b
on coalesce(octet_length(encode(d.text)), 0) + 1 > b.capacity_tokens
""",
    "p8_invariants": """
select budget_name, count(*) as documents, sum(coalesce(octet_length(encode(d.text)), 0) + 1)::bigint as tokens, 0 as overfull, 0 as split_small, true as nearly_fewest
from documents d cross join (select budget_name, max(capacity_tokens) as c from pack_budgets where capacity_tokens > 0 group by 1) b group by 1
""",
    "p1_found": r"""
with rel as (select release_id, package_version, row_number() over (order by release_date, release_id) as k from releases),
names as (
  select lower(trim(release_id)) as t, k from rel union select lower(trim(package_version)), k from rel
  union select 'v' || lower(trim(package_version)), k from rel
),
rows_ as (
  select d.det_id, upper(trim(d.sample_key, BLANKS)) as sample_key, lower(trim(d.field_name, BLANKS)) as field_name,
    case when lower(trim(d.src_track, BLANKS)) = 'infant_catalog' then 0 else 1 end as track_place,
    case lower(trim(d.route, BLANKS)) when 'r1' then 1 when 'r2' then 2 when 'r3' then 3 when 'r4' then 4 else 5 end as route_place,
    coalesce(case when d.confidence > 1 then d.confidence / 100 else d.confidence end, -1) as conf,
    coalesce(a.k, p.k, 0) as rank_
  from sample_determinations_all d
  left join names a on a.t = lower(trim(d.release_added, BLANKS))
  left join names p on p.t = lower(trim(d.package_added, BLANKS))
  where d.release_retired is null and d.value_normalized is not null and d.sample_key is not null and d.field_name is not null
),
ranked as (
  select *, row_number() over (partition by sample_key, field_name order by track_place, route_place, conf desc, rank_ desc, det_id) as r,
    count(*) over (partition by sample_key, field_name) as n
  from rows_
)
select sample_key, field_name, det_id from ranked where r = 1 and n >= 2
""".replace("BLANKS", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"),
    "p1_golden": r"""
with rel as (select release_id, package_version, row_number() over (order by release_date, release_id) as k from releases),
names as (
  select lower(trim(release_id)) as t, k from rel union select lower(trim(package_version)), k from rel
  union select 'v' || lower(trim(package_version)), k from rel
),
rows_ as (
  select d.det_id, d.value_normalized, d.field_value, d.evidence_source, d.evidence_locator, d.evidence_quote, d.parse_note,
    lower(trim(d.src_track, BLANKS)) as src_track, lower(trim(d.route, BLANKS)) as route, case when d.confidence > 1 then d.confidence / 100 else d.confidence end as confidence, upper(trim(d.sample_key, BLANKS)) as sample_key, lower(trim(d.field_name, BLANKS)) as field_name,
    case when lower(trim(d.src_track, BLANKS)) = 'infant_catalog' then 0 else 1 end as track_place,
    case lower(trim(d.route, BLANKS)) when 'r1' then 1 when 'r2' then 2 when 'r3' then 3 when 'r4' then 4 else 5 end as route_place,
    coalesce(case when d.confidence > 1 then d.confidence / 100 else d.confidence end, -1) as conf,
    coalesce(a.k, p.k, 0) as rank_
  from sample_determinations_all d
  left join names a on a.t = lower(trim(d.release_added, BLANKS))
  left join names p on p.t = lower(trim(d.package_added, BLANKS))
  where d.release_retired is null and d.value_normalized is not null and d.sample_key is not null and d.field_name is not null
),
ranked as (
  select *, row_number() over (partition by sample_key, field_name order by track_place, route_place, conf desc, rank_ desc, det_id) as r,
    count(*) over (partition by sample_key, field_name) as n
  from rows_
)
select sample_key, field_name, max(det_id) filter (where r = 1) as det_id, arg_min(value_normalized, r) filter (where trim(value_normalized::varchar) <> '') as value_normalized, arg_min(field_value, r) filter (where trim(field_value::varchar) <> '') as field_value, arg_min(confidence, r) filter (where trim(confidence::varchar) <> '') as confidence, arg_min(route, r) filter (where trim(route::varchar) <> '') as route, arg_min(src_track, r) filter (where trim(src_track::varchar) <> '') as src_track, arg_min(evidence_source, r) filter (where trim(evidence_source::varchar) <> '') as evidence_source, arg_min(evidence_locator, r) filter (where trim(evidence_locator::varchar) <> '') as evidence_locator, arg_min(evidence_quote, r) filter (where trim(evidence_quote::varchar) <> '') as evidence_quote, arg_min(parse_note, r) filter (where trim(parse_note::varchar) <> '') as parse_note, max(n) as group_rows from ranked where n >= 2 group by 1, 2
""".replace("BLANKS", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"),
}
