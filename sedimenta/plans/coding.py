"""Queries of the code books, parsers and guards over the attribute table, each with its SQL where the other engine can state it."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import codes as C
from sedimenta.functions import texts as T
from sedimenta.functions.keys import folded, normal_key
from sedimenta.functions.times import keep
from sedimenta.functions.quantities import dimension, parse_quantity, to_common, unit_of
from sedimenta.operators import eav
from sedimenta.operators.dispatch import apply_field_map
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()

# Which keys of the test tables each book reads.
KEYS = {
    "delivery": ["delivery_mode", "mode_of_delivery", "vaginal_csection"],
    "feeding": ["feeding_type", "host_diet"],
    "sex": ["sex", "host_sex"],
    "nec": ["host_disease", "health_status"],
    "preterm": ["gestational_age", "health_status"],
}
A = "(select attr_id, coalesce(attr_key_norm, trim(regexp_replace(lower(attr_key), '[^a-z0-9]+', '_', 'g'), '_')) as k, value from sample_attributes_new)"


def _attributes(spark, d):
    return table(spark, d, "sample_attributes_new").select("attr_id", F.coalesce("attr_key_norm", normal_key(F.col("attr_key"))).alias("k"), "value")


def _book_sql(name: str, keys: list[str]) -> str:
    code, note = C.as_sql("k", "value", C.BOOKS[name])
    return f"select attr_id, '{name}' as book, {code} as code, {note} as note from {A} where k in ({', '.join(repr(k) for k in keys)})"


@query(" union all ".join(_book_sql(n, ks) for n, ks in KEYS.items()))
def code_books(spark, d):
    """Categorical values to codes by the book of their key."""
    a, out = _attributes(spark, d), None
    for name, keys in KEYS.items():
        c = C.coded(F.col("k"), F.col("value"), C.BOOKS[name])
        one = a.where(F.col("k").isin(*keys)).withColumn("c", c).select("attr_id", F.lit(name).alias("book"), "c.code", "c.note")
        out = one if out is None else out.unionByName(one)
    return out


LIFESTYLE = ["smoking", "diet", "medication"]


@query("select k, value, count(*) as n, " + ", ".join(f"{C.as_sql('k', 'value', C.BOOKS[b])[0]} as {b}, {C.as_sql('k', 'value', C.BOOKS[b])[1]} as {b}_note" for b in LIFESTYLE) + f" from {A} group by k, value")
def lifestyle_codes(spark, d):
    """Smoking, diet and medication rules on each distinct (key, value), with its number of rows."""
    x = _attributes(spark, d).groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"))
    for b in LIFESTYLE:
        x = x.withColumn(b, C.coded(F.col("k"), F.col("value"), C.BOOKS[b]))
    return x.select("k", "value", "n", *[c for b in LIFESTYLE for c in (F.col(f"{b}.code").alias(b), F.col(f"{b}.note").alias(f"{b}_note"))])


@query(
    f"""select k, value, {C.as_sql("k", "value", C.MULTIPLE_BIRTH)[0]} as birth, {C.as_sql("k", "value", C.SIBLING)[0]} as sibling, case when len(parts) > 1 and not regexp_matches(parts[1], '[0-9]') and not regexp_matches(lower(sub), '{C.INSTITUTIONS}') then sub end as place,
case when lower(trim(regexp_replace(value, '[\\s ]+', ' ', 'g'))) in ({", ".join(repr(x) for x in C.SETTLEMENTS)}) then lower(trim(regexp_replace(value, '[\\s ]+', ' ', 'g'))) end as settlement from (select *, array_to_string(list_reverse(parts[2:100]), ', ') as sub from
(select distinct k, value, list_filter(list_transform(string_split(regexp_replace(value, '[\\s ]+', ' ', 'g'), ':'), lambda x: trim(x)), lambda x: x <> '') as parts from {A}))"""
)
def extension_fields(spark, d):
    """Multiple birth, siblings, place below the country and settlement of each distinct (key, value)."""
    x = _attributes(spark, d).select("k", "value").distinct()
    v = F.col("value")
    return x.select(
        "k", "value", C.coded(F.col("k"), v, C.MULTIPLE_BIRTH)["code"].alias("birth"), C.coded(F.col("k"), v, C.SIBLING)["code"].alias("sibling"), C.sub_national(v).alias("place"), C.settlement(v).alias("settlement")
    )


# Short forms of places.
SHORT_PLACES = {"usa": "united states of america", "uk": "united kingdom", "gbr": "united kingdom", "deu": "germany", "fra": "france", "nld": "netherlands", "jpn": "japan", "chn": "china"}
SHORT_SQL = "case t " + " ".join(f"when '{k}' then '{v}'" for k, v in SHORT_PLACES.items()) + " else '' end"


@query(
    f"""with a as (select study_accession, attr_id, value from sample_attributes_new where attr_key_norm in ('geo_loc_name', 'country') and value is not null),
m as (select study_accession, arg_min(v, (-n, v)) as place from (select study_accession, lower(trim(split_part(value, ':', 1))) as v, count(*) as n from a group by 1, 2) group by 1),
x as (select attr_id, lower(value) as raw, place, list_filter(regexp_split_to_array(place, '[^a-z0-9À-￿]+'), lambda w: w <> '') as ws,
list_filter(regexp_split_to_array(lower(value), '[^a-z0-9À-￿]+'), lambda w: w <> '') as ts from a join m on m.study_accession = a.study_accession)
select attr_id, place, len(list_filter(ws, lambda w: not (contains(raw, w) or len(list_filter(ts, lambda t: list_contains(string_split({SHORT_SQL}, ' '), w) or 1 - levenshtein(w, t) / greatest(length(w), length(t), 1) >= 0.5)) > 0))) = 0 as valid from x"""
)
def place_guard(spark, d):
    """Whether the commonest place of a study is covered by the raw place of each of its rows."""
    a = table(spark, d, "sample_attributes_new").where("attr_key_norm in ('geo_loc_name', 'country') and value is not null").select("study_accession", "attr_id", "value")
    n = a.groupBy("study_accession", F.lower(F.trim(F.substring_index("value", ":", 1))).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    m = n.groupBy(F.col("study_accession").alias("s")).agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("place"))
    j = a.join(m, F.col("study_accession") == F.col("s"))
    return j.select("attr_id", "place", C.place_valid(F.col("value"), F.col("place"), SHORT_PLACES).alias("valid"))


@query()
def dispatch(spark, d):
    """Every attribute row through the parser its key has in the field map, accepted or rejected with a note."""
    return apply_field_map(eav.attributes(table(spark, d, "sample_attributes_new"), table(spark, d, "attribute_field_map")))


def _amounts(spark, d, dim: str):
    rows = eav.attributes(table(spark, d, "sample_attributes_new"), table(spark, d, "attribute_field_map")).where(dimension(F.col("parser")) == dim)
    return keep(rows, "x", F.struct(parse_quantity(F.col("value"), F.lit(dim)).alias("q"))).select("*", "x.q")


@query()
def parse_age(spark, d):
    """Ages and gestational ages in days from the text of every such row, its own unit or the map's default."""
    u = F.coalesce(F.col("q.unit"), unit_of(F.col("unit_default"), F.lit("time")))
    return _amounts(spark, d, "time").select("attr_id", F.round(to_common(F.col("q"), u, F.lit("time")), 6).alias("days"))


@query()
def parse_weight(spark, d):
    """Weights in grams from the text of every such row, its own unit or the map's default; a bare number below 10 is kilograms."""
    bare = F.col("q.unit").isNull() & (F.col("q.amount") < 10)
    u = F.coalesce(F.col("q.unit"), F.when(bare, "kg"), unit_of(F.col("unit_default"), F.lit("mass")))
    return _amounts(spark, d, "mass").select("attr_id", F.round(to_common(F.col("q"), u, F.lit("mass")), 4).alias("grams"))


DAY = r"^(\d{4})(?:[-/](\d{1,2}))?(?:[-/](\d{1,2}))?(?:[t ].*)?$"
DATES = """(select 'study_meta' as src, meta_id as row_id, lower(trim(first_public)) as s from study_meta union all select 'sample_attributes_new', attr_id, lower(trim(value)) from sample_attributes_new
where attr_key_norm in ('collection_date', 'collection_timestamp', 'sampling_time'))"""


@query(
    f"""with x as (select src, row_id, s, regexp_extract(s, '{DAY}', 1) as y, regexp_extract(s, '{DAY}', 2) as m, regexp_extract(s, '{DAY}', 3) as d from {DATES}),
t as (select *, concat_ws('-', y, case when m <> '' then lpad(m, 2, '0') end, case when d <> '' then lpad(d, 2, '0') end) as txt from x)
select src, row_id, case when y <> '' and try_cast(y as int) between 1980 and 2026 and (m = '' or try_cast(m as int) between 1 and 12) and (d = '' or try_cast(txt as date) is not null) then txt end as day from t"""
)
def parse_date(spark, d):
    """Partial dates of every publication and sampling time."""
    m = table(spark, d, "study_meta").select(F.lit("study_meta").alias("src"), F.col("meta_id").alias("row_id"), F.col("first_public").alias("s"))
    a = table(spark, d, "sample_attributes_new").where("attr_key_norm in ('collection_date', 'collection_timestamp', 'sampling_time')")
    rows = m.unionByName(a.select(F.lit("sample_attributes_new").alias("src"), F.col("attr_id").alias("row_id"), F.col("value").alias("s")))
    return rows.select("src", "row_id", T.partial_date(F.col("s"), 2026).alias("day"))


@query()
def parse_lat_lon(spark, d):
    """Coordinates, from every attribute value."""
    lat, lon = T.lat_lon(F.col("value"))
    return table(spark, d, "sample_attributes_new").select("attr_id", lat.alias("lat"), lon.alias("lon"))


NUM = r"^[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]{1,3})?$"


@query(f"select attr_id, case when x % 1 = 0 and x between 1 and 7 then x::int end as scale, x as num from (select attr_id, case when regexp_matches(trim(value), '{NUM}') then try_cast(trim(value) as double) end as x from sample_attributes_new)")
def int_scale(spark, d):
    """Whole numbers in a range; numeric coercion of every value."""
    return table(spark, d, "sample_attributes_new").select("attr_id", T.int_scale(F.col("value"), 1, 7).alias("scale"), T.number(F.col("value")).alias("num"))


SUBJECT = r"(?:subj(?:ect)?|infant|baby|patient|inf|p|s)[ _.#-]?0*(\d{1,5})"


@query(
    rf"""with v as (select attr_id, lower(value) as s from {A} where k = 'sample_title' and value is not null), r as (select attr_id, s, regexp_extract(s, '{SUBJECT}', 1) as subj, regexp_replace(s, '{SUBJECT}', ' ', 'g') as rest from v),
q as (select *, regexp_extract(rest, '\b(?:t|visit|v)[ _.-]?(\d{{1,3}})\b', 1) as t, regexp_extract(rest, '(?:day|d|week|wk|w|month|mo|m)[ _.-]?(\d{{1,4}})\b', 1) as age, regexp_extract(rest, '\b(day|week|month)', 1) as unit from r)
select attr_id, try_cast(nullif(subj, '') as int) as subject_no, try_cast(nullif(t, '') as int) as timepoint, case when unit <> '' then try_cast(nullif(age, '') as int) end as age_n, nullif(unit, '') as age_unit,
regexp_matches(s, 'mother|maternal|mom\b|mum\b') as maternal from q"""
)
def parse_name(spark, d):
    """Subject, time point, age and maternal flag of every sample name."""
    v = _attributes(spark, d).where("k = 'sample_title' and value is not null")
    return v.select("attr_id", *[c.alias(n) for n, c in T.parse_name(F.col("value")).items()])


@query("""select k as "column", 'code' as form, avg(regexp_matches(v, '^[A-Za-z]{1,5}[-_.]?\\d{2,6}$')::int) as share, count(*) as n from (select k, trim(value) as v from """ + A + """ where k in ('host_subject_id', 'plate_well', 'lab_code', 'sample_title', 'geo_loc_name'))
where v <> '' group by 1 having avg(regexp_matches(v, '^(?:SAM[A-Z]{2}\\d+|[ESD]R[SRX]\\d{5,})$')::int) < 0.6 and share >= 0.6""")
def best_header(spark, d):
    """The id-like columns of a wide table of names and codes, best first."""
    a = _attributes(spark, d)
    keys = ["host_subject_id", "plate_well", "lab_code", "sample_title", "geo_loc_name"]
    wide = a.where(F.col("k").isin(*keys)).select("attr_id", *[F.when(F.col("k") == k, F.col("value")).alias(k) for k in keys])
    return T.best_id_header(wide, keys).where("form = 'code'")


@query(
    "with s as (select study_accession, min(study_title) as title, min(description) as description from study_meta group by 1) select study_accession, "
    + ", ".join(f"nullif(concat_ws(';', case when regexp_matches(lower(description), '{p}') then 'description' end, case when regexp_matches(lower(title), '{p}') then 'title' end), '') as {a}" for a, p in T.ASSAYS.items())
    + " from s"
)
def assay_tells(spark, d):
    """Assay tells of a study by labelled text source."""
    m = table(spark, d, "study_meta").groupBy("study_accession").agg(F.min("study_title").alias("title"), F.min("description").alias("description"))
    return m.select("study_accession", *[c.alias(n) for n, c in T.assay_tells({"title": F.col("title"), "description": F.col("description")}).items()])


@query(r"select doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '(?i)\b(?:UBERON|ENVO|MONDO|NCBITaxon)[:_][0-9]{4,8}\b'), lambda x: upper(replace(x, '_', ':'))))), ';') as ids from documents")
def ontology_ids(spark, d):
    """Ontology ids in texts."""
    return table(spark, d, "documents").select("doc_id", F.array_join(T.ontology_ids(F.col("text"), ["UBERON", "ENVO", "MONDO", "NCBITaxon"]), ";").alias("ids"))


@query(
    f"""with v as (select vocabulary, code, list_distinct(list(lower(trim(label))) || flatten(list(string_split(lower(coalesce(synonyms, '')), '|')))) as terms from vocab_terms group by 1, 2),
x as (select det_id, lower(trim(regexp_replace(field_value, '[\\s ]+', ' ', 'g'))) as t, lower(trim(regexp_replace(evidence_quote, '[\\s ]+', ' ', 'g'))) as r, lower(trim(regexp_replace(value_normalized, '[\\s ]+', ' ', 'g'))) as c,
lower(trim(regexp_replace(field_name, '[\\s ]+', ' ', 'g'))) as f from sample_determinations_all), j as (select x.*, v.code, v.terms from x left join v on v.vocabulary = x.f and lower(v.code) = x.c)
select det_id, case when code is null then 'not in vocabulary' when coalesce(t, '') = '' then 'no span' when coalesce(instr(r, t), 0) = 0 then 'no span'
when regexp_matches(substr(r, 1, instr(r, t)::bigint - 1), '\\b(?:{T.NEGATORS})(?:\\W+\\w+){{0,2}}\\W*$') then 'negated' when regexp_matches(t, '{T.HEDGES}') or regexp_matches(r, '{T.HEDGES}') then 'hedged'
when not (len(list_filter(terms, lambda y: trim(y) <> '' and contains(t, trim(y)))) > 0 or contains(t, replace(c, '_', ' '))) then 'no match term' end as problem from j"""
)
def output_guard(spark, d):
    """Determinations whose code is not in the vocabulary, or not carried by its span and quote, with the first reason."""
    terms = table(spark, d, "vocab_terms").groupBy(F.col("vocabulary").alias("f"), F.lower("code").alias("c")).agg(F.flatten(F.collect_set(F.split(F.concat_ws("|", "label", "synonyms"), r"\|"))).alias("terms"))
    x = table(spark, d, "sample_determinations_all").select("det_id", "field_value", "evidence_quote", folded(F.col("value_normalized")).alias("code"), folded(F.col("field_name")).alias("field"))
    j = x.join(eav.small(terms), (F.col("field") == F.col("f")) & (F.col("code") == F.col("c")), "left")
    return j.select("det_id", T.guard(F.col("code"), F.col("field_value"), F.col("evidence_quote"), F.col("c").isNotNull(), F.col("terms")).alias("problem"))


@query(
    "select det_id, case when not coalesce(" + " or ".join(f"starts_with(s, '{p}')" for p in T.SOURCES) + ", false) then 'source without label' when coalesce(trim(evidence_quote), '') = '' then 'no quote' "
    r"when len(regexp_split_to_array(trim(evidence_quote), '\s+')) > 12 then 'quote too long' when not coalesce(confidence between 0 and 1, false) then 'confidence out of range' "
    "when coalesce(trim(evidence_locator), '') = '' then 'no locator' end as problem from (select *, lower(trim(evidence_source)) as s from sample_determinations_all)"
)
def evidence_contract(spark, d):
    """The first breach of the evidence contract by each determination."""
    c = F.col
    t = table(spark, d, "sample_determinations_all")
    return t.select("det_id", T.evidence_problem(c("evidence_source"), c("evidence_quote"), c("confidence"), c("evidence_locator")).alias("problem"))
