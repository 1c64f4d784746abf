"""Queries of the text and value functions on documents, events and inline texts, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import texts as T
from sedimenta.functions.keys import PLACEHOLDER_PATTERN, is_placeholder, normal_key
from sedimenta.operators.eav import small
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()


@query(r"""select doc_id, regexp_matches(regexp_replace(text, '(?i:\bmaternal[\s-]+antibiotics?\b)', ' ', 'g'), '(?i:\bantibiotics?\b)|\bprobiotic\w*') as has_it from documents where text is not null""")
def term_match(spark, d):
    """H1, H2: vocabulary terms outside negative phrases."""
    t = table(spark, d, "documents").where("text is not null")
    return t.select("doc_id", T.has_term(F.col("text"), ["antibiotic", "probiotic*"], ["maternal antibiotic"]).alias("has_it"))


NEG = r"(?i:\b(?:no|not|without|never|non|free of|absence of|denies|negative for)\b(?:\W+\w+){0,2}?\W+)(?:(?i:\bconsents?\b)|(?i:\binterests?\b))|(?:(?i:\bconsents?\b)|(?i:\binterests?\b))(?i:[\s-]free\b)"


@query(f"select doc_id, regexp_matches(regexp_replace(text, '{NEG}', ' ', 'g'), '(?i:\\bconsents?\\b)|(?i:\\binterests?\\b)') as affirmed from documents where text is not null")
def negated_match(spark, d):
    """H3: a term that no negator precedes within three words."""
    t = table(spark, d, "documents").where("text is not null")
    return t.select("doc_id", T.affirmed(F.col("text"), ["consent", "interest"]).alias("affirmed"))


@query(r"""select doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '(?i)\b(?:stool|vaginal|rectal|milk)\b'), lambda x: lower(x)))), ';') as terms,
len(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '(?i)\b(?:stool|vaginal|rectal|milk)\b'), lambda x: lower(x)))) as score from documents""")
def term_score(spark, d):
    """H4: sorted distinct terms and their number."""
    f = T.found_terms(F.col("text"), r"(?i)\b(?:stool|vaginal|rectal|milk)\b")
    return table(spark, d, "documents").select("doc_id", F.array_join(f, ";").alias("terms"), F.size(f).alias("score"))


@query(r"""with s as (select study_accession, sum(len(regexp_extract_all(coalesce(text, ''), '(?i)infant|mother|child'))) as pos, sum(len(regexp_extract_all(coalesce(text, ''), '(?i)mouse|mice|soil|water')))
as neg from documents where study_accession is not null group by 1) select study_accession, pos, neg, case when pos >= 3 and neg = 0 then 'A' when pos > neg then 'B' when pos = 0 and neg = 0 then 'none' else 'C' end as rule,
pos > 0 and neg > 0 as ambiguous from s""")
def signal_rule(spark, d):
    """H5: a signal from term scores of all texts of a study."""
    n = lambda p: F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(p)))
    s = table(spark, d, "documents").where("study_accession is not null").groupBy("study_accession").agg(n("(?i)infant|mother|child").alias("pos"), n("(?i)mouse|mice|soil|water").alias("neg"))
    rule = T.ladder([((F.col("pos") >= 3) & (F.col("neg") == 0), "A"), (F.col("pos") > F.col("neg"), "B"), ((F.col("pos") == 0) & (F.col("neg") == 0), "none")], "C")
    return s.select("study_accession", "pos", "neg", rule.alias("rule"), ((F.col("pos") > 0) & (F.col("neg") > 0)).alias("ambiguous"))


@query(r"""select doc_id, array_to_string(list_slice(regexp_split_to_array(trim(regexp_extract(text, '((?:\S+\s+){0,3}\S*(?:antibiotic)\S*(?:\s+\S+){0,3})', 1)), '\s+'), 1, 12), ' ') as quote
from documents where text like '%antibiotic%'""")
def quote12(spark, d):
    """H6: a short quote around the first match."""
    t = table(spark, d, "documents").where("text like '%antibiotic%'")
    return t.select("doc_id", T.quote_around(F.col("text"), "antibiotic").alias("quote"))


@query("""select term_id, string_agg(x, ',' order by i) as names, count(*) as n from (select term_id, trim(unnest(string_split(synonyms, '|'))) as x, unnest(range(1, 1 +
len(string_split(synonyms, '|')))) as i from vocab_terms where synonyms is not null) where x <> '' group by 1""")
def split_multi(spark, d):
    """H7: lists in several notations."""
    v = table(spark, d, "vocab_terms").where("synonyms is not null")
    m = T.split_multi(F.col("synonyms"))
    return v.select("term_id", F.array_join(m, ",").alias("names"), F.size(m).alias("n"))


@query("""select attr_id, trim(regexp_replace(lower(attr_key), '[^a-z0-9]+', '_', 'g'), '_') as k from sample_attributes_new""")
def norm_key(spark, d):
    """H9: key normal form."""
    return table(spark, d, "sample_attributes_new").select("attr_id", normal_key(F.col("attr_key")).alias("k"))


@query("select attr_id, trim(split_part(value, ':', 1)) as head from sample_attributes_new where attr_key_norm = 'geo_loc_name' and value is not null")
def split_prefix(spark, d):
    """The part before a colon."""
    return table(spark, d, "sample_attributes_new").where("attr_key_norm = 'geo_loc_name' and value is not null").select("attr_id", T.split_prefix(F.col("value")).alias("head"))


@query(r"""select doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\b(?:PRJ[A-Z]{2}\d+|[ESD]RP\d{5,})\b'))), ';') as study,
array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\b(?:SAM[A-Z]{2}\d+|[ESD]RS\d{5,})\b'))), ';') as sample from documents where text is not null""")
def mine_accessions(spark, d):
    """Accessions mentioned in texts."""
    m = T.mine_accessions(F.col("text"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", m["study"].alias("study"), m["sample"].alias("sample"))


@query(r"select distinct left(regexp_replace(sample_key, '\d+', '#', 'g'), 12) as stem from sample_attributes_new")
def name_stem(spark, d):
    """Name-stem fingerprints."""
    return table(spark, d, "sample_attributes_new").select(T.stem(F.col("sample_key")).alias("stem")).distinct()


@query(r"""select meta_id, case when length(trim(regexp_replace(description, '\s+', ' ', 'g'))) > 40 then rtrim(left(trim(regexp_replace(description, '\s+', ' ', 'g')), 39)) || '…' else
trim(regexp_replace(description, '\s+', ' ', 'g')) end as short from study_meta where description is not null""")
def clip_text(spark, d):
    """Clipped descriptions."""
    return table(spark, d, "study_meta").where("description is not null").select("meta_id", T.clip(F.col("description"), 40).alias("short"))


@query("""select meta_id, 'https://example.org/new?title=' || url_encode(study_title) || '&body=' || url_encode(study_accession) as url from study_meta where study_title is not null""")
def url_template(spark, d):
    """Prefilled links."""
    m = table(spark, d, "study_meta").where("study_title is not null")
    return m.select("meta_id", T.url_template("https://example.org/new", F.col("study_title"), F.col("study_accession")).alias("url"))


@query(f"""with a as (select coalesce(attr_key_norm, trim(regexp_replace(lower(attr_key), '[^a-z0-9]+', '_', 'g'), '_')) as k, value from sample_attributes_new)
select m.field_name, count(*) as n, count(*) filter (where value is null or trim(regexp_replace(value, '\\s+', ' ', 'g')) = '' or regexp_matches(lower(trim(regexp_replace(value, '\\s+', ' ', 'g'))), '{PLACEHOLDER_PATTERN}')) as absent
from a join attribute_field_map m on m.attr_key_norm = a.k where m.parser <> 'SKIP' group by 1""")
def field_map(spark, d):
    """Attribute rows dispatched by the field map, placeholders counted as absent."""
    a = table(spark, d, "sample_attributes_new").select(F.coalesce("attr_key_norm", normal_key(F.col("attr_key"))).alias("k"), "value")
    m = table(spark, d, "attribute_field_map").where("parser <> 'SKIP'")
    return a.join(small(m), F.col("k") == m["attr_key_norm"]).groupBy("field_name").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_placeholder(F.col("value"))).alias("absent"))


@query(r"""with k as (select distinct study_accession as id from study_meta union select distinct sample_key from sample_attributes_new) select id, case when regexp_matches(trim(id),
'^(?:PRJ[A-Z]{2}\d+|[ESD]RP\d{5,})$') then 'study' when regexp_matches(trim(id), '^(?:SAM[A-Z]{2}\d+|[ESD]RS\d{5,})$') then 'sample' else 'other' end as kind from k""")
def kind_router(spark, d):
    """Identifiers routed by pattern."""
    k = table(spark, d, "study_meta").select(F.col("study_accession").alias("id")).union(table(spark, d, "sample_attributes_new").select("sample_key")).distinct()
    return k.select("id", T.kind_of(F.col("id")).alias("kind"))


@query(r"""select det_id, case when lower(trim(value_normalized)) in ('yes', 'y', 'true', '1') then true when lower(trim(value_normalized)) in ('no', 'n', 'false', '0') then false end as flag
from sample_determinations_all where field_name = 'antibiotic_exposure'""")
def yes_no(spark, d):
    """Flags."""
    return table(spark, d, "sample_determinations_all").where("field_name = 'antibiotic_exposure'").select("det_id", T.yes_no(F.col("value_normalized")).alias("flag"))


@query()
def sanitise(spark, d):
    """Identifiers scrubbed from all texts, of any script."""
    t, c = table(spark, d, "documents").where("text is not null"), F.col("text")
    return t.select("doc_id", T.sanitise(c).alias("clean"), (c.rlike(T.TOKENS) | c.rlike(T.LONG_NUMBERS)).alias("changed"))


@query()
def fold_accents(spark, d):
    """Accents folded in all values, of any script."""
    return table(spark, d, "sample_attributes_new").where("value is not null").select("attr_id", T.fold(F.col("value")).alias("folded"))


@query(r"""with v as (select study_accession, regexp_extract(value, '^(\d{1,2})[/.-](\d{1,2})[/.-]\d{4}', 1) as a, regexp_extract(value, '^(\d{1,2})[/.-](\d{1,2})[/.-]\d{4}', 2) as b from sample_attributes_new)
select study_accession, case when bool_or(try_cast(a as int) > 12) and bool_or(try_cast(b as int) > 12) then 'none' when bool_or(try_cast(a as int) > 12) then 'dmy' when bool_or(try_cast(b as int) > 12) then 'mdy' end as day_order
from v where a <> '' group by 1""")
def dm_order(spark, d):
    """I4: the order of day and month of each study, from its own values."""
    p = r"^(\d{1,2})[/.-](\d{1,2})[/.-]\d{4}"
    v = table(spark, d, "sample_attributes_new").select("study_accession", F.regexp_extract("value", p, 1).alias("a"), F.regexp_extract("value", p, 2).alias("b")).where("a <> ''")
    g = v.groupBy("study_accession").agg(F.bool_or(F.col("a").try_cast("int") > 12).alias("x"), F.bool_or(F.col("b").try_cast("int") > 12).alias("y"))
    return g.select("study_accession", F.when(F.col("x") & F.col("y"), "none").when(F.col("x"), "dmy").when(F.col("y"), "mdy").alias("day_order"))


@query("""with x as (select l_orderkey, sum(l_quantity) as a, sum(l_quantity) + max(l_linenumber) * 2 as b from lineitem group by 1) select l_orderkey, abs(a - b) > greatest(7.0, greatest(a, b) * 0.1) as age_differs,
abs(a - b) > 1 as gestation_differs, abs(a - b) > 250 as weight_differs from x""")
def tolerance(spark, d):
    """Comparison within tolerances."""
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("a"), (F.sum("l_quantity") + F.max("l_linenumber") * 2).alias("b"))
    return x.select("l_orderkey", *[T.differs(k, F.col("a"), F.col("b")).alias(f"{k}_differs") for k in ("age", "gestation", "weight")])


@query("""with c as (select study_accession, count(*) as n, avg((field_value is not null)::int) as c1, avg((confidence is not null)::int) as c2, avg((evidence_quote is not null)::int) as c3 from
sample_determinations_all group by 1) select study_accession, round((1.0 * (1 - c1) + 0.5 * (1 - c2) + 0.25 * (1 - c3)) * log10(n + 1), 6) as score from c""")
def priority_score(spark, d):
    """Weighted missing coverage by size."""
    full = lambda c: F.avg(F.col(c).isNotNull().cast("int"))
    c = table(spark, d, "sample_determinations_all").groupBy("study_accession").agg(F.count(F.lit(1)).alias("n"), full("field_value").alias("c1"), full("confidence").alias("c2"), full("evidence_quote").alias("c3"))
    return c.select("study_accession", F.round((1 - F.col("c1") + 0.5 * (1 - F.col("c2")) + 0.25 * (1 - F.col("c3"))) * F.log10(F.col("n") + 1), 6).alias("score"))


@query("""with v as (select l_suppkey, l_returnflag, sum(l_quantity) as q from lineitem group by 1, 2) select l_suppkey, l_returnflag, round(log10(q + 1e-5), 6) as lg, round(ln(q + 1e-5) - avg(ln(q + 1e-5)) over
(partition by l_suppkey), 6) as clr from v""")
def clr(spark, d):
    """Logarithm and centred log-ratio."""
    from pyspark.sql import Window

    v = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    x = F.ln(F.col("q") + 1e-5)
    return v.select("l_suppkey", "l_returnflag", F.round(F.log10(F.col("q") + 1e-5), 6).alias("lg"), F.round(x - F.avg(x).over(Window.partitionBy("l_suppkey")), 6).alias("clr"))


@query("""select o_orderkey, case when n > 0 then round(q / n / case when st = 'P' then 2 else 1 end, 6) end as len from (select o_orderkey, any_value(o_orderstatus) as st, count(l_orderkey) as n, sum(l_extendedprice) as q
from orders left join lineitem on l_orderkey = o_orderkey group by 1)""")
def length_proxy(spark, d):
    """Amount per unit, halved for pairs, null without units."""
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("q"))
    j = table(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(l, "o_orderkey", "left")
    return j.select("o_orderkey", F.round(F.try_divide("q", "n") / F.when(F.col("o_orderstatus") == "P", 2).otherwise(1), 6).alias("len"))


@query("""select event_id, json_extract_string(props, '$.k')::int as k from events""")
def json_props(spark, d):
    """JSON parsed by the built-in reader."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("""select event_id, '[{"source":"' || event_type || '","quote":"first"},{"source":"note","quote":"' || user_id || '"}]' as evidence from events""")
def json_append(spark, d):
    """JSON evidence lists with one object more."""
    e = table(spark, d, "events")
    one = T.json_append(F.lit(None).cast("string"), F.col("event_type"), F.lit("first"))
    return e.select("event_id", T.json_append(one, F.lit("note"), F.col("user_id").cast("string")).alias("evidence"))


@query("""select user_id, array_to_string(list_sort(list_distinct(list_append(list_filter(list(distinct event_type), lambda x: not starts_with(x, 'unknown')), 'seen'))), ';') as codes from events group by 1""")
def list_add(spark, d):
    """A code added to a list."""
    g = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("a"))
    return g.select("user_id", F.array_join(T.list_add(F.col("a"), F.lit("seen")), ";").alias("codes"))


@query("""select det_id, case when starts_with(evidence_source, 'sample.attr') then 'R1' when starts_with(evidence_source, 'paper') and upper(trim(scope)) = 'SAMPLE' then 'R2' when starts_with(evidence_source, 'paper') then 'R4'
else 'H' end as route from sample_determinations_all""")
def route_inference(spark, d):
    """The route from source prefix and level."""
    e, s = F.col("evidence_source"), F.upper(F.trim("scope"))
    steps = [(e.startswith("sample.attr"), "R1"), (e.startswith("paper") & (s == "SAMPLE"), "R2"), (e.startswith("paper"), "R4")]
    return table(spark, d, "sample_determinations_all").select("det_id", T.ladder(steps, "H").alias("route"))
