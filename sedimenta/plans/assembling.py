"""Queries of the registry, supplement, subject and assembly operators, each with its SQL where the other engine can state it."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import texts as T
from sedimenta.functions.keys import entity_key, folded, normal_key
from sedimenta.operators import assembly, registry as R, subjects as S, supplement as P
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()

# The classes of the test texts, their terms, and phrases that do not count.
HOSTS = {
    "human": (["infant*", "mother*", "patient*", "volunteer*", "preterm", "adult*"], ["mouse mother"]),
    "animal": (["mouse", "mice", "piglet*", "calf", "calves"], ["mouse model of"]),
    "environment": (["soil", "river*", "wastewater", "sediment*"], []),
}
SOURCES = {"title": ("title", 2.0, True), "description": ("descr", 1.0, False)}


def _weigh_sql(base: str, vocabulary: dict, sources: dict) -> str:
    """The classification of ``weigh_evidence`` without its quotes, in SQL."""
    q = lambda x: "'" + x.replace("'", "''") + "'"

    def hit(column: str, code: str) -> str:
        terms, negatives = vocabulary[code]
        text = f"regexp_replace({column}, {q('|'.join(T.term_regex(n) for n in negatives))}, ' ', 'g')" if negatives else column
        return f"coalesce(regexp_matches({text}, {q('|'.join(T.term_regex(t) for t in terms))}), false)"

    parts = [
        f"select study_accession, '{c}' as code, " + " + ".join(f"case when {hit(col, c)} then {w} else 0.0 end" for col, w, _ in sources.values()) + " as score, "
        + " or ".join(hit(col, c) if s else "false" for col, _, s in sources.values()) + f" as strong from {base}"
        for c in vocabulary
    ]
    return f"""with c as ({" union all ".join(parts)}), r as (select *, row_number() over w as rn, lead(score) over w as second, sum(score) over (partition by study_accession) as total from c window w as (partition by study_accession order by score desc, code))
select study_accession, case when score >= 1 then code else 'unknown' end as code, score, round(case when score < 1 then 0 when strong then score / total else least(score / total, 0.6) end, 6) as confidence, 'rule' as stage,
concat_ws(';', case when total = 0 then 'no evidence' end, case when total > 0 and score < 1 then 'below threshold' end, case when score >= 1 and not strong then 'weak sources only' end, case when score >= 1 and second * 2 >= score then 'conflict' end) as reasons
from r where rn = 1"""


STUDIES = "(select study_accession, min(study_title) as title, min(description) as descr from study_meta group by 1)"


@query(_weigh_sql(STUDIES, HOSTS, SOURCES))
def classify_hosts(spark, d):
    """K1: the host of each study by weighted evidence from strong and weak texts, with confidence and reasons for review."""
    m = table(spark, d, "study_meta").groupBy("study_accession").agg(F.min("study_title").alias("title"), F.min("description").alias("descr"))
    return R.weigh_evidence(m, "study_accession", SOURCES, HOSTS).drop("evidence")


SITES = {
    "gut": (["stool", "faecal", "fecal", "gut", "intestin*", "rectal"], ["gut feeling"]),
    "oral": (["oral", "saliva*", "tongue", "dental"], ["oral antibiotic", "oral dose"]),
    "skin": (["skin", "dermal"], []),
    "milk": (["breast milk", "human milk", "colostrum"], ["milk powder"]),
}
STAGES = {"infant": (["infant*", "neonat*", "preterm", "newborn*"], []), "child": (["child", "children", "school*"], ["childbirth"]), "adult": (["adult*", "elderly", "pregnan*", "mother*"], [])}
BODY = "(select study_accession, string_agg(text, ' ' order by doc_id) filter (where length(text) < 400) as title, min(text) as descr from documents where study_accession is not null group by 1)"


@query(f"select 'site' as axis, * from ({_weigh_sql(BODY, SITES, SOURCES)}) union all select 'stage', * from ({_weigh_sql(BODY, STAGES, SOURCES)})")
def classify_sites_and_stages(spark, d):
    """K1: body site and life stage of each study from its short texts (strong) and one long text (weak)."""
    t = table(spark, d, "documents").where("study_accession is not null").groupBy("study_accession")
    short = F.array_sort(F.collect_list(F.when(F.length("text") < 400, F.struct("doc_id", "text"))))  # short texts of one study
    m = t.agg(short.alias("a"), F.min("text").alias("descr")).select("study_accession", F.when(F.size("a") > 0, F.array_join(F.transform("a", lambda x: x["text"]), " ")).alias("title"), "descr")
    one = lambda axis, v: R.weigh_evidence(m, "study_accession", SOURCES, v).drop("evidence").select(F.lit(axis).alias("axis"), "*")
    return one("site", SITES).unionByName(one("stage", STAGES))


@query("""with b as (select c_custkey as k, c_nationkey, case when c_acctbal < 0 then 'unknown' else lower(c_mktsegment) end as rule from customer where c_custkey % 10 <> 0), p as (select o_custkey as k, min(case when o_totalprice > 200000 then 'machinery' else 'bogus' end) as prior from orders
where o_orderstatus = 'P' group by 1), m as (select o_custkey as k, min(lower(case when o_orderkey % 2 = 0 then 'building' else 'nonsense' end)) as model from orders group by 1), j as (select coalesce(b.k, p.k) as k, c_nationkey, rule, prior from b full join p on b.k = p.k),
x as (select j.*, m.model from j left join m using (k)), ok as (select *, prior in ('automobile', 'building', 'furniture', 'machinery', 'household') as p_ok, rule in ('automobile', 'building', 'furniture', 'machinery', 'household') as r_ok,
model in ('automobile', 'building', 'furniture', 'machinery', 'household') as m_ok from x) select k as c_custkey, c_nationkey, case when p_ok then prior when r_ok then rule when m_ok then model else 'unknown' end as code, case when p_ok then 'prior' when r_ok then 'rule'
when m_ok then 'model' else 'none' end as stage, concat_ws(';', case when prior is not null and not p_ok then 'prior: ' || prior end, case when rule is not null and not r_ok and rule <> 'unknown' then 'rule: ' || rule end, case when model is not null and not m_ok then 'model: ' || model end) as problem from ok""")
def registry_assembly(spark, d):
    """K2: registry rows by precedence of prior decision, rule and model, codes outside the vocabulary named."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    base = c.where("c_custkey % 10 <> 0").select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") < 0, "unknown").otherwise(F.lower("c_mktsegment")).alias("code"))
    prior = o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_totalprice") > 200000, "machinery").otherwise("bogus").alias("code"))
    model = o.select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderkey") % 2 == 0, "building").otherwise("nonsense").alias("code"))
    return R.assemble(base, "c_custkey", prior, model, ["automobile", "building", "furniture", "machinery", "household"], ["c_nationkey"])


MEMBER_KEYS = {"sex": ["sex", "host_sex"], "country": ["country", "geo_loc_name"], "body_site": ["body_site", "isolation_source"]}


@query("""with a as (select upper(trim(regexp_replace(sample_key, '[\\s ]+', ' ', 'g'))) as sample_key, attr_id, case when k in ('sex', 'host_sex') then 'sex' when k in ('country', 'geo_loc_name') then 'country' else 'body_site' end as f,
lower(trim(regexp_replace(value, '[\\s ]+', ' ', 'g'))) as v from (select *, coalesce(attr_key_norm, trim(regexp_replace(lower(attr_key), '[^a-z0-9]+', '_', 'g'), '_')) as k from sample_attributes_new)
where k in ('sex', 'host_sex', 'country', 'geo_loc_name', 'body_site', 'isolation_source')), n as (select f, v, min(code) as code from (select vocabulary as f, lower(trim(label)) as v, code from vocab_terms union all select vocabulary, lower(trim(unnest(string_split(synonyms, '|')))), code
from vocab_terms where synonyms is not null) group by 1, 2), b as (select sample_key, f, v, code, row_number() over (partition by sample_key, f order by code is null, attr_id, v) as r from a left join n using (f, v) where v is not null and sample_key is not null)
select sample_key, max(case when f = 'sex' then coalesce(code, 'unknown') end) as sex_code, max(case when f = 'sex' then v end) as sex_raw, max(case when f = 'country' then coalesce(code, 'unknown') end) as country_code, max(case when f = 'country' then v end) as country_raw,
max(case when f = 'body_site' then coalesce(code, 'unknown') end) as body_site_code, max(case when f = 'body_site' then v end) as body_site_raw from b where r = 1 group by 1""")
def member_tier(spark, d):
    """K3: the best normalised value per sample and field, ``unknown`` where a value has no code."""
    k = F.coalesce("attr_key_norm", normal_key(F.col("attr_key")))
    f = T.ladder([(k.isin(*keys), name) for name, keys in MEMBER_KEYS.items()], None)
    a = table(spark, d, "sample_attributes_new").select(entity_key(F.col("sample_key")).alias("sample_key"), "attr_id", f.alias("f"), folded(F.col("value")).alias("v")).where("f is not null")
    t = table(spark, d, "vocab_terms")
    names = F.concat(F.array("label"), F.coalesce(F.split("synonyms", r"\|"), F.array().cast("array<string>")))
    norm = t.select(F.col("vocabulary").alias("field"), "code", F.explode(names).alias("n")).select("field", "code", F.lower(F.trim("n")).alias("value")).where("value is not null")
    return R.member_tier(a, norm, list(MEMBER_KEYS), "sample_key", "f", "v", [F.col("attr_id"), F.col("v")])


RNA = ", ".join(f"'{x}'" for x in R.RNA_STRATEGIES), ", ".join(f"'{x}'" for x in R.RNA_SOURCES)
NAMED = f"(org <> '' and not regexp_matches(org, '(?i)metagenome') and not regexp_matches(org, '{R.COMMUNITY}'))"


@query(f"""with x as (select attr_id, coalesce(value, '') as org, coalesce(attr_key, '') as strat, upper(coalesce(attr_units, '')) as src, source, attr_units from sample_attributes_new)
select attr_id, {NAMED} and not regexp_matches(org, '{R.NO_ORGANISM}') as non_metagenome_strict, {NAMED} as non_metagenome_loose, regexp_matches(org, '(?i)synthetic|simulat') or src = 'SYNTHETIC' as synthetic,
strat in ({RNA[0]}) or src in ({RNA[1]}) as rna_strict, strat in ({RNA[0]}) or contains(src, 'RNA') or contains(src, 'TRANSCRIPT') as rna_loose, coalesce(lower(trim(source)) = 'yes', false) as low_complexity,
coalesce(trim(attr_units) <> '', false) as warning from x""")
def quality_flags(spark, d):
    """K9: quality flags of records (the attribute table's texts stand for organism, strategy and source)."""
    a = table(spark, d, "sample_attributes_new")
    f = R.qc_flags(F.col("value"), F.col("attr_key"), F.col("attr_units"), F.col("source"), F.col("attr_units"))
    return a.select("attr_id", *[c.alias(n) for n, c in f.items()])


@query("""with r as (select o_custkey as s, l_orderkey as run, p_brand as t, sum(l_quantity) as v from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey group by 1, 2, 3), t as (select s, t, sum(v) as v from r group by 1, 2),
g as (select s, sum(v) as root, count(*) as richness, arg_min(t, (-v, t)) as top_taxon, max(v) as top, ln(sum(v)) - sum(v * ln(v)) / sum(v) as entropy, coalesce(sum(v) filter (where t in ('Brand#11', 'Brand#12')), 0) / sum(v) as ones from t group by 1),
rt as (select s, run, sum(v) as tot from r group by 1, 2), n as (select s, count(*) as runs from rt group by 1), p as (select a.s, a.run, b.run as run2, coalesce(sum(least(x.v, coalesce(y.v, 0))), 0) as m, any_value(a.tot) + any_value(b.tot) as tt from rt a join rt b on a.s = b.s and a.run < b.run
left join r x on x.s = a.s and x.run = a.run left join r y on y.s = b.s and y.run = b.run and y.t = x.t group by 1, 2, 3), f as (select s, max(1 - 2 * m / tt) as far from p group by 1)
select s as o_custkey, runs, round(root, 4) as root, richness, top_taxon, round(top / root, 6) as top_share, round(entropy, 6) as entropy, round(ones, 6) as ones, root < 500 as is_shallow, coalesce(far, 0) > 0.9 as is_discordant from g join n using (s) left join f using (s)""")
def profile_summary(spark, d):
    """Per-sample profile summary over runs, with indicators and a flag for runs that disagree."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    s = R.profile_summary(l.join(o, "l_orderkey").join(p, "l_partkey"), "o_custkey", "l_orderkey", "p_brand", "l_quantity", {"ones": ["Brand#11", "Brand#12"]}, 500, 0.9)
    return s.withColumns({"root": F.round("root", 4), **{c: F.round(c, 6) for c in ("top_share", "entropy", "ones")}})


@query("""with g as (select study_accession, count(distinct doc_id) as n_runs, count(*) filter (where regexp_matches(text, '(?i)infant|neonat')) as infant, count(*) filter (where regexp_matches(text, '(?i)adult|elder')) as adult,
count(*) filter (where regexp_matches(text, '(?i)mouse|mice')) as animal from documents where study_accession is not null group by 1), p as (select study_accession, min('screened ' || coalesce(center_name, 'nowhere')) as v from study_meta where meta_id % 7 = 0 and study_accession is not null group by 1),
r as (select *, list_sort([(-infant, 'infant'), (-adult, 'adult'), (-animal, 'animal')]) as l from g), x as (select *, case when l[1][1] < 0 then l[1][2] else 'none' end as signal, l[2][1] < 0 and l[2][1] * 3 <= l[1][1] as ambiguous from r)
select study_accession, n_runs, infant, adult, animal, signal, ambiguous, coalesce(v, 'not_screened') as prior_verdict, coalesce(v, case when ambiguous then 'review' else signal end) as class from x left join p using (study_accession)""")
def universe(spark, d):
    """Records aggregated to studies, signals, prior verdicts and the resulting class."""
    prior = table(spark, d, "study_meta").where("meta_id % 7 = 0").select("study_accession", F.concat(F.lit("screened "), F.coalesce("center_name", F.lit("nowhere"))).alias("verdict"))
    signals = {"infant": "(?i)infant|neonat", "adult": "(?i)adult|elder", "animal": "(?i)mouse|mice"}
    return R.universe(table(spark, d, "documents"), "study_accession", "doc_id", signals, "text", prior)


def _cells(spark, d):
    """The attribute table as foreign tables, one per study: a row per sample, a column per key."""
    a = table(spark, d, "sample_attributes_new").where("study_accession is not null and value is not null")
    return a.select(F.col("study_accession").alias("tab"), entity_key(F.col("sample_key")).alias("sample"), F.coalesce("attr_key_norm", normal_key(F.col("attr_key"))).alias("header"), "value", "attr_id")


@query("""with a as (select study_accession as tab, upper(trim(regexp_replace(sample_key, '[\\s ]+', ' ', 'g'))) as s, coalesce(attr_key_norm, trim(regexp_replace(lower(attr_key), '[^a-z0-9]+', '_', 'g'), '_')) as h, value from sample_attributes_new where study_accession is not null and value is not null),
r as (select *, dense_rank() over (partition by tab order by s) - 1 as row_no from a), p as (select tab, h, avg(regexp_matches(trim(value), '^[-+]?[0-9]*\\.?[0-9]+(?:[eE][-+]?[0-9]+)?$')::int) as n from r where row_no < 50 and trim(value) <> '' group by 1, 2)
select tab, count(*) filter (where n >= 0.9) as numeric_columns, count(*) filter (where regexp_matches(h, '""" + P.METADATA_WORDS + """')) as metadata_columns, count(*) filter (where n >= 0.9) > 200 and count(*) filter (where regexp_matches(h, '""" + P.METADATA_WORDS + """')) = 0 as is_matrix from p group by 1""")
def matrix_tables(spark, d):
    """Which tables are matrices of measurements."""
    from pyspark.sql import Window

    c = _cells(spark, d).withColumn("row_no", F.dense_rank().over(Window.partitionBy("tab").orderBy("sample")) - 1)
    return P.is_matrix(c, "tab", "header", "value", "row_no")


def _attempts(spark, d):
    c = _cells(spark, d)
    keys = ["host_subject_id", "lab_code", "plate_well"]
    foreign = c.where(F.col("header").isin("lab_code", "host_subject_id")).select("tab", F.concat(F.lit("their_"), "header").alias("header"), F.col("sample").alias("row"), F.upper(F.concat(F.lit(" "), "value")).alias("value"))
    index = P.attribute_index(c.where(F.col("header").isin(*keys)), "tab", "sample", "header", "value").withColumnRenamed("header", "key")
    return foreign, P.column_attempts(foreign.withColumn("t", F.col("tab")), index, "tab", "t", "header", "row", "value", "key")


@query()
def attribute_match(spark, d):
    """How each column of a foreign table fares as a key of its study's attributes, by normal form and level."""
    return _attempts(spark, d)[1].drop("t")


@query()
def table_gate(spark, d):
    """The accepted way to join each foreign table, or why there is none."""
    foreign, attempts = _attempts(spark, d)
    tables = foreign.groupBy(F.col("tab").alias("t")).agg(F.count_distinct("row").alias("n_rows"))
    return P.choose_attempt(attempts, tables, "t", "header", "n_rows")


@query("""with e as (select event_id as row, user_id as subject, event_type as value from events where event_id % 3 = 0), a as (select distinct user_id as subject, event_id as entity, regexp_replace(lower(event_type || '-' || (event_id % 4)), '[^a-z0-9]', '', 'g') as f from events),
j as (select distinct e.row, a.entity from e join a on a.subject = e.subject and a.f = regexp_replace(lower(e.value || ' ' || (e.row % 4)), '[^a-z0-9]', '', 'g')) select row, min(entity) as entity from j group by 1 having count(distinct entity) = 1""")
def composite_key(spark, d):
    """Subject-level hits narrowed by a second column to one of the subject's samples."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    tag = lambda sep: F.concat("event_type", F.lit(sep), (F.col("event_id") % 4).cast("string"))
    third = e.where("event_id % 3 = 0")
    return P.composite(
        third.select(F.col("event_id").alias("row"), F.col("user_id").alias("subject")), third.select(F.col("event_id").alias("row"), tag(" ").alias("value")),
        e.select(F.col("user_id").alias("subject"), F.col("event_id").alias("entity"), tag("-").alias("value")), "row", "subject", "entity", "value",
    )


@query()
def column_extraction(spark, d):
    """Values of classified columns of a gated table, parsed with unit and legend, checked, expanded and located."""
    o = table(spark, d, "orders")
    price = F.concat(F.round(F.col("o_totalprice") / 1000, 1).cast("string"), F.lit(" kg"))
    cells = o.select(F.lit("t").alias("tab"), F.col("o_orderkey").alias("row"), F.explode(F.array(F.struct(F.lit("price").alias("header"), price.alias("value")), F.struct(F.lit("prio").alias("header"), F.col("o_orderpriority").alias("value")))).alias("x")).select("tab", "row", "x.*")
    hits = o.select(F.lit("t").alias("tab"), F.col("o_orderkey").alias("row"), F.col("o_custkey").alias("entity"), (F.col("o_orderkey") % 5 == 0).alias("subject_level"))
    columns = spark.createDataFrame([("t", "price", "weight", "mass", None, 50000.0, 200000.0, False), ("t", "prio", "priority", None, None, None, None, True)], "tab string, header string, field_name string, dim string, unit string, lo double, hi double, is_static boolean")
    legend = spark.createDataFrame([("t", "prio", "1-URGENT", "urgent")], "tab string, header string, value string, meaning string")
    return P.extract_columns(cells, hits, columns, legend, "tab", "row", "header", "value", "entity")


@query("""with r as (select l_orderkey as e, l_linenumber as run, count(*) as c from lineitem group by 1, 2), a as (select o_orderkey as e, 'Run-0' || (o_orderkey % 9) as f, 'prio' as field_name, o_orderpriority as raw from orders)
select a.e * 10 + r.run as run, field_name, case when raw = '1-URGENT' then 'urgent' else raw end as value_normalized from a join r on r.e = a.e and r.run = a.e % 9 group by all""")
def run_rekeying(spark, d):
    """Accepted rows of a sample moved to the one run that their foreign id names."""
    runs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("e"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("run"), F.concat(F.lit("run"), F.col("l_linenumber").cast("string")).alias("alias")).distinct()
    acc = table(spark, d, "orders").select(F.col("o_orderkey").alias("e"), F.concat(F.lit("Run-0"), (F.col("o_orderkey") % 9).cast("string")).alias("f"), F.lit("prio").alias("field_name"), F.col("o_orderpriority").alias("raw"))
    legend = spark.createDataFrame([("prio", "1-URGENT", "urgent")], "field_name string, raw string, meaning string")
    return P.rekey_runs(acc, runs, legend, "e", "run", "f")


@query()
def mention_links(spark, d):
    """Accession mentions of texts mapped to studies, with sections, differing contexts and the relation."""
    t = table(spark, d, "documents").where("text is not null")
    accession = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(T.ACCESSIONS["study"]), F.lit(0))))
    m = t.select(F.col("doc_id").alias("paper"), "text", "source", accession.alias("accession"))
    around = F.regexp_extract("text", r"([^.\n]{0,200}(?:PRJ[A-Z]{2}|[ESD]RP)\d+[^.\n]{0,200})", 1)
    m = m.select("paper", "accession", F.when(F.col("source") == "methods", "methods").otherwise(F.col("source")).alias("section"), around.alias("context"))
    s = table(spark, d, "study_meta")
    studies = s.select(F.col("study_accession").alias("accession"), "study_accession").union(s.select("secondary_study_accession", "study_accession")).where("accession is not null")
    return P.link_mentions(m, studies, "paper")


@query("""with x as (select user_id % 40 as g, event_id, case when event_id % 3 = 0 then 'mother' when event_id % 3 = 1 then 'infant' end as role, case when event_id % 3 = 0 then 'M-' else 'baby ' end || '0' || (event_id % 97) as subject, case when event_id % 5 = 0 then 'F' || (event_id % 11) end as fam from events),
i as (select distinct g, subject, fam, ltrim((regexp_extract(subject, '[0-9]+')), '0') as core from x where role = 'infant'), lf as (select g, fam, string_agg(distinct subject, ';' order by subject) as l from i where fam is not null group by 1, 2 having count(distinct subject) <= 3),
lc as (select g, case when core = '' then '0' else core end as core, string_agg(distinct subject, ';' order by subject) as l from i group by 1, 2 having count(distinct subject) <= 3),
m as (select distinct g, event_id, fam, case when ltrim(regexp_extract(subject, '[0-9]+'), '0') = '' then '0' else ltrim(regexp_extract(subject, '[0-9]+'), '0') end as core from x where role = 'mother')
select m.g, m.event_id, coalesce(lf.l, lc.l) as linked, case when lf.l is not null then 'family' else 'core' end as basis from m left join lf on lf.g = m.g and lf.fam = m.fam left join lc on lc.g = m.g and lc.core = m.core where coalesce(lf.l, lc.l) is not null""")
def role_links(spark, d):
    """Mothers linked to the one to three infants of their group by family id, else by core id."""
    e, k = table(spark, d, "events"), F.col("event_id")
    role = F.when(k % 3 == 0, "mother").when(k % 3 == 1, "infant")
    subject = F.concat(F.when(k % 3 == 0, "mother-").otherwise("baby "), F.lit("0"), (k % 97).cast("string"))
    x = e.select((F.col("user_id") % 40).alias("g"), "event_id", role.alias("role"), subject.alias("subject"), F.when(k % 5 == 0, F.concat(F.lit("F"), (k % 11).cast("string"))).alias("fam"))
    return S.link_roles(x, "g", "event_id", "subject", "role", "fam")


@query("""with x as (select user_id % 6 as g, event_id, 'F' || (user_id % 9) || '-' || (event_id % 4) as subject_id, case when user_id % 6 < 3 then 'lib F' || (user_id % 9) || '_' || (event_id % 4) else 'lib' end as name from events),
j as (select *, (user_id_known)::double as known, contains(regexp_replace(lower(name), '[^a-z0-9]', '', 'g'), regexp_replace(lower(subject_id), '[^a-z0-9]', '', 'g'))::int as named from (select *, g in (0, 1, 4) as user_id_known from x))
select g, event_id, subject_id from j where g in (select g from j group by 1 having avg(known) >= 0.5 and avg(named) >= 0.5)""")
def composite_subjects(spark, d):
    """Family and member attributes joined to one id in the groups where that form is in use."""
    u, k = F.col("user_id"), F.col("event_id")
    fam, member = F.concat(F.lit("F"), (u % 9).cast("string")), (k % 4).cast("string")
    name = F.when(u % 6 < 3, F.concat(F.lit("lib "), fam, F.lit("_"), member)).otherwise("lib")
    x = table(spark, d, "events").select((u % 6).alias("g"), "event_id", fam.alias("fam"), member.alias("member"), name.alias("name"))
    existing = x.where("g in (0, 1, 4)").select("g", F.concat("fam", "member").alias("id")).distinct()
    return S.composite_ids(x, "g", "event_id", "fam", "member", "name", existing)


def _resolved(spark, d):
    a = table(spark, d, "sample_attributes_new").select(
        entity_key(F.col("sample_key")).alias("sample"), "study_accession", F.coalesce("attr_key_norm", normal_key(F.col("attr_key"))).alias("k"), F.trim("value").alias("v"), "harvested_at"
    )
    one = lambda key: F.min(F.when(F.col("k") == key, F.col("v")))
    s = a.where("sample is not null and study_accession is not null").groupBy("sample").agg(
        F.min("study_accession").alias("study"), one("host_subject_id").alias("host_subject_id"), one("lab_code").alias("lab_code"), one("sample_title").alias("title"), one("age_in_days").alias("age"), F.min("harvested_at").alias("seen")
    )
    s = s.withColumn("age", T.number(F.col("age")))
    return S.resolve_subjects(s, "study", "sample", [("host_subject_id", "attribute"), ("lab_code", "lab code")], "title", "age", "seen")


@query()
def subjects(spark, d):
    """K7: the subject, role and place in time of every sample."""
    return _resolved(spark, d)


@query()
def subject_summaries(spark, d):
    """K7: subjects with their samples and span."""
    return S.subject_summary(_resolved(spark, d), "study", "age")


def _scope(spark, d):
    t = table(spark, d, "sample_determinations_all").select(
        "det_id", entity_key(F.col("sample_key")).alias("entity"), "study_accession", folded(F.col("field_name")).alias("field_name"), folded(F.col("value_normalized")).alias("value"),
        F.when(F.col("confidence") > 1, F.col("confidence") / 100).otherwise(F.col("confidence")).alias("confidence"), folded(F.col("route")).alias("route"), "release_retired", "scope",
    )
    live = t.where("release_retired is null")
    statements = live.where("study_accession is not null and value is not null and confidence is not null and det_id % 50 = 0").drop("entity")
    members = t.where("entity is not null and study_accession is not null").groupBy("entity").agg(F.min("study_accession").alias("study_accession"))
    number = F.col("value").try_cast("double")
    fields = {
        "sex": F.col("value").isin("male", "female"), "country": F.length("value") > 1, "gestational_age_weeks": number.between(20, 45), "birth_weight_grams": number.between(300, 7000), "delivery_mode": F.col("value") != "",
    }
    corrections = live.where("det_id % 400 = 0 and study_accession is not null").groupBy("study_accession").agg(F.min("det_id").alias("correction_id"))
    corrections = corrections.select("correction_id", "study_accession", F.lit("delivery_mode").alias("field_name"), F.lit("").alias("entity"), F.lit("vaginal").alias("old"), F.lit("recode").alias("action"), F.lit("vaginal_birth").alias("new"))
    previous = None
    return assembly.build_scope([live.where("det_id % 2 = 0"), live.where("det_id % 2 = 1")], statements, members, corrections, fields, ["r1", "r2", "r3", "r4"], previous, "R2027.1")


SCOPE = """with t as (select det_id, upper(trim(regexp_replace(sample_key, '[\\s ]+', ' ', 'g'))) as e, study_accession as st, lower(trim(regexp_replace(field_name, '[\\s ]+', ' ', 'g'))) as f, lower(trim(regexp_replace(value_normalized, '[\\s ]+', ' ', 'g'))) as v,
case when confidence > 1 then confidence / 100 else confidence end as c, lower(trim(regexp_replace(route, '[\\s ]+', ' ', 'g'))) as rt, release_retired from sample_determinations_all), live as (select * from t where release_retired is null),
ok as (select * from live where e is not null and coalesce(c between 0 and 1, false) and coalesce(case f when 'sex' then v in ('male', 'female') when 'country' then length(v) > 1 when 'gestational_age_weeks' then try_cast(v as double) between 20 and 45
when 'birth_weight_grams' then try_cast(v as double) between 300 and 7000 when 'delivery_mode' then v <> '' end, false)), cor as (select st, min(det_id) as id from live where det_id % 400 = 0 and st is not null group by 1),
m as (select det_id, e, id from ok join cor using (st) where f = 'delivery_mode' and v = 'vaginal'), first as (select e, id, min(det_id) as det_id from m group by 1, 2),
good as (select * from ok where det_id not in (select det_id from m) union all select ok.* replace ('vaginal_birth' as v) from ok join first using (det_id)),
won as (select * from good qualify row_number() over (partition by e, f order by case rt when 'r1' then 0 when 'r2' then 1 when 'r3' then 2 when 'r4' then 3 else 4 end, c desc, det_id) = 1),
stm as (select st, f, v from live where st is not null and v is not null and c is not null and det_id % 50 = 0 qualify row_number() over (partition by st, f order by -least(c, 0.6), det_id) = 1),
mem as (select e, min(st) as st from t where e is not null and st is not null group by 1), res as (select e, f, v from won union all select mem.e, stm.f, stm.v from stm join mem using (st) where (mem.e, stm.f) not in (select e, f from won)),
wide as (select mem.e, mem.st, max(case when f = 'sex' then v end) as sex, max(case when f = 'country' then v end) as country, max(case when f = 'gestational_age_weeks' then v end) as gestational_age_weeks, max(case when f = 'birth_weight_grams' then v end) as birth_weight_grams,
max(case when f = 'delivery_mode' then v end) as delivery_mode from mem left join res using (e) group by 1, 2) """


@query(SCOPE + "select e as entity, st as study_accession, sex, country, gestational_age_weeks, birth_weight_grams, delivery_mode, 'R2027.1' as release_added, null as release_retired from wide")
def scope_wide(spark, d):
    """The wide table of a scope, assembled end to end from its sources."""
    return _scope(spark, d)["wide"]


@query(SCOPE + "select st as study_accession, count(*) as members, " + ", ".join(f"round(avg(({f} is not null)::int), 6) as {f}" for f in ("sex", "country", "gestational_age_weeks", "birth_weight_grams", "delivery_mode")) + " from wide group by 1")
def scope_coverage(spark, d):
    """Coverage per study of the assembled scope."""
    return _scope(spark, d)["coverage"]


@query("""with k as (select distinct o_custkey as e from orders where o_orderdate < timestamp '1998-01-01'), n as (select o_custkey as e, min(o_orderpriority) as st, min(o_orderdate)::date::varchar as fp from orders where o_orderdate >= timestamp '1998-01-01' group by 1),
new as (select * from n where e not in (from k)), w as (select o_custkey as e, min((o_totalprice / 20)::int::varchar) as age, min(o_orderstatus) as status from orders where o_orderkey % 3 = 0 group by 1)
select new.e as entity, new.st as study, w.age as age_at_collection_days, w.status, case when try_cast(age as double) < 1096 then 'infant' when try_cast(age as double) >= 6574 then 'adult' when age is not null then 'child' else 'unknown' end as age_scope from new join w using (e)""")
def new_member_rows(spark, d):
    """Wide rows and age scope of the entities a delivery adds."""
    return _new_members(spark, d)["rows"]


@query("""with k as (select distinct o_custkey as e from orders where o_orderdate < timestamp '1998-01-01'), n as (select o_custkey as e, min(o_orderpriority) as st, min(o_orderdate)::date::varchar as fp from orders where o_orderdate >= timestamp '1998-01-01' group by 1)
select e as entity, st as study, case when e % 4 = 0 then 'not found' when fp > '2000-01-01' then 'after horizon' else 'no attributes' end as reason from n where e not in (from k) and e not in (select o_custkey from orders where o_orderkey % 3 = 0)""")
def new_members_missed(spark, d):
    """New entities without determinations and why."""
    return _new_members(spark, d)["missed"]


def _new_members(spark, d):
    o = table(spark, d, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    known = o.where(F.col("o_orderdate") < cut).select(F.col("o_custkey").alias("entity")).distinct()
    delivered = o.where(F.col("o_orderdate") >= cut).groupBy(F.col("o_custkey").alias("entity")).agg(F.min("o_orderpriority").alias("study"), F.min(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("first_public"))
    looked = delivered.select("entity", F.when(F.col("entity") % 4 == 0, "missing").otherwise("found").alias("status"))
    third = o.where("o_orderkey % 3 = 0")
    two = F.array(F.struct(F.lit("age_at_collection_days").alias("field_name"), F.rint(F.col("o_totalprice") / 20).cast("int").cast("string").alias("value")), F.struct(F.lit("status").alias("field_name"), F.col("o_orderstatus").alias("value")))
    dets = third.select(F.col("o_custkey").alias("entity"), F.explode(two).alias("x")).select("entity", "x.*")
    return assembly.new_members(known, delivered, looked, dets, "entity", "study", ["age_at_collection_days", "status"], "2000-01-01")


@query("""with i as (select study_accession as id from study_meta union select study_accession from documents union select study_accession from sample_determinations_all), s as (select study_accession as id, count(*) as n, min(study_title) as t from study_meta group by 1),
d as (select study_accession as id, count(*) as n, min(det_id) as k from sample_determinations_all group by 1), t as (select study_accession as id, count(*) as n, min(doc_id) as k from documents group by 1), h as (select study_accession as id, list_distinct(list(lower(trim(field_name)))) as f
from sample_determinations_all where value_normalized is not null group by 1) select i.id, coalesce(s.n, 0) as n_study, case when t2.t is not null then '{"study_title":"' || t2.t || '"}' else case when s.id is not null then '{}' end end as study, coalesce(d.n, 0) as n_facts, '{"det_id":' || d.k || '}' as facts,
coalesce(t.n, 0) as n_texts, '{"doc_id":' || t.k || '}' as texts, array_to_string(list_filter(['country', 'feeding_mode', 'sex'], lambda x: not coalesce(list_contains(h.f, x), false)), ';') as gaps from i left join s using (id) left join d using (id) left join t using (id) left join h using (id)
left join (select study_accession as id, case when count(*) = count(study_title) then min(study_title) end as t from study_meta group by 1) t2 using (id) where i.id is not null""")
def study_audit(spark, d):
    """What the tables say of every study: its record, determinations, texts and fields without a value."""
    meta, det, docs = [table(spark, d, t) for t in ("study_meta", "sample_determinations_all", "documents")]
    ids = meta.select(F.col("study_accession").alias("id")).union(docs.select("study_accession")).union(det.select("study_accession"))
    blocks = {"study": (meta, "study_accession", ["study_title"]), "facts": (det, "study_accession", ["det_id"]), "texts": (docs, "study_accession", ["doc_id"])}
    have = det.where("value_normalized is not null").select("study_accession", F.lower(F.trim("field_name")).alias("f"))
    return assembly.audit(ids, "id", blocks, (have, "study_accession", "f", ["sex", "country", "feeding_mode"]))

