"""Queries of the statistics, predicate, classification and work-list operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import texts as T
from sedimenta.operators import explore as X
from sedimenta.operators import stats as S
from sedimenta.operators.resolve import bh
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()


@query("""with g as (select l_suppkey, avg(l_discount) filter (where l_quantity > 25) as m1, avg(l_discount) filter (where l_quantity <= 25) as m0, count(*) filter (where l_quantity > 25) as n1, count(*) filter
(where l_quantity <= 25) as n0, sum(l_discount) filter (where l_quantity > 25) as s1, sum(l_discount) filter (where l_quantity <= 25) as s0 from lineitem group by 1)
select count(*) as groups, round(median(m1 - m0), 7) as median_effect, round(greatest(avg((m1 > m0)::int), 1 - avg((m1 > m0)::int)), 7) as agreement, round(sum(s1) / sum(n1) - sum(s0) / sum(n0), 7) as pooled_effect
from g where n1 >= 20 and n0 >= 20""")
def within_effect(spark, d):
    """L1: effects inside groups, then over groups."""
    l = table(spark, d, "lineitem").select("l_suppkey", "l_discount", (F.col("l_quantity") > 25).alias("arm"))
    e = S.within_effect(l, "l_suppkey", "arm", "l_discount")
    return e.select("groups", *[F.round(c, 7).alias(c) for c in ("median_effect", "agreement", "pooled_effect")])


U = """with m as (select p_type, l_suppkey, avg(l_extendedprice) as v, l_suppkey % 2 = 0 as arm from lineitem join part on p_partkey = l_partkey group by 1, 2),
r as (select *, rank() over (partition by p_type order by v) + (count(*) over (partition by p_type, v) - 1) / 2.0 as rk from m)
select p_type, count(*) filter (where arm) as n1, count(*) filter (where not arm) as n0, round(sum(rk) filter (where arm) - count(*) filter (where arm) * (count(*) filter (where arm) + 1) / 2.0, 4) as u from r group by 1"""


def _means(spark, d):
    j = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice").join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    return j.groupBy("p_type", "l_suppkey").agg(F.avg("l_extendedprice").alias("v")).withColumn("arm", F.col("l_suppkey") % 2 == 0)


@query(U)
def mwu(spark, d):
    """L2: Mann-Whitney U of group means."""
    return S.mann_whitney(_means(spark, d), ["p_type"], "arm", "v").select("p_type", "n1", "n0", F.round("u", 4).alias("u"))


@query(U.replace("select p_type, count(*) filter (where arm) as n1", ", t as (select p_type, sum(c * c * c - c) as ties from (select p_type, v, count(*)::double as c from m group by 1, 2) group by 1), u as (select p_type, count(*) filter (where arm) as n1") + """), z as (select p_type, u / (n1 * n0) as superiority,
abs((u - n1 * n0 / 2.0) / sqrt(n1 * n0 / 12.0 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1.0))))) / sqrt(2.0) as x from u join t using (p_type)), p as (select *, 1 / (1 + 0.3275911 * x) as k from z),
q as (select p_type, superiority, least(1.0, k * (0.254829592 + k * (-0.284496736 + k * (1.421413741 + k * (-1.453152027 + k * 1.061405429)))) * exp(-x * x)) as p from p), w as (select *, row_number() over (order by p, p_type) as rk, count(*) over () as n from q),
a as (select *, least(1.0, min(p * n / rk) over (order by p, p_type rows between current row and unbounded following)) as q from w)
select p_type, round(superiority, 6) as superiority, round(p, 6) as p, round(q, 6) as q, case when q > 0.1 then 'none' when superiority > 0.5 then 'up' else 'down' end as kind from a""")
def volcano(spark, d):
    """L3: U test per feature with adjusted p values and a class."""
    u = S.mann_whitney(_means(spark, d), ["p_type"], "arm", "v").withColumn("p", S.two_sided_p(F.col("z")))
    q = bh(u, "p", "p_type")
    return q.select("p_type", *[F.round(c, 6).alias(c) for c in ("superiority", "p", "q")], F.when(F.col("q") > 0.1, "none").when(F.col("superiority") > 0.5, "up").otherwise("down").alias("kind"))


@query("""with r as (select l_suppkey, rank() over (partition by l_suppkey order by l_quantity) + (count(*) over (partition by l_suppkey, l_quantity) - 1) / 2.0 as rx, rank() over (partition by l_suppkey order by
l_discount) + (count(*) over (partition by l_suppkey, l_discount) - 1) / 2.0 as ry from lineitem) select l_suppkey, count(*) as n, round(corr(rx, ry), 6) + 0.0 as rho from r group by 1""")
def spearman(spark, d):
    """L4: rank correlation per group."""
    return S.spearman(table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_discount"), ["l_suppkey"], "l_quantity", "l_discount").withColumn("rho", F.round("rho", 6) + F.lit(0.0))


@query("""with x as (select vec_id, label, unnest(embedding)::double as v, unnest(range(1, 1 + len(embedding))) as i from embeddings), c as (select label, i, avg(v) as m from x group by 1, 2), g as (select i, avg(v) as m from x
group by 1) select (select count(*) from embeddings) as n, round((select sum(pow(v - g.m, 2)) from x join g using (i)), 3) as ss_total, round((select sum(pow(v - c.m, 2)) from x join c using (label, i)), 3) as ss_within,
round(1 - (select sum(pow(v - c.m, 2)) from x join c using (label, i)) / (select sum(pow(v - g.m, 2)) from x join g using (i)), 5) as r2""")
def permanova(spark, d):
    """Variance explained by a factor, from sums of squares around centroids."""
    v = S.variance_explained(table(spark, d, "embeddings"), "label", "embedding", 64)
    return v.select("n", F.round("ss_total", 3).alias("ss_total"), F.round("ss_within", 3).alias("ss_within"), F.round("r2", 5).alias("r2"))


@query("""with n as (select l_suppkey, l_linestatus, count(*) as c from lineitem group by 1, 2), g as (select l_suppkey, arg_max(l_linestatus, (c, l_linestatus)) as l_linestatus, sum(c)::bigint as n, max(c) as m from n group by 1)
select l_suppkey, l_linestatus, n from g where n >= 20 and m >= 0.5 * n""")
def single_origin(spark, d):
    """Groups dominated by one value."""
    return S.dominant_share(table(spark, d, "lineitem").select("l_suppkey", "l_linestatus"), "l_suppkey", "l_linestatus", 20, 0.5)


@query("""with m as (select o_custkey % 50 as g, year(o_orderdate) as y, median(o_totalprice) as m from orders group by 1, 2), r as (select g, rank() over (partition by g order by y) as rx, rank() over (partition by g order by m) +
(count(*) over (partition by g, m) - 1) / 2.0 as ry from m) select g, count(*) as periods, round(corr(rx, ry), 6) + 0.0 as rho from r group by 1 having count(*) >= 3""")
def trend(spark, d):
    """Rank correlation of yearly medians."""
    o = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("g"), F.year("o_orderdate").alias("y"), "o_totalprice")
    return S.trend(o, "g", "y", "o_totalprice").withColumn("rho", F.round("rho", 6) + F.lit(0.0))


@query("""with f as (select l_orderkey, case when l_returnflag in ('A', 'R') then 'back' else 'kept' end as fam, sum(l_quantity) as s from lineitem group by 1, 2) select l_orderkey, round(coalesce(sum(s) filter (where fam = 'back'), 0), 4) as back,
round(coalesce(sum(s) filter (where fam = 'kept'), 0), 4) as kept from f group by 1""")
def feature_sums(spark, d):
    """Features summed by family."""
    back = F.when(F.col("l_returnflag").isin("A", "R"), F.col("l_quantity"))
    kept = F.when(~F.col("l_returnflag").isin("A", "R"), F.col("l_quantity"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.round(F.coalesce(F.sum(back), F.lit(0.0)), 4).alias("back"), F.round(F.coalesce(F.sum(kept), F.lit(0.0)), 4).alias("kept"))


@query("""with g as (select year(l_shipdate) as stage, l_suppkey, sum(l_quantity) as s, count(*) as n, count(*) filter (where l_quantity > 40) as p from lineitem group by 1, 2) select stage, round(sum(s) / sum(n), 7) as pooled,
round(sum(p) / sum(n), 7) as prevalence, round(median(s / n), 7) as median_of_means from g group by 1""")
def trajectory(spark, d):
    """Pooled and group-level statistics along an ordered category."""
    l = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("stage"), "l_suppkey", "l_quantity")
    t = S.trajectory(l, "stage", "l_suppkey", "l_quantity", 40)
    return t.select("stage", *[F.round(c, 7).alias(c) for c in ("pooled", "prevalence", "median_of_means")])


@query("""select meta_id, coalesce(study_accession, '') as accession, coalesce(study_title, '') as title, '' as owner from study_meta""")
def canonical_columns(spark, d):
    """B1: the first alias that exists, else an empty text."""
    m = X.canonicalise(table(spark, d, "study_meta"), {"meta_id": ["meta_id"], "accession": ["acc", "study_accession"], "title": ["study_title", "title"], "owner": ["owner_name"]})
    return m.withColumns({"accession": F.coalesce("accession", F.lit("")), "title": F.coalesce("title", F.lit(""))})


@query("""select unnest(['sample_key', 'confidence', 'quote_words', 'value']) as "check", unnest([(select count(*) from sample_determinations_all where not regexp_matches(upper(trim(sample_key)), '^SAM')),
(select count(*) from sample_determinations_all where not coalesce(confidence between 0 and 1, false)), (select count(*) from sample_determinations_all where not coalesce(evidence_quote is null or
length(evidence_quote) - length(replace(evidence_quote, ' ', '')) < 12, false)), (select count(*) from sample_determinations_all where value_normalized is null)]) as failures""")
def contract_checks(spark, d):
    """All checks of a contract in one pass."""
    q = F.col("evidence_quote")
    checks = {
        "sample_key": F.upper(F.trim("sample_key")).startswith("SAM"),
        "confidence": F.col("confidence").between(0, 1),
        "quote_words": q.isNull() | (F.length(q) - F.length(F.replace(q, F.lit(" "), F.lit(""))) < 12),
        "value": F.col("value_normalized").isNotNull(),
    }
    return X.violations(table(spark, d, "sample_determinations_all"), checks)


@query("select det_id, release_added from sample_determinations_all where release_retired is null")
def current_rows(spark, d):
    """The current snapshot; the filter reaches the scan."""
    return table(spark, d, "sample_determinations_all").where("release_retired is null").select("det_id", "release_added")


@query("""select p_partkey, list_contains(string_split(lower(p_type), ' '), 'steel') as has_code from part""")
def list_membership(spark, d):
    """A code in a list held as text."""
    return table(spark, d, "part").select("p_partkey", T.has_code(F.translate(F.lower("p_type"), " ", ";"), "steel").alias("has_code"))


@query("""select meta_id, study_accession from study_meta where study_title ilike '%preterm%' and center_name is not null and try_cast(left(received_at::varchar, 4) as int) between 2025 and 2026 and
secondary_study_accession is null""")
def explorer_filter(spark, d):
    """An interactive predicate."""
    cols = {"text": "study_title", "accession": "study_accession", "year": "received_at", "second": "secondary_study_accession"}
    p = X.predicate({"text": "preterm", "year": (2025, 2026), "second": None}, cols)
    return table(spark, d, "study_meta").where(p & F.col("center_name").isNotNull()).select("meta_id", "study_accession")


@query("""with k as (select * from orders where o_orderstatus in ('F', 'O') and o_totalprice between 50000 and 150000) select o_orderkey, o_custkey from k where o_custkey in (select o_custkey from k group by 1 having count(*) >= 3)""")
def collection_mask(spark, d):
    """A named collection with a subject count on the rows kept."""
    spec = {"filters": {"o_orderstatus": ["F", "O"], "o_totalprice": {"min": 50000, "max": 150000}}, "least_per_subject": 3}
    return X.collection(table(spark, d, "orders"), spec, "o_orderkey", "o_custkey")[0].select("o_orderkey", "o_custkey")


@query("""select o_orderkey from orders where not coalesce(o_totalprice > 200000, false) and not coalesce(case when o_custkey % 3 = 0 then o_orderstatus = 'F' end, false)""")
def qc_filter(spark, d):
    """None of the flags, null as false, absent flags ignored."""
    o = table(spark, d, "orders").withColumn("big", F.col("o_totalprice") > 200000).withColumn("odd", F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderstatus") == "F"))
    return X.qc_filter(o, ["big", "odd", "not_there"]).select("o_orderkey")


@query("""select c_custkey, concat_ws(';', case when c_acctbal > 5000 then 'rich' end, case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'heavy' end, case when c_nationkey < 5 then 'near' end) as scopes,
case when c_acctbal < 0 then 'debt' when c_acctbal > 9000 then 'top' else 'plain' end as class from customer""")
def scope_membership(spark, d):
    """Scopes whose rule holds; a first-match ladder."""
    rules = {"rich": F.col("c_acctbal") > 5000, "heavy": F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "near": F.col("c_nationkey") < 5}
    cls = T.ladder([(F.col("c_acctbal") < 0, "debt"), (F.col("c_acctbal") > 9000, "top")], "plain")
    return table(spark, d, "customer").select("c_custkey", X.scopes(rules).alias("scopes"), cls.alias("class"))


@query("""select det_id from sample_determinations_all where (field_name, upper(trim(route))) in (('sex', 'R1'), ('country', 'R1'), ('country', 'R2')) or lower(trim(src_track)) = 'infant_catalog'""")
def route_allow_list(spark, d):
    """Allowed routes per field, one track exempt."""
    allowed = spark.createDataFrame([("sex", "R1"), ("country", "R1"), ("country", "R2")], "f string, r string").withColumn("ok", F.lit(True))
    t = table(spark, d, "sample_determinations_all").select("det_id", "field_name", F.upper(F.trim("route")).alias("route"), F.lower(F.trim("src_track")).alias("track"))
    j = t.join(F.broadcast(allowed), (F.col("field_name") == F.col("f")) & (F.col("route") == F.col("r")), "left")  # a configured list
    return j.where((F.col("track") == "infant_catalog") | F.col("ok")).select("det_id")


@query("""select term_id, string_agg(distinct x, ';' order by x) as codes from (select term_id, unnest(string_split(lower(coalesce(synonyms, '') || '|' || label), '|')) as x from vocab_terms)
where x in ('usa', 'france', 'skin', 'f', 'male', 'female') group by 1""")
def validate_values(spark, d):
    """Lists reduced to valid codes."""
    v = table(spark, d, "vocab_terms").select("term_id", F.translate(F.lower(F.concat_ws("|", "synonyms", "label")), "|", ";").alias("l"))
    return v.select("term_id", X.validate_list(F.col("l"), ["usa", "france", "skin", "f", "male", "female"]).alias("codes")).where("codes is not null")


@query("""select det_id, coalesce(nullif(trim(field_value), ''), nullif(trim(value_normalized), ''), '') as v, case when nullif(trim(field_value), '') is not null then 'field_value' when nullif(trim(value_normalized), '')
is not null then 'value_normalized' else 'none' end as basis from sample_determinations_all""")
def coalesce_cascade(spark, d):
    """The first filled column with its name."""
    a, b = [F.when(F.trim(c) != "", F.trim(c)) for c in ("field_value", "value_normalized")]
    return table(spark, d, "sample_determinations_all").select("det_id", F.coalesce(a, b, F.lit("")).alias("v"), F.when(a.isNotNull(), "field_value").when(b.isNotNull(), "value_normalized").otherwise("none").alias("basis"))


@query(r"""select doc_id, concat_ws(';', case when regexp_matches(text, '(?i)\b(?:range|ranged)\b') then 'range' end, case when regexp_matches(text, '(?i)\b(?:mean|median|average)\b') then 'summary' end, case when regexp_matches(text,
'(?i)\b(?:less|more) than|percent\b') then 'threshold' end) as broken from documents where text is not null""")
def statement_lint(spark, d):
    """Rules a statement breaks."""
    rules = {"range": r"(?i)\b(?:range|ranged)\b", "summary": r"(?i)\b(?:mean|median|average)\b", "threshold": r"(?i)\b(?:less|more) than|percent\b"}
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(T.lint(F.col("text"), rules), ";").alias("broken"))


@query("""select m.study_accession from (select study_accession, min(study_title) as t, max(study_title) as u from study_meta group by 1) m where lower(t) <> lower(u)""")
def label_guard(spark, d):
    """Ids whose labels disagree (none may)."""
    g = table(spark, d, "study_meta").groupBy("study_accession").agg(F.min("study_title").alias("t"), F.max("study_title").alias("u"))
    return g.where(F.lower("t") != F.lower("u")).select("study_accession")


@query()
def classify_studies(spark, d):
    """Studies classified from weighted text sources."""
    m = table(spark, d, "study_meta").groupBy("study_accession").agg(F.min("study_title").alias("title"), F.min("description").alias("descr"))
    sources = {"title": ("title", 2.0), "description": ("descr", 1.0)}
    classes = {"infant": r"(?i)infant|preterm|early-life|neonat", "adult": r"(?i)adult|ageing|elder", "disease": r"(?i)bowel|cancer|diabet|crohn"}
    return X.classify(m, "study_accession", sources, classes, 2.0)


SQL["classify_studies"] = """with m as (select study_accession, min(study_title) as title, min(description) as descr from study_meta group by 1), c(class, p) as (values ('infant', '(?i)infant|preterm|early-life|neonat'),
('adult', '(?i)adult|ageing|elder'), ('disease', '(?i)bowel|cancer|diabet|crohn')), s as (select study_accession, class, case when coalesce(regexp_matches(title, p), false) then 2.0 else 0 end as a, case when
coalesce(regexp_matches(descr, p), false) then 1.0 else 0 end as b from m, c), r as (select *, row_number() over (partition by study_accession order by -(a + b), class) as rn, sum(a + b) over (partition by study_accession) as t from s)
select study_accession, case when a + b >= 2 then class else 'unknown' end as class, a + b as score, round(coalesce((a + b) / nullif(t, 0), 0), 6) as confidence, case when a + b >= 2 then concat_ws(';', case when a > 0 then 'title' end,
case when b > 0 then 'description' end) end as evidence from r where rn = 1"""


@query("""with a as (select sample_key as k, field_name as f, min(lower(trim(value_normalized))) as v, avg(confidence) as c from determination_snapshots where release_id = 'R2026.9' group by 1, 2), b as (select sample_key as k,
field_name as f, min(lower(trim(value_normalized))) as v, avg(confidence) as c from determination_snapshots where release_id = 'R2026.12' group by 1, 2)
select coalesce(a.k || '|' || a.f, b.k || '|' || b.f) as k, case when a.k is not null and b.k is not null and a.v is not distinct from b.v then b.v end as v, case when a.k is not null and b.k is not null and a.v is not distinct from b.v
then round((a.c + b.c) / 2, 6) end as c, case when a.k is not null and b.k is not null and a.v is not distinct from b.v then 'merged' else 'queue' end as status from a full join b on a.k = b.k and a.f = b.f""")
def replicate_agreement(spark, d):
    """K4: replicates that agree are merged, others queued."""
    t = table(spark, d, "determination_snapshots").withColumn("k", F.concat_ws("|", "sample_key", "field_name"))
    one = lambda r: t.where(F.col("release_id") == r).groupBy("k").agg(F.min(F.lower(F.trim("value_normalized"))).alias("v"), F.avg("confidence").alias("c"))
    return X.merge_replicates(one("R2026.9"), one("R2026.12"), "k", ["v"], "c").withColumn("c", F.round("c", 6))


@query("""with c as (select o_orderpriority, o_orderstatus, o_orderkey from orders), dcs as (select o_orderpriority, o_orderstatus, case when count(*) % 2 = 0 then 'a' else 'b' end as decision from c where o_orderstatus <> 'P' group by 1, 2)
select o_orderkey, coalesce(decision, 'open') as decision from c left join dcs using (o_orderpriority, o_orderstatus)""")
def adjudicate(spark, d):
    """K5: decisions by pattern fanned back to the conflicts."""
    c = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    dec = c.where("o_orderstatus <> 'P'").groupBy("o_orderpriority", "o_orderstatus").agg(F.when(F.count(F.lit(1)) % 2 == 0, "a").otherwise("b").alias("decision"))
    return X.adjudicate(c, dec, ["o_orderpriority", "o_orderstatus"]).select("o_orderkey", "decision")


@query("""with c as (select study_accession, count(*) as n, round(avg((field_value is not null)::int), 9) as field_value, round(avg((confidence is not null)::int), 9) as confidence, round(avg((evidence_quote is not null)::int), 9) as evidence_quote,
max((route is null)::int) as no_route from sample_determinations_all group by 1), s as (select study_accession, concat_ws(';', case when field_value < 1 then 'field_value' end, case when confidence < 1 then 'confidence' end, case when
evidence_quote < 1 then 'evidence_quote' end) as missing, round(((1 - field_value) + 0.5 * (1 - confidence) + 0.25 * (1 - evidence_quote)) * log10(n + 1), 6) as score, n, case when no_route = 1 then 'no route' when field_value < 0.5 then
'sparse' else 'none' end as blocker from c) select study_accession, missing, score, blocker, row_number() over (order by score desc, n desc, study_accession) as place from s where missing <> ''""")
def worklist(spark, d):
    """K6: groups ordered by what is missing, with the first blocker."""
    full = lambda c: F.round(F.avg(F.col(c).isNotNull().cast("int")), 9).alias(c)
    fields = ["field_value", "confidence", "evidence_quote"]
    c = table(spark, d, "sample_determinations_all").groupBy("study_accession").agg(F.count(F.lit(1)).alias("n"), *[full(f) for f in fields], F.max(F.col("route").isNull().cast("int")).alias("no_route"))
    w = X.worklist(c, "study_accession", "n", {"field_value": 1.0, "confidence": 0.5, "evidence_quote": 0.25}, [("no route", F.col("no_route") == 1), ("sparse", F.col("field_value") < 0.5)])
    return w.drop("n")


@query("""with h as (select p_type, avg((l_returnflag = 'R')::int) as hit from lineitem join part on p_partkey = l_partkey group by 1), a as (select p_type, count(*) as n from part group by 1)
select p_type, case when coalesce(hit, 0) >= 0.5 then 'attribute' when n >= 5 then 'table' when hit > 0 then 'weak' else 'none' end as tier, case when coalesce(hit, 0) >= 0.5 then 0.9 when n >= 5 then 0.6 when hit > 0 then 0.3 else 0.0 end as conf
from a left join h using (p_type)""")
def recoverability(spark, d):
    """The first rung that applies per group."""
    p = table(spark, d, "part")
    l = table(spark, d, "lineitem").select("l_returnflag", F.col("l_partkey").alias("p_partkey"))
    h = l.join(p.select("p_partkey", "p_type"), "p_partkey").groupBy("p_type").agg(F.avg((F.col("l_returnflag") == "R").cast("int")).alias("hit"))
    a = p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).join(h, "p_type", "left")
    tier = T.ladder([(F.col("hit") >= 0.5, "attribute"), (F.col("n") >= 5, "table"), (F.col("hit") > 0, "weak")], "none")
    return a.select("p_type", tier.alias("tier")).withColumn("conf", F.when(F.col("tier") == "attribute", 0.9).when(F.col("tier") == "table", 0.6).when(F.col("tier") == "weak", 0.3).otherwise(0.0))


@query("""select q.c_custkey, coalesce(r.v, 'no_answer') as v, coalesce(r.n, 0) as n from (select c_custkey from customer where c_custkey % 4 = 0) q left join (select o_custkey, min(v).v as v, min(v).n as n from (select o_custkey, {'v': o_orderstatus, 'n': 1} as v
from orders) group by 1) r on r.o_custkey = q.c_custkey""")
def parse_batch(spark, d):
    """One row per requested id, a sentinel where the answer is missing."""
    r = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("v"), F.lit(1).alias("n"))
    return X.parse_batch(r, table(spark, d, "customer").where("c_custkey % 4 = 0").select("c_custkey"), "c_custkey", {"v": "no_answer", "n": 0})


@query()
def permanova_baseline(spark, d):
    """Variance explained beside its mean under permuted labels."""
    v = S.variance_baseline(table(spark, d, "embeddings"), "label", "embedding", 64, "vec_id", [1, 2, 3])
    return v.select("n", F.round("r2", 5).alias("r2"), F.round("baseline", 5).alias("baseline"))


CARDS = """with x as (select l_suppkey as g, unnest([{'card': 'large', 'arm': l_quantity > 25}, {'card': 'returned', 'arm': case when l_returnflag <> 'A' then l_returnflag = 'R' end}]) as c, l_discount, l_tax from lineitem),
y as (select g, c.card as card, c.arm as arm, unnest([{'f': 'l_discount', 'v': l_discount}, {'f': 'l_tax', 'v': l_tax}]) as f from x), z as (select g, card, f.f as feature, sum(f.v) filter (where arm) as s1, sum(f.v) filter (where not arm) as s0, count(*) filter (where arm) as n1,
count(*) filter (where not arm) as n0 from y where arm is not null group by 1, 2, 3)"""


@query(CARDS + """ select card, feature, count(*) as groups, round(median(s1 / n1 - s0 / n0), 7) as median_effect, round(greatest(avg((s1 / n1 > s0 / n0)::int), 1 - avg((s1 / n1 > s0 / n0)::int)), 7) as agreement,
round(sum(s1) / sum(n1) - sum(s0) / sum(n0), 7) as pooled_effect from z where n1 >= 20 and n0 >= 20 group by 1, 2""")
def contrast_cards(spark, d):
    """Contrasts of several features under several masks, inside groups, in one pass."""
    l = table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag", "l_discount", "l_tax")
    cards = {"large": F.col("l_quantity") > 25, "returned": F.when(F.col("l_returnflag") != "A", F.col("l_returnflag") == "R")}
    c = S.contrast_cards(l, "l_suppkey", cards, ["l_discount", "l_tax"])
    return c.select("card", "feature", "groups", *[F.round(x, 7).alias(x) for x in ("median_effect", "agreement", "pooled_effect")])


@query("""select 'orders' as card, 'done' as status, count(*) as rows from orders union all select 'broken', 'failed', null union all select 'unplanned', 'failed', null union all select 'empty', 'skipped', 0""")
def isolated_cards(spark, d):
    """Cards run one by one; those that fail while planned or while running, or have no rows, are recorded."""
    from sedimenta.sources.io import scratch

    o = table(spark, d, "orders")
    cards = {
        "orders": lambda: o.select("o_orderkey"), "broken": lambda: o.select(F.raise_error(F.lit("no")).cast("string").alias("x")), "unplanned": lambda: o.select("no_such_column"),
        "empty": lambda: o.where("o_orderkey < 0").select("o_orderkey"),
    }
    return S.run_all(cards, scratch(spark)).drop("message")


@query(f"""select det_id from sample_determinations_all where not coalesce(lower(trim(scope)) <> 'sample' and try_cast(trim(value_normalized) as double) is not null and not regexp_matches(lower(trim(value_normalized)), 'nan|inf|e') and regexp_matches(evidence_quote, '{X.COMPARATIVE}') and not coalesce(regexp_matches(evidence_quote, '(?i)infant'), false), false)""")
def threshold_quotes(spark, d):
    """Numeric group statements quoted from comparative wording left out, unless the quote speaks of the default class."""
    t = table(spark, d, "sample_determinations_all").withColumn("v", T.number(F.col("value_normalized")).cast("string"))
    return X.threshold_filter(t, F.lower(F.trim("scope")) != "sample", "v", "evidence_quote", F.col("evidence_quote").rlike("(?i)infant")).select("det_id")
