"""Queries of the join operators on the test tables, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sedimenta.operators import joins as J
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()


@query("""select a.det_id, m.center_name, m.study_title from sample_determinations_all a left join (select study_accession, min({'c': center_name, 't': study_title}) as s,
any_value(center_name) as center_name, min(study_title) as study_title from study_meta group by 1) m using (study_accession)""")
def enrich_study(spark, d):
    """Enrichment by a dimension that holds its key more than once."""
    a = table(spark, d, "sample_determinations_all").select("det_id", "study_accession")
    return J.lookup(a, table(spark, d, "study_meta"), "study_accession", ["center_name", "study_title"]).drop("study_accession")


@query("""select l_orderkey, o_custkey, p_brand, round(sum(l_quantity), 4) as qty from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey
where p_size < 10 group by all""")
def inner_join(spark, d):
    """Inner equi-joins over two keys, the filter pushed to the dimension."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, d, "part").where("p_size < 10").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return l.join(p, "l_partkey").join(o, "l_orderkey").groupBy("l_orderkey", "o_custkey", "p_brand").agg(F.round(F.sum("l_quantity"), 4).alias("qty"))


@query("""with k as (select attr_id, upper(trim(sample_key)) as sample_key, coalesce(attr_key_norm, trim(regexp_replace(lower(attr_key), '[^a-z0-9]+', '_', 'g'), '_')) as k, lower(trim(value)) as v
from sample_attributes_new), norm as (select 'sex' as k, lower(label) as v, code, term_id from vocab_terms where vocabulary = 'sex' union all select 'host_sex', lower(label), code, term_id
from vocab_terms where vocabulary = 'sex' union all select 'sex', lower(synonyms), code, term_id from vocab_terms where vocabulary = 'sex')
select attr_id, sample_key, code from (select k.attr_id, k.sample_key, n.code, row_number() over (partition by attr_id order by n.term_id, n.code) as rn from k left join norm n using (k, v)
where k.k in ('sex', 'host_sex')) where rn = 1""")
def composite_enrichment(spark, d):
    """Attribute rows joined to a (key, value) map with several candidates, then the best."""
    from sedimenta.functions.keys import normal_key
    from sedimenta.operators.resolve import best_row

    a = table(spark, d, "sample_attributes_new").select(
        "attr_id", F.upper(F.trim("sample_key")).alias("sample_key"), F.coalesce("attr_key_norm", normal_key(F.col("attr_key"))).alias("k"), F.lower(F.trim("value")).alias("v")
    )
    t = table(spark, d, "vocab_terms").where("vocabulary = 'sex'")
    forms = t.select("code", "term_id", F.explode(F.array(F.struct(F.lit("sex").alias("k"), F.lower("label").alias("v")), F.struct(F.lit("host_sex").alias("k"), F.lower("label").alias("v")), F.struct(F.lit("sex").alias("k"), F.lower("synonyms").alias("v")))).alias("x"))
    j = a.where("k in ('sex', 'host_sex')").join(forms.select("x.k", "x.v", "code", "term_id"), ["k", "v"], "left")
    return best_row(j.select("attr_id", "sample_key", "code", "term_id"), ["attr_id"], [F.col("term_id"), F.col("code")]).select("attr_id", "sample_key", "code")


PREV_CUR = """prev as (select o_orderkey, o_orderstatus from orders where o_orderdate < timestamp '2000-01-01'), cur as (select o_orderkey, case when o_orderkey % 13 = 0 then
o_orderstatus || '*' else o_orderstatus end as o_orderstatus from orders where o_orderkey % 17 <> 0)"""


def prev_cur(spark, d):
    """Two synthetic snapshots of the orders."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    prev = o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).drop("o_orderdate")
    status = F.when(F.col("o_orderkey") % 13 == 0, F.concat("o_orderstatus", F.lit("*"))).otherwise(F.col("o_orderstatus"))
    return prev, o.where("o_orderkey % 17 <> 0").select("o_orderkey", status.alias("o_orderstatus"))


@query("with " + PREV_CUR + """ select coalesce(p.o_orderkey, c.o_orderkey) as o_orderkey, case when p.o_orderkey is null then 'added' when c.o_orderkey is null then 'removed' else 'changed' end
as change from prev p full join cur c on p.o_orderkey = c.o_orderkey where p.o_orderkey is null or c.o_orderkey is null or p.o_orderstatus <> c.o_orderstatus""")
def snapshot_diff(spark, d):
    """C4: full outer difference of two snapshots."""
    return J.snapshot_diff(*prev_cur(spark, d), ["o_orderkey"], ["o_orderstatus"])


@query("with " + PREV_CUR + " select * from (select * from cur except select * from prev)")
def anti_rows(spark, d):
    """Rows of one frame with no equal row in the other."""
    prev, cur = prev_cur(spark, d)
    return J.missing_in(cur, prev, cur.columns)


@query("""select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 200000) as big from customer where c_custkey in (select o_custkey from orders)""")
def semi_anti(spark, d):
    """Membership filters."""
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    have = c.join(o, "c_custkey", "left_semi")
    big = o.where("o_totalprice > 200000")
    return have.join(big, "c_custkey", "left_semi").withColumn("big", F.lit(True)).unionByName(have.join(big, "c_custkey", "left_anti").withColumn("big", F.lit(False)))


@query("with " + PREV_CUR + """, st as (select *, 'R1' as release_added, case when o_orderkey % 11 = 0 then 'R2' end as release_retired from prev)
select c.o_orderkey, c.o_orderstatus, coalesce(p.release_added, 'R3') as release_added, null as release_retired from cur c left join st p on p.o_orderkey = c.o_orderkey and p.release_retired is null
union all select o_orderkey, o_orderstatus, release_added, 'R3' from st where release_retired is null and o_orderkey not in (select o_orderkey from cur)
union all select o_orderkey, o_orderstatus, release_added, release_retired from st where release_retired is not null""")
def carry_release(spark, d):
    """Stamps carried, vanished rows retired, history kept."""
    prev, cur = prev_cur(spark, d)
    st = prev.withColumn("release_added", F.lit("R1")).withColumn("release_retired", F.when(F.col("o_orderkey") % 11 == 0, "R2"))
    return J.carry_release(cur, st, ["o_orderkey"], "R3")


@query("""with v as (select n_regionkey as parent, n_nationkey as node, count(*) as n from customer join nation on n_nationkey = c_nationkey group by 1, 2)
select node, n, sum(n) over (partition by parent) as parent_total from v""")
def parent_child(spark, d):
    """Each node beside the sum of its siblings' parent."""
    n = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    v = n.join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("node")).select("node", F.col("n_regionkey").alias("parent"), "n")
    return v.join(v.groupBy("parent").agg(F.sum("n").alias("parent_total")), "parent").select("node", "n", "parent_total")


@query("""with s as (select study_accession as k, min(meta_id) as v from study_meta group by 1), t as (select secondary_study_accession as k, min(meta_id) as v from study_meta where
secondary_study_accession is not null group by 1), q as (select distinct study_accession as a, replace(study_accession, 'PRJ', 'ERP') as b from sample_attributes_new union
select distinct secondary_study_accession, secondary_study_accession from study_meta where secondary_study_accession is not null)
select q.a, coalesce(s.v, t.v) as resolved, case when s.v is not null then 'a' when t.v is not null then 'b' end as resolved_by from q left join s on s.k = q.a left join t on t.k = q.b""")
def cascade_key(spark, d):
    """A key resolved by primary, else by secondary accession."""
    m = table(spark, d, "study_meta")
    a = table(spark, d, "sample_attributes_new").select(F.col("study_accession").alias("a"), F.replace("study_accession", F.lit("PRJ"), F.lit("ERP")).alias("b"))
    b = m.where("secondary_study_accession is not null").select(F.col("secondary_study_accession").alias("a"), F.col("secondary_study_accession").alias("b"))
    q = a.union(b).distinct()
    return J.cascade(q, ["a", "b"], [(m, "study_accession", "meta_id"), (m, "secondary_study_accession", "meta_id")]).drop("b")


@query("""with ids as (select distinct case c_custkey % 4 when 0 then c_name when 1 then lower(c_name) when 2 then replace(c_name, '#', '-') else 'customer' || c_custkey end as id from customer),
t as (select distinct c_name as target from customer), f as (select target, 0 as lv, 'exact' as level, trim(target) as form from t union all select target, 1, 'casefold', lower(trim(target)) from t
union all select target, 2, 'alnum', regexp_replace(lower(trim(target)), '[^a-z0-9]', '', 'g') from t union all select target, 3, 'no_zeros', regexp_replace(regexp_replace(lower(trim(target)),
'[^a-z0-9]', '', 'g'), '(^|[a-z])0+([0-9])', '\\1\\2', 'g') from t union all select target, 4, 'digits', regexp_replace(regexp_replace(lower(target), '[^0-9]', '', 'g'), '^0+', '') from t),
u as (select lv, level, form, min(target) as target from f where form <> '' group by 1, 2, 3 having count(distinct target) = 1),
g as (select id, 0 as lv, trim(id) as form from ids union all select id, 1, lower(trim(id)) from ids union all select id, 2, regexp_replace(lower(trim(id)), '[^a-z0-9]', '', 'g') from ids
union all select id, 3, regexp_replace(regexp_replace(lower(trim(id)), '[^a-z0-9]', '', 'g'), '(^|[a-z])0+([0-9])', '\\1\\2', 'g') from ids union all select id, 4,
regexp_replace(regexp_replace(lower(id), '[^0-9]', '', 'g'), '^0+', '') from ids)
select id, target, level from (select g.id, u.target, u.level, row_number() over (partition by g.id order by g.lv) as rn from g join u using (lv, form)) where rn = 1""")
def id_match(spark, d):
    """C11, H8: foreign identifiers matched through normal forms from strict to loose."""
    c = table(spark, d, "customer")
    i = F.col("c_custkey") % 4
    form = F.when(i == 0, F.col("c_name")).when(i == 1, F.lower("c_name")).when(i == 2, F.replace("c_name", F.lit("#"), F.lit("-"))).otherwise(F.concat(F.lit("customer"), F.col("c_custkey").cast("string")))
    return J.id_match(c.select(form.alias("id")), c, "id", "c_name")


@query("""with k as (select distinct s_name as v from supplier), l as (select 's_name' as "column", s_name as v from supplier union all select 's_suppkey', s_suppkey::varchar from supplier
union all select 's_nationkey', s_nationkey::varchar from supplier), g as (select "column", count(*) as n, count(distinct v) as dn, count(distinct case when v in (from k) then v end) as hits,
avg((length(v) <= 40)::int) as short from l group by 1)
select "column", hits, n from g where dn >= 0.5 * n and hits >= greatest(3, ceil(dn * 0.5)) order by hits desc, "column" limit 3""")
def joinability(spark, d):
    """Which column of a table matches a key."""
    s = table(spark, d, "supplier")
    return J.joinability(s, ["s_name", "s_suppkey", "s_nationkey"], s, "s_name")


@query("""select c_custkey, case when c_acctbal <= 0 then 'negative' when c_acctbal <= 1000 then 'low' when c_acctbal <= 5000 then 'middle' else 'high' end as bin from customer""")
def interval_lookup(spark, d):
    """A value placed in closed intervals."""
    bins = [("negative", None, 0), ("low", 0, 1000), ("middle", 1000, 5000), ("high", 5000, None)]
    return table(spark, d, "customer").select("c_custkey", J.interval_bins(F.col("c_acctbal"), bins).alias("bin"))


@query("""with st as (select s_nationkey as g, 'all' as kind, null as target, s_suppkey as k, 0.9 as c from supplier where s_suppkey % 3 = 0 union all select s_nationkey, 'label', ' Building', s_suppkey, 0.5 from supplier where s_suppkey % 3 = 1
union all select s_nationkey, 'regex', '[13579]$', s_suppkey, null from supplier where s_suppkey % 3 = 2) select c.c_nationkey as g, c.c_custkey, st.k, st.kind, case when st.kind = 'all' then 0.8 when st.kind = 'label' then 0.5 else 0.6 end as confidence
from customer c join st on st.g = c.c_nationkey and case st.kind when 'all' then true when 'label' then lower(c.c_mktsegment) = 'building' else regexp_matches(c.c_name, '[13579]$') end""")
def typed_targets(spark, d):
    """Statements that target all members, a label, or a pattern over names."""
    s, m3 = table(spark, d, "supplier"), F.col("s_suppkey") % 3
    st = s.select(
        F.col("s_nationkey").alias("g"), F.when(m3 == 0, "all").when(m3 == 1, "label").otherwise("regex").alias("kind"), F.when(m3 == 1, " Building").when(m3 == 2, "[13579]$").alias("target"), F.col("s_suppkey").alias("k"),
        F.when(m3 == 0, 0.9).when(m3 == 1, 0.5).alias("confidence"),
    )
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("g"), "c_custkey", "c_mktsegment", "c_name")
    return J.expand_targets(st, c, "g", "c_custkey", "c_mktsegment", "c_name", ["k"])


@query("""with p as (select c_custkey, (c_custkey % 179) - 89 + (c_custkey % 7) / 10.0 as lat, (c_custkey * 7 % 360) - 180 + (c_custkey % 10) / 10.0 as lon from customer),
q as (select s_name as place, (s_suppkey * 3 % 179) - 89 + 0.2 as lat2, (s_suppkey * 21 % 360) - 180 + 0.3 as lon2 from supplier),
j as (select c_custkey, place, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon) / 2), 2)))) as km from p, q)
select c_custkey, place, round(km, 5) as km from (select *, row_number() over (partition by c_custkey order by km, place) as rn from j where km <= 300) where rn = 1""")
def nearest_place(spark, d):
    """The nearest place within reach, over the whole globe, through cells of equal width."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    p = table(spark, d, "customer").select("c_custkey", ((k % 179) - 89 + (k % 7) / 10.0).alias("lat"), ((k * 7 % 360) - 180 + (k % 10) / 10.0).alias("lon"))
    q = table(spark, d, "supplier").select(F.col("s_name").alias("place"), ((s * 3 % 179) - 89 + 0.2).alias("lat"), ((s * 21 % 360) - 180 + 0.3).alias("lon"))
    return J.nearest(p, q, "c_custkey", 300).withColumn("km", F.round("km", 5))


@query("""with recursive e as (select distinct c_custkey as a, c_custkey + 1 as b from customer where c_custkey % 5 <> 0), u as (select a, b from e union select b, a from e),
r(node, root) as (select a, a from u union select u.b, r.root from r join u on u.a = r.node where r.root < u.b) select node, min(root) as root from r group by 1""")
def components(spark, d):
    """C20: connected components."""
    c = table(spark, d, "customer").where("c_custkey % 5 <> 0")
    return J.components(c.select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 1).alias("b")), "a", "b")


@query("""with x as (select l_suppkey % 7 as grp, l_quantity as sib, l_quantity / case when l_suppkey % 7 < 3 then 7.0 when l_suppkey % 7 < 5 then 30.4375 else 2.0 end as x from lineitem)
select grp, case when grp < 3 then 'week' else 'month' end as unit, count(*) as n from x where grp < 5 group by 1""")
def unit_inference(spark, d):
    """The unit whose conversion agrees with a sibling column."""
    g = F.col("l_suppkey") % 7
    x = table(spark, d, "lineitem").select(g.alias("grp"), F.col("l_quantity").alias("sib"), (F.col("l_quantity") / F.when(g < 3, 7.0).when(g < 5, 30.4375).otherwise(2.0)).alias("x"))
    return J.infer_unit(x, "grp", "x", "sib", {"day": 1.0, "week": 7.0, "month": 30.4375, "year": 365.25})


@query("""with g as (select o_orderpriority as g, min(o_orderstatus) as v from orders group by 1 union all select 'none', 'F'), m as (select o_orderpriority as g, o_orderstatus as m from orders),
bad as (select g.g from g join m using (g) group by 1 having count(*) >= 5 and avg((g.v <> m.m)::int) > 0.5) select g, v from g where g not in (from bad)""")
def consistency(spark, d):
    """Group statements that their members do not contradict."""
    o = table(spark, d, "orders")
    m = o.select(F.col("o_orderpriority").alias("g"), F.col("o_orderstatus").alias("v"))
    g = m.groupBy("g").agg(F.min("v").alias("v")).unionByName(spark.createDataFrame([("none", "F")], "g string, v string"))
    return J.consistent(g, m, ["g"], "v", rate=0.5)


@query("""with gold as (select sample_key, field_name, min(lower(trim(value_normalized))) as v from determination_snapshots where value_normalized is not null and release_id = 'R2026.12' group by 1, 2),
det as (select sample_key, field_name, min(lower(trim(value_normalized))) as v from determination_snapshots where value_normalized is not null and release_id = 'R2026.7' group by 1, 2)
select field_name, count(*) as gold_n, count(d.v) as covered, count(*) filter (where d.v = g.v) as agreeing, round(count(*) filter (where d.v = g.v) / nullif(count(d.v), 0), 9) as "precision",
round(count(*) filter (where d.v = g.v) / count(*), 9) as recall from gold g left join det d using (sample_key, field_name) group by 1""")
def gold_score(spark, d):
    """Coverage, precision and recall against gold values."""
    s = table(spark, d, "determination_snapshots").where("value_normalized is not null").withColumn("v", F.lower(F.trim("value_normalized")))
    one = lambda r: s.where(F.col("release_id") == r).groupBy("sample_key", "field_name").agg(F.min("v").alias("v"))
    x = J.score_against(one("R2026.7"), one("R2026.12"), ["sample_key", "field_name"], "field_name", "v")
    return x.withColumn("precision", F.round("precision", 9)).withColumn("recall", F.round("recall", 9))


@query("""select c.c_custkey, min(s.s_acctbal) as inherited from customer c join supplier s on s.s_nationkey = c.c_nationkey where c.c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')
group by 1""")
def propagate(spark, d):
    """Constants of a parent copied to children without their own."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    own = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    p = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.min("s_acctbal").alias("inherited"))
    return c.join(own, "c_custkey", "left_anti").join(p, "k").select("c_custkey", "inherited")


@query("""with i as (select distinct c_name as id from customer union select distinct upper(trim(sample_key)) from sample_attributes_new union select s_name from supplier union select study_accession from documents),
h as (select c_name as id, 0 as o, 'customer.c_name' as path from customer union select s_name, 1, 'supplier.s_name' from supplier union select study_accession, 2, 'study_meta.study_accession' from study_meta union
select secondary_study_accession, 3, 'study_meta.secondary_study_accession' from study_meta union select sample_key, 4, 'determination_snapshots.sample_key' from determination_snapshots)
select i.id, coalesce(arg_min(path, o), 'none') as path from i left join h using (id) where i.id is not null group by 1""")
def locate_identifier(spark, d):
    """An identifier searched through a fixed order of (table, column)."""
    src = [("customer", "c_name"), ("supplier", "s_name"), ("study_meta", "study_accession"), ("study_meta", "secondary_study_accession"), ("determination_snapshots", "sample_key")]
    asked = [("customer", F.col("c_name")), ("sample_attributes_new", F.upper(F.trim("sample_key"))), ("supplier", F.col("s_name")), ("documents", F.col("study_accession"))]
    ids = reduce(lambda a, b: a.union(b), [table(spark, d, t).select(c.alias("id")) for t, c in asked]).where("id is not null").distinct()
    every = [table(spark, d, t).select(F.col(c).alias("id")).distinct().withColumns({"o": F.lit(i), "path": F.lit(f"{t}.{c}")}) for i, (t, c) in enumerate(src)]
    hit = reduce(lambda a, b: a.union(b), every).groupBy("id").agg(F.min_by("path", "o").alias("path"))
    return ids.join(hit, "id", "left").withColumn("path", F.coalesce("path", F.lit("none")))


@query("""select c_custkey, coalesce(v, 'not_screened') as verdict, v is not null as screened from customer left join (select o_custkey, min(o_orderstatus) as v from orders where o_totalprice > 250000 group by 1)
on o_custkey = c_custkey""")
def join_prior(spark, d):
    """Prior verdicts with explicit absence."""
    v = table(spark, d, "orders").where("o_totalprice > 250000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderstatus").alias("v"))
    j = table(spark, d, "customer").select("c_custkey").join(v, "c_custkey", "left")
    return j.select("c_custkey", F.coalesce("v", F.lit("not_screened")).alias("verdict"), F.col("v").isNotNull().alias("screened"))


@query("""select p.event_id, v.event_id as matched_event_id, v.value as matched_value, v.ts as matched_time from (select * from events where event_type = 'purchase') p asof left join
(select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts""")
def asof_join(spark, d):
    """As-of join: the latest view at or before each purchase of the same user."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    p, v = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'view'")
    return J.asof(p, v, ["user_id"], "ts", "ts", ["event_id", "value"]).drop("user_id", "ts")
