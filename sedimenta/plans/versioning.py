"""Queries of the release-versioning operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import versioned as V
from sedimenta.operators.eav import small
from sedimenta.plans.joining import PREV_CUR, prev_cur
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()


@query("select o_orderkey, o_orderstatus, 'R3' as release_added, null as release_retired, '1.3' as package_added from orders")
def stamp(spark, d):
    """Release columns appended."""
    return V.stamp(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "R3", "1.3")


SEED = "with " + PREV_CUR + ", prior as (select o_orderkey, case when o_orderkey % 2 = 0 then 'R1' else 'R2' end as release_added from prev)"


@query(SEED + """ select c.o_orderkey, c.o_orderstatus, case when p.o_orderkey is null or p.o_orderstatus is distinct from c.o_orderstatus then 'R3' else r.release_added end as release_added
from cur c left join prev p using (o_orderkey) left join prior r using (o_orderkey)""")
def bitemporal_seed(spark, d):
    """Stamps carried for unchanged rows, new for new and changed ones."""
    prev, cur = prev_cur(spark, d)
    prior = prev.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "R1").otherwise("R2").alias("release_added"))
    return V.seed_incremental(cur, prior, prev, ["o_orderkey"], ["o_orderstatus"], "R3")


@query(SEED + """ select p.o_orderkey, p.o_orderstatus, r.release_added, 'R3' as release_retired, case when c.o_orderkey is null then 'gone' else 'changed' end as retired_reason
from prev p join prior r using (o_orderkey) left join cur c using (o_orderkey) where c.o_orderkey is null or c.o_orderstatus is distinct from p.o_orderstatus""")
def bitemporal_retire(spark, d):
    """Rows gone or changed since the previous release, retired."""
    prev, cur = prev_cur(spark, d)
    st = prev.withColumn("release_added", F.when(F.col("o_orderkey") % 2 == 0, "R1").otherwise("R2"))
    return V.retire(st, cur, ["o_orderkey"], ["o_orderstatus"], "R3")


@query("""with h as (select det_id, upper(trim(sample_key)) as sample_key, field_name, lower(trim(release_retired)) as rt from sample_determinations_all), n as (select lower(release_id) as t,
row_number() over (order by release_date) as k from releases), m as (select h.*, n.k from h join n on n.t = h.rt) select sample_key, field_name, max(k) as newest_rank, arg_max(det_id, (k, det_id)) as det_id
from m group by 1, 2""")
def seed_history(spark, d):
    """The newest history event per key by registry position."""
    n = V.release_positions(table(spark, d, "releases"))
    h = table(spark, d, "sample_determinations_all").select("det_id", F.upper(F.trim("sample_key")).alias("sample_key"), "field_name", F.lower(F.trim("release_retired")).alias("t"))
    j = h.join(small(n), "t")
    return j.groupBy("sample_key", "field_name").agg(F.max("k").alias("newest_rank"), F.max_by("det_id", F.struct("k", "det_id")).alias("det_id"))


@query("""with h as (select det_id, upper(trim(sample_key)) as sample_key, field_name, lower(trim(value_normalized)) as val, release_retired, n.k from sample_determinations_all left join
(select lower(release_id) as t, row_number() over (order by release_date) as k from releases) n on n.t = lower(trim(release_retired)))
select sample_key, field_name, det_id, row_number() over (partition by sample_key, field_name order by (release_retired is not null)::int, k desc nulls last, det_id) as place from h""")
def value_timeline(spark, d):
    """Current rows first, then retired ones, newest first."""
    n = V.release_positions(table(spark, d, "releases"))
    h = table(spark, d, "sample_determinations_all").select("det_id", F.upper(F.trim("sample_key")).alias("sample_key"), "field_name", F.lower(F.trim("release_retired")).alias("t"), "release_retired")
    return V.value_timeline(h.join(small(n), "t", "left"), ["sample_key", "field_name"], "release_retired", "k", "det_id")


@query("with " + PREV_CUR + """ select 'added' as metric, count(*) as v from cur where o_orderkey not in (select o_orderkey from prev) union all select 'removed', count(*) from prev where o_orderkey not in
(select o_orderkey from cur) union all select 'changed', count(*) from prev join cur using (o_orderkey) where prev.o_orderstatus <> cur.o_orderstatus union all
select 'unchanged', count(*) from prev join cur using (o_orderkey) where prev.o_orderstatus = cur.o_orderstatus""")
def release_report(spark, d):
    """Counts of a release difference."""
    return V.diff_report(*prev_cur(spark, d), ["o_orderkey"], ["o_orderstatus"])


FINDINGS = """det as (select o_orderkey as k, o_orderstatus as v from orders), fx as (select o_orderkey as k, o_custkey as ordinal, case when o_orderkey % 3 = 0 then 'add' else 'supersede' end as action,
'X' as v from orders where o_orderkey % 5 = 0 union all select o_orderkey + 90000000, o_custkey, 'add', 'N' from orders where o_orderkey % 50 = 0),
ok as (select * from (select *, row_number() over (partition by k order by ordinal desc, action, v) as rn from fx) where rn = 1 and (action = 'add' or k in (select k from det)))"""


@query("with " + FINDINGS + """ select k, v, 'current' as status from det where k not in (select k from ok where action = 'supersede') and k not in (select k from ok where action = 'add')
union all select k, v, 'current' from ok union all select d.k, d.v, 'superseded' from det d join ok using (k)""")
def merge_findings(spark, d):
    """Findings applied as a merge, superseded rows kept as history."""
    o = table(spark, d, "orders")
    det = o.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    f = o.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ordinal"), F.when(F.col("o_orderkey") % 3 == 0, "add").otherwise("supersede").alias("action"), F.lit("X").alias("v"))
    g = o.where("o_orderkey % 50 = 0").select((F.col("o_orderkey") + 90000000).alias("k"), F.col("o_custkey").alias("ordinal"), F.lit("add").alias("action"), F.lit("N").alias("v"))
    return V.apply_findings(det, f.unionByName(g), ["k"], "v", "ordinal")


@query("""with x as (select field_name, study_accession, upper(trim(sample_key)) as s, lower(trim(value_normalized)) as v, det_id from sample_determinations_all), c as (select min(det_id) as id, study_accession as cs, 'sex' as cf, '' as old,
'retire' as action, null as new from x where det_id % 500 = 0 and study_accession is not null group by 2 union all select min(det_id), study_accession, 'delivery_mode', 'vaginal', 'recode', 'vaginal_birth' from x where det_id % 300 = 0 and study_accession is not null
group by 2 union all select min(det_id) + 1000000000, study_accession, 'delivery_mode', '', 'recode', 'any_birth' from x where det_id % 200 = 0 and study_accession is not null group by 2),
kept as (select * from x where not exists (select 1 from c where action = 'retire' and cs = study_accession and cf = field_name and (old = '' or old = v))),
m as (select det_id, s, id, new, row_number() over (partition by det_id order by (old = '')::int, id) as r from kept join c on action = 'recode' and cs = study_accession and cf = field_name and (old = '' or old = v)),
f as (select s, id, min(det_id) as det_id, any_value(new) as new from m where r = 1 group by s, id)
select det_id, v, null::bigint as correction from kept where det_id not in (select det_id from m) union all select det_id, new, id from f""")
def corrections(spark, d):
    """Corrections that retire or recode, with wildcards for sample and old value; one row per recode and sample takes the place of its matches."""
    x = table(spark, d, "sample_determinations_all").select("field_name", "study_accession", F.upper(F.trim("sample_key")).alias("s"), F.lower(F.trim("value_normalized")).alias("v"), "det_id")

    def listed(every: int, field: str, old: str, action: str, new: str | None, add: int = 0):
        g = x.where(f"det_id % {every} = 0 and study_accession is not null").groupBy("study_accession").agg((F.min("det_id") + add).alias("correction_id"))
        return g.select("correction_id", "study_accession", F.lit(field).alias("field_name"), F.lit("").alias("entity"), F.lit(old).alias("old"), F.lit(action).alias("action"), F.lit(new).cast("string").alias("new"))

    c = listed(500, "sex", "", "retire", None).unionByName(listed(300, "delivery_mode", "vaginal", "recode", "vaginal_birth")).unionByName(listed(200, "delivery_mode", "", "recode", "any_birth", 1_000_000_000))
    return V.apply_corrections(x, c, "s", "v", "det_id").select("det_id", "v", "correction")


@query("""with m as (select p_brand as k, p_type as v, min(p_size) as code from part where p_size < 40 group by 1, 2), vo as (select v, min(code) as code from m group by 1 having count(distinct code) = 1)
select p_partkey, coalesce(m.code, vo.code) as code from part left join m on m.k = p_brand and m.v = p_type left join vo on vo.v = p_type""")
def map_derived(spark, d):
    """Codes by (key, value), else by value where every key agrees."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    m = p.where("p_size < 40").groupBy("p_brand", "p_type").agg(F.min("p_size").alias("code"))
    return V.derive_codes(p.drop("p_size"), m, "p_brand", "p_type", "code").select("p_partkey", "code")


@query("""select c_custkey, coalesce(o.v, s.v, c_mktsegment) as verdict, case when o.v is not null then 'owner' when s.v is not null then 'curated' else 'base' end as stage from customer
left join (select o_custkey as k, max(o_orderpriority) as v from orders where o_totalprice > 300000 group by 1) o on o.k = c_custkey left join (select o_custkey as k, min(o_orderstatus) as v from orders
where o_totalprice < 3000 group by 1) s on s.k = c_custkey""")
def overrides(spark, d):
    """Owner decisions beat curated verdicts, these beat the base value."""
    o = table(spark, d, "orders")
    owner = o.where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("v"))
    cur = o.where("o_totalprice < 3000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderstatus").alias("v"))
    return V.overrides(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey", "c_mktsegment", [("owner", owner), ("curated", cur)])


@query("""select count(*) as rows_after, (select count(*) from orders) as rows_before, 0 as collisions from (select o_orderkey from orders union all select o_orderkey + 70000000 from orders where o_orderkey % 9 = 0)""")
def append_only(spark, d):
    """An append that may not touch existing rows; the digest before equals that of the old part after."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return V.append_only(o, o.where("o_orderkey % 9 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 70000000), ["o_orderkey"])


@query("""with w as (select user_id, max(case when event_type = 'view' then value end) as v, max(case when event_type = 'click' then value end) as c from events where event_id % 2 = 0 group by 1),
n as (select user_id, max(case when event_type = 'view' then value end) as v, max(case when event_type = 'click' then value end) as c from events where event_id % 7 = 0 group by 1)
select w.user_id, coalesce(n.v, w.v) as view, coalesce(n.c, w.c) as click from w left join n using (user_id) where w.user_id % 10 <> 0""")
def rewide(spark, d):
    """Touched cells overwritten, excluded groups left out of the wide table."""
    e = table(spark, d, "events")
    wide = lambda x: x.groupBy("user_id").pivot("event_type", ["view", "click"]).agg(F.max("value"))
    return V.rewide(wide(e.where("event_id % 2 = 0")), wide(e.where("event_id % 7 = 0")), "user_id", e.where("user_id % 10 = 0").select("user_id"))


@query("""with e as (select distinct upper(trim(sample_key)) as s from determination_snapshots), f as (select unnest(['sex', 'country', 'feeding_mode']) as field_name),
h as (select distinct upper(trim(sample_key)) as s, field_name from determination_snapshots where value_normalized is not null)
select s, field_name, 'no_evidence' as val from e, f where (s, field_name) not in (select s, field_name from h)""")
def sentinels(spark, d):
    """An explicit no-evidence row for every entity and field without a value."""
    t = table(spark, d, "determination_snapshots").select(F.upper(F.trim("sample_key")).alias("s"), "field_name", "value_normalized")
    return V.complete(t.select("s").distinct(), "s", "field_name", ["sex", "country", "feeding_mode"], t.where("value_normalized is not null").select("s", "field_name")).withColumn("val", F.lit("no_evidence"))


@query("""with x as (select det_id, field_name, lower(trim(value_normalized)) as v, confidence, upper(trim(sample_key)) as s, upper(trim(route)) as route from sample_determinations_all), r as (select *,
case when v is null then 'rejected' when confidence > 1 then 'rejected' when row_number() over (partition by s, field_name, route, (v is null or coalesce(confidence > 1, false)) order by coalesce(-confidence, 0), det_id) = 1 then 'accepted' else 'superseded' end as outcome,
case when v is null then 'no value' when confidence > 1 then 'confidence out of range' end as message from x) select det_id, outcome, message from r""")
def accept_reject(spark, d):
    """Accepted, superseded and rejected rows from one tagged frame."""
    x = table(spark, d, "sample_determinations_all").select("det_id", "field_name", F.lower(F.trim("value_normalized")).alias("v"), "confidence", F.upper(F.trim("sample_key")).alias("s"), F.upper(F.trim("route")).alias("route"))
    checks = [("no value", F.col("v").isNull()), ("confidence out of range", F.col("confidence") > 1)]
    return V.split_outcomes(x, ["s", "field_name", "route"], [F.coalesce(-F.col("confidence"), F.lit(0.0)), F.col("det_id")], checks).select("det_id", "outcome", "message")


@query("""with x as (select det_id, study_accession, field_name, lower(trim(value_normalized)) as v from sample_determinations_all), k as (select study_accession || '|' || field_name as g, min(v) as v from x where v not in ('unknown', 'none', 'not collected')
group by 1 having min(v) = max(v)) select det_id, case when coalesce(x.v in ('unknown', 'none', 'not collected'), true) and k.v is not null then k.v else x.v end as v, case when coalesce(x.v in ('unknown', 'none', 'not collected'), true) and k.v is not null
then 'was ' || coalesce(x.v, 'null') || '; class of its group' end as recode_note from x left join k on k.g = x.study_accession || '|' || x.field_name""")
def recode_placeholders(spark, d):
    """Placeholder values replaced by the one value known for their study and field."""
    x = table(spark, d, "sample_determinations_all").select("det_id", F.concat("study_accession", F.lit("|"), "field_name").alias("g"), F.lower(F.trim("value_normalized")).alias("v"))
    blanks = ["unknown", "none", "not collected"]
    known = x.where(~F.col("v").isin(*blanks)).select("g", F.col("v").alias("known"))
    return V.conditional_recode(x, "g", "v", blanks, known, "known").select("det_id", "v", "recode_note")


@query("with " + PREV_CUR + """, st as (select *, 'R1' as release_added, 'p1' as package_added, case when o_orderkey % 11 = 0 then 'R2' end as release_retired from prev), live as (select * from st where release_retired is null),
nw as (select o_orderkey, case when o_orderkey % 1000 = 1 then 'O!' else o_orderstatus end as o_orderstatus from cur)
select 'orders' as fact, c.o_orderkey as k, c.o_orderstatus as v, case when p.o_orderstatus = c.o_orderstatus then p.release_added else 'R3' end as release_added, case when p.o_orderstatus = c.o_orderstatus then p.package_added else 'p3' end as package_added,
null as release_retired from nw c left join live p using (o_orderkey) union all select 'orders', p.o_orderkey, p.o_orderstatus, p.release_added, p.package_added, 'R3' from live p left join nw c using (o_orderkey) where c.o_orderstatus is distinct from p.o_orderstatus
union all select 'orders', o_orderkey, o_orderstatus, release_added, package_added, release_retired from st where release_retired is not null union all select 'customers', c_custkey, c_mktsegment, 'R3', 'p3', null from customer""")
def fact_tables(spark, d):
    """Two fact tables stamped by their specifications, with overrides that match one row each."""
    prev, cur = prev_cur(spark, d)
    st = prev.withColumns({"release_added": F.lit("R1"), "package_added": F.lit("p1"), "release_retired": F.when(F.col("o_orderkey") % 11 == 0, "R2")})
    over = cur.where("o_orderkey % 1000 = 1").select("o_orderkey", F.lit("O!").alias("o_orderstatus"))
    specs = [
        {"name": "orders", "current": cur, "previous": st, "key": ["o_orderkey"], "diff": ["o_orderstatus"], "overrides": over},
        {"name": "customers", "current": table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "key": ["c_custkey"], "diff": ["c_mktsegment"]},
    ]
    f = V.build_facts(specs, "R3", "p3")
    shape = lambda n, k, v: f[n].select(F.lit(n).alias("fact"), F.col(k).cast("long").alias("k"), F.col(v).alias("v"), "release_added", "package_added", "release_retired")
    return shape("orders", "o_orderkey", "o_orderstatus").unionByName(shape("customers", "c_custkey", "c_mktsegment"))


@query("""with r as (select release_id, package_version, release_date from releases union all select 'R9999.1', '99.0', date '2099-01-01') select row_number() over (order by release_date, release_id) as place, release_id, package_version, release_date from r""")
def release_registry(spark, d):
    """The ordered registry of published, historical and current releases."""
    r = table(spark, d, "releases").select("release_id", "package_version", "release_date")
    history = r.withColumn("package_version", F.lit("never published"))
    current = spark.createDataFrame([("R9999.1", "99.0")], "release_id string, package_version string").withColumn("release_date", F.lit("2099-01-01").cast("date"))
    return V.release_registry(history, r, current, "release_id", ["release_date"])


@query("""with o as (select o_custkey, min(o_orderstatus) as verdict, count(*) as n from orders group by 1), u as (select c_custkey as k, c_mktsegment as verdict from customer where c_custkey % 3 = 0)
select k, verdict, 'old' as stage from u union all select o_custkey, verdict, 'append' from o where verdict in ('F', 'O') and n >= 2 and o_custkey not in (select k from u)""")
def append_verdicts(spark, d):
    """Validated verdicts for unseen keys appended, known keys and verdicts outside the vocabulary left alone."""
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderstatus").alias("verdict"), F.count(F.lit(1)).alias("n"))
    u = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("verdict"))
    return V.append_verdicts(u, o, "k", "verdict", ["F", "O"], F.col("n") >= 2)
