"""Queries of the resolution, ranking and set operators on the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import resolve as R
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()

ROUTE_SQL = "case lower(trim(route)) when 'r1' then 0 when 'r2' then 1 when 'r3' then 2 when 'r4' then 3 else 4 end"
DET_SQL = f"""with det as (select det_id, upper(trim(sample_key)) as sample_key, field_name, lower(trim(value_normalized)) as val,
  case when confidence > 1 then confidence / 100 else confidence end as conf, upper(trim(route)) as route, lower(trim(src_track)) as src_track,
  study_accession, {ROUTE_SQL} as route_rank from sample_determinations_all where release_retired is null)"""


def _det(spark, d):
    """Current determinations with keys, route, track and value in normal form."""
    t = table(spark, d, "sample_determinations_all").where("release_retired is null")
    route = F.upper(F.trim("route"))
    rank = F.when(route == "R1", 0).when(route == "R2", 1).when(route == "R3", 2).when(route == "R4", 3).otherwise(4)
    return t.select(
        "det_id",
        F.upper(F.trim("sample_key")).alias("sample_key"),
        "field_name",
        F.lower(F.trim("value_normalized")).alias("val"),
        F.when(F.col("confidence") > 1, F.col("confidence") / 100).otherwise(F.col("confidence")).alias("conf"),
        route.alias("route"),
        F.lower(F.trim("src_track")).alias("src_track"),
        "study_accession",
        rank.alias("route_rank"),
    )


def _order():
    return [F.col("route_rank"), -F.coalesce(F.col("conf"), F.lit(-1.0)), F.col("det_id")]


@query(DET_SQL + """ select sample_key, field_name, det_id, val, route from (select *, row_number() over (partition by sample_key, field_name
order by route_rank, -coalesce(conf, -1.0), det_id) as rn from det) where rn = 1""")
def resolve_best_row(spark, d):
    """The winner per sample and field by route rank, confidence and id."""
    return R.best_row(_det(spark, d), ["sample_key", "field_name"], _order()).select("sample_key", "field_name", "det_id", "val", "route")


@query(DET_SQL + """, w as (select *, first_value(val) over (partition by sample_key, field_name order by route_rank, -coalesce(conf, -1.0), det_id
rows between unbounded preceding and unbounded following) as winner_value from det)
select sample_key, field_name, det_id, val, winner_value from w where val is distinct from winner_value""")
def resolve_conflicts(spark, d):
    """Losers that disagree with the winner."""
    return R.conflicts(_det(spark, d), ["sample_key", "field_name"], _order(), "val").select("sample_key", "field_name", "det_id", "val", "winner_value")


@query(DET_SQL + """, pr as (select * from (select *, row_number() over (partition by sample_key, field_name, route order by route_rank,
-coalesce(conf, -1.0), det_id) as rn from det) where rn = 1), r as (select *, row_number() over (partition by sample_key, field_name order by
route_rank, -coalesce(conf, -1.0), det_id) as k, count(*) over (partition by sample_key, field_name) as routes from pr),
v as (select sample_key, field_name, count(distinct val) > 1 as disputed from pr group by all)
select r.sample_key, r.field_name, r.det_id, r.route, r.val, r.routes, v.disputed from r join v using (sample_key, field_name) where k = 1""")
def merge_routes(spark, d):
    """The best row of each route, merged over routes with a dispute flag."""
    return R.merge_routes(_det(spark, d), ["sample_key", "field_name"], "route", ["R1", "R2", "R3", "R4"], "conf", "val", "det_id")


@query("""select c_mktsegment, c_custkey, c_acctbal, rn from (select *, row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey)
as rn from customer) where rn <= 12""")
def top_n_panel(spark, d):
    """The twelve largest balances per segment."""
    c = table(spark, d, "customer")
    return R.top_n(c, ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 12).select("c_mktsegment", "c_custkey", "c_acctbal", "rn")


@query("""select s_nationkey, s_suppkey, round(s_acctbal / nullif(sum(s_acctbal) over (partition by s_nationkey), 0), 6) as share from supplier""")
def share_within(spark, d):
    """Each supplier's share of its nation's balance."""
    s = R.share_within(table(spark, d, "supplier"), ["s_nationkey"], "s_acctbal")
    return s.select("s_nationkey", "s_suppkey", F.round("share", 6).alias("share"))


@query("""with e as (select user_id, event_id, case when event_id % 3 > 0 then value end as a, epoch_us(ts) as t, count(*) over (partition by user_id) as n,
count(case when event_id % 3 > 0 then value end) over (partition by user_id) as c from events)
select user_id, event_id, case when n = 1 then 'single' when c >= 2 and c * 2 >= n then 'a' when n >= 2 then 't' end as basis,
case when n = 1 then 1 when c >= 2 and c * 2 >= n then case when a is not null then dense_rank() over (partition by user_id order by a nulls last) end
else dense_rank() over (partition by user_id order by t) end as "position" from e""")
def timeline(spark, d):
    """E5: dense time-line positions with a fallback basis."""
    e = table(spark, d, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("a"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t")
    )
    return R.timeline(e, "user_id", ["a", "t"]).select("user_id", "event_id", "basis", "position")


@query("""select e.event_id, g.n_rows, g.n_types from events e join (select user_id, count(*) as n_rows, count(distinct event_type) as n_types from events
group by 1) g using (user_id)""")
def group_stat(spark, d):
    """Group size and distinct count on every row."""
    g = R.group_stat(table(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id"], [F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_type").alias("n_types")])
    return g.select("event_id", "n_rows", "n_types")


@query("""with k as (select l_suppkey, l_returnflag, count(*) as n from lineitem group by 1, 2), g as (select l_suppkey, sum(n) as r, count(*) as ids from k group by 1)
select k.l_suppkey, k.l_returnflag, (n > 200 or (r > 40 and n * 2 > r) or (ids <= 5 and r > 50) or length(l_returnflag) <= 1) as is_degenerate, n as n_rows
from k join g using (l_suppkey)""")
def degenerate_guard(spark, d):
    """Keys that cannot be identifiers."""
    x = R.degenerate(table(spark, d, "lineitem").select("l_suppkey", "l_returnflag"), "l_suppkey", "l_returnflag")
    return x.groupBy("l_suppkey", "l_returnflag", "is_degenerate").agg(F.count(F.lit(1)).alias("n_rows"))


@query("select p_partkey, row_number() over (order by p_retailprice desc, p_size desc, p_partkey) as rank_all from part")
def rank_all(spark, d):
    """A global ranking. Ranks within value ranges are numbered in parallel and shifted by the sizes of the ranges before."""
    return R.rank_all(table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size"), [F.desc("p_retailprice"), F.desc("p_size"), F.asc("p_partkey")]).select("p_partkey", "rank_all")


@query("""with p as (select l_suppkey, count(case when l_returnflag = 'R' then 1 end)::double / count(*) as p from lineitem group by 1),
r as (select *, row_number() over (order by p, l_suppkey) as k, count(*) over () as n from p)
select l_suppkey, round(least(1.0, min(p * n / k) over (order by p, l_suppkey rows between current row and unbounded following)), 9) as q from r""")
def bh_adjust(spark, d):
    """Benjamini-Hochberg over one value per supplier."""
    p = table(spark, d, "lineitem").groupBy("l_suppkey").agg((F.count_if(F.col("l_returnflag") == "R") / F.count(F.lit(1))).alias("p"))
    return R.bh(p, "p", "l_suppkey").select("l_suppkey", F.round("q", 9).alias("q"))


@query("""select user_id, arg_min(value, (ts, event_id)) as first_value, arg_max(value, (ts, event_id)) as last_value from events group by 1""")
def first_last(spark, d):
    """First and last value per user."""
    return R.first_last(table(spark, d, "events"), "user_id", [F.col("ts"), F.col("event_id")], "value")


@query("""select c.user_id, c.event_id as kept, min(x.event_id) as detail from events c join events x on x.user_id = c.user_id and x.event_id > c.event_id
and x.event_type = 'view' where c.event_type = 'purchase' group by 1, 2""")
def follow_choice(spark, d):
    """The first detail row after each kept row."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return R.follow_choice(e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), ["user_id"], "event_id")


FIELDS = ["age_at_collection_days", "country", "delivery_mode", "feeding_mode", "sex"]


@query(DET_SQL + """, w as (select * from (select *, row_number() over (partition by sample_key, field_name order by route_rank, -coalesce(conf, -1.0), det_id) as rn
from det) where rn = 1) select sample_key, """ + ", ".join(f"max(case when field_name = '{f}' then val end) as {f}" for f in FIELDS) + " from w group by 1")
def widen(spark, d):
    """One row per sample, one column per field, after resolution."""
    b = R.best_row(_det(spark, d), ["sample_key", "field_name"], _order())
    return R.widen(b, ["sample_key"], "field_name", FIELDS, "val")


@query("""with st as (select s_nationkey, s_suppkey, round(s_acctbal) as v from supplier), best as (select * from (select *, row_number() over (partition by
s_nationkey order by -v, s_suppkey) as rn from st) where rn = 1) select c.c_custkey, b.v as val from customer c join best b on b.s_nationkey = c.c_nationkey
where c.c_custkey not in (select o_custkey from orders where o_orderstatus = 'F' and o_custkey is not null)""")
def expand_group(spark, d):
    """C17: a group statement copied to members without a value of their own."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("grp"), F.lit("v").alias("fld"), F.round("s_acctbal").alias("val"), "s_suppkey")
    m = table(spark, d, "customer").select(F.col("c_nationkey").alias("grp"), F.col("c_custkey").alias("ent"))
    have = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("ent"), F.lit("v").alias("fld"))
    x = R.expand_group(s, m, have, "grp", "ent", "fld", [-F.col("val"), F.col("s_suppkey")])
    return x.select(F.col("ent").alias("c_custkey"), "val")


@query("""select c_custkey as id, c_name as label, 'a' as src from customer where c_custkey % 2 = 0 union all
select c_custkey, upper(c_name), 'b' from customer where c_custkey % 3 = 0 and c_custkey % 2 <> 0""")
def union_prefer(spark, d):
    """A union in which the first source wins per key."""
    c = table(spark, d, "customer")
    a = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"), F.lit("a").alias("src"))
    b = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.upper("c_name").alias("label"), F.lit("b").alias("src"))
    return R.union_prefer([a, b], ["id"])


@query("""select l_partkey, string_agg(distinct 'slice_' || l_returnflag, ';' order by 'slice_' || l_returnflag) as found_by from lineitem group by 1""")
def found_by(spark, d):
    """One row per part with the slices that hold it."""
    l = table(spark, d, "lineitem").select("l_partkey", "l_returnflag")
    return R.union_found_by({f"slice_{f}": l.where(F.col("l_returnflag") == f) for f in ("A", "N", "R")}, "l_partkey")


@query("""select distinct o_custkey as k, 'removed' as kind from orders where o_orderdate < timestamp '1998-01-01' and o_custkey not in (select o_custkey from orders
where o_orderdate >= timestamp '1998-01-01') union all select distinct o_custkey, 'added' from orders where o_orderdate >= timestamp '1998-01-01' and o_custkey not in
(select o_custkey from orders where o_orderdate < timestamp '1998-01-01')""")
def key_sets(spark, d):
    """Keys added and removed between two sets."""
    o = table(spark, d, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old, new = o.where(F.col("o_orderdate") < cut).select(F.col("o_custkey").alias("k")), o.where(F.col("o_orderdate") >= cut).select(F.col("o_custkey").alias("k"))
    gone, added = old.subtract(new).withColumn("kind", F.lit("removed")), new.subtract(old).withColumn("kind", F.lit("added"))
    return gone.unionByName(added)


@query("""with idx as (select o_orderkey from orders), seen as (select distinct l_orderkey from lineitem) select (select count(*) from idx) as indexed,
(select count(*) from seen) as seen, (select count(*) from idx where o_orderkey not in (select l_orderkey from seen)) as missing,
(select count(*) from seen where l_orderkey not in (select o_orderkey from idx)) as extra""")
def reconcile(spark, d):
    """Index against rows seen, in one full outer aggregate."""
    i = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit(1).alias("i"), F.lit(0).alias("s"))
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit(0).alias("i"), F.lit(1).alias("s"))
    g = i.unionByName(s).groupBy("k").agg(F.max("i").alias("i"), F.max("s").alias("s"))
    return g.agg(
        F.sum("i").alias("indexed"), F.sum("s").alias("seen"), F.count_if((F.col("i") == 1) & (F.col("s") == 0)).alias("missing"), F.count_if((F.col("i") == 0) & (F.col("s") == 1)).alias("extra")
    )


@query("""with cur as (select l_returnflag || l_linestatus as slice, count(*) as n from lineitem where l_quantity > 5 group by 1),
prev as (select l_returnflag || l_linestatus as slice, count(*) as n from lineitem where l_quantity > 5 and l_returnflag <> 'A' and l_tax >= 0 group by 1)
select c.slice, case when p.slice is null then 'new' when p.n <> c.n then 'changed' else 'unchanged' end as kind from cur c left join prev p using (slice)""")
def slice_changes(spark, d):
    """New, changed and unchanged slices against the previous audit."""
    l = table(spark, d, "lineitem").where("l_quantity > 5").withColumn("slice", F.concat("l_returnflag", "l_linestatus"))
    cur, prev = l.groupBy("slice").agg(F.count(F.lit(1)).alias("n")), l.where("l_returnflag <> 'A' and l_tax >= 0").groupBy("slice").agg(F.count(F.lit(1)).alias("m"))
    j = cur.join(prev, "slice", "left")
    return j.select("slice", F.when(F.col("m").isNull(), "new").when(F.col("m") != F.col("n"), "changed").otherwise("unchanged").alias("kind"))


@query("""select o_custkey, o_orderstatus, max(o_totalprice) as conf, string_agg(distinct left(o_orderpriority, 1), ';' order by left(o_orderpriority, 1)) as replicates
from orders group by 1, 2""")
def replicate_union(spark, d):
    """Identical statements of several replicates collapsed."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus", F.col("o_totalprice").alias("conf"), F.substring("o_orderpriority", 1, 1).alias("rep"))
    return R.replicate_union(o, ["o_custkey", "o_orderstatus"], "conf", "rep")


@query("""select o_orderkey, 'order' as origin from orders union all select l_orderkey + 100000000, 'carried' from (select distinct l_orderkey from lineitem where
l_returnflag = 'R')""")
def carry_missing(spark, d):
    """Rows of one universe absent from the other appended with provenance."""
    a = table(spark, d, "orders").select("o_orderkey").withColumn("origin", F.lit("order"))
    b = table(spark, d, "lineitem").where("l_returnflag = 'R'").select((F.col("l_orderkey") + 100000000).alias("o_orderkey")).distinct()
    return a.unionByName(b.join(a, "o_orderkey", "left_anti").withColumn("origin", F.lit("carried")))


@query(DET_SQL + """, n as (select study_accession, field_name, val, count(*) as votes from det where val is not null group by all), r as (select *, sum(votes) over (partition by
study_accession, field_name) as t, row_number() over (partition by study_accession, field_name order by votes desc, val) as rn from n)
select study_accession, field_name, val, votes, round(votes / t, 9) as share from r where rn = 1""")
def weighted_vote(spark, d):
    """The majority value per study and field."""
    v = R.weighted_vote(_det(spark, d), ["study_accession", "field_name"], "val")
    return v.withColumn("share", F.round("share", 9))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 50 offset 100")
def explorer_page(spark, d):
    """the third page of a sorted table."""
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").offset(100).limit(50)


@query("""select l_partkey, total, kind from (select l_partkey, total, 'high' as kind, row_number() over (order by total desc, l_partkey) as rn from (select l_partkey,
round(sum(l_quantity), 2) as total from lineitem group by 1) union all select l_partkey, total, 'low', row_number() over (order by total, l_partkey) from (select l_partkey,
round(sum(l_quantity), 2) as total from lineitem group by 1)) where rn <= 10""")
def extremes(spark, d):
    """the ten largest and smallest, each by a take-ordered."""
    g = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias("total"))
    hi = g.orderBy(F.desc("total"), "l_partkey").limit(10).withColumn("kind", F.lit("high"))
    return hi.unionByName(g.orderBy("total", "l_partkey").limit(10).withColumn("kind", F.lit("low")))


@query("""with t as (select p_type, row_number() over (order by count(*) desc, p_type) as rn from part group by 1)
select p_partkey, coalesce(case when rn <= 5 then t.p_type end, 'other') as code from part left join t using (p_type)""")
def capped_categories(spark, d):
    """the five most frequent labels keep their code."""
    return R.encode_topk(table(spark, d, "part").select("p_partkey", "p_type"), "p_type", 5).select("p_partkey", "code")


@query("""select o_orderkey, o_orderstatus, o_orderpriority from (select *, row_number() over (partition by o_orderstatus, o_orderpriority order by o_orderkey) as rn
from orders) where rn <= 4""")
def stratified_sample(spark, d):
    """a deterministic stratified sample."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return R.stratified_head(o, ["o_orderstatus", "o_orderpriority"], [F.col("o_orderkey")], 4)
