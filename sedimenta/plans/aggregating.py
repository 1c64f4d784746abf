"""Queries of the aggregation operators on the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import aggregate as A
from sedimenta.plans.registry import registry
from sedimenta.sources.tables import table

QUERIES, SQL, query = registry()


@query("""select l_suppkey, count(*) as n, count(distinct l_partkey) as parts, count(distinct l_orderkey) as orders, round(sum(l_quantity), 4) as qty,
round(avg(l_discount), 9) as disc, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, round(median(l_extendedprice), 6) as mid, bool_or(l_tax > 0.07) as any_high,
count(*) filter (where l_returnflag = 'R') as returned from lineitem group by 1""")
def collapse_supplier(spark, d):
    """Counts, distincts, statistics and flags of a group."""
    l = table(spark, d, "lineitem")
    plain = l.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("l_quantity"), 4).alias("qty"),
        F.round(F.avg("l_discount"), 9).alias("disc"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.round(F.percentile("l_extendedprice", F.lit(0.5)), 6).alias("mid"),
        F.bool_or(F.col("l_tax") > 0.07).alias("any_high"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    # Distinct counts on their own: beside the median they would expand every row and its median state once per distinct column.
    distinct = lambda c, name: l.groupBy("l_suppkey").agg(F.countDistinct(c).alias(name))
    return plain.join(distinct("l_partkey", "parts"), "l_suppkey").join(distinct("l_orderkey", "orders"), "l_suppkey")


@query("""select l_suppkey, string_agg(distinct l_returnflag || l_linestatus, ';' order by l_returnflag || l_linestatus) as kinds from lineitem group by 1""")
def join_distinct(spark, d):
    """Distinct sorted joined list."""
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(A.join_distinct(F.concat("l_returnflag", "l_linestatus")).alias("kinds"))


@query("""with f as (select user_id, event_type, min(event_id) as o from events group by 1, 2) select user_id, string_agg(event_type, ' | ' order by o) as joined
from f group by 1""")
def join_first_seen(spark, d):
    """Distinct values in order of first arrival."""
    return A.join_first_seen(table(spark, d, "events"), ["user_id"], "event_type", "event_id")


TOP = """with n as (select p_type, p_brand, count(*) as n, row_number() over (partition by p_type order by count(*) desc, p_brand) as rn from part group by 1, 2) """


@query(TOP + """select p_type, '{' || string_agg('"' || p_brand || '":' || n, ',' order by rn) || '}' as counts from n where rn <= 3 group by 1""")
def topk_json(spark, d):
    """The three most frequent brands per type as JSON."""
    return A.topk_json(table(spark, d, "part"), ["p_type"], "p_brand", 3)


@query(TOP + """select p_type, string_agg(p_brand || '(' || n || ')', '; ' order by rn) as label from n where rn <= 5 group by 1""")
def topk_label(spark, d):
    """Top-five label."""
    return A.topk_label(table(spark, d, "part"), ["p_type"], "p_brand", 5)


@query("""with n as (select sample_key, src_track, count(*) as n from determination_snapshots where value_normalized is not null group by 1, 2) select sample_key,
src_track as mode from (select *, row_number() over (partition by sample_key order by n desc, src_track) as rn from n) where rn = 1
union all select distinct sample_key, 'none' from determination_snapshots where sample_key not in (select sample_key from n)""")
def mode_or_default(spark, d):
    """Most frequent value with a default."""
    s = table(spark, d, "determination_snapshots").withColumn("t", F.when(F.col("value_normalized").isNotNull(), F.col("src_track")))
    return A.mode_or(s.select("sample_key", "t"), ["sample_key"], "t", "none")


@query("""select l_suppkey, round(case when sum(l_quantity) > 0 then sum(l_discount * l_quantity) / sum(l_quantity) else avg(l_discount) end, 9) as wmean from lineitem group by 1""")
def weighted_mean(spark, d):
    """Weighted mean with fallback."""
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(A.wmean(F.col("l_discount"), F.col("l_quantity")), 9).alias("wmean"))


@query("""with s as (select l_suppkey, l_partkey, sum(l_quantity) as v from lineitem group by 1, 2), p as (select l_suppkey, v / sum(v) over (partition by l_suppkey) as p from s)
select l_suppkey, round(-sum(p * ln(p)), 6) as entropy from p where p > 0 group by 1""")
def shannon(spark, d):
    """Entropy of the part shares of each supplier."""
    s = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("v"))
    return A.shannon(s, ["l_suppkey"], "v").withColumn("entropy", F.round("entropy", 6))


@query("""select o_orderpriority, round(avg(case when l_orderkey is not null then 1.0 else 0 end), 3) as has_lines, round(avg(case when ret is not null then 1.0 else 0 end), 3)
as has_return from orders left join (select l_orderkey, max(case when l_returnflag = 'R' then 1 end) as ret from lineitem group by 1) on l_orderkey = o_orderkey group by 1""")
def coverage(spark, d):
    """Share of filled values per group."""
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("has_lines")).agg(F.max(F.when(F.col("l_returnflag") == "R", 1)).alias("has_return"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return A.coverage(o.join(l, F.col("o_orderkey") == F.col("has_lines"), "left"), ["o_orderpriority"], ["has_lines", "has_return"])


@query("""with t as (select l_linestatus from lineitem group by 1 order by count(*) desc, 1 limit 1), n as (select l_returnflag, case when l_linestatus in (from t) then
l_linestatus else 'other' end as l_linestatus, count(*) as n from lineitem group by 1, 2) select *, round(n / sum(n) over (partition by l_returnflag), 9) as share from n""")
def crosstab_share(spark, d):
    """Cross tabulation with row shares and a folded rest."""
    return A.crosstab_share(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus"), "l_returnflag", "l_linestatus", 1).withColumn("share", F.round("share", 9))


@query("""with g as (select p_brand, l_suppkey, avg(l_discount) as m, count(*) as n from lineitem join part on p_partkey = l_partkey group by 1, 2 having count(*) >= 3)
select p_brand, round(median(m), 9) as median_of_means, count(*) as groups from g group by 1""")
def nested_agg(spark, d):
    """Mean per supplier, then the median over suppliers, with a minimum n."""
    j = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_discount").join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return A.nested(j, ["l_suppkey"], ["p_brand"], "l_discount", 3).withColumn("median_of_means", F.round("median_of_means", 9))


@query("""with n as (select o_custkey, o_orderstatus, count(*) as n from orders group by 1, 2), r as (select *, sum(n) over (partition by o_custkey) as t, row_number() over
(partition by o_custkey order by n desc, o_orderstatus) as rn from n) select o_custkey, case when (t - n) / t >= 0.2 then 'mixed' else o_orderstatus end as majority from r where rn = 1""")
def majority_mixed(spark, d):
    """The majority class or mixed."""
    return A.majority_mixed(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus")


@query("""with v as (select n_regionkey as grp, s_nationkey as item, p_type as f, sum(l_quantity) as v from lineitem join supplier on s_suppkey = l_suppkey join nation on
n_nationkey = s_nationkey join part on p_partkey = l_partkey group by all), t as (select grp, item, sum(v) as t from v group by all)
select a.grp, a.item as a, b.item as b, round(1 - 2 * sum(least(a.v, b.v)) / any_value(ta.t + tb.t), 6) as dissimilarity from v a join v b on a.grp = b.grp and a.f = b.f and a.item < b.item
join t ta on ta.grp = a.grp and ta.item = a.item join t tb on tb.grp = b.grp and tb.item = b.item group by 1, 2, 3""")
def pairwise_bc(spark, d):
    """Dissimilarity of the nations of each region over part types."""
    n = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    j = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity").join(n, F.col("s_suppkey") == F.col("l_suppkey"))
    j = j.join(table(spark, d, "part").select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
    x = A.bray_curtis(j.select(F.col("n_regionkey").alias("grp"), F.col("s_nationkey").alias("item"), "p_type", "l_quantity"), "grp", "item", "p_type", "l_quantity")
    return x.withColumn("dissimilarity", F.round("dissimilarity", 6))


@query("select count(*) as rows, true as same_in_any_order, true as differs_when_changed from orders")
def snapshot_hash(spark, d):
    """The digest of a table's rows: the same in any order and partitioning, another one when a cell changes or a row is repeated."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    one = A.content_hash(o).select("rows", F.struct("rows", "h1", "h2").alias("a"))
    moved = A.content_hash(o.select(*reversed(o.columns)).repartition(7, "o_totalprice").sortWithinPartitions(F.desc("o_orderkey"))).select(F.struct("rows", "h1", "h2").alias("b"))
    least = o.agg(F.min("o_orderkey")).first()[0]
    status = F.when(F.col("o_orderkey") == least, F.concat("o_orderstatus", F.lit("x"))).otherwise(F.col("o_orderstatus"))
    changed = A.content_hash(o.withColumn("o_orderstatus", status)).select(F.struct("rows", "h1", "h2").alias("c"))
    twice = A.content_hash(o.unionByName(o.where(F.col("o_orderkey") == least))).select(F.struct("rows", "h1", "h2").alias("e"))
    x = one.crossJoin(moved).crossJoin(changed).crossJoin(twice)  # one row each
    return x.select("rows", (F.col("a") == F.col("b")).alias("same_in_any_order"), ((F.col("a") != F.col("c")) & (F.col("a") != F.col("e"))).alias("differs_when_changed"))


@query("""with x as (select distinct o_orderkey, o_totalprice, unnest(string_split(lower(o_orderpriority), '-')) as v from orders) select v as facet_value,
count(distinct o_orderkey) as keys, round(sum(o_totalprice), 2) as amount from x where v <> '' group by 1""")
def facets(spark, d):
    """Facet counts over a list column."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.lower("o_orderpriority").alias("p"))
    return A.facet(o, "p", "-", "o_orderkey", "o_totalprice").withColumn("amount", F.round("amount", 2))


@query("""select count(*) as all_rows, count(*) filter (where o_orderstatus = 'F') as closed, count(*) filter (where o_orderstatus = 'F' and o_totalprice > 100000) as big,
count(*) filter (where o_orderstatus = 'F' and o_totalprice > 100000 and o_orderpriority like '1%') as urgent from orders""")
def funnel(spark, d):
    """Nested predicate counts."""
    steps = [("all_rows", F.lit(True)), ("closed", F.col("o_orderstatus") == "F"), ("big", F.col("o_totalprice") > 100000), ("urgent", F.col("o_orderpriority").startswith("1"))]
    return A.funnel(table(spark, d, "orders"), steps)


@query("""with s as (select o_custkey, l_orderkey, sum(l_quantity) as q from lineitem join orders on o_orderkey = l_orderkey group by 1, 2)
select o_custkey, round(median(q), 6) as mid from s group by 1""")
def sum_then_median(spark, d):
    """Summed per order, then the median per customer."""
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"))
    j = l.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return j.groupBy("o_custkey").agg(F.round(F.percentile("q", F.lit(0.5)), 6).alias("mid"))


def _lineage(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    s = table(spark, d, "supplier").join(n, F.col("n_nationkey") == F.col("s_nationkey"))
    s = s.select("s_suppkey", F.concat_ws("; ", F.lit("root"), "r_name", "n_name", F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name"))).alias("lineage"))
    l = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return l.join(s, F.col("s_suppkey") == F.col("l_suppkey")).select("l_returnflag", "lineage", "q")


LINEAGE = """with leaf as (select l_returnflag, 'root; ' || r_name || '; ' || n_name as up, case when s_suppkey % 3 > 0 then s_name end as leaf, l_quantity as q, r_name, n_name from lineitem
join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey),
ranks as (select l_returnflag, 'root' as node, 1 as depth, sum(q) as total from leaf group by 1 union all
select l_returnflag, 'root; ' || r_name, 2, sum(q) from leaf group by 1, 2 union all select l_returnflag, up, 3, sum(q) from leaf group by 1, 2 union all
select l_returnflag, up || '; ' || leaf, 4, sum(q) from leaf where leaf is not null group by 1, 2)"""


@query(LINEAGE + " select l_returnflag, node, depth, round(total, 4) as total from ranks")
def lineage_rollup(spark, d):
    """Totals of every ancestor of a lineage."""
    return A.rollup_ranks(_lineage(spark, d), ["l_returnflag"], "lineage", "q").withColumn("total", F.round("total", 4))


@query(LINEAGE + """, root as (select l_returnflag, total as root from ranks where depth = 1), per as (select l_returnflag, depth, sum(total) as s from ranks group by 1, 2)
select l_returnflag, depth, node, round(total / root, 9) as share from ranks join root using (l_returnflag)
union all select l_returnflag, depth, 'unassigned', round((root - s) / root, 9) from per join root using (l_returnflag) where root - s > 1e-9 * root""")
def normalise_profile(spark, d):
    """Shares of the root with the remainder of each rank."""
    p = A.normalise(A.rollup_ranks(_lineage(spark, d), ["l_returnflag"], "lineage", "q"), ["l_returnflag"], 4)
    return p.withColumn("share", F.round("share", 9))


@query("""with it as (select o_orderkey as item, o_orderstatus as st, o_orderpriority as pr from orders), v as (select p_type, l_orderkey as item, st, pr, sum(l_quantity) as v from lineitem
join part on p_partkey = l_partkey join it on it.item = l_orderkey group by all),
sizes as (select 'all' as dim, 'all' as "group", count(*) as n from it union all select 'st', st, count(*) from it group by st union all select 'pr', pr, count(*) from it group by pr)
select p_type, dim, "group", present, round(s / n, 9) as mean_share from (select p_type, 'all' as dim, 'all' as "group", count(*) filter (where v > 20) as present, sum(v) as s from v group by 1
union all select p_type, 'st', st, count(*) filter (where v > 20), sum(v) from v group by p_type, st union all
select p_type, 'pr', pr, count(*) filter (where v > 20), sum(v) from v group by p_type, pr) join sizes using (dim, "group")""")
def prevalence_cube(spark, d):
    """Presence and mean share per feature and group, absent counted as 0."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("pr"))
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item"), "l_partkey", "l_quantity")
    j = l.join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey").join(o, "item")
    g = F.array(F.struct(F.lit("all").alias("dim"), F.lit("all").alias("group")), F.struct(F.lit("st").alias("dim"), F.col("st").alias("group")), F.struct(F.lit("pr").alias("dim"), F.col("pr").alias("group")))
    sizes = o.select(F.explode(g).alias("g")).groupBy("g.dim", "g.group").agg(F.count(F.lit(1)).alias("n"))
    return A.prevalence_cube(j, "p_type", ["st", "pr"], "item", "l_quantity", sizes, 20).withColumn("mean_share", F.round("mean_share", 9))


@query("""select ceil(log10(l_extendedprice) * 4) / 4 as bin, round(median(l_discount), 9) as mid, count(*) as n from lineitem where l_extendedprice > 0 group by 1""")
def binned_median(spark, d):
    """The median of y per quarter-decade bin of x; bins are open below and closed above."""
    l = table(spark, d, "lineitem").where("l_extendedprice > 0")
    return l.groupBy((F.ceil(F.log10("l_extendedprice") * 4) / 4).alias("bin")).agg(F.round(F.percentile("l_discount", F.lit(0.5)), 9).alias("mid"), F.count(F.lit(1)).alias("n"))


@query("""select lower(p_brand) as name_key, min(p_brand) as display, count(distinct p_type) as studies, sum(case when p_size <= 10 then 1 else 0 end) as first_n,
upper(left(lower(p_brand), 1)) as shard from part group by 1""")
def name_index(spark, d):
    """Name index with distinct studies, first-place count and shard."""
    g = table(spark, d, "part").groupBy(F.lower("p_brand").alias("name_key"))
    x = g.agg(F.min("p_brand").alias("display"), F.countDistinct("p_type").alias("studies"), F.sum((F.col("p_size") <= 10).cast("int")).alias("first_n"))
    return x.withColumn("shard", F.upper(F.substring("name_key", 1, 1)))


@query("""select 'determinations' as tbl, 'rows' as metric, count(*) as v from sample_determinations_all union all select 'determinations', 'retired', count(release_retired) from
sample_determinations_all union all select 'studies', 'rows', count(*) from study_meta union all select 'studies', 'centres', count(distinct center_name) from study_meta
union all select 'snapshots', 'rows', count(*) from determination_snapshots union all select 'snapshots', 'releases', count(distinct release_id) from determination_snapshots""")
def package_counts(spark, d):
    """Table statistics as (table, metric, value)."""
    spec = {
        ("determinations", "sample_determinations_all"): {"rows": F.count(F.lit(1)), "retired": F.count("release_retired")},
        ("studies", "study_meta"): {"rows": F.count(F.lit(1)), "centres": F.countDistinct("center_name")},
        ("snapshots", "determination_snapshots"): {"rows": F.count(F.lit(1)), "releases": F.countDistinct("release_id")},
    }
    out = None
    for (name, t), metrics in spec.items():
        one = table(spark, d, t).agg(*[v.cast("long").alias(k) for k, v in metrics.items()])
        long = one.select(F.lit(name).alias("tbl"), F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("v")) for k in metrics])).alias("x")).select("tbl", "x.metric", "x.v")
        out = long if out is None else out.unionByName(long)
    return out


@query("""with s as (select o_custkey, o_orderstatus, count(*) as n, count(*) / sum(count(*)) over (partition by o_custkey) as share from orders group by 1, 2)
select o_custkey, string_agg(o_orderstatus, ';' order by n desc, o_orderstatus) filter (where share >= 0.1 and n >= 3) as codes, max(case when share >= 0.6 then o_orderstatus end) as primary_code
from s group by 1""")
def member_refinement(spark, d):
    """Codes a group gains from its members, and the primary one."""
    from pyspark.sql import Window

    s = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    s = s.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("o_custkey")))
    kept = F.when((F.col("share") >= 0.1) & (F.col("n") >= 3), F.struct((-F.col("n")).alias("n"), F.col("o_orderstatus").alias("c")))
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["c"]), ";")
    g = s.groupBy("o_custkey").agg(codes.alias("codes"), F.max(F.when(F.col("share") >= 0.6, F.col("o_orderstatus"))).alias("primary_code"))
    return g.withColumn("codes", F.when(F.col("codes") != "", F.col("codes")))


@query("""with o as (select field_name, upper(trim(route)) as route, count(*) as n from sample_determinations_all where release_retired is not null group by 1, 2),
c as (select field_name, upper(trim(route)) as route, count(*) as n from sample_determinations_all where release_retired is null group by 1, 2)
select coalesce(o.field_name, c.field_name) as field_name, coalesce(o.route, c.route) as route, coalesce(o.n, 0) as old_n, coalesce(c.n, 0) as new_n from o full join c
on o.field_name = c.field_name and o.route = c.route""")
def profile_shift(spark, d):
    """Old against new counts per field and route, in one conditional aggregate."""
    t = table(spark, d, "sample_determinations_all").groupBy("field_name", F.upper(F.trim("route")).alias("route"))
    return t.agg(F.count("release_retired").alias("old_n"), F.count_if(F.col("release_retired").isNull()).alias("new_n"))


@query("""with s as (select c_nationkey, c_mktsegment, avg((c_acctbal > 5000)::int) as p, count(*) as n from customer group by 1, 2) select c_nationkey, round(sum(p * n) / sum(n), 9) as pooled,
round(median(p) filter (where n >= 2), 9) as mid_of_groups, sum(n)::bigint as n from s group by 1""")
def prevalence_two_views(spark, d):
    """Pooled prevalence beside the median of group prevalences with a minimum n."""
    s = table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.avg((F.col("c_acctbal") > 5000).cast("int")).alias("p"), F.count(F.lit(1)).alias("n"))
    return s.groupBy("c_nationkey").agg(
        F.round(F.sum(F.col("p") * F.col("n")) / F.sum("n"), 9).alias("pooled"), F.round(F.percentile(F.when(F.col("n") >= 2, F.col("p")), F.lit(0.5)), 9).alias("mid_of_groups"), F.sum("n").alias("n")
    )


@query("""select c_custkey, c_name || ' is in the ' || lower(c_mktsegment) || ' segment, balance ' || case when c_acctbal < 0 then 'negative' when c_acctbal < 5000 then 'moderate' else 'high'
end || '.' as sentence from customer""")
def describe_row(spark, d):
    """A plain sentence from a classified row."""
    level = F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") < 5000, "moderate").otherwise("high")
    return table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(" is in the "), F.lower("c_mktsegment"), F.lit(" segment, balance "), level, F.lit(".")).alias("sentence"))
