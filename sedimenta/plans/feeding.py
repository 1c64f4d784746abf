"""Queries of the sources, sinks and streams, each with its SQL where the result is a plain table."""

from __future__ import annotations

import zipfile
from io import BytesIO

import pandas as pd
from pyspark.sql import functions as F

from sedimenta.plans.registry import registry
from sedimenta.sources import io
from sedimenta.sources.tables import table
from sedimenta.streaming import intake

QUERIES, SQL, query = registry()


@query("select s_suppkey, s_name from supplier")
def pruned_scan(spark, d):
    """A1: named columns of a columnar table; only they are read."""
    return table(spark, d, "supplier").select("s_suppkey", "s_name")


@query("""select study_accession, study_title, coalesce(center_name, '') as center_name, '' as owner from study_meta""")
def text_tables(spark, d):
    """A CSV written and read back as text, empty and null kept apart; absent columns come as empty."""
    out = io.scratch(spark)
    m = table(spark, d, "study_meta").select("study_accession", F.regexp_replace("study_title", "[\\t\\r\\n]", " ").alias("study_title"), "center_name")
    io.sink(m, out, "csv", ["study_accession"])
    back = io.scan_csv_text(spark, out, m.columns)
    return back.select("study_accession", "study_title", F.coalesce("center_name", F.lit("")).alias("center_name"), F.lit("").alias("owner"))


@query("""select o_orderkey::varchar as o_orderkey, o_orderstatus, case when o_orderkey % 2 = 0 then 'even' else 'odd' end as slice_tag from orders""")
def tagged_ingest(spark, d):
    """Slices ingested as text with a tag, and read back as one contract."""
    out = io.scratch(spark)
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    io.ingest(o.where("o_orderkey % 2 = 0"), out, "even")
    io.ingest(o.where("o_orderkey % 2 <> 0"), out, "odd")
    return io.scan_shards(spark, [out], {"o_orderkey": "string", "o_orderstatus": "string", "slice_tag": "string"}).drop("shard")


@query("""select l_orderkey, count(*) as n from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'P') group by 1""")
def semi_filter(spark, d):
    """A5: one pass over the bulk keeping wanted keys."""
    keys = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    kept, _ = io.semi_filter(table(spark, d, "lineitem").select("l_orderkey"), keys, "l_orderkey")
    return kept.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("""select attr_id, trim(attr_key) as attr_key, trim(value) as value, nullif(trim(coalesce(attr_units, '')), '') as units from sample_attributes_new where attr_key is not null and value is not null""")
def xml_attributes(spark, d):
    """Attribute XML of both dialects to entity-attribute-value rows; markup characters in values come as entities."""
    a = table(spark, d, "sample_attributes_new").where("attr_key is not null and value is not null")
    k, v, u = [io.xml_escape(F.coalesce(c, F.lit(""))) for c in ("attr_key", "value", "attr_units")]
    tags = F.concat(F.lit("<X><TAG>"), k, F.lit("</TAG> <VALUE>"), v, F.lit("</VALUE><UNITS>"), u, F.lit("</UNITS></X>"))
    named = F.concat(F.lit('<Attributes><Attribute unit="'), u, F.lit('" attribute_name="'), k, F.lit('">'), v, F.lit("</Attribute></Attributes>"))
    return io.xml_to_eav(a.select("attr_id", F.when(F.col("attr_id") % 2 == 0, tags).otherwise(named).alias("xml")), "attr_id", "xml")


@query("""select doc_id, g as place, substr(text, g * 1000 + 1, 1000) as chunk from (select doc_id, text, unnest(range(0, (length(text) + 999) // 1000)) as g from documents where length(text) > 0)""")
def text_chunks(spark, d):
    """A10: whole texts in chunks of bounded size."""
    t = table(spark, d, "documents").select("doc_id", "text")
    return io.chunks(t, "doc_id", "text", 1000)


@query("""select meta_id, study_title as title, '' as reply from study_meta where study_title is not null and center_name is not null""")
def issue_form(spark, d):
    """A form in Markdown split by its headings."""
    m = table(spark, d, "study_meta").where("study_title is not null and center_name is not null")
    body = F.concat(F.lit("### Title\n\n"), F.col("study_title"), F.lit("\n\n### Reply\n\n_No response_\n"))
    f = m.select("meta_id", io.parse_form(body).alias("f"))
    return f.select("meta_id", F.try_element_at("f", F.lit("Title")).alias("title"), F.try_element_at("f", F.lit("Reply")).alias("reply"))


@query("""select study_accession as study, count(*)::int as n, 'a1;b2' as quoted from study_meta where regexp_matches(study_accession, '^PRJ') group by 1""")
def report_rows(spark, d):
    """Table rows of a report."""
    g = table(spark, d, "study_meta").where("study_accession like 'PRJ%'").groupBy("study_accession").agg(F.count(F.lit(1)).alias("n"))
    return io.parse_report(g.select(F.concat(F.lit("| "), "study_accession", F.lit(" | "), F.col("n").cast("string"), F.lit(" | `a1`, `b2` |")).alias("line")), "line")


@query("""select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1""")
def partitioned_export(spark, d):
    """One folder per key, read back with its partition column."""
    out = io.scratch(spark)
    io.sink_partitioned(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), out, "o_orderpriority")
    return spark.read.parquet(out).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""select count(*) as rows, 0 as over_budget, 0 as problems, sum(length('{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}') + 1)::bigint as bytes from supplier""")
def export_manifest(spark, d):
    """Files of at most a byte budget, listed with their digests and checked against the folder; nothing is lost or changed."""
    out, budget = io.scratch(spark), 2_000
    io.sink_budget(table(spark, d, "supplier").select("s_suppkey", "s_name"), out, budget, ["s_suppkey"])
    listed = io.manifest(spark, out, "*.txt")
    g = listed.agg(F.count_if(F.col("bytes") > budget).alias("over_budget"), F.sum("bytes").alias("bytes"))
    bad = io.check_manifest(listed, io.manifest(spark, out, "*.txt")).agg(F.count(F.lit(1)).alias("problems"))
    n = spark.read.text(f"{out}/*/*.txt").agg(F.count(F.lit(1)).alias("rows"))
    return g.crossJoin(bad).crossJoin(n)  # one row each


@query("""select c_custkey::varchar as k, case when c_custkey % 5 = 0 then 'old body' when c_custkey % 7 <> 0 then 'body of ' || c_custkey end as body, case when c_custkey % 5 = 0 then 'cached' when c_custkey % 11 = 0 then 'failed' when c_custkey % 7 = 0 then 'missing' else 'fetched' end as status
from customer where c_custkey % 5 = 0 or c_custkey % 11 <> 0 union all select c_custkey::varchar, null, 'failed' from customer where c_custkey % 5 <> 0 and c_custkey % 11 = 0""")
def batched_fetch(spark, d):
    """Keys fetched in batches through a client with a cache; one bad key does not lose its batch."""

    def client(ids):
        if any(int(i) % 11 == 0 for i in ids):
            raise OSError("no answer")
        return {**{i: f"body of {i}" for i in ids if int(i) % 7}, "stray": "x"}

    keys = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("k"), "c_custkey")
    cache = keys.where("c_custkey % 5 = 0").select("k", F.lit("old body").alias("body"))
    return io.fetch_by_key(keys, "k", client, cache, retries=0)


@query("""select 'tax' || (c_custkey % 3) as query, 'id' || c_custkey as id from customer""")
def paged_search(spark, d):
    """Searches counted first and read page by page."""
    n = table(spark, d, "customer").agg(F.max("c_custkey"), F.min("c_custkey")).first()
    ids = lambda q: range(n[1] + (int(q[3:]) - n[1]) % 3, n[0] + 1, 3)  # noqa: E731  (customers are numbered without gaps)
    return io.search_pages(spark, ["tax0", "tax1", "tax2"], lambda q: len(ids(q)), lambda q, start, size: [f"id{i}" for i in ids(q)[start : start + size]], 40)


@query("""select study_accession, regexp_replace(study_title, '[\\t\\r\\n]', ' ', 'g') as study_title, coalesce(center_name, '') as center_name, '' as owner from study_meta where study_accession is not null""")
def lenient_tsv(spark, d):
    """A3: tab-separated text without quoting; absent contract columns come as empty texts, in the contract's order."""
    out = io.scratch(spark)
    m = table(spark, d, "study_meta").where("study_accession is not null")
    clean = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[\\t\\r\\n]", " ")
    m.select(clean("center_name").alias("center_name"), F.when(F.col("study_title").isNull(), io.NULL_TOKEN).otherwise(clean("study_title")).alias("study_title"), "study_accession").select(
        F.concat_ws("\t", "center_name", "study_title", "study_accession").alias("line")
    ).coalesce(1).write.text(f"{out}/body")
    head = spark.createDataFrame([("center_name\tstudy_title\tstudy_accession",)], "line string")
    head.unionByName(spark.read.text(f"{out}/body").withColumnRenamed("value", "line")).coalesce(1).write.text(f"{out}/whole")
    t = io.scan_tsv(spark, f"{out}/whole", ["study_accession", "study_title", "center_name", "owner"])
    return t.withColumn("study_title", F.when(F.col("study_title") != "", F.col("study_title")))


@query("""select term_id, code, label from vocab_terms where vocabulary = 'sex' union all select 1000, 'x', null""")
def configured_list(spark, d):
    """A configured list as a frame joined to the reference list; repeated keys are an error."""
    rows = [{"code": "female"}, {"code": "male"}, {"code": "x", "term_id": 1000}]
    c = io.dimension_frame(spark, rows, "code")
    t = table(spark, d, "vocab_terms").where("vocabulary = 'sex'").select("code", F.col("term_id").alias("t"), "label")
    return c.join(t, "code", "left").select(F.coalesce("t", F.col("term_id").cast("long")).alias("term_id"), "code", "label")


@query("""select meta_id, trim(regexp_replace(coalesce(study_title, ''), '\\s+', ' ', 'g')) as abstract, trim(regexp_replace(coalesce(description, ''), '\\s+', ' ', 'g')) as methods, 'Ends & odds' as other from study_meta""")
def article_sections(spark, d):
    """A10: the named parts of marked-up articles, entities resolved, and the rest."""
    esc = lambda c: io.xml_escape(F.coalesce(c, F.lit("")))
    xml = F.concat(
        F.lit("<article><abstract><p>"), esc("study_title"), F.lit("</p></abstract><body><sec id='s1'><title>Materials and methods</title> <p>"), esc("description"), F.lit("</p></sec><sec><p>Ends &amp; odds</p></sec></body></article>")
    )
    parts = io.sections(F.col("xml"), ["abstract", "methods"])
    return table(spark, d, "study_meta").select("meta_id", xml.alias("xml")).select("meta_id", *[c.alias(n) for n, c in parts.items()])


@query("""select t || '-' || s || '-' || p as slice, a, b from (select unnest([408170, 9606])::varchar as t), (select unnest(['WGS', 'AMPLICON']) as s), (values ('2019', '2019-03-01', '2019-12-31'), ('2020Q1', '2020-01-01', '2020-03-31'), ('2020Q2', '2020-04-01', '2020-06-30'),
('2020Q3', '2020-07-01', '2020-09-30'), ('2020Q4', '2020-10-01', '2020-12-31'), ('2021', '2021-01-01', '2021-02-10')) v(p, a, b)""")
def archive_slices(spark, d):
    """Archive queries by taxon, strategy and period, dense years in quarters."""
    rows = io.build_slices(["408170", "9606"], ["WGS", "AMPLICON"], "2019-03-01", "2021-02-10", {2020})
    q = spark.createDataFrame([(r["slice"], r["query"]) for r in rows], "slice string, query string")
    day = lambda op: F.regexp_extract("query", rf"first_public{op}=(\S+)", 1)
    return q.select("slice", day(">").alias("a"), day("<").alias("b"))


@query("""select p_brand, count(*) as rows, (4 * (1 + 2 * count(*)))::int as bytes, (sum(n) + sum(round(m * 1000000)))::bigint as total from (select p_brand, p_size, count(*) as n, avg(p_retailprice) / 1000000 as m from part group by 1, 2) group by 1""")
def packed_payload(spark, d):
    """Counts and scaled means of each group packed as little-endian integers, and read back."""
    g = table(spark, d, "part").groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"), (F.avg("p_retailprice") / 1_000_000).alias("m"))
    x = io.encode_payload(g, "p_brand", ["n"], ["m"])
    words = F.transform(F.sequence(F.lit(0), F.floor(F.length("payload") / 4).cast("int") - 1), lambda i: F.conv(F.array_join(F.reverse(F.regexp_extract_all(F.hex(F.substr("payload", i * 4 + 1, F.lit(4))), F.lit("(..)"), F.lit(1))), ""), 16, 10).cast("long"))
    x = x.select("p_brand", F.length("payload").alias("bytes"), words.alias("w"))
    return x.select("p_brand", F.get("w", 0).alias("rows"), "bytes", F.aggregate(F.slice("w", F.lit(2), F.size("w")), F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))


@query("""select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'P' and o_totalprice > 100000""")
def filtered_export(spark, d):
    """The current filtered result as ordered CSV, read back."""
    out = io.scratch(spark)
    o = table(spark, d, "orders").where("o_orderstatus = 'P' and o_totalprice > 100000").select("o_orderkey", "o_custkey", "o_totalprice")
    io.export_csv(o, out, ["o_custkey", "o_orderkey"])
    back = io.scan_csv_text(spark, out, o.columns)
    return back.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), F.col("o_totalprice").cast("double").alias("o_totalprice"))


def _pack(members: dict) -> bytes:
    b = BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return b.getvalue()


def _zipped(rows: pd.Series) -> pd.Series:
    """Archives of an archive with a tab-separated table, and of a broken one."""
    lines = lambda r: "note\nterm_id\tlabel\textra\n" + "\n".join(f"{x['term_id']}\t{x['label'] or ''}\t" for x in r)
    return pd.Series([_pack({"in.zip": _pack({"t.tsv": lines(r)}), "bad.zip": b"PK not an archive"}) for r in rows])


@query("""select 'a.zip!in.zip!t.tsv' as path, row_number() over (order by term_id) - 1 as row_no, term_id::varchar as term_id, coalesce(label, '') as label, 'read' as status from vocab_terms union all select 'a.zip!bad.zip', null, null, null, 'broken'""")
def archived_tables(spark, d):
    """Tables in nested archives, header found, statuses logged."""
    terms = table(spark, d, "vocab_terms").agg(F.array_sort(F.collect_list(F.struct("term_id", "label"))).alias("r"))  # a reference list
    x = io.parse_files(terms.select(F.lit("a.zip").alias("path"), F.pandas_udf(_zipped, "binary")("r").alias("content")))
    cell = lambda c: F.get_json_object("cells", f"$.{c}")
    return x.select("path", "row_no", cell("term_id").alias("term_id"), cell("label").alias("label"), "status")


@query("""select epoch(date_trunc('hour', ts))::bigint as start_s, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2""")
def tumbling_windows(spark, d):
    """Tumbling event-time windows (batch plan of the streaming aggregate)."""
    e = _events(spark, d)
    w = e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.unix_seconds("w.start").alias("start_s"), "event_type", "n", "total")


@query("""select (floor(epoch(ts) / 3600)::bigint - g) * 3600 as start_s, count(*) as n from events, range(0, 3) r(g) group by 1""")
def sliding_windows(spark, d):
    """Sliding windows of three hours every hour."""
    w = _events(spark, d).groupBy(F.window("ts", "3 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.unix_seconds("w.start").alias("start_s"), "n")


@query("""with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 2 hour then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by user_id order by ts
rows unbounded preceding) as k from e) select user_id, epoch_us(min(ts)) as start_us, count(*) as n from s group by user_id, k""")
def session_windows(spark, d):
    """Sessions with a gap of two hours."""
    w = _events(spark, d).groupBy(F.session_window("ts", "2 hours").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return w.select("user_id", F.unix_micros("w.start").alias("start_us"), "n")


def _events(spark, d):
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _stream(spark, d):
    schema = table(spark, d, "events").schema
    return intake.read_files(spark, f"{d}/event[s].parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query("""with m as (select max(ts) as m from events) select epoch(date_trunc('hour', ts))::bigint as start_s, count(*) as n from events, m group by 1, m.m having date_trunc('hour', any_value(ts)) + interval 1 hour <= m.m - interval
10 minute""")
def stream_windows(spark, d):
    """A stream of windows with a watermark, run over all files present; windows still open are not emitted."""
    w = intake.windowed(_stream(spark, d), "ts", "1 hour", None, "10 minutes", [], [F.count(F.lit(1)).alias("n")])
    return intake.run_available(w, spark).select(F.unix_seconds("w.start").alias("start_s"), "n")


@query("select distinct user_id, event_type from events")
def stream_dedupe(spark, d):
    """A stream without repeated keys within the watermark."""
    s = intake.deduplicated(_stream(spark, d).select("ts", "user_id", "event_type"), "ts", ["user_id", "event_type"], "60 days")
    return intake.run_available(s, spark).select("user_id", "event_type")


@query("select user_id, event_type, max(event_id) as event_id from events group by 1, 2")
def stream_merge(spark, d):
    """A stream merged batch by batch into the latest row per key."""
    return intake.merge_batches(_stream(spark, d).select("user_id", "event_type", "event_id"), spark, ["user_id", "event_type"], ["event_id"])


@query("""with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 2 hour then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from e),
m as (select max(ts) as m from events) select user_id, epoch_us(min(ts)) as start_us, count(*) as n from s, m group by user_id, k, m.m having max(ts) + interval 2 hour <= m.m - interval 10 minute""")
def stream_sessions(spark, d):
    """A stream of sessions per user with a watermark; sessions still open are not emitted."""
    w = intake.sessions(_stream(spark, d), "ts", "2 hours", "10 minutes", ["user_id"], [F.count(F.lit(1)).alias("n")])
    return intake.run_available(w, spark).select("user_id", F.unix_micros("w.start").alias("start_us"), "n")


@query("""select event_id, user_id, case when event_id % 6 = 0 then 'changed' else event_type end as event_type from events where event_id % 6 = 0 or event_id % 2 = 1""")
def new_content(spark, d):
    """Rows of a delivery whose content was not seen before, however often they are delivered again."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    batch = e.withColumn("event_type", F.when(F.col("event_id") % 6 == 0, "changed").otherwise(F.col("event_type")))
    return intake.new_only(batch.unionByName(batch), e.where("event_id % 2 = 0"), "event_id", ["user_id", "event_type"])

