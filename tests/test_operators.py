"""Code books, guards, foreign tables, archives, subjects and drivers on small frames, with the cases the tables lack."""

import io as bytes_io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import codes as C
from sedimenta.functions import texts as T
from sedimenta.operators import dispatch, joins, registry, resolve, snapshots, subjects, supplement, versioned
from sedimenta.sources import io, tables


def coded(spark, book, rows):
    df = spark.createDataFrame([(k, v) for k, v in rows], "k string, v string")
    return [(r.c.code, r.c.note) for r in df.select(C.coded(F.col("k"), F.col("v"), C.BOOKS[book]).alias("c")).collect()]


@pytest.mark.parametrize(
    "book, rows",
    [
        ("smoking", [("smoking", "Never smoked", "never"), ("smoker", "non-smoker", "never"), ("smoking", "Ex smoker", "former"), ("smoking", "10 cigs (1983-1993)", "former"), ("smoking", "2 cigarettes QD (2009-pres)", "current"),
                     ("smoking", "Smoker occasionally", "current"), ("smoker", "yes", "current"), ("smoker", "no", "never"), ("smoking", "12", None), ("smoking", "20+ years", None), ("smoking", "Smoked", None), ("smoker", "Passive smoking", None),
                     ("smoking_history", "Yes", None), ("smoking", None, None), ("smoking", "not provided", None), ("smoking", "N; marijuana", None)]),
        ("delivery", [("delivery_mode", "C-Section", "c_section"), ("delivery_mode", "emergency caesarean", "c_section_emergency"), ("delivery_mode", "elective c-section", "c_section_elective"), ("delivery_mode", "NVD", "vaginal"),
                      ("csection", "no", "vaginal"), ("caesareansection", "1", "c_section"), ("delivery", "2", None), ("delivery_mode", "unplanned section", "c_section_emergency"), ("delivery_mode", "", None)]),
        ("feeding", [("feed", "EBF", "exclusive_breast"), ("feed", "breast and formula", "mixed"), ("feed", "formula", "formula"), ("formula_percent", "0", "exclusive_breast"), ("formula_percent", "100", "formula"), ("formula_percent", "40", "mixed"), ("feed", "weaned", "weaned/solids")]),
        ("sex", [("sex", "Girl", "female"), ("legal_sex_0_m_1_f", "0", "male"), ("phenotype", "male_subject_of_3_years", "male"), ("sex", "both", None)]),
        ("yes_no", [("antibiotic", "Ampicillin", "yes"), ("days_on_abx", "0", "no"), ("days_on_abx", "3", "yes"), ("antibiotic_history", "I have not taken any", "no"), ("abx", "none", "no"), ("abx", "after", None)]),
        ("diet", [("host_diet", "vegan", "vegan"), ("host_diet", "non-vegetarian", "omnivore"), ("host_diet", "low-FODMAP vegan", "therapeutic_or_study_diet"), ("vegan_diet", "no", None), ("host_diet", "mouse chow", None), ("host_diet", "mostly vegetarian", None), ("host_diet", "no special diet", "omnivore")]),
        ("multiple_birth", [("is_twin", "0", "singleton"), ("twin_id", "A", "twin"), ("relation", "triplet sister", "triplet_or_more"), ("twins", "AB12+AB13", "twin"), ("relation", "mother", None)]),
        ("nec", [("nec", "surgical", "yes"), ("nec", "no", "no")]), ("preterm", [("x", "1", "preterm"), ("x", "full-term", "term")]), ("probiotic_freq", [("x", "never", "no"), ("x", "Daily", "yes")]), ("hmo", [("x", "2'FL HMO", "yes")]),
        ("sibling", [("number_of_siblings", "2", "yes"), ("siblings", "0", "no")]), ("medication", [("med", "metformin 500 mg", "yes"), ("med", "not taking any medication", "no"), ("med", "planned", None)]),
    ],
)
def test_code_books(spark, book, rows):
    got = coded(spark, book, [(k, v) for k, v, _ in rows])
    assert [(v, c) for (_, v, _), (c, _) in zip(rows, got)] == [(v, w) for _, v, w in rows]
    assert all(note for _, note in got)


def test_places(spark):
    df = spark.createDataFrame([("USA:CA:San Diego", "California"), ("Krakow, Poland", "Cracow"), ("TUW", "Tuvalu"), (None, "France"), ("x", None), ("Charité hospital, Berlin", "berlin"), ("Unit: NICU ward", None)], "raw string, place string")
    r = df.select(C.place_valid(F.col("raw"), F.col("place"), {"CA": "California"}).alias("v"), C.sub_national(F.col("raw")).alias("s")).collect()
    assert [x.v for x in r] == [True, True, False, False, True, True, True]
    assert r[0].s == "San Diego, CA" and r[6].s is None and r[3].s is None


def test_guard_gives_the_first_reason(spark):
    rows = [("vegan", "vegan diet", "a vegan diet since 2018", True, None), ("vegan", "vegan", "eats all", True, "no span"), ("odd", "x", "x", False, "not in vocabulary"), ("vegan", "vegan", "not a vegan", True, "negated"),
            ("vegan", "vegan", "mostly vegan", True, "hedged"), ("vegan", "diet", "a diet", True, "no match term"), (None, None, None, None, "not in vocabulary")]
    df = spark.createDataFrame(rows, "code string, term string, raw string, known boolean, want string").withColumn("terms", F.array(F.lit("Vegan")))
    for r in df.select("want", T.guard(F.col("code"), F.col("term"), F.col("raw"), F.col("known"), F.col("terms")).alias("got")).collect():
        assert r.got == r.want


def test_lists_with_blanks(spark):
    df = spark.createDataFrame([("a ; b;0 c",)], "x string")
    assert df.select(T.has_code(F.col("x"), "b").alias("h"), T.has_code(F.col("x"), "0 c").alias("z")).first() == (True, True)


def test_dispatch(spark):
    rows = [(1, "age", "age_numeric", "days", "3 weeks"), (2, "age", "age_numeric", None, "36"), (3, "sex", "categorical_sex", None, "boy"), (4, "day", "timestamp_text", None, "2019-02-30"), (5, "id", "identifier", None, " A1 "), (6, "x", "odd", None, "v"), (7, "age", "age_numeric", None, None), (8, "p", "percent_feeding", None, "50")]
    df = spark.createDataFrame([(i, "S", "P", f"f_{k}", k, p, u, v) for i, k, p, u, v in rows], "attr_id long, sample_key string, study_accession string, field_name string, attr_key_norm string, parser string, unit_default string, value string")
    got = {r.attr_id: (r.value_normalized, r.accepted, r.note) for r in dispatch.apply_field_map(df).collect()}
    assert got[1][0] == "21" and got[2] == (None, False, "bare number, no unit") and got[3][0] == "male" and got[4][1] is False and got[5][0] == "A1" and got[6][2] == "no parser" and 7 not in got
    assert dispatch.apply_field_map(df.limit(0)).count() == 0


def test_xml_in_every_spelling(spark):
    xml = """<S><Attribute unit='days' attribute_name="age">3</Attribute><Attribute attribute_name='note'>5&apos;3&quot; &lt;b&gt; &amp;amp; &#233;&#x4e2d;</Attribute>
    <Attribute attribute_name="raw"><![CDATA[a < b & c]]></Attribute><Attribute attribute_name="none"/><TAG>k</TAG><VALUE>v &amp; w</VALUE><UNITS>kg</UNITS><TAG>l</TAG><VALUE/></S>"""
    df = spark.createDataFrame([(1, xml), (2, None), (3, ""), (4, "no xml")], "id long, xml string")
    got = {r.attr_key: (r.value, r.units) for r in io.xml_to_eav(df, "id", "xml").collect()}
    assert got == {"age": ("3", "days"), "note": ("5'3\" <b> &amp; é中", None), "raw": ("a < b & c", None), "none": ("", None), "k": ("v & w", "kg"), "l": ("", None)}


def test_archives_of_any_depth_and_size():
    def pack(members):
        b = bytes_io.BytesIO()
        with zipfile.ZipFile(b, "w", zipfile.ZIP_DEFLATED) as z:
            for n, x in members.items():
                z.writestr(n, x)
        return b.getvalue()

    data = pack({"deep.csv": "a,b\n1,2"})
    for i in range(7):
        data = pack({f"l{i}.zip": data})
    got = list(io.walk_archive("top", pack({"n.zip": data, "big.csv": "x\n" + "0" * 70_000_000, "bad.zip": b"PKxx"})))
    assert {(p.split("!")[-1], s, len(d)) for p, s, d in got} == {("deep.csv", "read", 7), ("big.csv", "read", 70_000_002), ("bad.zip", "broken", 0)}
    assert io.split_header([["", "x"], ["id", "id", ""], ["1"], [None, ""], ["2", "3"]]) == (["id", "id_2", "col3"], [["1", "", ""], ["2", "3", ""]])
    assert io.split_header([]) == ([], [])


def test_files_stay_below_their_budget(spark, tmp_path):
    df = spark.createDataFrame([(i, "é" * (i % 50)) for i in range(400)] + [(1000, "z" * 900)], "id long, s string")
    io.sink_budget(df, str(tmp_path / "o"), 700, ["id"])
    sizes = [p.stat().st_size for p in (tmp_path / "o").rglob("*.txt")]
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(str(tmp_path / "o")).collect()) == [*range(400), 1000]
    assert sorted(sizes)[-2] <= 700 < sizes[sizes.index(max(sizes))]


def test_shared_folder_is_demanded_on_clusters(spark):
    class Context:
        master = "spark://far:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(*_):
                return None

    with pytest.raises(ValueError):
        tables.shared_folder(Session())


def test_corrections_follow_their_precedence(spark):
    det = spark.createDataFrame([(1, "P", "f", "A", "x"), (2, "P", "f", "A", "x"), (3, "P", "f", "B", "y"), (4, "P", "g", "A", "x"), (5, None, "f", "A", "x"), (6, "P", "f", "C", None)], "id long, study_accession string, field_name string, e string, v string")
    cor = spark.createDataFrame([(1, "P", "f", "", "", "recode", "any"), (2, "P", "f", "A", "", "recode", "a"), (3, "P", "g", "", "", "retire", None)], "correction_id long, study_accession string, field_name string, entity string, old string, action string, new string")
    got = sorted((r.id, r.v, r.correction) for r in versioned.apply_corrections(det, cor, "e", "v", "id").collect())
    assert got == [(1, "a", 2), (3, "any", 1), (5, "x", None), (6, "any", 1)]
    assert versioned.apply_corrections(det.limit(0), cor, "e", "v", "id").count() == 0


def test_overrides_must_match_one_row(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    spec = {"name": "t", "current": cur, "key": ["k"], "diff": ["v"], "overrides": spark.createDataFrame([(3, "z")], "k long, v string")}
    with pytest.raises(ValueError):
        versioned.build_facts([spec], "R2", "p2")
    out = versioned.build_facts([spec | {"overrides": None}], "R2", "p2")["t"]
    assert {(r.k, r.release_added) for r in out.collect()} == {(1, "R2"), (2, "R2")}


def test_nearest_at_poles_and_the_180th_meridian(spark):
    import math
    import random

    rnd = random.Random(2)
    far = lambda a, b: 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)))
    where = lambda: (math.degrees(math.asin(rnd.uniform(-1, 1))) if rnd.random() < 0.5 else rnd.choice([-1, 1]) * rnd.uniform(80, 90), rnd.choice([rnd.uniform(-180, 180), rnd.uniform(179.5, 180), rnd.uniform(-180, -179.5)]))
    places, points = [(f"p{i:03}", *where()) for i in range(150)], [(i, *where()) for i in range(300)] + [(300, 90.0, 0.0), (301, -90.0, 180.0), (302, None, 1.0)]
    p = spark.createDataFrame(points, "id long, lat double, lon double")
    q = spark.createDataFrame(places, "place string, lat double, lon double")
    for reach in (40.0, 250.0, 1200.0):
        got = {r.id: r.place for r in joins.nearest(p, q, "id", reach).collect()}
        want = {}
        for i, *x in points:
            if x[0] is not None:
                km, name = min((far(x, y), n) for n, *y in places)
                if km <= reach:
                    want[i] = name
        assert got == want


def test_components_of_a_long_path(spark):
    n = 300
    e = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (2000, 2000), (None, 5)], "a long, b long")
    got = {r.node: r.root for r in joins.components(e, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000, 2000: 2000}


def test_hot_keys_give_the_same_salted(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)], "i long, k string")
    dim = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    a, b = [sorted(map(tuple, resolve.attach(df, dim, ["k"], most=m).collect())) for m in (10**6, 0)]
    assert a == b and len(a) == 90


def test_adjusted_p_values_without_groups(spark):
    import random

    rnd = random.Random(3)
    rows = [(i, rnd.choice([rnd.random(), 0.01, 0.5])) for i in range(200)] + [(999, None)]
    df = spark.createDataFrame(rows, "k long, p double")
    got = {r.k: r.q for r in resolve.bh(df, "p", "k").collect()}
    ranked = sorted((p, k) for k, p in rows if p is not None)
    q, want = 1.0, {}
    for r in range(len(ranked), 0, -1):
        p, k = ranked[r - 1]
        q = min(q, p * len(ranked) / r)
        want[k] = q
    assert got == pytest.approx(want)
    grouped = {r.k: r.q for r in resolve.bh(df.withColumn("g", F.lit(1)), "p", "k", ["g"]).collect()}
    assert grouped == pytest.approx(want)
    assert resolve.bh(df.limit(0), "p", "k").count() == 0


def test_table_gate_statuses(spark):
    a = "t string, header string, level string, level_no int, hits long, targets long, rate double, subject_level boolean"
    rows = [("own", "h", "exact", 0, 3, 3, 0.5, False), ("own", "g", "alnum", 2, 9, 9, 0.9, False), ("pooled", "h", "exact", 0, 25, 25, 0.1, False), ("below", "h", "exact", 0, 2, 2, 0.9, False), ("subject", "h", "exact", 0, 5, 0, 0.9, True), ("subject", "i", "alnum", 2, 4, 4, 0.6, False)]
    t = spark.createDataFrame([(n, r) for n, r in [("own", 6), ("pooled", 250), ("below", 10), ("subject", 9), ("none", 5), ("few", 2), ("large", 10**6)]], "t string, n_rows long")
    got = {r.t: (r.status, r.header) for r in supplement.choose_attempt(spark.createDataFrame(rows, a), t, "t", "header", "n_rows").collect()}
    assert got == {"own": ("mapped", "h"), "pooled": ("mapped_pooled", "h"), "below": ("below_gate", "h"), "subject": ("mapped", "i"), "none": ("no_match", None), "few": ("too_few_rows", None), "large": ("too_large", None)}


def test_matrix_and_extraction(spark):
    cells = spark.createDataFrame([("m", f"taxon{c}", r, f"0.{c}") for c in range(220) for r in range(3)] + [("s", "age", r, "3") for r in range(3)], "t string, h string, r long, v string")
    assert {x.t: x.is_matrix for x in supplement.is_matrix(cells, "t", "h", "v", "r").collect()} == {"m": True, "s": False}
    c = spark.createDataFrame([("t", 0, "age", "3 weeks"), ("t", 1, "age", "3-5 weeks"), ("t", 2, "age", "900 years"), ("t", 3, "mode", "2"), ("t", 0, "mode", None)], "t string, r long, h string, v string")
    hits = spark.createDataFrame([("t", 0, "A", True), ("t", 0, "B", True), ("t", 1, "C", False), ("t", 2, "C", False), ("t", 3, "D", True)], "t string, r long, e string, subject_level boolean")
    cols = spark.createDataFrame([("t", "age", "age_days", "time", None, 0.0, 40000.0, False), ("t", "mode", "delivery", None, None, None, None, True)], "t string, h string, field_name string, dim string, unit string, lo double, hi double, is_static boolean")
    legend = spark.createDataFrame([("t", "mode", "2", "c_section")], "t string, h string, v string, meaning string")
    got = sorted((x.e, x.field_name, x.value_normalized, x.confidence) for x in supplement.extract_columns(c, hits, cols, legend, "t", "r", "h", "v", "e").collect())
    assert got == [("D", "delivery", "c_section", 0.8)]  # ages at subject level are not static, a range and an absurd age are rejected


def test_mentions(spark):
    m = spark.createDataFrame([("p", "PRJ1", "methods", "We deposited our reads under PRJ1"), ("p", "PRJ1", "results", "We deposited our reads under PRJ1 too"), ("q", "PRJ1", "intro", "publicly available data PRJ1"), ("r", "PRJ1", "intro", "see PRJ1"), ("r", "PRJ9", "intro", "see PRJ9"), ("s", "PRJ1", "intro", None)], "paper string, accession string, section string, context string")
    got = {r.paper: (r.relation, r.n_mentions, r.contexts.count("||")) for r in supplement.link_mentions(m, spark.createDataFrame([("PRJ1", "S1")], "accession string, study_accession string"), "paper").collect()}
    assert got == {"p": ("own", 2, 0), "q": ("reused", 1, 0), "r": ("cited", 1, 0), "s": ("cited", 1, 0)}


def test_subjects(spark):
    rows = [("g", "a1", "S1", None, "infant 1 day 3", 3.0, 1), ("g", "a2", "S1", None, "infant 1 day 9", 9.0, 2), ("g", "a3", None, None, "mother of baby 2", None, 3), ("g", "a4", None, None, None, None, 4), ("g", "a4", None, None, None, None, 4)]
    df = spark.createDataFrame(rows, "g string, e string, i string, j string, n string, age double, o int")
    got = {r.e: (r.subject_id, r.role, r.position) for r in subjects.resolve_subjects(df, "g", "e", [("i", "attribute"), ("j", "lab")], "n", "age", "o").collect()}
    assert got["a1"] == ("S1", "infant", 1) and got["a2"] == ("S1", "infant", 2) and got["a3"][1] == "mother" and got["a4"] == (None, "unknown", 1)


def test_evidence_is_weighed(spark):
    df = spark.createDataFrame([(1, "mouse gut", "infants"), (2, None, "infants"), (3, None, None), (4, "infants", "mice"), (5, "infants", None)], "id long, a string, b string")
    voc = {"human": (["infant*"], []), "animal": (["mouse", "mice"], ["mouse model"])}
    src = {"title": ("a", 2.0, True), "text": ("b", 1.0, False)}
    got = {r.id: (r.code, r.reasons, r.stage) for r in registry.weigh_evidence(df, "id", src, voc, F.when(F.col("id") == 5, "animal")).collect()}
    assert got == {1: ("animal", "conflict", "rule"), 2: ("human", "weak sources only", "rule"), 3: ("unknown", "no evidence", "rule"), 4: ("human", "conflict", "rule"), 5: ("animal", "", "prior")}


def test_bucket_number_needs_no_job(spark):
    assert snapshots.file_bytes(spark.read.parquet("/root/testdata/sf0.001/orders.parquet")) > 1000
    assert snapshots.file_bytes(spark.createDataFrame([(1,)], "a int")) >= 0
