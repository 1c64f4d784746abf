"""The curation operators: hand-made cases, brute force on whole small tables, and edge cases."""

import datetime as dt
import re
import zoneinfo

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sedimenta.functions.keys import is_placeholder
from sedimenta.functions.quantities import parse_quantity, to_common
from sedimenta.functions.times import keep, parse_time, utc_text
from sedimenta.operators import eav, history, snapshots, timestamps, units
from sedimenta.plans import curation

SF = "/root/testdata/sf0.001"


def utc(spark, rows):
    """{text: utc text} of (text, zone, order) rows."""
    df = spark.createDataFrame(rows, "v string, z string, o string")
    zones = timestamps.zone_years(spark.createDataFrame([(z,) for z in {r[1] for r in rows if r[1]}] or [("UTC",)], "zone_id string"), "zone_id")
    p = keep(df, "p", parse_time(F.col("v"), F.col("o")))
    got = timestamps.resolve_local(p, zones, "p", F.col("z"), "us").select("v", utc_text(F.col("us")).alias("t")).collect()
    return {r.v: r.t for r in got}


def test_times_and_zones(spark):
    rows = [
        ("2021-03-28 02:30", "Europe/Berlin", "dmy"),  # never occurs: moved forward
        ("2021-10-31 02:30", "Europe/Berlin", "dmy"),  # occurs twice: the first
        ("03/04/2020", "America/New_York", "mdy"),
        ("04/03/2020", "Europe/London", "dmy"),
        ("2020-01-01T00:00:00.123+0545", "Europe/London", "dmy"),
        ("1617205148", "Asia/Tokyo", "mdy"),
        ("14 août 2022 18:05", "Europe/Berlin", "dmy"),
        ("April 25, 2021 4:57 p.m.", "UTC", "dmy"),
        ("2019-02-30", "UTC", "dmy"),
        ("summer 2020", "UTC", "dmy"),
        ("2019-06-01", None, "dmy"),
        (None, "UTC", "dmy"),
        ("", "UTC", "dmy"),
        ("x" * 50_000, "UTC", "dmy"),
    ]
    got = utc(spark, rows)
    assert got == {
        "2021-03-28 02:30": "2021-03-28T01:30:00.000000Z",
        "2021-10-31 02:30": "2021-10-31T00:30:00.000000Z",
        "03/04/2020": "2020-03-04T05:00:00.000000Z",
        "04/03/2020": "2020-03-04T00:00:00.000000Z",
        "2020-01-01T00:00:00.123+0545": "2019-12-31T18:15:00.123000Z",
        "1617205148": "2021-03-31T15:39:08.000000Z",
        "14 août 2022 18:05": "2022-08-14T16:05:00.000000Z",
        "April 25, 2021 4:57 p.m.": "2021-04-25T16:57:00.000000Z",
        "2019-06-01": None,
    }


def test_zone_offsets_against_zoneinfo(spark):
    """Every half hour of three years around the changes, against the standard library."""
    for name in ("Europe/Berlin", "America/Los_Angeles", "Australia/Sydney"):
        z = zoneinfo.ZoneInfo(name)
        texts, want = [], {}
        at = dt.datetime(2019, 12, 25)
        while at < dt.datetime(2020, 11, 20):
            text = at.strftime("%Y-%m-%d %H:%M")
            local = at.replace(tzinfo=z, fold=0)
            back = local.astimezone(dt.timezone.utc).astimezone(z).replace(tzinfo=None)
            utc_time = local.astimezone(dt.timezone.utc)
            if back != at:  # a gap: forward by its length
                utc_time = (at - (at.replace(tzinfo=z, fold=0).utcoffset())).replace(tzinfo=dt.timezone.utc)
            want[text] = utc_time.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
            texts.append((text, name, "dmy"))
            at += dt.timedelta(minutes=30)
        assert utc(spark, texts) == want


def test_years_beyond_the_table(spark):
    """Every eleventh day of years from 1700 to 9000 at noon, against the standard library."""
    for name in ("Europe/Berlin", "America/New_York", "Australia/Sydney"):
        z, texts, want = zoneinfo.ZoneInfo(name), [], {}
        for year in (1700, 1799, 1850, 2100, 2101, 2104, 2150, 2200, 2399, 2400, 3333, 9000):
            for day in range(0, 365, 11):
                at = dt.datetime(year, 1, 1, 12) + dt.timedelta(days=day)
                text = at.strftime("%Y-%m-%d %H:%M")
                texts.append((text, name, "dmy"))
                want[text] = (at - at.replace(tzinfo=z).utcoffset()).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        assert utc(spark, texts) == want


def test_lookup_is_the_same_salted(spark):
    left = spark.createDataFrame([(i, f"k{i % 3}" if i % 5 else None) for i in range(60)], "id long, k string")
    dim = spark.createDataFrame([("k0", 1), ("k1", 2)], "k string, v int")
    a, b = [sorted(map(str, timestamps.salted_lookup(left, dim, "k", F.col("id"), most=n).collect())) for n in (100, 0)]
    assert a == b and len(a) == 60


def test_p2_against_plain_reading(spark):
    """The rows of ISO notation, read by the standard library."""
    got = {(r.table_name, r.row_id): r.utc_text for r in curation.p2_found(spark, SF).collect()}
    meta = pd.read_parquet(f"{SF}/study_meta.parquet")
    n = 0
    for r in meta.itertuples():
        v = (r.first_public or "").strip() if isinstance(r.first_public, str) else ""
        if re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z", v):
            t = dt.datetime.fromisoformat(v.replace("Z", "+00:00"))
            assert got["study_meta", r.meta_id] == t.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
            n += 1
    assert n
    assert len(got) == curation.p2_found(spark, SF).count()


def test_placeholders(spark):
    yes = [None, "", "  ", "N/A", "n.a.", "missing: control sample", "Not Applicable", "none", "-", "--", "?", "NaN", "restricted access", "unknown", "nd"]
    no = ["nose", "Norway", "0", "nothing special here", "see chart", "missouri", "unknownium"]
    df = spark.createDataFrame([(v,) for v in yes + no], "v string")
    assert [r[0] for r in df.select(is_placeholder(F.col("v"))).collect()] == [True] * len(yes) + [False] * len(no)


def test_quantities(spark):
    rows = [("8lb 15oz", "mass", 4054), ("3,016 g", "mass", 3016), ("3,483 kg", "mass", 3483), ("90-92 kg", "mass", 91000), ("6'5\"", "length", 1956), ("1 457 mm", "length", 1457), ("−80 °C", "temp", -80), ("310.15K", "temp", 37), ("38 0/7", "time", 266), ("P4Y9M", "time", 1735), ("1,005 days old", "time", 1005), ("at birth", "time", 0), ("as above", "time", None), ("", "time", None), (None, "mass", None), ("9" * 10_000, "mass", None)]
    df = spark.createDataFrame(rows, "v string, d string, want long").withColumn("q", parse_quantity(F.col("v"), F.col("d")))
    for r in df.select("v", "want", F.round(to_common(F.col("q"), F.col("q.unit"), F.col("d"))).try_cast("long").alias("got")).collect():
        assert r.got == r.want, r.v if r.v is None else r.v[:40]


H = "e string, v string, s int, f int, id long, extra string"


def test_history_cases(spark):
    rows = [
        ("a", "x", 1, None, 1, ""), ("a", "x", 3, 5, 2, ""), ("a", "y", 5, None, 3, ""),  # continuous x, then y
        ("b", "x", 1, 2, 4, ""), ("b", "x", 4, None, 5, ""),  # a gap keeps versions apart
        ("c", "x", 2, 2, 6, ""), ("c", None, 1, None, 7, ""), ("c", "z", None, None, 8, ""),  # all ignored
        ("d", "x", 1, 3, 9, ""), ("d", "x", 1, 3, 9, ""), ("d", "q", 1, 3, 8, ""),  # repeated rows and a tie
        (None, "n", 1, None, 10, ""),
    ]
    df = spark.createDataFrame(rows, H)
    out = history.versions(df, ["e"], F.col("v"), F.col("s"), F.col("f"), F.col("id")).collect()
    got = {(r.e, r.version_value, r.start, r.end) for r in out}
    assert got == {("a", "x", 1, 5), ("a", "y", 5, None), ("b", "x", 1, 2), ("b", "x", 4, None), ("d", "x", 1, 3), (None, "n", 1, None)}
    assert history.versions(df.limit(0), ["e"], F.col("v"), F.col("s"), F.col("f"), F.col("id")).count() == 0


def test_snapshot_changes_brute_force(spark):
    """Random snapshots with tiny chunks, so that borders and unmatched chunks occur, against dictionaries."""
    import random

    rnd = random.Random(5)
    snaps = [{f"k{i}": rnd.choice(["a", "b", None]) for i in range(400)}]
    for _ in range(3):
        d = dict(snaps[-1])
        for k in rnd.sample(sorted(d), 15):
            d.pop(k)
        for k in rnd.sample(sorted(d), 15):
            d[k] = rnd.choice(["c", "d", None])
        d |= {f"n{rnd.randrange(10**6)}": "e" for _ in range(10)}
        snaps.append(d)
    rows = [(f"s{i}", k, v, 1) for i, d in enumerate(snaps) for k, v in d.items()]
    rows += [("s1", k, "old", 0) for k in list(snaps[1])[:50]] + rows[:100] + [(None, "k1", "x", 1), ("s1", None, "x", 1)]
    df = spark.createDataFrame(rows, "r string, k string, v string, t int")
    prev = spark.createDataFrame([(f"s{i}", f"s{i + 1}" if i < 3 else None, i > 0) for i in range(4)], "snapshot string, next_snapshot string, has_previous boolean")
    run = lambda x: snapshots.snapshot_changes(x, F.col("r"), prev, [F.col("k")], F.col("v"), F.col("t"), chunk_keys=8, buckets=20)
    got = {(r.snapshot, r.k0, r.change_kind) for r in run(df).collect()}
    want = set()
    for i in range(1, 4):
        a, b = snaps[i - 1], snaps[i]
        want |= {(f"s{i}", k, "added") for k in b.keys() - a.keys()} | {(f"s{i}", k, "removed") for k in a.keys() - b.keys()}
        want |= {(f"s{i}", k, "changed") for k in a.keys() & b.keys() if a[k] != b[k]}
    assert got == want
    assert run(df.limit(0)).count() == 0


ATTR = "attr_id long, sample_key string, study_accession string, attr_key string, attr_key_norm string, value string, attr_units string, source string, harvested_at timestamp, parser string"
MAP = "attr_key_norm string, field_name string, parser string, unit_default string, note string"


@pytest.fixture(scope="module")
def attrs(spark):
    t = dt.datetime(2025, 1, 1)
    m = spark.createDataFrame(
        [("age", "age", "age_text_unitkey", None, None), ("age_units", "age_unit", "label", None, None), ("bw", "bw", "bw_numeric", "grams", "values <10 -> kg"), ("day", "day", "timestamp_text", None, None),
         ("sex", "sex", "vocabulary", None, None), ("skipped", "x", "SKIP", None, None), (None, "y", "label", None, None)], MAP)
    rows = [
        (1, " s1 ", "p", "Age", None, "36", None, "a", t, ""),
        (2, "S1", "p", "age units", "age_units", "weeks", None, "a", t, ""),
        (3, "S1", "p", "bw", "bw", "3.4", None, "a", t, ""),
        (4, "S1", "p", "bw", "bw", "not recorded", None, "a", t + dt.timedelta(1), ""),
        (5, "s1", "p", "bw", "bw", "3300", "g", "a", t, ""),
        (5, "s1", "p", "bw", "bw", "3300", "g", "a", t, ""),
        (6, "S2", "p", "age", "age", "2", None, "a", None, ""),
        (7, "S2", "p", "day", "day", "2020-02-30", None, "a", t, ""),
        (8, "S2", "p", "day", "day", "25/12/2020", None, "a", t, ""),
        (9, "S2", "p", "skipped", "skipped", "1", None, "a", t, ""),
        (10, None, "p", "sex", "sex", "f", None, "a", t, ""),
        (11, "S2", None, "sex", "sex", None, None, "a", t, ""),
        (12, "S2", None, "sex", "sex", "y" * 30_000, None, "a", t, ""),
        (13, "S3", "p", None, None, "v", None, "a", t, ""),
    ]
    return spark.createDataFrame(rows, ATTR), m


def test_wide_cells(spark, attrs):
    rows, m = attrs
    keys = ["age", "bw", "day", "sex"]
    t = eav.typed(eav.attributes(rows, m))
    cells = eav.wide_cells(t, keys, "sample_key", "attr_key_norm", [F.col("harvested_at"), F.col("attr_id")], "attr_id")
    got = {r.sample_key: [c and c.row_id for c in r.cells] for r in cells.collect()}
    assert got == {"S1": [1, 5, None, None], "S2": [6, None, 8, 12]}
    wide = eav.wide_table(cells, keys, ["age_text_unitkey", "bw_numeric", "timestamp_text", "vocabulary"], "sample_key")
    assert wide.dtypes == [("sample_key", "string"), ("age", "double"), ("bw", "double"), ("day", "bigint"), ("sex", "string")]
    assert {r.sample_key: r.bw for r in wide.collect()} == {"S1": 3300.0, "S2": None}
    assert eav.wide_cells(t.limit(0), keys, "sample_key", "attr_key_norm", [F.col("attr_id")], "attr_id").count() == 0


def test_units(spark, attrs):
    rows, m = attrs
    a = eav.attributes(rows, m)
    comp = a.where("attr_key_norm = 'age_units'").select("attr_id", "sample_key", "attr_key_norm", "value", "harvested_at")
    told = eav.told_units(a, comp)
    out = units.decode_units(told, ["study_accession", "attr_key_norm"], "attr_id", "field_name", "dim", "q", F.col("told_unit"))
    got = sorted({(r.row_id, r.unit, r.told, round(r.common, 3)) for r in out.collect() if r.told})
    assert got == [(1, "w", True, 252.0), (3, "kg", True, 3400.0), (5, "g", True, 3300.0)]
    assert out.where("not told").count() == 1  # an age without any unit: decoded, but marked as a guess
    none = units.decode_units(told.limit(0), ["study_accession", "attr_key_norm"], "attr_id", "field_name", "dim", "q", F.col("told_unit"))
    assert none.count() == 0


def test_viterbi_finds_a_switch():
    """Weights of one device, unmarked, first in grams, then in kilograms."""
    import numpy as np

    grams = [3000.0, 3200, 2900, 3100, 3.1, 3.3, 2.8, 3.0]
    factors = np.array([units.FACTORS["mass"][u] for u in units.STATES["mass"]])
    path = units.viterbi(np.array(grams)[:, None] * factors[None, :], np.full(8, -1), np.log(3000), 0.3, True)
    assert [units.STATES["mass"][p] for p in path] == ["g"] * 4 + ["kg"] * 4


def test_chain_in_portions_is_the_whole_chain():
    """Random chains taken in random portions, against a plain search over the best paths, each with its level."""
    import math

    import numpy as np

    rnd = np.random.default_rng(7)
    factors = np.array([units.FACTORS["mass"][u] for u in units.STATES["mass"]])
    s = len(factors)
    stay, move = math.log1p(-math.exp(units.SWITCH)), units.SWITCH - math.log(s - 1)
    early = 0
    for _ in range(40):
        n = int(rnd.integers(1, 40))
        values = rnd.lognormal(8, 0.3, n)[:, None] / factors[rnd.integers(0, s, n)][:, None] * factors[None, :]
        told = rnd.choice([-1, -1, -1, -1, -2, 1, 2], n)
        best = {j: (0.0, 8.0, []) for j in range(s)}
        for t in range(n):
            new = {}
            for j in range(s):
                if told[t] >= 0 and j != told[t]:
                    continue
                score, level, path = max(((v + (0 if not t else stay if i == j else move), lv, p) for i, (v, lv, p) in best.items() if t or i == j), key=lambda z: z[0])
                off = math.log(values[t, j]) - level
                if told[t] == -1:
                    score -= 0.5 * (off / 0.3) ** 2
                if told[t] != -2:
                    level += units.SMOOTHING * off
                new[j] = (score, level, [*path, j])
            best = new
        want = max(best.values(), key=lambda z: z[0])[2]
        whole = units.viterbi(values, told, 8.0, 0.3, True)
        assert all(a == b for a, b, c in zip(whole, want, told) if c != -2)  # a switch may fall anywhere among rows without evidence
        chain, got = units.Chain(s, 8.0, 0.3, True), []
        for part in np.split(np.arange(n), sorted(rnd.integers(0, n + 1, 5))):
            chain.take(values[part], told[part])
            got += list(chain.settle(False))
        early += len(got)
        assert got + list(chain.settle(True)) == list(whole)
    assert early


def test_units_do_not_depend_on_the_width_of_ids(spark):
    """A device's unmarked rows between others, with narrow and with wide ids, read in batches of three rows."""
    grams = [3000.0, 3200, 2900, 3100, 3.1, 3.3, 2.8, 3.0] * 4
    rows = [(i, f"p{k}", "bw", "mass", str(g) + u) for k in range(3) for i, g, u in [(1000 * k + i, g, "" if 0 < i < 31 else " g" if not i else " kg") for i, g in enumerate(grams)]]
    got = []
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for width, batch in ((1, "10000"), (1_000_000, "10000"), (1, "3"), (1_000_000, "3")):
        df = spark.createDataFrame([(i * width, *x) for i, *x in rows], "id long, study string, f string, dim string, v string").withColumn("q", parse_quantity(F.col("v"), F.col("dim")))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            out = units.decode_units(df, ["study"], "id", "f", "dim", "q", F.col("q.unit")).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        got.append(sorted((r.row_id // width, r.unit, r.told) for r in out))
    assert len(got[0]) == len(rows) and got[1] == got[0] and got[2] == got[0] and got[3] == got[0]
    assert [u for i, u, _ in got[0] if i < 8] == ["g"] * 4 + ["kg"] * 4


def test_hot_devices_are_spread_with_the_same_result(spark):
    """One device of most rows, in stretches of about 16 rows, whole and spread over tasks by blocks of ids."""
    grams = [3000.0, 3200, 2900, 3100, 3.1, 3.3, 2.8, 3.0]
    rows = [(i * 7, "hot" if i % 9 else f"s{i % 5}", "bw", "mass", f"{grams[i % 8]}" + (" g" if i % 11 == 0 and i % 8 < 4 else "")) for i in range(900)] + [(7, "hot", "bw", "mass", "3000")] * 2
    df = spark.createDataFrame(rows, "id long, study string, f string, dim string, v string").withColumn("q", parse_quantity(F.col("v"), F.col("dim")))
    run = lambda hot: sorted(map(tuple, units.decode_units(df, ["study"], "id", "f", "dim", "q", F.col("q.unit"), hot_rows=hot, stretch_rows=16).collect()))
    assert run(10**6) == run(50) and len(run(50)) == len(rows)


def test_too_many_columns_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(eav, "MOST_COLUMNS", 3)
    with pytest.raises(ValueError):
        curation.p5_wide(spark, SF)


def test_p6_brute_force(spark):
    """Rows with a plain number and a unit in the text or beside it, against a dictionary of factors."""
    day = {"d": 1, "day": 1, "days": 1, "w": 7, "wk": 7, "wks": 7, "weeks": 7, "week": 7, "mo": 30.4375, "months": 30.4375, "y": 365.25, "yr": 365.25, "yrs": 365.25, "years": 365.25}
    got = {r.attr_id: r.common_value for r in curation.p6_found(spark, SF).collect()}
    a = pd.read_parquet(f"{SF}/sample_attributes_new.parquet")
    n = 0
    for r in a.itertuples():
        m = re.fullmatch(r"(\d+(?:\.\d+)?) ?([a-z]+)", (r.value or "").strip().lower()) if isinstance(r.value, str) else None
        if r.attr_key_norm in ("host_age", "age", "age_in_days", "age_months", "age_years", "infant_age_weeks", "day_of_life") and m and m[2] in day:
            assert got[r.attr_id] == int(float(m[1]) * day[m[2]] + 0.5), r.value
            n += 1
    assert n


def test_sanitise_and_fold_read_every_text(spark):
    """All rows against the standard library, and hand-made texts beyond ASCII and Latin-1."""
    import unicodedata

    from sedimenta.functions import texts
    from sedimenta.plans import texting

    docs = pd.read_parquet(f"{SF}/documents.parquet").dropna(subset=["text"])
    token, number = r"\b[A-Fa-f0-9]{16,}\b|[\w.+-]+@[\w-]+\.[\w.]+", r"\b\d{9,}\b"
    want = sorted((r.doc_id, re.sub(number, "[n]", re.sub(token, "[id]", r.text)).strip(" "), bool(re.search(f"{token}|{number}", r.text))) for r in docs.itertuples())
    assert sorted(tuple(r) for r in texting.sanitise(spark, SF).collect()) == want
    assert any(not t.isascii() for t in docs.text)
    fold = lambda x: "".join(k for k in unicodedata.normalize("NFKD", x) if not unicodedata.combining(k)).lower()
    values = pd.read_parquet(f"{SF}/sample_attributes_new.parquet").dropna(subset=["value"])
    assert sorted(tuple(r) for r in texting.fold_accents(spark, SF).collect()) == sorted((r.attr_id, fold(r.value)) for r in values.itertuples())
    df = spark.createDataFrame([("josé.müller@uni-köln.de ist da", "Việt Nam ﬁn"), (None, None)], "a string, b string")
    assert [tuple(r) for r in df.select(texts.sanitise(F.col("a")), texts.fold(F.col("b"))).collect()] == [("[id] ist da", "viet nam fin"), (None, None)]


def test_told_rows_need_no_decoding(spark, attrs):
    """``p6_found`` runs no stage that decides nothing: its rows are the told ones of the decoded table without the model, odd rows included."""
    found = curation.p6_found(spark, SF)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "Repartition" not in plan
    want = curation.p6_units(spark, SF).where("told").select("row_id", F.round("common").cast("bigint"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    values = ["3 kg", "0 g", "-2 g", "birth", "12 weeks", "98.6 F", "37", "1e400 g", "3-4 kg", "x", None, "3 kg", "1,200 g", "12"]
    rows = [(None if i == 8 else i, ("age", "mass", "temp", None)[k], v) for k in range(4) for i, v in enumerate(values)]
    df = spark.createDataFrame([(i, "p", d or "none", d, v) for i, d, v in rows], "id long, study string, f string, dim string, v string")
    df = df.withColumn("dim", F.when(F.col("dim") == "age", "time").otherwise(F.col("dim"))).withColumn("q", parse_quantity(F.col("v"), F.col("dim")))
    told = units.convert_told(df, "id", "f", "dim", "q", F.col("q.unit"))
    old = units.decode_units(df, ["study"], "id", "f", "dim", "q", F.col("q.unit")).where("told").select("row_id", "field", "unit", "common")
    got = sorted(map(str, told.collect()))
    assert got and got == sorted(map(str, old.collect()))
    assert units.convert_told(df.limit(0), "id", "f", "dim", "q", F.col("q.unit")).count() == 0
