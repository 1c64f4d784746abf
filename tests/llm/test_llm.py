"""The training-data operators: hand-made cases, brute force, round trips, held-out accuracy, edge cases."""

import random
import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent.parent))
import compare  # noqa: E402

from sedimenta.llm import golden, leakage, packing, queries, toxicity, vocabulary  # noqa: E402
from sedimenta.llm.aliases import ALIASES, OTHERS  # noqa: E402
from sedimenta.llm.characters import plain, words  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), queries.SQL[name], compare.connect(SF)) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


# Golden records

G = "id long, g string, f string, v string, r int, conf double, note string, cur boolean, extra string"


def gold(spark, rows):
    df = spark.createDataFrame(rows, G)
    out = golden.golden_records(df, ["g", "f"], "f", "v", "r", [-F.coalesce("conf", F.lit(-1.0))], "id", F.col("cur"), ["note", "conf"])
    return {(r.g, r.f): (r.id, r.note, r.conf, r.group_rows) for r in out.collect()}


def test_golden_order_and_gaps(spark):
    rows = [
        (1, "a", "x", "1", 1, 0.9, None, True, ""), (2, "a", "x", "2", 2, 0.9, " ", True, ""), (3, "a", "x", "3", 2, 0.5, "n3", True, ""),
        (4, "b", "x", "1", 1, None, None, True, ""), (5, "b", "x", "1", 1, None, None, True, ""), (5, "b", "x", "1", 1, None, None, True, ""),
        (6, "c", "x", "1", 1, 0.9, "n", True, ""), (7, "d", "x", "1", 1, 0.9, "n", True, ""), (8, "d", "x", "1", 1, 0.9, "n", False, ""),
        (9, None, "x", "1", 1, 0.9, "n", True, ""),
    ]
    assert gold(spark, rows) == {("a", "x"): (2, "n3", 0.9, 3), ("b", "x"): (4, None, None, 3)}
    assert gold(spark, rows[:0]) == {}


def test_currency_places_rows_without_stamps(spark):
    """Elsewhere ``old`` is always followed by ``new``; where the stamps are missing the later value survives."""
    rows = [(i * 2 + k, f"t{i}", "x", v, r, 0.5, None, True, "") for i in range(8) for k, (v, r) in enumerate([("old", 1), ("new", 2)])]
    rows += [(100, "u", "x", "old", None, 0.5, None, True, ""), (101, "u", "x", "new", None, 0.5, None, True, "")]
    got = gold(spark, rows)
    assert got["u", "x"][0] == 101
    p = golden.learn_transitions(spark.createDataFrame(rows, G), ["g", "f"], "f", "v", "r").collect()
    assert [(r.attribute, r.earlier, r.later) for r in p] == [("x", "old", "new")]


def test_currency_on_hidden_stamps(spark):
    """A planted order with a tenth of the stamps wrong is learned and decides held groups; values without an order decide none."""
    rnd = random.Random(11)
    rows, n = [], 0
    for i in range(400):
        values = ["draft", "checked", "curated"]
        for r, v in enumerate(values if rnd.random() > 0.1 else values[::-1]):
            rows.append((n := n + 1, f"g{i}", "state", v, r, 0.5, None, True, ""))
        for r, v in enumerate(rnd.sample(["red", "green", "blue"], 3)):
            rows.append((n := n + 1, f"g{i}", "colour", v, r, 0.5, None, True, ""))
    df = spark.createDataFrame(rows, G)
    got = {r.f: r for r in golden.currency_score(df, ["g", "f"], "f", "v", "r", F.pmod(F.xxhash64("g"), F.lit(4)) == 0).collect()}
    assert got["state"].decided == got["state"].groups > 50 and got["state"].right >= 0.8 * got["state"].groups
    assert got["colour"].decided <= 0.1 * got["colour"].groups
    assert golden.currency_score(df.limit(0), ["g", "f"], "f", "v", "r", F.lit(True)).count() == 0


# Values to a list

TERMS = [(1, "country", "US", "United States of America", "USA|United States"), (2, "country", "AU", "Australia", None), (3, "country", "NG", "Nigeria", None), (4, "sex", "female", "Female", "F"), (5, "sex", "male", "Male", "M")]


def test_vocabulary(spark):
    rows = [("country", "Untied States", 1), ("country", "U.S.A.", 1), ("country", "austrlia", 2), ("country", "Austria", 0), ("country", "Niger", 0), ("country", "Nigéria", 3), ("country", "USA: Ohio", 1),
            ("sex", "femlae", 4), ("sex", "f", 4), ("sex", "weiblich", 4), ("sex", "code 9", 0), ("sex", None, 0), (None, "f", 0), ("sex", "", 0), ("sex", "z" * 40_000, 0), ("planet", "Mars", 0)]
    df = spark.createDataFrame([(i, v, x, w, "e") for i, (v, x, w) in enumerate(rows)], "id long, voc string, val string, want long, term_id string")
    terms = spark.createDataFrame(TERMS, "term_id long, vocabulary string, code string, label string, synonyms string")
    got = {r.id: r.term_id for r in vocabulary.map_values(df, terms, "id", "voc", "val", ALIASES, OTHERS).collect()}
    assert got == {i: w for i, (_, _, w) in enumerate(rows)}
    assert vocabulary.map_values(df.limit(0), terms, "id", "voc", "val").count() == 0
    assert {r.term_id for r in vocabulary.map_values(df, terms.limit(0), "id", "voc", "val").collect()} <= {0}


def test_symmetric_delete_finds_every_name_in_reach():
    """Against a scan of all names."""
    rnd = random.Random(1)
    names = {("v", "".join(rnd.choice("abcdef") for _ in range(rnd.randint(3, 9)))): i + 1 for i in range(150)}
    d = vocabulary.Dictionary(names, {})
    for _ in range(300):
        w = list(rnd.choice(list(names))[1])
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = rnd.choice("abcdef")
        s = "".join(w)
        scan = {n: vocabulary.distance(s, n, min(2, vocabulary.reach(len(n)), vocabulary.reach(len(s)))) for _, n in names}
        scan = {n: x for n, x in scan.items() if x is not None}
        best = min(scan.values(), default=None)
        got = d.near("v", s)
        assert (got is None) == (best is None)
        if got is not None:
            assert scan[next(n for (_, n), t in names.items() if t == got)] == best


def test_join_equals_broadcast(spark):
    """The whole small tables through both lookups, and the hand-made cases."""
    d = "/root/testdata/sf0.01"
    rows, terms = queries._vocabulary_rows(spark, d), spark.read.parquet(f"{d}/vocab_terms.parquet")
    for lists in ((ALIASES, OTHERS), (None, None)):
        a, b = [sorted(map(tuple, vocabulary.map_values(rows, terms, "attr_id", "field_name", "value", *lists, n).collect())) for n in (20_000, 0)]
        assert a == b and len(a) > 1000
    df = spark.createDataFrame([(1, "sex", "femlae"), (2, "sex", "Male"), (3, "country", "austrlia"), (4, "country", "Atlantis"), (5, None, "x"), (6, "sex", None), (7, "sex", "x " * 9000)], "row_id long, vocabulary string, value string")
    terms = spark.createDataFrame(TERMS, "term_id long, vocabulary string, code string, label string, synonyms string")
    got = {r.row_id: r.term_id for r in vocabulary.map_values(df, terms, "row_id", "vocabulary", "value", most_broadcast=0).collect()}
    assert got == {1: 4, 2: 5, 3: 2, 4: 0, 5: 0, 6: 0, 7: 0}


def test_agreement_without_further_names(spark):
    """What the reference list alone finds, held against the result with the further names: hardly ever another entry."""
    d = "/root/testdata/sf0.01"
    a, b = [{r.attr_id: r.term_id for r in queries.QUERIES[q](spark, d).collect()} for q in ("p7_found", "p7_unaided")]
    same = sum(a[k] == b[k] for k in a) / len(a)
    other = sum(b[k] not in (0, a[k]) for k in a) / len(a)
    assert same > 0.8 and other < 0.03, (same, other)


# Packing


def test_histogram_packing_round_trip():
    rnd = random.Random(2)
    for capacity in (1, 7, 100, 2048):
        h = Counter(rnd.randint(1, capacity) for _ in range(500))
        packed = Counter()
        for n, pattern in packing.pack_histogram(h, capacity):
            assert n > 0 and sum(k * v for k, v in pattern.items()) <= capacity
            packed.update({k: v * n for k, v in pattern.items()})
        assert packed == h
    assert packing.pack_histogram({}, 5) == []


def test_histogram_of_long_containers_is_quick():
    """The driver's part at 131,072 tokens and 10 million items: a few seconds, nothing lost, hardly any room left."""
    rnd = random.Random(5)
    cap = 131_072
    h = Counter(min(cap, int(rnd.lognormvariate(7, 1.3)) + 1) for _ in range(200_000))
    h = {k: v * 50 for k, v in h.items()}
    began = time.time()
    packed, n = Counter(), 0
    for count, pattern in packing.pack_histogram(h, cap):
        assert sum(k * v for k, v in pattern.items()) <= cap
        packed.update({k: v * count for k, v in pattern.items()})
        n += count
    assert time.time() - began < 20
    assert packed == h and sum(k * v for k, v in h.items()) / (n * cap) > 0.999


def test_packing_of_rows(spark):
    sizes = [0, None, 1, 5, 5, 5, 5, 10, 11, 25, 25, 3] + [2] * 40
    df = spark.createDataFrame([(i % 50, s, "x") for i, s in enumerate(sizes)], "id long, n long, container string")
    rows = packing.pack(df, "id", F.col("n"), 10).collect()
    used = Counter()
    for r in rows:
        used[r.container] += r.length
    assert all(v <= 10 for c, v in used.items() if c >= 0)
    assert sum(r.length for r in rows) == sum(s or 0 for s in sizes)
    assert sorted({r.id for r in rows if r.split}) == [8, 9, 10]
    whole = Counter(r.id for r in rows if not r.split)
    assert whole == Counter(i % 50 for i, s in enumerate(sizes) if not s or s <= 10)
    assert packing.pack(df.limit(0), "id", F.col("n"), 10).count() == 0


def test_fill_is_high(spark):
    for r in queries.p8_fill(spark, "/root/testdata/sf0.01").collect():
        assert r.fill > 0.97, r


# Leakage


def altered(rnd, ws, kind):
    ws = list(ws)
    if kind == "upper":
        return " ".join(ws).upper()
    if kind == "marks":
        return " ".join(w + (f" [{i}]" if i % 6 == 0 else "") for i, w in enumerate(ws))
    if kind == "markup":
        return " ".join(f"<b>{w}</b>" if i % 5 == 0 else f"*{w}*" if i % 7 == 0 else w for i, w in enumerate(ws))
    if kind == "wrapped":
        return " ".join(w if len(w) < 8 or i % 9 else f"{w[:4]}-\n{w[4:]}" for i, w in enumerate(ws))
    if kind == "look":
        return " ".join(ws).replace("e", "е").replace("o", "о")
    for at in range(4, len(ws), 10):
        ws[at] = rnd.choice(["again", "changed", ""])
    return " ".join(ws)


def test_leaks_planted_and_near_misses():
    rnd = random.Random(3)
    lex = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + i % 7)}" for i in range(400)]
    sent = lambda n: " ".join(rnd.choice(lex) for _ in range(n)) + "."
    stock = "Written informed consent was obtained from all participants in this work."
    items = [(i, f"{sent(24)} {stock} {sent(18)}") for i in range(30)]
    index = leakage.build_index(items)
    docs, want = [], set()
    for kind in ("plain", "upper", "marks", "markup", "wrapped", "look", "noise"):
        for i in range(5):
            part = index_words(items[i][1])[:22]
            body = " ".join(part) if kind == "plain" else altered(rnd, part, kind)
            want.add((len(docs), i))
            docs.append(f"{sent(30)} {body} {sent(30)}")
    for i in range(5):  # too short, stock only, unrelated
        docs.append(f"{sent(20)} {' '.join(index_words(items[i][1])[:12])} {sent(20)}")
        docs.append(f"{sent(20)} {stock} {sent(20)}")
        docs.append(sent(60))
    docs += ["", "   ", sent(15_000)]
    got = {(r, i) for r, i, k in leakage.search(pd.Series(docs), index) if k == "passage"}
    assert got == want


def index_words(text):
    return text.replace(".", "").split()


def test_reparameterised_question():
    rnd = random.Random(4)
    base = "the cultures were held at {} hours under {} millibar with {} grams of substrate and {} percent of gas then {} cycles followed by {} minutes of rest in {} days"
    one = base.format(*[rnd.randint(10, 99) for _ in range(7)])
    other = base.format(*[rnd.randint(100, 999) for _ in range(7)])
    got = leakage.search(pd.Series([other, one]), leakage.build_index([(7, one)]))
    assert sorted(got) == [(0, 0, "reparameterised"), (1, 0, "passage")]


def test_passage_against_edit_distance():
    """The vectorised programme against a plain one over all pairs of windows."""
    rnd = random.Random(6)

    def slow(item, doc, length, edits):
        for i in range(len(item) - length + 1):
            a = item[i : i + length]
            for x in range(len(doc)):
                for y in range(x + length - edits, min(len(doc), x + length + edits) + 1):
                    b = doc[x:y]
                    if not b or a[0] != b[0] or a[-1] != b[-1]:
                        continue
                    row = list(range(len(b) + 1))
                    for p, wa in enumerate(a, 1):
                        new = [p]
                        for q, wb in enumerate(b, 1):
                            new.append(min(row[q] + 1, new[-1] + 1, row[q - 1] + (wa != wb)))
                        row = new
                    if row[-1] <= edits:
                        return True
        return False

    found = 0
    for _ in range(60):
        item = [rnd.choice("abcd") for _ in range(20)]
        doc = item[3:19]
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(doc))
            doc[at : at + rnd.randint(0, 1)] = rnd.choice([[], ["x"], ["a"]])
        doc = ["z"] * 3 + doc + ["z"] * 3
        want = slow(item, doc, 16, 2)
        assert leakage.passage(item, doc) == want
        found += want
    assert 5 < found < 60


def test_leaks_of_frames(spark):
    items = spark.createDataFrame([(1, " ".join(f"unique{chr(97 + i)}" for i in range(25))), (2, None)], "item_id long, text string")
    docs = spark.createDataFrame([(10, "Before. " + " ".join(f"unique{chr(97 + i)}" for i in range(25)), 1), (11, None, 1), (None, "", 1)], "doc_id long, text string, item_id int")
    out = leakage.find_leaks(docs, items, "doc_id", "text", "item_id", "text").collect()
    assert [tuple(r) for r in out] == [(10, 1, "passage")]
    assert leakage.find_leaks(docs, items.limit(0), "doc_id", "text", "item_id", "text").count() == 0
    assert leakage.find_leaks(docs.limit(0), items, "doc_id", "text", "item_id", "text").count() == 0


def test_leaks_of_copies_and_both_joins(spark):
    """Copies of an item are no stock sentences, a sentence of three different items is one; the broadcast and the exchange give the same rows."""
    rnd = random.Random(8)
    sent = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(n)) + "."
    one, stock = f"{sent(20)} {sent(20)}", sent(20)
    texts = [one, one + " ", one.upper()] + [f"{sent(20)} {stock} {sent(20)}" for _ in range(3)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(10, f"{sent(9)} {one.split('.')[0]}. {sent(9)}"), (11, f"{sent(9)} {stock} {sent(9)}"), (10, "")], "doc_id long, text string")
    for most in (leakage.BROADCAST_WORDS, 0):
        out = leakage.find_leaks(docs, items, "doc_id", "text", "item_id", "text", most).collect()
        assert sorted((r.doc_id, r.item_id, r.kind) for r in out) == [(10, i, "passage") for i in range(3)]


def test_exchange_equals_broadcast_on_the_tables(spark):
    """All rows of the small tables through both joins."""
    docs, items = [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "eval_items")]
    a, b = [sorted(map(tuple, leakage.find_leaks(docs, items, "doc_id", "text", "item_id", "text", n).collect())) for n in (leakage.BROADCAST_WORDS, 0)]
    assert a == b and len(a) > 20


def test_no_passage_is_lost_whatever_the_edits():
    """Brute force over edit positions: every three changes in 24 words and every two in 16, also drops and insertions beside numbers and units."""
    from itertools import combinations

    for length, edits in ((16, 2), (24, 3)):
        ws = [f"w{chr(97 + i)}x" for i in range(length)]
        ws[5], ws[6], ws[11], ws[12] = "14", "weeks", "3", "mg"
        index = leakage.build_index([(1, " ".join(ws))])
        docs = []
        for at in combinations(range(1, length - 1), edits):
            docs.append(" ".join("zz" if i in at else w for i, w in enumerate(ws)))
            docs.append(" ".join(w for i, w in enumerate(ws) if i not in at))
            docs.append(" ".join(f"{w} qq" if i in at else w for i, w in enumerate(ws)))
        got = leakage.search(pd.Series(docs), index)
        assert {r for r, _, k in got if k == "passage"} == set(range(len(docs)))


def test_items_with_other_parameters_are_recognised(spark):
    """Recall of re-parameterised items over the whole evaluation set."""
    rows = queries.p9_reparameterised(spark, "/root/testdata/sf0.01").collect()
    assert sum(r.kind is not None for r in rows) >= 0.9 * len(rows) > 0
    assert any(r.kind == "reparameterised" for r in rows)


def test_words():
    assert words("The <b>Re-\n acquired</b> ﬁbre, [3] at 3.5 mg &amp; more") == ["the", "reacquired", "fibre", "at", "35", "mg", "more"]
    assert words(None) == [] and plain("Ünïcode ＡＢ") == "unicode ab"


# Toxicity


def test_hidden_words_are_read():
    for text in ("you are an asshole", "you are an a*****e", "you are an a s s h o l e", "you are an assssshole", "you are an аsshоlе", "you are an @$$hole", "you are an a​s​s​h​ole"):
        assert "asshole" in {t for s in toxicity.sentences(text) for t in s[0]}, text


def test_isotonic_is_monotone_and_pools():
    k, v = toxicity.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert (np.diff(v) >= 0).all() and abs(v[2] - 0.5) < 1e-9


def test_held_out_accuracy(spark):
    """Fitted on half of the reviewed documents, tested on the other half; labels are noisy, so perfection is impossible."""
    docs = dict(pd.read_parquet("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"]).itertuples(index=False))
    v = pd.read_parquet("/root/testdata/sf0.1/doc_reviews.parquet").dropna(subset=["toxic"]).groupby("doc_id").toxic.agg(["mean", "count"])
    ids = [i for i in v.index if docs.get(i)]
    random.Random(0).shuffle(ids)
    cut = len(ids) * 2 // 3
    train, test = ids[:cut], ids[cut:]
    model, lexicon = toxicity.fit([docs[i] for i in train], v.loc[train, "mean"].to_numpy(), np.sqrt(v.loc[train, "count"].to_numpy(float)))
    score = model.score(np.array([toxicity.features(docs[i], lexicon) for i in test]))
    y, p = v.loc[test, "mean"].to_numpy() >= 0.5, score >= 0.5
    assert (p == y).mean() > 0.9
    assert (p & y).sum() / max(1, p.sum()) > 0.8


def test_scoring_of_frames(spark):
    docs = spark.createDataFrame([(1, "You are a stupid idiot.", "a", 9), (2, "Nice work.", "a", 9), (3, None, None, 9), (4, "", "b", 9), (5, "x" * 50_000, "b", 9)], "doc_id long, text string, source string, score int")
    rev = spark.createDataFrame([(1, "r", 1), (1, "q", None), (2, "r", 0), (None, "r", 1)], "doc_id long, reviewer string, toxic int")
    assert toxicity.score_documents(docs, rev).count() == 5
    assert {r.score for r in toxicity.score_documents(docs, rev.limit(0)).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), rev).count() == 0


def test_reader_gives_the_features_of_each_text():
    """All texts of the small tables and odd ones, read together and one by one, with a lexicon of words and pairs."""
    texts = [None, "", "  \n ", "!!!", "a b a b. A b!", "you are an a*****e 你好世界！", "x" * 30_000, "word " * 5_000, *pd.read_parquet("/root/testdata/sf0.01/documents.parquet").text.head(400)]
    seen = Counter(g for t in texts[:200] for s in toxicity.sentences(t or "") for g in toxicity.grams(s[0]))
    lexicon = {g: random.Random(str(g)).uniform(-2, 4) for g, n in seen.items() if n > 1}
    one = np.array([toxicity.features(t, lexicon) for t in texts])
    assert np.allclose(toxicity.Reader(lexicon).features(texts), one)
    assert np.allclose(toxicity.Reader({}).features(texts), [toxicity.features(t, {}) for t in texts])
    assert toxicity.Reader({}).features([]).shape == (0, len(toxicity.NAMES))


def test_other_scripts_are_read(spark):
    """Words of scripts without lexicons are learned from labels; unspaced scripts are read as pairs of signs; a repeated id takes one text."""
    assert [t for s in toxicity.sentences("Дщюж бизнес. 你好世界！") for t in s[0]][-3:] == ["你好", "好世", "世界"]
    assert toxicity.sentences("Дщюж")[0][0] != []
    bad, good = "Щэфж дюъл вас.", "Здесь щю фёдор и лодка."
    docs = spark.createDataFrame([(i, (bad if i % 2 else good) + f" {i}", "s") for i in range(200)] + [(1, "zz", "s")], "doc_id long, text string, source string")
    rev = spark.createDataFrame([(i, "r", i % 2) for i in range(160)], "doc_id long, reviewer string, toxic int")
    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, rev).where("doc_id >= 160").collect()}
    assert all((v >= 0.5) == bool(i % 2) for i, v in score.items())


def test_every_label_is_learned_from(spark):
    """Abuse in words of no lexicon, told only by labels beyond the first 6,000 in the order of a hash."""
    ids = [r.id for r in spark.range(6_600).orderBy(F.xxhash64("id"), "id").collect()]
    tail = lambda at: f"{chr(97 + at % 26)}{chr(97 + at // 26 % 26)}x"
    rows = []
    for at, i in enumerate(ids):
        late, listed = at >= 6_000 and at % 2, at < 6_000 and at % 20 == 0
        text = f"Dein Zorvex {tail(at)} quith!" if late else f"You are a stupid idiot {tail(at)}." if listed else f"Alle Boote fahren {tail(at)} nach Norden."
        rows.append((i, text, int(late or listed)))
    new = [(20_000, "Dein Zorvex kkk quith!"), (20_001, "Alle Boote fahren kkk nach Norden.")]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(i, t, "s") for i, t in new], "doc_id long, text string, source string")
    rev = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, rev).where("doc_id >= 20000").collect()}
    assert score[20_000] >= 0.5 and score[20_001] < 0.5
