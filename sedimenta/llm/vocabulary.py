"""Freely typed values mapped to a reference list: symmetric-delete lookup, weighted Damerau-Levenshtein, reference frequency."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.characters import plain

#: A list of more entries than this is not broadcast; candidates are then found by a join, with the same result.
MAX_BROADCAST_NAMES = 20_000
# Words that leave the meaning of a longer text to the other words.
NOISE = re.compile(r"\b(?:the|of|a|an|de|la|le|sample|samples|swab|swabs|specimen|cohort)\b")


def normal(text: str) -> str:
    """Lower case without accents; points and apostrophes closed up, other signs as one blank."""
    s = re.sub(r"[.'’`´]", "", plain(text).replace("ß", "ss"))
    return re.sub(r"[^a-z0-9]+", " ", s).strip()


def reach(n: int) -> int:
    """Edits allowed for a name of ``n`` letters."""
    return 0 if n <= 3 else 1 if n <= 5 else 2


def deletes(word: str, most: int) -> set[str]:
    """``word`` with up to ``most`` letters left out."""
    out = {word}
    for k in range(1, most + 1):
        out |= {"".join(c for i, c in enumerate(word) if i not in gone) for gone in combinations(range(len(word)), k)}
    return out


def distance(typed: str, name: str, most: int) -> float | None:
    """Weighted Damerau-Levenshtein distance, or None beyond ``most`` edits.

    Edits count 1; a neighbouring swap, a doubled letter and a lost double 0.7, a blank 0.5, another vowel 0.8, at the first letter 0.6 more;
    a changed digit is never a slip.
    """
    a, b = typed, name
    digits = lambda x: re.sub(r"(\d)\1+", r"\1", re.sub(r"\D", "", x))
    if digits(a) != digits(b):
        return None
    big, n, m = 1e9, len(a), len(b)
    cost = [[(0.0, 0)] + [(big, 99)] * m for _ in range(n + 1)]

    def weigh(c: str, before: str, first: bool) -> float:
        return (0.5 if c == " " else 0.7 if c == before else 1.0) + (0.6 if first else 0.0)

    for i in range(n + 1):
        for j in range(max(0, i - most), min(m, i + most) + 1):
            if i == j == 0:
                continue
            best = (big, 99)
            if i and j:
                w, e = cost[i - 1][j - 1]
                if a[i - 1] == b[j - 1]:
                    best = min(best, (w, e))
                else:
                    s = 0.8 if a[i - 1] in "aeiou" and b[j - 1] in "aeiou" else 1.0
                    best = min(best, (w + s + (0.6 if i == 1 else 0), e + 1))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1] and a[i - 1] != a[i - 2]:
                    w, e = cost[i - 2][j - 2]
                    best = min(best, (w + 0.7, e + 1))
                # A swap with a letter gained or lost between the two.
                if i > 1 and j > 2 and a[i - 1] == b[j - 3] and a[i - 2] == b[j - 1]:
                    w, e = cost[i - 2][j - 3]
                    best = min(best, (w + 1.7, e + 2))
                if i > 2 and j > 1 and a[i - 1] == b[j - 2] and a[i - 3] == b[j - 1]:
                    w, e = cost[i - 3][j - 2]
                    best = min(best, (w + 1.7, e + 2))
            if i:
                w, e = cost[i - 1][j]
                best = min(best, (w + weigh(a[i - 1], a[i - 2] if i > 1 else "", i == 1), e + 1))
            if j:
                w, e = cost[i][j - 1]
                best = min(best, (w + weigh(b[j - 1], b[j - 2] if j > 1 else "", j == 1), e + 1))
            cost[i][j] = best
    w, e = cost[n][m]
    return w if e <= most else None


def names_of(terms: list[tuple], aliases: dict[str, dict[str, str]] | None = None) -> list[tuple[str, str, int, int]]:
    """(vocabulary, normal name, term id, place) of all names of some entries; of equal names the one with the smaller (place, term id) counts.

    Labels, synonyms and codes go before the further names of ``aliases`` (by vocabulary and code, separated by ``|``).
    """
    out = []
    for term_id, vocabulary, code, label, synonyms in terms:
        if vocabulary is None:
            continue
        own = [label, code, *(synonyms or "").split("|")]
        more = (aliases or {}).get(vocabulary, {}).get(code or "", "").split("|")
        out += [(vocabulary, normal(x), int(term_id), place) for place, xs in enumerate((own, more)) for x in xs if x and normal(x)]
    return out


def other_names(others: dict[str, str] | None) -> list[tuple[str, str, int, int]]:
    """Names known to be no entry, as ``names_of`` with term id 0 and the last place."""
    return [(v, normal(x), 0, 2) for v, xs in (others or {}).items() for x in xs.split("|") if normal(x)]


def settled(names: list[tuple[str, str, int, int]]) -> dict[tuple[str, str], int]:
    """(vocabulary, name) -> term id: one entry per name."""
    out: dict[tuple[str, str], int] = {}
    for v, name, term, _ in sorted(names, key=lambda x: (x[3], x[2])):
        out.setdefault((v, name), term)
    return out


def readings(value: str) -> tuple[str, list[str], list[str], str]:
    """What of a value is looked up: the whole, the parts before and after separators, and the whole without noise words."""
    s = normal(value)
    heads = [normal(value.split(sep)[0]) for sep in (":", ",", ";", "(") if sep in value]
    tails = [normal(x) for x in re.split(r"[,;:()]", value)[1:]]
    return s, heads, tails, " ".join(NOISE.sub(" ", s).split())


class Dictionary:
    """The symmetric-delete dictionary: every name with up to its reach of letters left out."""

    def __init__(self, names: dict[tuple[str, str], int], frequency: dict[int, int], longest: int | None = None):
        self.names, self.frequency = names, frequency
        self.by_delete: dict[tuple[str, str], list[str]] = defaultdict(list)
        self.lengths: dict[str, set[int]] = defaultdict(set)
        self.longest = longest if longest is not None else max((len(n) for _, n in names), default=0) + 2  # no longer text is within reach
        for (v, name), term in names.items():
            for d in deletes(name, reach(len(name))) if term else ():  # names of other things count only as written
                self.by_delete[v, d].append(name)
            self.lengths[v].add(len(name.split()))

    def best(self, vocabulary: str, found: list[tuple[float, str]]) -> int | None:
        """The term of the nearest name; the more frequent term, then the smaller id, on a tie."""
        ranked = [(w, -self.frequency.get(t, 0), t) for w, name in found for t in [self.names[vocabulary, name]]]
        return min(ranked)[2] if ranked else None

    def near(self, vocabulary: str, s: str) -> int | None:
        found = {}
        for d in deletes(s, reach(len(s))) if len(s) <= self.longest else ():
            for name in self.by_delete.get((vocabulary, d), ()):
                if name not in found:
                    found[name] = distance(s, name, min(2, reach(len(name)), reach(len(s))))
        return self.best(vocabulary, [(w, name) for name, w in found.items() if w is not None])

    def inside(self, vocabulary: str, s: str) -> int | None:
        """The one entry whose names stand in the text as whole words; longer names hide the shorter ones within them."""
        ws, hits = s.split(), []
        for k in self.lengths.get(vocabulary, ()):
            for i in range(len(ws) - k + 1):
                name = " ".join(ws[i : i + k])
                if (vocabulary, name) in self.names and (k > 1 or len(name) > 2):
                    hits.append((i, i + k, self.names[vocabulary, name]))
        top = [h for h in hits if not any(o != h and o[0] <= h[0] and h[1] <= o[1] and o[1] - o[0] > h[1] - h[0] for o in hits)]
        terms = {t for _, _, t in top}
        return terms.pop() if len(terms) == 1 else 0 if terms else None

    def find(self, vocabulary: str, value: str) -> int:
        """The term id of a typed value, 0 if the list has no entry for it."""
        s, heads, tails, short = readings(value)
        if not s:
            return 0
        for h in (s, *heads):
            if h and (vocabulary, h) in self.names:
                return self.names[vocabulary, h]
        if (got := self.near(vocabulary, s)) is not None:
            return got
        if (got := self.inside(vocabulary, s)) is not None:
            return got
        for h in [*heads, *tails]:
            if h and (got := self.near(vocabulary, h)) is not None:
                return got
        if short and short != s and (got := self.near(vocabulary, short)) is not None:
            return got
        return 0


def map_values(
    rows: DataFrame,
    terms: DataFrame,
    row_id: str,
    vocabulary: str,
    value: str,
    aliases: dict[str, dict[str, str]] | None = None,
    others: dict[str, str] | None = None,
    most_broadcast: int = MAX_BROADCAST_NAMES,
) -> DataFrame:
    """(``row_id``, ``term_id``): every row with the entry of its vocabulary that its value means, 0 where the list has none.

    A symmetric-delete dictionary of all names (labels, synonyms, codes, the caller's ``aliases`` and ``others``, names of things that are no entry)
    finds every name within the bounded edit distance of a value; candidates are ranked by weighted Damerau-Levenshtein distance, then
    by how often their term occurs written exactly in all rows (``frequency``). Values without a near name are searched for one
    listed name among their words. Misses come out as 0 and can be counted.

    Defined results: rows with a null id are left out; rows with a null value or vocabulary give 0, so do empty and very long texts that hold no name; repeated rows are each
    reported; on equal distance and frequency the smaller term id wins; an empty table gives no rows, an empty list only zeros; other
    columns are dropped.

    Scale: the dictionary is broadcast while the list has at most ``most_broadcast`` entries - no exchange of the rows, each distinct value
    of a batch is looked up once. For a longer list the names that can matter to each distinct value are found by a join on
    deletes and word runs, and the same lookup is made among these (``_by_join``): the rows are the same.
    """
    entries = terms.where("term_id is not null and vocabulary is not null").select(F.col("term_id").cast("long").alias("term_id"), "vocabulary", "code", "label", "synonyms")
    key = F.col(row_id).cast("long")
    src = rows.where(key.isNotNull()).select(key.alias("row_id"), F.col(vocabulary).alias("vocabulary"), F.col(value).alias("value"))
    spark = rows.sparkSession
    other = other_names(others)
    if entries.limit(most_broadcast + 1).count() > most_broadcast:
        return _by_join(src, entries, aliases, other).withColumnRenamed("row_id", row_id)
    names = settled([*names_of([tuple(r) for r in entries.collect()], aliases), *other])
    listed = F.broadcast(spark.createDataFrame([(v, n, t) for (v, n), t in names.items()] or [("", "", 0)], "vocabulary string, n2 string, t long"))
    freq = _written(src).join(listed, ["vocabulary", "n2"]).groupBy("t").agg(F.sum("c").alias("c"))
    shared = spark.sparkContext.broadcast((names, {r.t: r.c for r in freq.collect()}))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d = Dictionary(*shared.value)
        memo: dict[tuple, int] = {}
        for pdf in batches:
            out = []
            for key in zip(pdf["vocabulary"], pdf["value"]):
                if key not in memo:
                    if len(memo) > 500_000:
                        memo.clear()
                    memo[key] = 0 if key[0] is None or key[1] is None else d.find(*key)
                out.append(memo[key])
            yield pd.DataFrame({"row_id": pdf["row_id"], "term_id": np.array(out, dtype=np.int64)})

    return src.mapInPandas(find, "row_id long, term_id long").withColumnRenamed("row_id", row_id)


def _written(src: DataFrame) -> DataFrame:
    """(vocabulary, n2, c): how often each value occurs as written, but for case and signs; counted before anything is joined."""
    squeezed = F.trim(F.regexp_replace(F.regexp_replace(F.lower("value"), "[.'’]", ""), r"[^a-z0-9]+", " "))
    return src.where("value is not null").groupBy("vocabulary", squeezed.alias("n2")).agg(F.count(F.lit(1)).alias("c"))


def _by_join(src: DataFrame, entries: DataFrame, aliases: dict | None, other: list[tuple[str, str, int, int]]) -> DataFrame:
    """The same lookup for lists too long to broadcast.

    A name can matter to a value only if it shares a delete with one of the value's readings or stands in the value as a run of whole words. Names
    and distinct values are exploded into these keys and joined by them, spread by (vocabulary, key); each value then looks among its own few names.
    """
    spark = src.sparkSession

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(names_of([tuple(r) for r in pdf.itertuples(index=False)], aliases), columns=["vocabulary", "name", "term_id", "place"])

    kind = "vocabulary string, name string, term_id long, place int"
    every = entries.mapInPandas(listed, kind)
    every = every.unionByName(spark.createDataFrame(other, kind)) if other else every
    names = every.groupBy("vocabulary", "name").agg(F.min_by("term_id", F.struct("place", "term_id")).alias("term_id"))
    longest, words = names.agg(F.max(F.length("name")), F.max(F.size(F.split("name", " ")))).first()
    longest, words = (longest or 0) + 2, words or 0

    def keys(of_names: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for v, x in zip(pdf["vocabulary"], pdf["x"]):
                    if of_names:
                        found = {f"d {d}" for d in deletes(x, reach(len(x)))} | {f"w {x}"}
                    else:
                        s, heads, tails, short = readings(x)
                        found = {f"d {d}" for r in {s, *heads, *tails, short} if r and len(r) <= longest for d in deletes(r, reach(len(r)))}
                        ws = s.split()
                        found |= {f"w {' '.join(ws[i : i + k])}" for k in range(1, words + 1) for i in range(len(ws) - k + 1)}
                        found |= {f"w {h}" for h in heads}
                    yield pd.DataFrame({"vocabulary": v, "k": list(found), "x": x})

        return run

    values = src.where("value is not null and vocabulary is not null").select("vocabulary", F.col("value").alias("x")).distinct()
    shape = "vocabulary string, k string, x string"
    n = names.select("vocabulary", F.col("name").alias("x")).mapInPandas(keys(True), shape).withColumnRenamed("x", "name")
    pairs = values.mapInPandas(keys(False), shape).join(n, ["vocabulary", "k"]).select("vocabulary", "x", "name").distinct()
    known = names.join(_written(src).withColumnRenamed("n2", "name"), ["vocabulary", "name"], "left")
    frequency = known.groupBy("term_id").agg(F.sum("c").alias("f"))
    named = pairs.join(names, ["vocabulary", "name"]).join(frequency, "term_id", "left")
    # As many names as lie within two edits of a value or stand in it.
    own = named.groupBy("vocabulary", "x").agg(F.collect_list(F.struct("name", "term_id", F.coalesce("f", F.lit(0)).alias("f"))).alias("names"))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for v, x, ns in zip(pdf["vocabulary"], pdf["x"], pdf["names"]):
                d = Dictionary({(v, r["name"]): r["term_id"] for r in ns}, {r["term_id"]: r["f"] for r in ns}, longest)
                out.append(d.find(v, x))
            yield pd.DataFrame({"vocabulary": pdf["vocabulary"], "x": pdf["x"], "term_id": np.array(out, dtype=np.int64)})

    best = own.mapInPandas(find, "vocabulary string, x string, term_id long").where("term_id <> 0").withColumnsRenamed({"vocabulary": "v", "x": "value2"})
    salted = best.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(15))))  # a hot value is shared out to 16 tasks
    left = src.withColumn("z2", F.pmod(F.xxhash64("row_id"), F.lit(16)).cast("int"))
    j = left.join(salted, (F.col("vocabulary") == F.col("v")) & (F.col("value") == F.col("value2")) & (F.col("z") == F.col("z2")), "left")
    return j.select("row_id", F.coalesce("term_id", F.lit(0)).alias("term_id"))
