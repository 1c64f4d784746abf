"""Text operators as built-in expressions: vocabularies with negatives, normal forms, quotes, mining, name parsing."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.keys import folded

# Accession patterns by kind.
ACCESSIONS = {
    "study": r"\b(?:PRJ[A-Z]{2}\d+|[ESD]RP\d{5,})\b",
    "sample": r"\b(?:SAM[A-Z]{2}\d+|[ESD]RS\d{5,})\b",
    "run": r"\b[ESD]RR\d{5,}\b",
    "experiment": r"\b[ESD]RX\d{5,}\b",
    "doi": r"\b10\.\d{4,9}/[-._;()/:a-zA-Z0-9]+\b",
    "pubmed": r"\bPMID:? ?\d{5,9}\b",
}
# Words that deny what follows them.
NEGATORS = "no|not|without|never|non|free of|absence of|denies|negative for"


def term_regex(term: str) -> str:
    """A vocabulary term as a pattern: ``stem*``, a whole word with optional plural, a phrase over blanks or hyphens; short acronyms keep case."""
    if term.endswith("*"):
        return r"\b" + re.escape(term[:-1]) + r"\w*"
    body = r"[\s-]+".join(re.escape(w) for w in term.split())
    if term.isupper() and len(term) <= 4:
        return rf"\b{body}\b"
    return rf"(?i:\b{body}s?\b)"


def has_term(text: Column, terms: list[str], negatives: list[str] | None = None) -> Column:
    """Whether a term occurs outside all negative phrases (which are blanked first)."""
    t = text
    if negatives:
        t = F.regexp_replace(t, "|".join(term_regex(n) for n in negatives), " ")
    return F.coalesce(t.rlike("|".join(term_regex(x) for x in terms)), F.lit(False))


def affirmed(text: Column, terms: list[str]) -> Column:
    """Whether a term occurs that no negator precedes within three words."""
    body = "|".join(term_regex(x) for x in terms)
    denied = rf"(?i:\b(?:{NEGATORS})\b(?:\W+\w+){{0,2}}?\W+)(?:{body})|(?:{body})(?i:[\s-]free\b)"
    return F.coalesce(F.regexp_replace(text, denied, " ").rlike(body), F.lit(False))


def found_terms(text: Column, pattern: str) -> Column:
    """Sorted distinct lower-case matches."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)), F.lower)))


def quote_around(text: Column, pattern: str, words: int = 3, most: int = 12) -> Column:
    """The first match with up to ``words`` words on either side, at most ``most`` words."""
    q = F.regexp_extract(text, rf"((?:\S+\s+){{0,{words}}}\S*(?:{pattern})\S*(?:\s+\S+){{0,{words}}})", 1)
    return F.array_join(F.slice(F.split(F.trim(q), r"\s+"), 1, most), " ")


def split_multi(c: Column) -> Column:
    """A list from `` | `` or ``;`` text, JSON object keys or a JSON array; distinct, blanks dropped, order kept."""
    s = F.trim(c)
    parts = (
        F.when(s.startswith("{"), F.json_object_keys(s))
        .when(s.startswith("["), F.from_json(s, "array<string>"))
        .otherwise(F.split(s, r"\s*(?:\||;)\s*"))
    )
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))


def split_prefix(c: Column) -> Column:
    """The part before the first colon."""
    return F.trim(F.substring_index(c, ":", 1))


def stem(c: Column) -> Column:
    """Digits to ``#``, the first twelve characters."""
    return F.substring(F.regexp_replace(c, r"\d+", "#"), 1, 12)


def clip(c: Column, n: int) -> Column:
    """White space squeezed; cut to ``n`` characters with an ellipsis."""
    s = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(s) > n, F.concat(F.rtrim(F.substring(s, 1, n - 1)), F.lit("…"))).otherwise(s)


def mine_accessions(text: Column) -> dict[str, Column]:
    """Per kind the sorted distinct accessions of a text, upper case, joined."""
    found = lambda p: F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), F.upper)))
    return {k: F.array_join(found(p), ";") for k, p in ACCESSIONS.items()}


def kind_of(c: Column) -> Column:
    """The kind of an identifier by full match."""
    s, out = F.trim(c), F.lit("other")
    for k, p in reversed(list(ACCESSIONS.items())):
        body = p.replace(r"\b", "")
        out = F.when(s.rlike(f"^(?:{body})$"), k).otherwise(out)
    return out


def yes_no(c: Column) -> Column:
    """Flag text to true, false or null; "within n days" affirms."""
    s = F.lower(F.trim(c))
    yes = s.isin("yes", "y", "true", "1", "t", "positive", "present", "ja", "oui", "si") | s.rlike(r"^within \d+ (?:day|week|month)s?")
    return F.when(yes, True).when(s.isin("no", "n", "false", "0", "f", "negative", "absent", "nein", "non", "never"), False)


#: Session-like tokens and e-mail addresses, and long numbers, with letters and digits of every script.
TOKENS, LONG_NUMBERS = r"(?U)\b[A-Fa-f0-9]{16,}\b|[\w.+-]+@[\w-]+\.[\w.]+", r"(?U)\b\d{9,}\b"


def sanitise(c: Column) -> Column:
    """Session-like tokens, e-mail addresses and long numbers blanked."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, TOKENS, "[id]"), LONG_NUMBERS, "[n]"))


def fold(c: Column) -> Column:
    """Lower-case text without combining marks, compatibility forms resolved; null for null."""

    @F.pandas_udf("string")
    def folded(v: pd.Series) -> pd.Series:
        plain = lambda x: "".join(k for k in unicodedata.normalize("NFKD", x) if not unicodedata.combining(k)).lower()
        return v.map(plain, na_action="ignore")

    return folded(c)


def url_template(base: str, title: Column, body: Column) -> Column:
    """A prefilled link, parts percent-encoded."""
    enc = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return F.concat(F.lit(f"{base}?title="), enc(title), F.lit("&body="), enc(body))


def parse_name(c: Column) -> dict[str, Column]:
    """Subject ordinal, time point and age of a sample name."""
    s = F.lower(c)
    subject = F.regexp_extract(s, r"(?:subj(?:ect)?|infant|baby|patient|inf|p|s)[ _.#-]?0*(\d{1,5})", 1)
    rest = F.regexp_replace(s, r"(?:subj(?:ect)?|infant|baby|patient|inf|p|s)[ _.#-]?0*\d{1,5}", " ")
    age = F.regexp_extract(rest, r"(?:day|d|week|wk|w|month|mo|m)[ _.-]?(\d{1,4})\b", 1)
    unit = F.regexp_extract(rest, r"\b(day|week|month)", 1)
    return {
        "subject_no": F.when(subject != "", subject).try_cast("int"),
        "timepoint": F.when(F.regexp_extract(rest, r"\b(?:t|visit|v)[ _.-]?(\d{1,3})\b", 1) != "", F.regexp_extract(rest, r"\b(?:t|visit|v)[ _.-]?(\d{1,3})\b", 1)).try_cast("int"),
        "age_n": F.when((age != "") & (unit != ""), age).try_cast("int"),
        "age_unit": F.when(unit != "", unit),
        "maternal": s.rlike(r"mother|maternal|mom\b|mum\b"),
    }


def lineage_parts(c: Column, sep: str = "; ") -> dict[str, Column]:
    """Last token, parent and depth of a lineage."""
    parts = F.split(c, sep)
    return {"leaf": F.element_at(parts, -1), "parent": F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), sep), "depth": F.size(parts)}


def has_code(c: Column, code: str) -> Column:
    """Whether a ``;`` list holds a code."""
    return F.coalesce(F.array_contains(F.transform(F.split(c, ";"), lambda x: F.trim(x)), code), F.lit(False))


def lint(stmt: Column, rules: dict[str, str]) -> Column:
    """Names of the rules whose pattern a statement matches."""
    return F.array_compact(F.array(*[F.when(stmt.rlike(p), F.lit(n)) for n, p in rules.items()]))


def ladder(steps: list[tuple[Column, str]], default: str | None) -> Column:
    """The value of the first condition that holds; null conditions do not."""
    out = F.lit(default)
    for cond, value in reversed(steps):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(value)).otherwise(out)
    return out


def first_message(checks: list[tuple[Column, str]]) -> Column:
    """The message of the first failing check, null if all hold; a null check fails."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(m)) for ok, m in checks])


def json_append(c: Column, source: Column, quote: Column) -> Column:
    """A JSON list of evidence with one object more."""
    kind = "array<struct<source:string,quote:string>>"
    old = F.coalesce(F.from_json(c, kind), F.array().cast(kind))
    return F.to_json(F.concat(old, F.array(F.struct(source.alias("source"), quote.alias("quote")))))


def list_add(arr: Column, code: Column) -> Column:
    """A code added to a list without ``unknown`` members, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.concat(F.filter(arr, lambda x: ~x.startswith("unknown")), F.array(code))))


def differs(kind: str, a: Column, b: Column) -> Column:
    """Whether two values differ beyond the tolerance of their kind."""
    gap = F.abs(a - b) if kind in ("age", "gestation", "weight") else None
    if kind == "age":
        return gap > F.greatest(F.lit(7.0), F.greatest(a, b) * 0.1)
    if kind == "gestation":
        return gap > 1
    if kind == "weight":
        return gap > 250
    return F.lower(F.trim(a)) != F.lower(F.trim(b))


def number(c: Column) -> Column:
    """A text that is a number and nothing else, else null (``36d``, ``inf`` and ``nan`` are none)."""
    s = F.trim(c)
    return F.when(s.rlike(r"^[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]{1,3})?$"), s).try_cast("double")


def int_scale(c: Column, lo: int, hi: int) -> Column:
    """A whole number within a range, else null; ranges and means are no whole numbers."""
    x = number(c)
    return F.when((x % 1 == 0) & x.between(lo, hi), x).try_cast("int")


def lat_lon(c: Column) -> tuple[Column, Column]:
    """Latitude and longitude of decimal, hemisphere or degree-minute-second text, rounded to 4 digits; null out of range and at (0, 0)."""
    s = F.regexp_replace(F.upper(F.trim(c)), r"(\d),(\d+)(?=\s*[NSEW°;]|\s+[-+]?\d|$)", "$1.$2")
    dec = r"^([-+]?\d+(?:\.\d+)?)\s*°?\s*([NS])?[\s,;]+([-+]?\d+(?:\.\d+)?)\s*°?\s*([EW])?$"
    dms = r"^(\d+)°\s*(\d+)['′]\s*(\d+(?:\.\d+)?)?[\"″]?\s*([NS])[\s,;]+(\d+)°\s*(\d+)['′]\s*(\d+(?:\.\d+)?)?[\"″]?\s*([EW])$"
    g = lambda p, i: F.regexp_extract(s, p, i)
    num = lambda x: F.coalesce(F.when(x != "", x).try_cast("double"), F.lit(0.0))
    sign = lambda x: F.when(x.isin("S", "W"), -1.0).otherwise(1.0)
    lat = F.when(s.rlike(dec), num(g(dec, 1)) * sign(g(dec, 2))).when(s.rlike(dms), (num(g(dms, 1)) + num(g(dms, 2)) / 60 + num(g(dms, 3)) / 3600) * sign(g(dms, 4)))
    lon = F.when(s.rlike(dec), num(g(dec, 3)) * sign(g(dec, 4))).when(s.rlike(dms), (num(g(dms, 5)) + num(g(dms, 6)) / 60 + num(g(dms, 7)) / 3600) * sign(g(dms, 8)))
    ok = lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0))
    return F.when(ok, F.round(lat, 4)), F.when(ok, F.round(lon, 4))


def partial_date(c: Column, most_year: int) -> Column:
    """``YYYY[-MM[-DD]]`` of a date text, null for impossible, future or early (before 1980) dates."""
    s = F.lower(F.trim(c))
    iso = r"^(\d{4})(?:[-/](\d{1,2}))?(?:[-/](\d{1,2}))?(?:[t ].*)?$"
    y, m, d = [F.regexp_extract(s, iso, i) for i in (1, 2, 3)]
    two = lambda x: F.lpad(x, 2, "0")
    text = F.concat_ws("-", y, F.when(m != "", two(m)), F.when(d != "", two(d)))
    yi, mi, di = [F.when(x != "", x).try_cast("int") for x in (y, m, d)]
    ok = s.rlike(iso) & yi.between(1980, most_year) & (mi.isNull() | mi.between(1, 12))
    whole = F.when(di.isNotNull(), F.try_to_date(text)).isNotNull() | di.isNull()
    return F.when(ok & whole, text)


# Words that tell the kind of library in its selection, source and gene fields.
ASSAYS = {
    "amplicon": r"\b(?:16s|18s|its[12]?|amplicons?|rrna|v[1-9](?:-?v[1-9])?|515f|806r|pcr)\b",
    "shotgun": r"\b(?:shotgun|wgs|whole[- ]genome|metagenom\w*|random)\b",
    "transcript": r"\b(?:rna-?seq|transcriptom\w*|metatranscriptom\w*|cdna)\b",
}


def assay_tells(parts: dict[str, Column]) -> dict[str, Column]:
    """Per assay the sorted ``;`` list of the labelled texts that tell it, null if none does."""
    hit = lambda c, p: F.coalesce(F.lower(c).rlike(p), F.lit(False))
    out = {}
    for assay, p in ASSAYS.items():
        names = F.array_compact(F.array(*[F.when(hit(c, p), F.lit(n)) for n, c in sorted(parts.items())]))
        out[assay] = F.when(F.size(names) > 0, F.array_join(names, ";"))
    return out


def ontology_ids(c: Column, prefixes: list[str]) -> Column:
    """Sorted distinct ontology ids of a text (``UBERON:0001988``, also with an underscore), upper case with a colon."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"(?i)\b({'|'.join(prefixes)})[:_]([0-9]{{4,8}})\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.upper(F.replace(x, F.lit("_"), F.lit(":"))))))


# Words that take back what they stand beside.
HEDGES = r"\b(?:semi|mostly|partly|occasional(?:ly)?|sometimes|possibl[ey]|probabl[ey]|suspected|likely|maybe)\b"


def guard(code: Column, term: Column, raw: Column, known: Column, match_terms: Column) -> Column:
    """Why a proposed code is not kept, null if it is.

    In this order: ``not in vocabulary`` (``known`` false or null), ``no span`` (the justifying term is empty or not in the raw text), ``negated`` (a denial
    within three words before the term), ``hedged``, ``no match term`` (none of the code's terms, nor the code, is in the span). Texts are compared folded.
    """
    t, r = folded(term), folded(raw)
    at = F.instr(r, t)
    before = F.substring(r, F.lit(1), at - 1)
    denied = before.rlike(rf"\b(?:{NEGATORS})(?:\W+\w+){{0,2}}\W*$")
    terms = F.transform(F.coalesce(match_terms, F.array().cast("array<string>")), folded)
    match = F.exists(terms, lambda x: (x != "") & t.contains(x)) | t.contains(F.replace(folded(code), F.lit("_"), F.lit(" ")))
    return ladder(
        [
            (~F.coalesce(known, F.lit(False)), "not in vocabulary"),
            (F.coalesce(t, F.lit("")) == "", "no span"),
            (F.coalesce(at, F.lit(0)) == 0, "no span"),
            (denied, "negated"),
            (t.rlike(HEDGES) | r.rlike(HEDGES), "hedged"),
            (~match, "no match term"),
        ],
        None,
    )


# What an evidence source begins with, and the outcomes of a screening.
SOURCES = ["sample.attr", "sample.title", "paper", "supplement", "study", "catalog", "curator"]


def evidence_problem(source: Column, quote: Column, confidence: Column, locator: Column, most_words: int = 12) -> Column:
    """The first breach of the evidence contract, null if there is none: a labelled source, a non-empty quote of at most ``most_words`` words, a
    confidence from 0 to 1, and a locator."""
    s, words = F.lower(F.trim(source)), F.size(F.split(F.trim(quote), r"\s+"))
    labelled = F.lit(False)
    for p in SOURCES:
        labelled = labelled | s.startswith(p)
    return first_message(
        [
            (labelled, "source without label"),
            (F.trim(quote) != "", "no quote"),
            (words <= most_words, "quote too long"),
            (confidence.between(0, 1), "confidence out of range"),
            (F.trim(locator) != "", "no locator"),
        ]
    )


def best_id_header(df, columns: list[str], least: float = 0.6):
    """(column, form, share, n): the form of each column whose filled values share one, most id-like first; the first row is the best header.

    Forms from strict to loose: accession, letters then digits, parts joined by signs, whole number; the strictest that ``least`` of the values have counts.
    """
    forms = [("accession", r"^(?:SAM[A-Z]{2}\d+|[ESD]R[SRX]\d{5,})$"), ("code", r"^[A-Za-z]{1,5}[-_.]?\d{2,6}$"), ("composite", r"^[A-Za-z0-9]+(?:[-_.][A-Za-z0-9]+){1,4}$"), ("number", r"^\d{1,9}$")]
    v = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.trim(F.col(c).cast("string")).alias("v")) for c in columns])).alias("x")).select("x.*").where("v <> ''")
    g = v.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d"), *[F.avg(F.col("v").rlike(p).cast("double")).alias(f) for f, p in forms])
    form = ladder([(F.col(f) >= least, f) for f, _ in forms], None)
    share = F.coalesce(*[F.when(F.col(f) >= least, F.col(f)) for f, _ in forms])
    place = F.coalesce(*[F.when(F.col(f) >= least, F.lit(i)) for i, (f, _) in enumerate(forms)])
    out = g.select("column", form.alias("form"), share.alias("share"), "n", place.alias("__p"), (F.col("d") / F.col("n")).alias("__u")).where("form is not null")
    return out.orderBy("__p", F.desc("__u"), F.desc("share"), "column").drop("__p", "__u")  # one row per column
