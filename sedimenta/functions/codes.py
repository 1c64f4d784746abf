"""Code books: values of categorical attributes to codes by ordered rules, one expression per book.

A rule is (keys, value, code, note): it applies where the attribute key fully matches ``keys`` (empty: any key) and the lower-case, squeezed value
holds the pattern ``value`` (several patterns: all of them; one that begins with ``!`` must not be held). The first rule that applies gives the code; a rule
without a code rejects the value, and ``note`` is the reason. Patterns use only what every regular-expression engine knows, so a book can be
handed to another engine as it is (``as_sql``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.keys import PLACEHOLDER_PATTERN, folded, is_placeholder, squeezed

Rule = tuple[str, str | tuple[str, ...], str | None, str]

# Words of consent and denial.
YES = "^(?:yes|y|true|t|1|during|exposed|positive|pos|present|ja|oui|si|past use|current use|yes_current)$"
NO = "^(?:no|n|false|f|0|never|not_during|unexposed|none|negative|neg|absent|nein|no antibiotics|no abx|nonec|no_nec)$"
NUMBER = r"^[-+]?[0-9]+(?:\.[0-9]+)?$"

# The rules of each code book, in order.
YES_NO: list[Rule] = [
    ("antibiotic_history", "^i have not taken", "no", "history"),
    ("antibiotic_history", "^(?:week|month|6 months|year)$", "yes", "history within a year"),
    ("days_on_abx", r"^0+(?:\.0+)?$", "no", "days"),
    ("days_on_abx", r"^[0-9]+(?:\.[0-9]+)?$", "yes", "days"),
    ("", YES, "yes", "flag"),
    ("", NO, "no", "flag"),
    ("antibiotic|host_maternal_peripartum_abx|m_antibiotics", "cillin|mycin|cef|ceph|penem|floxacin|cycline|azole|gentamicin|sulfa|trimethoprim|nitrofurantoin", "yes", "drug name"),
    ("", "^(?:after|before)$", None, "timing ambiguous"),
]
DELIVERY: list[Rule] = [
    ("csection", YES, "c_section", "flag"),
    ("csection", NO, "vaginal", "flag"),
    ("caesareansection|c_section_0_no_1_yes", "^1$", "c_section", "coded"),
    ("caesareansection|c_section_0_no_1_yes", "^0$", "vaginal", "coded"),
    ("vaginal_delivery_0_no_1_yes", "^1$", "vaginal", "coded"),
    ("vaginal_delivery_0_no_1_yes", "^0$", "c_section", "coded"),
    ("csection|caesareansection|c_section_0_no_1_yes|vaginal_delivery_0_no_1_yes", "", None, "unparsed"),
    ("delivery_mode_abx", "^vd", "vaginal", "coded"),
    ("delivery_mode_abx", "^cs", "c_section", "coded"),
    ("delivery", "^[12]$", None, "coded without legend"),
    ("", "^(?:cs|c[- _]?section|ca?e?sarean|ca?e?sarian|c|sc|ca?esarea|sectio|caeserean|section|1_cs)$", "c_section", "whole value"),
    ("", r"elective|\bplanned|scheduled|pre[- ]?labou?r|without labou?r|no labou?r|\bcold\b", "c_section_elective", "words"),
    ("", "emergen|unplanned|urgent|in labou?r|with labou?r|after labou?r|intrapartum", "c_section_emergency", "words"),
    ("", r"c[- _]?section|caesar|cesar|^cs\b|\bcs$|sectio", "c_section", "words"),
    ("", "^(?:vd|vb|svd|nvd|v|vag|natural|spontaneous|normal|normal delivery|per vaginam|vacuum|forceps|ventouse|0|vag_delivery)$|vagin|spontaneous", "vaginal", "words"),
]
FEEDING: list[Rule] = [
    ("formula", "breast", "exclusive_breast", "coded"),
    ("formula", "formula|hmo", "formula", "coded"),
    ("breastfeeding_status", "^exclusive$", "exclusive_breast", "coded"),
    ("breastfeeding_status", "^(?:partial|mixed)$", "mixed", "coded"),
    ("breastfeeding_status", "^(?:none|no)$", "formula", "coded"),
    ("formula_percent", r"^(?:0(?:\.[0-4][0-9]*)?|0?\.[0-4][0-9]*|0\.5)$", "exclusive_breast", "percent"),
    ("formula_percent", r"^(?:99\.[5-9][0-9]*|100(?:\.0+)?)$", "formula", "percent"),
    ("breast_?milk_percent|percent_breast_?milk", r"^(?:99\.[5-9][0-9]*|100(?:\.0+)?)$", "exclusive_breast", "percent"),
    ("breast_?milk_percent|percent_breast_?milk", r"^(?:0(?:\.[0-4][0-9]*)?|0?\.[0-4][0-9]*|0\.5)$", "formula", "percent"),
    ("formula_percent|breast_?milk_percent|percent_breast_?milk", r"^[0-9]{1,2}(?:\.[0-9]+)?$", "mixed", "percent"),
    ("", r"^(?:exclusive(?:ly)?[ _-]?(?:breast.*|bf)|ebf|breast|breast ?milk|breastfed|breastfeeding|bf|b|human milk|exclusive|mother'?s? ?milk|mbm|only breast milk)$", "exclusive_breast", "whole value"),
    ("", "^(?:formula|ff|f|formula[ _-]?fed|exclusive(?:ly)? formula|formula milk|infant formula|control formula|standard formula|formula only|other milk)$", "formula", "whole value"),
    ("", "solid|wean|complementary|table food|^fs$|^bs$", "weaned/solids", "words"),
    ("", r"mixed|\bmf\b|partial|both|combin|and formula|\+", "mixed", "words"),
    ("", "formula", "formula", "words"),
    ("", "breast|human milk|mbm", "exclusive_breast", "words"),
]
SEX: list[Rule] = [
    ("legal_sex_0_m_1_f", "^0$", "male", "coded"),
    ("legal_sex_0_m_1_f", "^1$", "female", "coded"),
    ("phenotype", "^female_subject", "female", "phenotype"),
    ("phenotype", "^male_subject", "male", "phenotype"),
    ("", "^(?:f|female|girl|fem|woman|w)$", "female", "sex"),
    ("", "^(?:m|male|boy|man)$", "male", "sex"),
]
NEC: list[Rule] = [("", f"{YES}|^(?:nec|medical|surgical)$", "yes", "flag"), ("", NO, "no", "flag")]
MILK_SUGARS: list[Rule] = [("", "hmo", "yes", "coded"), ("", "control formula|breast", "no", "coded")]
FREQUENCY: list[Rule] = [("", "^never$", "no", "frequency"), ("", "daily|regularly|occasionally|rarely", "yes", "frequency")]
PRETERM: list[Rule] = [("", "^1$|preterm|pre-term|prematur", "preterm", "coded"), ("", "^[02]$|^(?:full[- ]?)?term$", "term", "coded")]
SMOKING: list[Rule] = [
    ("", "passive|second[- ]?hand|environmental tobacco", None, "passive exposure"),
    ("", r"\bnever\b|\bnon[- ]?smok|\bno smok|not smoke|\bnonsmok", "never", "stated"),
    ("", r"\bformer|\bex[- ]?smok|\bquit\b|stopped|past smok", "former", "stated"),
    ("", (r"(?:[0-9]{4}|unk) ?[-–] ?(?:[0-9]{1,2}/)?[0-9]{4}", "cig|pack|smok", r"!\b(?:pres|present|current)\b"), "former", "ended window"),
    ("", "^[01239]$", None, "coded scale"),
    ("", NUMBER, None, "number only"),
    (".*history.*", YES, None, "ever, not when"),
    ("", (r"[0-9]\+? ?(?:years?|yrs?)\b", "!cig|smok|tobacco"), None, "duration only"),
    ("", "^smoked$", None, "tense ambiguous"),
    ("", r"\bsmokers?\b|\bsmoking\b|\bcurrent\b|\bcig|every ?day|\bdaily\b|times? (?:a|per) (?:day|week|month)", "current", "stated"),
    ("", YES, "current", "flag"),
    ("", NO, "never", "flag"),
]
DIET: list[Rule] = [
    (".*(?:vegan|vegetarian|gluten_free|lactose_free).*", NO, None, "flag is false"),
    (".*vegan.*", YES, "vegan", "flag key"),
    (".*vegetarian.*", YES, "vegetarian", "flag key"),
    (".*gluten_free.*", YES, "gluten_free", "flag key"),
    (".*lactose_free.*", YES, "lactose_free", "flag key"),
    ("special_diet|specialized_diet.*|dietary_restrictions?", NO, "omnivore", "no special diet"),
    ("special_diet|specialized_diet.*|dietary_restrictions?", YES, None, "special diet unspecified"),
    ("", NUMBER, None, "arm or code"),
    ("", "^(?:a|b|c|control|control diet|habitual|intervention|treatment|group [a-z0-9]+|diet [a-z0-9]+)$", None, "arm or code"),
    ("", r"\b(?:mice|mouse|rat|chow|pig|cattle|fodder|silage)\b", None, "not of a person"),
    ("", "^(?:no (?:special|specific|particular) diet|no (?:dietary )?restrictions?|unrestricted|normal diet|regular diet)", "omnivore", "no special diet"),
    ("", "semi[- ]?veg|flexitarian|mostly|partly|part-time|occasional", None, "hedged"),
    ("", "^(?:paleo|kosher|halal|dairy[- ]free|casein[- ]free|raw food)", "other_diet", "named diet"),
    ("", "fib(?:er|re)[- ]free|low[- ]|high[- ]|enteral nutrition|elimination|fodmap|ketogenic|fasting|enriched", "therapeutic_or_study_diet", "words"),
    ("", "non[-_ ]?veg|omnivor|eats? (?:meat|everything)", "omnivore", "words"),
    ("", (r"\bvegan", "!vegetarian"), "vegan", "words"),
    ("", (r"\bvegetarian|ovo|lacto-", "!vegan"), "vegetarian", "words"),
    ("", "pescatarian|pesco", "pescatarian", "words"),
    ("", "mediterranean", "mediterranean", "words"),
    ("", "western|processed|fast food", "western_or_processed", "words"),
    ("", "gluten[- ]free", "gluten_free", "words"),
]
MEDICATION: list[Rule] = [
    ("", "^(?:no medications?|none reported|not? (?:on|taking) (?:any )?(?:drugs?|medications?))", "no", "stated"),
    ("", YES, "yes", "flag"),
    ("", NO, "no", "flag"),
    ("", "planned|considering|advised", None, "hedged"),
    ("", "metformin|insulin|statin|prazole|aspirin|ibuprofen|paracetamol|acetaminophen|steroid|predni|mesalamine|infliximab|adalimumab|cillin|mycin", "yes", "drug name"),
]
MULTIPLE_BIRTH: list[Rule] = [
    ("has_twin|twin_gestation.*|is_twin|maternal_complication_twin|twin_in_study", "^(?:true|yes|y|1|t)$", "twin", "flag"),
    ("has_twin|twin_gestation.*|is_twin|maternal_complication_twin", "^(?:false|no|n|0|f)$", "singleton", "flag"),
    ("twin_id", "^(?:not applicable|na|n/a)$", "singleton", "no twin id"),
    ("twin_id", "^[ab12]$", "twin", "member of a pair"),
    ("twin_pair", r"^pair\s*[0-9]+", "twin", "pair code"),
    ("twins", r"^[a-z]{1,4}[0-9]{1,4}\+[a-z]{1,4}[0-9]{1,4}$", "twin", "pair code"),
    ("type_of_twin", r"gemini|dc/da|mc/da|mc/ma|\bdz\b|\bmz\b", "twin", "type of twin"),
    ("", r"\bsingleton", "singleton", "words"),
    ("", r"\btriplet|\bquadruplet|\bquintuplet", "triplet_or_more", "words"),
    ("", r"\btwins?\b", "twin", "words"),
]
SIBLING: list[Rule] = [
    ("has_siblings?|siblings?", YES, "yes", "flag"),
    ("has_siblings?|siblings?", NO, "no", "flag"),
    ("number_of_siblings|siblings?|n_siblings|older_siblings", "^0+$", "no", "count"),
    ("number_of_siblings|siblings?|n_siblings|older_siblings", "^[0-9]{1,2}$", "yes", "count"),
    ("", r"\b(?:brother|sister|sibling)s?\b", "yes", "words"),
]
BOOKS = {
    "yes_no": YES_NO, "delivery": DELIVERY, "feeding": FEEDING, "sex": SEX, "nec": NEC, "hmo": MILK_SUGARS, "probiotic_freq": FREQUENCY, "preterm": PRETERM,
    "smoking": SMOKING, "diet": DIET, "medication": MEDICATION, "multiple_birth": MULTIPLE_BIRTH, "sibling": SIBLING,
}
# Settlement classes, and words that make a place an institution.
SETTLEMENTS = ["urban", "suburban", "rural", "peri-urban", "periurban", "semi-urban"]
INSTITUTIONS = r"hospital|clinic|university|laborator|cent(?:re|er)|institute|medical|nicu|\bward\b|\bunit\b|\bdept|department|school of|college"


def coded(key: Column, value: Column, rules: list[Rule]) -> Column:
    """Struct(``code``, ``note``) of a value by a code book.

    A value that no rule matches is ``placeholder`` if it only says that nothing is known, else ``unparsed``; null is a placeholder.
    """
    s, k = folded(value), F.coalesce(F.lower(key), F.lit(""))
    made = lambda code, note: F.struct(F.lit(code).cast("string").alias("code"), F.lit(note).alias("note"))
    out = F.when(s.isNull(), made(None, "placeholder"))
    for keys, patterns, code, note in rules:
        cond = k.rlike(f"^(?:{keys})$") if keys else F.lit(True)
        for p in (patterns,) if isinstance(patterns, str) else patterns:
            cond = cond & (~s.rlike(p[1:]) if p.startswith("!") else s.rlike(p))
        out = out.when(cond, made(code, note))
    return out.when(is_placeholder(value), made(None, "placeholder")).otherwise(made(None, "unparsed"))


def as_sql(key: str, value: str, rules: list[Rule]) -> tuple[str, str]:
    """The (code, note) of a code book as two CASE expressions of ANSI SQL with ``regexp_matches``."""
    s, q = f"lower(trim(regexp_replace({value}, '[\\s\u00a0]+', ' ', 'g')))", lambda x: "'" + x.replace("'", "''") + "'"
    steps = [(f"{value} is null", None, "placeholder")]
    for keys, patterns, code, note in rules:
        conds = [f"regexp_matches(coalesce(lower({key}), ''), {q(f'^(?:{keys})$')})"] if keys else []
        for p in (patterns,) if isinstance(patterns, str) else patterns:
            conds.append(f"not regexp_matches({s}, {q(p[1:])})" if p.startswith("!") else f"regexp_matches({s}, {q(p)})")
        steps.append((" and ".join(conds), code, note))
    steps.append((f"{s} = '' or regexp_matches({s}, {q(PLACEHOLDER_PATTERN)})", None, "placeholder"))
    case = lambda i, last: "case " + " ".join(f"when {x[0]} then {'null' if x[i] is None else q(x[i])}" for x in steps) + f" else {last} end"
    return case(1, "null"), case(2, "'unparsed'")


def sub_national(value: Column) -> Column:
    """The part of a place below the country, smallest unit first: ``USA:CA:San Diego`` is ``San Diego, CA``; null without one, for an institution, or where a number comes first."""
    parts = F.filter(F.transform(F.split(squeezed(value), ":"), lambda x: F.trim(x)), lambda x: x != "")
    sub = F.array_join(F.reverse(F.slice(parts, 2, 100)), ", ")
    return F.when((F.size(parts) > 1) & ~F.get(parts, 0).rlike("[0-9]") & ~F.lower(sub).rlike(INSTITUTIONS), sub)


def settlement(value: Column) -> Column:
    """The settlement class a text names, or null."""
    s = folded(value)
    return F.when(s.isin(*SETTLEMENTS), s)


def similarity(a: Column, b: Column) -> Column:
    """1 for equal texts, 0 for texts without a letter in common place: one less the edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def place_valid(raw: Column, place: Column, abbreviations: dict[str, str], least: float = 0.5) -> Column:
    """Whether every word of a proposed place is covered by the raw text, so that no other place was smuggled in.

    A word is covered if it stands in the raw text, in what one of the raw words abbreviates, or resembles a raw word (an exonym: ``similarity`` of at
    least ``least``). A null or empty place is valid, a place for a null text is not. Both sides are compared in lower case.
    """
    text = F.lower(F.coalesce(raw, F.lit("")))
    split = lambda c: F.filter(F.split(c, "[^a-z0-9\\u00c0-\\uffff]+"), lambda x: x != "")
    known = F.create_map(*[F.lit(x.lower()) for kv in abbreviations.items() for x in kv]) if abbreviations else F.create_map().cast("map<string,string>")
    have = split(text)
    longer = F.transform(have, lambda t: F.coalesce(F.try_element_at(known, t), F.lit("")))
    covered = lambda w: F.instr(text, w).cast("boolean") | F.exists(longer, lambda e: F.array_contains(F.split(e, " "), w)) | F.exists(have, lambda t: similarity(w, t) >= least)
    return F.coalesce(F.forall(split(F.lower(place)), covered), F.lit(True))
