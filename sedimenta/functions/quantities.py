"""Quantities in free text: number and unit, with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.keys import squeezed
from sedimenta.functions.times import let

# For each dimension the unit names in use and the unit each means.
UNIT_NAMES = {
    "time": {
        "h": "h hr hrs hour hours std stunde stunden heure heures hora horas",
        "d": "d day days dy dys tag tage tagen jour jours dia dias dag dagen giorni",
        "w": "w wk wks week weeks week(s) wo woche wochen semaine semaines semana semanas ssw",
        "mo": "m mo mos mon mth mths month months month(s) monat monate monaten mois mes meses",
        "y": "y yr yrs year years year(s) yo jahr jahre jahren an ans ano anos",
    },
    "mass": {
        "mg": "mg milligram milligrams",
        "g": "g gr gm gms gram grams gramm gramme grammes gramos",
        "kg": "kg kgs kilo kilos kilogram kilograms kilogramm kilogrammes kilogramos",
        "lb": "lb lbs pound pounds pfund",
        "oz": "oz ounce ounces",
    },
    "length": {
        "mm": "mm millimeter millimeters millimetre millimetres",
        "cm": "cm cms centimeter centimeters centimetre centimetres zentimeter",
        "m": "m meter meters metre metres",
        "in": 'in ins inch inches "',
        "ft": "ft foot feet '",
    },
    "temp": {
        "c": "c °c degc celsius degcelsius °celsius centigrade grad",
        "f": "f °f degf fahrenheit degfahrenheit °fahrenheit",
        "k": "k °k degk kelvin degkelvin",
    },
}
# What one unit is in the common unit of its dimension (days, grams, millimetres).
FACTORS = {
    "time": {"h": 1 / 24, "d": 1.0, "w": 7.0, "mo": 30.4375, "y": 365.25},
    "mass": {"mg": 0.001, "g": 1.0, "kg": 1000.0, "lb": 453.59237, "oz": 453.59237 / 16},
    "length": {"mm": 1.0, "cm": 10.0, "m": 1000.0, "in": 25.4, "ft": 304.8},
}
# Parser name prefix and its dimension.
DIMENSIONS = {"age_": "time", "ga_": "time", "bw_": "mass", "mass_": "mass", "length_": "length", "temp_": "temp"}
# Words for small numbers, and words for age zero.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve".split()
BIRTH = r"^(?:at |from )?(?:birth|newborn|neonate|new born|day of birth|geburt|neugeboren|naissance|nacimiento)$"
NUM = r"\d{1,3}(?:[ ,]\d{3})+(?:\.\d+)?(?![\d])|\d+(?:[.,]\d+)?|\.\d+"
UNIT = r"(?:deg(?:rees?|\.)?\s?)?[a-z°][a-z°]*(?:\(s\))?\.?|[\"']"


def dimension(parser: Column) -> Column:
    """The dimension of a quantity parser, null for other parsers."""
    c = F.lit(None).cast("string")
    for prefix, dim in DIMENSIONS.items():
        c = F.when(F.lower(parser).startswith(prefix), F.lit(dim)).otherwise(c)
    return c


def unit_of(text: Column, dim: Column) -> Column:
    """The unit that a unit text names in the given dimension, or null."""
    s = F.lower(squeezed(text))
    s = F.translate(s, "áéíóúñ′″’”", "aeioun'\"'\"")
    s = F.regexp_replace(s, r"^degrees? ?|^deg\.? ?", "deg")
    s = F.regexp_replace(s, r"[. ]", "")
    names = {f"{d}:{n}": u for d, us in UNIT_NAMES.items() for u, ns in us.items() for n in ns.split()}
    # Two maps keep each literal small.
    items = list(names.items())
    half = F.create_map(*[F.lit(x) for kv in items for x in kv])
    return F.try_element_at(half, F.concat(dim, F.lit(":"), s))


def _number(s: Column, thousands: Column) -> Column:
    """A number with decimal point or comma; a lone comma or blank before three digits groups thousands where said."""
    grouped = s.rlike(r"^\d{1,3}(?:[ ,]\d{3})+(?:\.\d+)?$") & (thousands | s.contains(" ") | s.rlike(r",.*[,.]"))
    return F.when(grouped, F.regexp_replace(s, "[ ,]", "")).otherwise(F.regexp_replace(s, ",", ".")).try_cast("double")


def parse_quantity(text: Column, dim: Column) -> Column:
    """Struct(``amount``, ``unit``, ``amount_grouped``, ``common``) of a text that is a quantity, or null.

    ``unit`` is the unit the text names, else null; ``common`` is set where the text itself fixes the amount in the
    common unit of the dimension (compound amounts such as ``8 lb 3 oz``, ISO durations, birth). ``amount_grouped``
    reads a comma before exactly three digits as grouping thousands, ``amount`` as a decimal comma. A range means its
    middle. Texts that are no quantity of the dimension give null.
    """
    s = F.lower(squeezed(text))
    s = F.translate(s, "−–—′″’”", "---'\"'\"")
    s = F.regexp_replace(s, r"^(?:approx(?:imately|\.)?|about|around|ca\.?|circa|~|≈|c\.)\s*", "")
    s = F.regexp_replace(s, r"^minus\s*", "-")
    s = F.regexp_replace(s, r"^y\.o\.|\by\.?\s?o\b\.?|(?<=[\d ])y\.o\.", "yo")
    s = F.regexp_replace(s, r"\s*(?:old|of age|gestation(?:al age)?|post ?partum)\.?$", "")
    words = F.create_map(*[F.lit(x) for n, word in enumerate(NUMBER_WORDS) for x in (word, str(n))])

    def spelled(x: Column) -> Column:
        first = F.regexp_extract(x, "^([a-z]{2,6}) ", 1)
        number = F.try_element_at(words, first)
        return F.when(number.isNotNull(), F.concat(number, F.lit(" "), F.regexp_replace(x, "^[a-z]+ ", ""))).otherwise(x)

    s = let(s, spelled)
    return let(F.struct(s.alias("s"), dim.alias("dim")), lambda x: _quantity(x["s"], x["dim"]))


def _quantity(s: Column, dim: Column) -> Column:
    def groups(pattern: str, n: int):
        sep = "\x01"
        return F.split(F.regexp_replace(s, pattern, sep.join(f"${i}" for i in range(1, n + 1))), sep, -1)

    def made(amount=None, unit=None, grouped=None, common=None):
        none = F.lit(None)
        return F.struct(
            (none if amount is None else amount).cast("double").alias("amount"),
            (none if unit is None else unit).cast("string").alias("unit"),
            (none if grouped is None else grouped).cast("double").alias("amount_grouped"),
            (none if common is None else common).cast("double").alias("common"),
        )

    zero = F.lit(0.0)
    num = lambda c: F.coalesce(_number(c, F.lit(False)), zero)
    iso = r"^p(?:(\d+(?:\.\d+)?)y)?(?:(\d+(?:\.\d+)?)m)?(?:(\d+(?:\.\d+)?)w)?(?:(\d+(?:\.\d+)?)d)?(?:t(\d+)h)?$"
    wd = r"^(\d{1,2})\s?(?:\+\s?|\s)(\d)(?:/7)?$"
    feet = r"^(\d+)\s?(?:'|ft\.?|feet|foot)\s?(\d+(?:\.\d+)?)\s?(?:\"|''|in\.?|inch|inches)?$"
    pair = rf"^({NUM})\s?({UNIT})(?:\s?[,+&]?\s?(?:and )?)({NUM})\s?({UNIT})$"
    span = rf"^({NUM})\s?(?:-|to|bis)\s?({NUM})\s?({UNIT})?$"
    front = rf"^({UNIT})\s({NUM})$"
    one = rf"^(-?)\s?({NUM})\s?({UNIT})?$"
    day_factor = F.create_map(*[F.lit(x) for kv in FACTORS["time"].items() for x in kv])
    mass_factor = F.create_map(*[F.lit(x) for kv in FACTORS["mass"].items() for x in kv])
    len_factor = F.create_map(*[F.lit(x) for kv in FACTORS["length"].items() for x in kv])

    def factor(unit: Column) -> Column:
        return (
            F.when(dim == "time", F.try_element_at(day_factor, unit))
            .when(dim == "mass", F.try_element_at(mass_factor, unit))
            .when(dim == "length", F.try_element_at(len_factor, unit))
        )

    def of_iso(g):
        y, m, w, d, h = [num(F.get(g, i)) for i in range(5)]
        return made(common=y * 365.25 + m * 30.4375 + w * 7 + d + h / 24)

    def of_pair(g):
        u1, u2 = unit_of(F.get(g, 1), dim), unit_of(F.get(g, 3), dim)
        f1, f2 = factor(u1), factor(u2)
        total = num(F.get(g, 0)) * f1 + num(F.get(g, 2)) * f2
        return F.when(f1 > f2, made(common=total))

    def of_span(g):
        u = unit_of(F.get(g, 2), dim)
        lo, hi = num(F.get(g, 0)), num(F.get(g, 1))
        ok = (hi >= lo) & ((F.get(g, 2) == "") | u.isNotNull())
        return F.when(ok, made(amount=(lo + hi) / 2, unit=u, grouped=(lo + hi) / 2))

    def of_front(g):
        u = unit_of(F.get(g, 0), dim)
        return F.when(u.isNotNull(), made(_number(F.get(g, 1), F.lit(False)), u, _number(F.get(g, 1), F.lit(True))))

    def of_one(g):
        u = unit_of(F.get(g, 2), dim)
        sign = F.when(F.get(g, 0) == "-", -1.0).otherwise(1.0)
        ok = ((F.get(g, 2) == "") | u.isNotNull()) & ((F.get(g, 0) == "") | (dim == "temp"))
        return F.when(ok, made(sign * _number(F.get(g, 1), F.lit(False)), u, sign * _number(F.get(g, 1), F.lit(True))))

    return (
        F.when(dim.isNull() | s.isNull(), F.lit(None))
        .when((dim == "time") & s.rlike(BIRTH), made(common=zero))
        .when((dim == "time") & s.rlike(iso) & s.rlike(r"\d"), let(groups(iso, 5), of_iso))
        .when((dim == "time") & s.rlike(wd), let(groups(wd, 2), lambda g: made(common=num(F.get(g, 0)) * 7 + num(F.get(g, 1)))))
        .when((dim == "length") & s.rlike(feet), let(groups(feet, 2), lambda g: made(common=num(F.get(g, 0)) * 304.8 + num(F.get(g, 1)) * 25.4)))
        .when(s.rlike(one), let(groups(one, 3), of_one))
        .when(s.rlike(span), let(groups(span, 3), of_span))
        .when((dim != "temp") & s.rlike(pair), let(groups(pair, 4), of_pair))
        .when((dim == "time") & s.rlike(front), let(groups(front, 2), of_front))
    )


#: Units in which amounts are whole numbers, so that a comma before three digits groups thousands.
WHOLE_UNITS = ["h", "d", "g", "mg", "mm"]


def to_common(q: Column, unit: Column, dim: Column) -> Column:
    """The amount of a parsed quantity in the common unit (days, grams, millimetres, degrees Celsius)."""
    amount = F.when(unit.isin(*WHOLE_UNITS), q["amount_grouped"]).otherwise(q["amount"])
    c = F.lit(None).cast("double")
    for d, fs in FACTORS.items():
        table = F.create_map(*[F.lit(x) for kv in fs.items() for x in kv])
        c = F.when(dim == d, amount * F.try_element_at(table, unit)).otherwise(c)
    temp = F.when(unit == "c", amount).when(unit == "f", (amount - 32) * 5 / 9).when(unit == "k", amount - 273.15)
    return F.coalesce(q["common"], F.when(dim == "temp", temp).otherwise(c))
