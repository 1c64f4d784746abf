"""Reading of free-form dates and times, with built-in expressions only.

``parse_time`` turns a text into a struct of microseconds of local time, precision, and what the text says of its
zone. Placing the local time in a zone is left to ``operators.timestamps``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.keys import squeezed

# Month names, the beginnings that tell them apart in English, German, French, Spanish, Italian, Portuguese and Dutch,
# accents removed.
MONTH_STEMS = {
    1: ["jan", "ene", "gen"],
    2: ["feb", "fev"],
    3: ["mar", "mrz", "maer", "maa"],
    4: ["apr", "avr", "abr"],
    5: ["may", "mai", "mei", "mag"],
    6: ["jun", "juin", "giu"],
    7: ["jul", "juil", "lug"],
    8: ["aug", "aou", "ago"],
    9: ["sep", "set"],
    10: ["oct", "okt", "out", "ott"],
    11: ["nov"],
    12: ["dec", "dez", "dic"],
}
# Zone abbreviations in minutes east of UTC.
ZONE_MINUTES = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 60, "cet": 60, "west": 60, "cest": 120, "eet": 120, "eest": 180,
    "msk": 180, "eat": 180, "ist": 330, "jst": 540, "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "est": -300, "edt": -240,
    "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "cot": -300,
}
MONTH_WORD = r"([a-z]{3,10})\.?"
CLOCK = (
    r"(?:[t ,]*(?:at |um |a las |à )?(\d{1,2})[:h](\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
    r"\s*(?:([ap])\.?\s?m\.?(?![a-z]))?\s*(?:uhr)?)?"
)
ZONE = r"\s*([a-z]{1,4}|(?:utc|gmt)?\s?[+-]\d{1,2}(?::?\d{2})?)?\s*(?:\[([^\]]+)\])?$"
DATE_NUM = r"^(\d{1,2})[-/. ](\d{1,2})[-/. ](\d{4})"
PATTERNS = {
    "ymd": r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + CLOCK + ZONE,
    "num": DATE_NUM + CLOCK + ZONE,
    "dmon": r"^(\d{1,2})(?:st|nd|rd|th|er)?[-. ]+(?:de |of )?" + MONTH_WORD + r"[-. ,]+(?:de |del )?(\d{4})" + CLOCK + ZONE,
    "mond": r"^" + MONTH_WORD + r"[-. ]+(\d{1,2})(?:st|nd|rd|th)?[-., ]+(\d{4})" + CLOCK + ZONE,
    "packed": r"^(\d{4})(\d{2})(\d{2})(?:[t ]?(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,9}))?)?)?" + ZONE,
}
SEP = "\x01"
US = 1_000_000
DAY_US = 86_400 * US


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, by arithmetic: no exceptions, no session zone."""
    y2 = F.when(m <= 2, y - 1).otherwise(y)
    era = F.floor(y2 / 400)
    yoe = y2 - era * 400
    doy = F.floor((F.lit(153) * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    return (era * 146097 + yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy - 719468).cast("long")


def valid_day(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    longest = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= longest)


def _month(word: Column) -> Column:
    stem4 = F.create_map(*[F.lit(x) for m, stems in MONTH_STEMS.items() for s in stems if len(s) == 4 for x in (s, m)])
    stem3 = F.create_map(*[F.lit(x) for m, stems in MONTH_STEMS.items() for s in stems if len(s) == 3 for x in (s, m)])
    return F.coalesce(F.try_element_at(stem4, F.substring(word, 1, 4)), F.try_element_at(stem3, F.substring(word, 1, 3)))


def let(value: Column, body) -> Column:
    """``body`` applied to ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def keep(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column, rows where it is null left out; a generator, so that the optimiser evaluates it once."""
    return df.withColumn(name, F.explode(F.array_compact(F.array(value))))


def _int(c: Column) -> Column:
    return F.when(c != "", c).try_cast("int")


def parse_time(text: Column, order: Column) -> Column:
    """Struct(``local_us``, ``day_only``, ``offset_min``, ``zone_id``) of a text, or null.

    ``local_us`` counts microseconds of the text's own clock since 1970. ``offset_min`` is set where the text holds an offset or
    zone abbreviation (0 for an epoch number), ``zone_id`` where it names an IANA zone. ``order`` (``dmy``,
    ``mdy``, or ``any`` for the one that is valid, null = ``dmy``) is the order of all-number dates that do not begin with the year. Null is the result
    for texts that do not fix a valid calendar day, or hold an impossible clock time or trailing words.
    """
    raw = squeezed(text)
    s = F.lower(raw)
    s = F.translate(s, "áàâäãéèêëíìîïóòôöõúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
    s = F.regexp_replace(s, r"^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,? ", "")
    iana_raw = F.regexp_extract(raw, r"\[([^\]]+)\]$", 1)
    mdy = F.coalesce(F.lower(order) == "mdy", F.lit(False))
    either = F.coalesce(F.lower(order) == "any", F.lit(False))
    known = F.create_map(*[F.lit(x) for kv in ZONE_MINUTES.items() for x in kv])

    def reading(name: str) -> Column:
        n = 8 if name == "packed" else 10
        parts = F.split(F.regexp_replace(s, PATTERNS[name], SEP.join(f"${i}" for i in range(1, n + 1))), SEP, -1)

        def fields(g: Column) -> Column:
            at = [F.get(g, i) for i in range(n)]
            if name in ("ymd", "packed"):
                y, m, d = _int(at[0]), _int(at[1]), _int(at[2])
            elif name == "num":
                y = _int(at[2])
                first_is_month = mdy | (either & (_int(at[1]) > 12))
                m = F.when(first_is_month, _int(at[0])).otherwise(_int(at[1]))
                d = F.when(first_is_month, _int(at[1])).otherwise(_int(at[0]))
            elif name == "dmon":
                d, m, y = _int(at[0]), _month(at[1]), _int(at[2])
            else:
                m, d, y = _month(at[0]), _int(at[1]), _int(at[2])
            hh, mi, ss, frac, half, zone, iana = at[3:] if n == 10 else [*at[3:7], F.lit(""), *at[7:], iana_raw]
            clean = F.regexp_replace(F.regexp_replace(zone, r"^(?:utc|gmt)\s?(?=[+-])", ""), ":", "")
            return F.struct(
                y.alias("y"), m.alias("m"), d.alias("d"), (hh != "").alias("timed"), _int(hh).alias("h"), _int(mi).alias("mi"),
                F.coalesce(_int(ss), F.lit(0)).alias("sec"),
                F.coalesce(_int(F.when(frac != "", F.rpad(F.substring(frac, 1, 6), 6, "0"))), F.lit(0)).alias("us"),
                half.alias("half"), clean.alias("zone"), iana.alias("iana"),
            )

        return let(parts, fields)

    def placed(x: Column) -> Column:
        h, zone, half = x["h"], x["zone"], x["half"]
        hour = F.when((half == "p") & (h < 12), h + 12).when((half == "a") & (h == 12), F.lit(0)).otherwise(h)
        digits = F.regexp_replace(zone, r"^[+-]", "")
        whole = F.when(F.length(digits) > 2, _int(digits)).otherwise(_int(digits) * 100)
        minutes = F.floor(whole / 100) * 60 + whole % 100
        offset = F.coalesce(
            F.try_element_at(known, zone),
            F.when(zone.rlike(r"^[+-]\d{1,4}$"), F.when(zone.startswith("-"), -minutes).otherwise(minutes)).cast("int"),
        )
        ok = valid_day(x["y"], x["m"], x["d"]) & ((zone == "") | offset.isNotNull())
        clock_ok = (hour <= 23) & (x["mi"] <= 59) & (x["sec"] <= 59) & ((half == "") | ((h >= 1) & (h <= 12)))
        ok = ok & (~x["timed"] | clock_ok)
        local = days_from_civil(x["y"], x["m"], x["d"]) * F.lit(DAY_US)
        clock = ((hour * 60 + x["mi"]) * 60 + x["sec"]).cast("long") * F.lit(US) + x["us"]
        return F.when(
            ok,
            F.struct(
                (local + F.when(x["timed"], clock).otherwise(F.lit(0))).cast("long").alias("local_us"),
                (~x["timed"]).alias("day_only"),
                offset.cast("int").alias("offset_min"),
                F.when(x["iana"] != "", iana_raw).alias("zone_id"),
            ),
        )

    epoch = F.struct(
        F.when(s.rlike(r"^\d{10}$"), s.try_cast("long") * F.lit(US)).otherwise(s.try_cast("long") * F.lit(1000)).alias("local_us"),
        F.lit(False).alias("day_only"),
        F.lit(0).alias("offset_min"),
        F.lit(None).cast("string").alias("zone_id"),
    )
    ladder = F.when(s.rlike(PATTERNS["ymd"]), reading("ymd"))
    for name in ("num", "dmon", "mond", "packed"):
        ladder = ladder.when(s.rlike(PATTERNS[name]), reading(name))
    return F.when(s.rlike(r"^\d{10}$|^\d{13}$"), epoch).otherwise(let(ladder, placed))


def utc_text(us: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffffZ`` of microseconds since 1970, independent of the session zone."""
    rest = F.pmod(us, F.lit(DAY_US))
    day = ((us - rest) / F.lit(DAY_US)).cast("int")
    sec = ((rest - F.pmod(rest, F.lit(US))) / F.lit(US)).cast("int")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(
        F.date_from_unix_date(day).cast("string"),
        F.lit("T"),
        two(F.floor(sec / 3600)),
        F.lit(":"),
        two(F.floor(sec / 60) % 60),
        F.lit(":"),
        two(sec % 60),
        F.lit("."),
        F.lpad(F.pmod(rest, F.lit(US)).cast("string"), 6, "0"),
        F.lit("Z"),
    )
