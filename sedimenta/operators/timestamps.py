"""Local times placed in their zones: an as-of join to zone-offset intervals exploded by year."""

from __future__ import annotations

import datetime as dt
import zoneinfo
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.times import DAY_US, US

#: Years for which offsets are tabulated. Before the first no zone of the database had changed yet; after the last the rules repeat by calendar, so
#: a later year takes the offsets of the tabulated year that begins on the same weekday and is as long.
FIRST_YEAR, LAST_YEAR = 1800, 2100
CYCLE = range(2072, 2100)
SALTS = 32
#: A dimension of up to this many rows is sent to every task instead of being salted.
MAX_BROADCAST_ROWS = 500_000


def _transitions(zone: zoneinfo.ZoneInfo, lo: int, hi: int) -> list[tuple[int, int]]:
    """(first second in UTC, offset in seconds) of each stretch of constant offset between lo and hi."""
    base = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    off = lambda s: int((base + dt.timedelta(seconds=s)).astimezone(zone).utcoffset().total_seconds())
    out, at, step = [(lo, off(lo))], lo, 7 * 86400  # no zone changes twice within a week and back
    while at < hi:
        nxt = min(at + step, hi)
        if off(nxt) != out[-1][1]:
            a, b = at, nxt
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (mid, b) if off(mid) == out[-1][1] else (a, mid)
            out.append((b, off(b)))
            at = b
        else:
            at = nxt
    return out


def zone_years(zones: DataFrame, zone_col: str) -> DataFrame:
    """(``zone_id``, ``zone_year``, ``stretches``): for each zone and year of local time, the stretches of constant offset.

    A stretch is (``lo``, ``hi``, ``off``) in microseconds of *local* time. The stretches that touch a year, and the one before
    its first, are listed with it, so a lookup by zone and year finds every interval that can hold a local time. The
    table is bounded by the zones of the IANA database. Unknown zone names give no rows.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = int(dt.datetime(FIRST_YEAR, 1, 1, tzinfo=dt.timezone.utc).timestamp())
        last = int(dt.datetime(LAST_YEAR + 1, 1, 1, tzinfo=dt.timezone.utc).timestamp())
        for pdf in batches:
            for name in pdf["zone_id"]:
                try:
                    zone = zoneinfo.ZoneInfo(name)
                except Exception:  # noqa: BLE001  (not a zone: no intervals)
                    continue
                t = _transitions(zone, first, last)
                ends = [x for x, _ in t[1:]] + [last + 86400]
                local = [(max(a + o, -(2**53)), e + o, o) for (a, o), e in zip(t, ends)]
                local[0] = (-(1 << 40), local[0][1], local[0][2])  # nothing changed before
                ids, years, lists = [], [], []
                for y in range(FIRST_YEAR, LAST_YEAR + 1):
                    a = int(dt.datetime(y, 1, 1, tzinfo=dt.timezone.utc).timestamp())
                    b = int(dt.datetime(y + 1, 1, 1, tzinfo=dt.timezone.utc).timestamp())
                    near = [i for i, (lo, hi, _) in enumerate(local) if lo < b + 86400 and hi > a - 86400]
                    near = list(range(max(0, near[0] - 1), near[-1] + 1)) if near else [len(local) - 1]
                    ids.append(name)
                    years.append(y)
                    lists.append([{"lo": local[i][0] * US, "hi": local[i][1] * US, "off": local[i][2] * US} for i in near])
                yield pd.DataFrame({"zone_id": ids, "zone_year": years, "stretches": lists})

    names = zones.select(F.trim(zone_col).alias("zone_id")).where("zone_id is not null").distinct()
    return names.mapInPandas(rows, "zone_id string, zone_year int, stretches array<struct<lo:bigint,hi:bigint,off:bigint>>")


def resolve_local(df: DataFrame, zones: DataFrame, parsed: str, zone: Column, out: str) -> DataFrame:
    """``df`` with ``out``: the UTC microseconds of a ``parse_time`` struct, or null.

    An offset in the text counts first, then a zone named in it, then ``zone``. Where the local time lies in two
    stretches it occurs twice and the first occurrence is meant; where it lies in none it never occurs and is
    moved forward by the length of the gap (the offset of the stretch before it applies); else the one stretch gives the
    offset. ``zones`` is ``zone_years`` of all zones that may occur; it is broadcast (bounded by the IANA database).
    A null or unknown zone gives null.
    """
    p = F.col(parsed)
    local = p["local_us"]
    day = ((local - F.pmod(local, F.lit(DAY_US))) / F.lit(DAY_US)).cast("int")
    year = F.greatest(F.year(F.date_from_unix_date(day)), F.lit(FIRST_YEAR))
    # A year beyond the table is looked up in one of the same kind, its times moved by the days between the two.
    new_year = lambda y: F.unix_date(F.make_date(y, F.lit(1), F.lit(1)))
    jan1 = new_year(year)
    kind = F.pmod(jan1, F.lit(7)) * 2 + F.when(F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) > 365, 1).otherwise(0)
    base = dt.date(1970, 1, 1)
    alike = {((dt.date(y, 1, 1) - base).days % 7) * 2 + (y % 4 == 0): y for y in CYCLE}
    like = F.when(year > LAST_YEAR, F.try_element_at(F.create_map(*[F.lit(x) for k, y in alike.items() for x in (k, y)]), kind.cast("int"))).otherwise(year)
    shift = F.when(year > LAST_YEAR, (jan1 - new_year(like)).cast("long") * F.lit(DAY_US)).otherwise(F.lit(0).cast("long"))
    z = F.broadcast(zones.select(F.col("zone_id").alias("__z"), F.col("zone_year").alias("__y"), F.col("stretches").alias("__s")))
    want_zone = F.coalesce(p["zone_id"], zone)
    j = df.withColumn("__want", F.when(p["offset_min"].isNull(), want_zone)).withColumn("__year", F.when(p["offset_min"].isNull(), like)).withColumn("__at", local - shift)
    j = j.join(z, (F.col("__want") == F.col("__z")) & (F.col("__year") == F.col("__y")), "left")
    at = F.col("__at")
    holds = F.filter("__s", lambda x: (x["lo"] <= at) & (at < x["hi"]))
    before = F.filter("__s", lambda x: x["lo"] <= at)
    off = F.when(F.size(holds) > 0, F.array_max(F.transform(holds, lambda x: x["off"]))).otherwise(
        F.element_at(F.transform(F.array_sort(before), lambda x: x["off"]), -1)
    )
    off = F.when(p["offset_min"].isNotNull(), p["offset_min"].cast("long") * F.lit(60 * US)).otherwise(F.when(F.size(before) > 0, off))
    return j.withColumn(out, local - off).drop("__want", "__year", "__at", "__z", "__y", "__s")


def salted_lookup(df: DataFrame, dim: DataFrame, on: str, salt: Column, salts: int = SALTS, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join to a dimension with unique ``on``, safe for hot keys.

    A dimension of up to ``most`` rows (counted) is sent to every task, so the rows do not move at all. A larger one is repeated ``salts`` times and
    joined by a shuffle, so a key that holds a third of all rows is shared out to ``salts`` tasks. Null keys find nothing and are spread too.
    """
    d = dim.withColumnRenamed(on, "__on")
    if d.limit(most + 1).count() <= most:
        return df.join(F.broadcast(d), df[on] == d["__on"], "left").drop("__on")
    d = d.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    left = df.withColumn("__salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    j = left.join(d, (left[on] == d["__on"]) & (left["__salt"] == d["__salt"]), "left")
    return j.drop(d["__salt"]).drop("__on", "__salt")
