"""History of changing attributes: versions with the period each was valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def versions(
    rows: DataFrame,
    keys: list[str],
    value: Column,
    start: Column,
    end: Column,
    order: Column,
) -> DataFrame:
    """(keys, ``version_value``, ``start``, ``end``): the versions of each entity, from stamped rows.

    Each row holds from ``start`` up to but not including ``end`` (null = open), and not beyond the start of the
    entity's next row. The rows of an entity are gathered as a sorted array of structs; a higher-order fold appends
    a version only when the value changes or time is left uncovered, and the versions are exploded with their end.

    Defined results: rows with a null value or start, and rows that end at or before their start, are ignored.
    Rows of one entity and start: the one with the greatest ``order`` counts; repeated rows are one row. Null keys
    form their own entity. An empty table gives no rows. Columns other than the keys are not carried, so clashing
    names do no harm.

    Scale: before the arrays are built the rows are reduced to one per entity and start by a partial aggregation, so
    an array is no longer than the number of distinct starts (releases), however many rows an entity has.
    """
    k = [f"__k{i}" for i in range(len(keys))]
    r = rows.select(
        *[F.col(c).alias(a) for c, a in zip(keys, k)], value.alias("__v"), start.alias("__s"), end.alias("__e"), order.alias("__o")
    ).where("__v is not null and __s is not null and (__e is null or __e > __s)")
    one = r.groupBy(*k, "__s").agg(F.max_by(F.struct("__v", "__e"), F.struct("__o", "__v")).alias("__x"))
    arrays = one.groupBy(*k).agg(F.array_sort(F.collect_list(F.struct("__s", "__x.__v", "__x.__e"))).alias("__a"))
    cut = F.transform(
        F.col("__a"),
        lambda x, i: F.struct(
            x["__s"].alias("s"),
            x["__v"].alias("v"),
            F.least(x["__e"], F.get(F.col("__a"), i + 1)["__s"]).alias("e"),
        ),
    )
    row_type = "array<struct<s:int,v:string,e:int>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        same = (F.size(acc) > 0) & F.coalesce((last["v"] == x["v"]) & (last["e"] == x["s"]), F.lit(False))
        grown = F.concat(
            F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(last["s"].alias("s"), last["v"].alias("v"), x["e"].alias("e"))),
        )
        return F.when(same, grown).otherwise(F.concat(acc, F.array(x)))

    folded = F.aggregate(cut.cast(row_type), F.array().cast(row_type), lambda acc, x: F.when(F.size(acc) == 0, F.array(x)).otherwise(step(acc, x)))
    return arrays.select(*[F.col(a).alias(c) for c, a in zip(keys, k)], F.explode(folded).alias("x")).select(
        *keys, F.col("x.v").alias("version_value"), F.col("x.s").alias("start"), F.col("x.e").alias("end")
    )
