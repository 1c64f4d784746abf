"""The best representative of each duplicate group, by currency reasoning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.eav import small
from sedimenta.sources.tables import checkpointed

#: A transition counts as learned when it was seen this often, and more often than its reverse by more than chance would give: the square
#: of the difference exceeds this many times the sum (99 % of a normal law).
LEAST_SUPPORT, BEYOND_CHANCE = 3, 6.63
#: Up to this many unstamped rows their groups are sent to the tasks; beyond, the planner shuffles.
FEW_UNSTAMPED = 200_000


def learn_transitions(rows: DataFrame, group: list[str], attribute: str, value: str, rank: str, least_support: int = LEAST_SUPPORT) -> DataFrame:
    """(``attribute``, ``earlier``, ``later``): which value follows which, learned from the timestamped rows of all groups.

    Within a group the values are put in the order of their time stamps (one value per stamp: the smallest); each pair of
    consecutive different values is a transition. A transition is kept if seen ``least_support`` times or more and more
    often than its reverse beyond chance (``BEYOND_CHANCE``), so values without an order of their own teach none. Rows are first reduced to one per group and stamp, so a group's array is no longer than the number of
    distinct stamps.
    """
    stamped = rows.where(F.col(value).isNotNull() & F.col(rank).isNotNull())
    one = stamped.groupBy(*group, rank).agg(F.min(value).alias("__v"))
    runs = one.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), "__v"))).alias("__a"))
    pairs = runs.where(F.size("__a") > 1).select(
        F.col(attribute).alias("__f"),
        F.explode(
            F.transform(
                F.slice("__a", F.lit(1), F.size("__a") - 1),
                lambda x, i: F.struct(x["__v"].alias("a"), F.get("__a", i + 1)["__v"].alias("b")),
            )
        ).alias("p"),
    )
    # A pair and its reverse fall into one row, so no self-join is needed.
    lo, hi = F.least("p.a", "p.b"), F.greatest("p.a", "p.b")
    seen = (
        pairs.where("p.a <> p.b")
        .groupBy("__f", lo.alias("lo"), hi.alias("hi"))
        .agg(F.count_if(F.col("p.a") < F.col("p.b")).alias("up"), F.count_if(F.col("p.a") > F.col("p.b")).alias("down"))
    )
    clear = F.pow(F.col("up") - F.col("down"), 2) > BEYOND_CHANCE * (F.col("up") + F.col("down"))
    kept = seen.where(clear & (F.greatest("up", "down") >= least_support))
    up = F.col("up") > F.col("down")
    return kept.select(
        F.col("__f").alias("attribute"),
        F.when(up, F.col("lo")).otherwise(F.col("hi")).alias("earlier"),
        F.when(up, F.col("hi")).otherwise(F.col("lo")).alias("later"),
    )


def latest_by_order(candidates: DataFrame, group: list[str], attribute: str, value: str, rank: str, precedence: DataFrame, unstamped: DataFrame | None = None) -> DataFrame:
    """``candidates`` with ``is_latest``: in the partial order of its group no value of the group comes after the row's value.

    Only rows without a time stamp are placed by the order; stamped rows get null. The order of a group is the learned
    precedence among its distinct values; its topologically latest values are those without a successor in the group (all values
    of a cycle have one, so none of them is latest). ``unstamped`` are the groups and values of the rows without a stamp, if known already.
    """
    lone = candidates.where(F.col(rank).isNull() & F.col(value).isNotNull()).select(*group, value) if unstamped is None else unstamped
    few = lone.limit(FEW_UNSTAMPED + 1).count() <= FEW_UNSTAMPED
    sent = F.broadcast if few else lambda df: df  # all of it is bounded by the unstamped rows
    missing = lone.distinct()
    names = [F.col(c).alias(f"__{c}") for c in group]
    same = [F.col(c) == F.col(f"__{c}") for c in group]
    # Only groups with an unstamped row have anything to be placed.
    open_groups = candidates.where(F.col(value).isNotNull()).join(sent(missing.select(*group).distinct()), group, "left_semi")
    present = open_groups.select(*names, F.col(value).alias("__later")).distinct()
    p = precedence.select(F.col("attribute").alias("__pf"), F.col("earlier").alias("__pe"), F.col("later").alias("__pl"))
    after = missing.join(p, (F.col(attribute) == F.col("__pf")) & (F.col(value) == F.col("__pe")))
    beaten = after.join(present, [*same, F.col("__pl") == F.col("__later")], "left_semi").select(*names, F.col(value).alias("__bv")).distinct()
    out = candidates.join(sent(beaten), [*same, F.col(value) == F.col("__bv"), F.col(rank).isNull()], "left")
    return out.withColumn("is_latest", F.when(F.col(rank).isNull(), F.col("__bv").isNull())).drop("__bv", *[f"__{c}" for c in group])


def currency_score(rows: DataFrame, group: list[str], attribute: str, value: str, rank: str, held: Column) -> DataFrame:
    """(``attribute``, ``groups``, ``decided``, ``right``): how well the partial order finds the latest value where stamps are missing.

    The stamps of the groups for which ``held`` is true are hidden; the precedence is learned from the other groups; in each held
    group with two or more values the topologically latest values are taken. ``decided`` groups have exactly one, ``right`` ones the
    value that the hidden stamps say is the latest. Rows without group, value or stamp are ignored.
    """
    rows = rows.where(" and ".join(f"`{c}` is not null" for c in [*group, value, rank]))
    truth = rows.where(held).groupBy(*group).agg(F.max_by(value, F.struct(rank, value)).alias("__true"), F.count_distinct(value).alias("__n")).where("__n > 1")
    precedence = learn_transitions(rows.where(~held), group, attribute, value, rank)
    hidden = rows.where(held).join(truth.select(*group), group, "left_semi").withColumn(rank, F.lit(None).cast("int"))
    placed = latest_by_order(hidden, group, attribute, value, rank, precedence)
    g = placed.where("is_latest").groupBy(*group).agg(F.count_distinct(value).alias("latest"), F.min(value).alias("__v"))
    one = F.coalesce(F.col("latest") == 1, F.lit(False))
    out = truth.join(g, group, "left").groupBy(attribute)
    return out.agg(F.count(F.lit(1)).alias("groups"), F.count_if(one).alias("decided"), F.count_if(one & (F.col("__v") == F.col("__true"))).alias("right"))


def golden_records(
    rows: DataFrame,
    group: list[str],
    attribute: str,
    value: str,
    rank: str,
    trust: list[Column],
    row_id: str,
    current: Column,
    fill: list[str],
    least_rows: int = 2,
) -> DataFrame:
    """(group, ``row_id``, ``fill``.., ``group_rows``): one surviving row per group, its gaps filled from the others field by field.

    ``trust`` are ascending sort keys (smaller = more trusted). Among equally trusted rows the greater time stamp ``rank`` survives,
    then - for rows without one - the topologically latest value of the group's partial order (see ``latest_by_order``), then the
    smallest ``row_id``. Every ``fill`` column takes the first value in this order that is neither null nor blank. Only rows
    where ``current`` holds compete; all rows, retired ones too, teach the precedence. Groups of fewer than
    ``least_rows`` competing rows are left out.

    Defined results: null group keys leave a row out; null trust keys come last; repeated rows tie and the smallest id
    survives; an empty table gives no rows; other columns are dropped. The selection is a ``min_by`` over structs, aggregated before
    the exchange, so no group is ever gathered.
    """
    rows = rows.where(" and ".join(f"`{c}` is not null" for c in group))
    # Only attributes with an unstamped candidate need a precedence. These rows are found once; what follows reads a narrow table of them.
    unstamped = checkpointed(rows.where(current & F.col(rank).isNull() & F.col(value).isNotNull()).select(*group, value))
    wanted = unstamped.select(F.col(attribute).alias("__wanted")).distinct()
    taught = rows.join(small(wanted), F.col(attribute) == F.col("__wanted"), "left_semi")
    precedence = learn_transitions(taught, group, attribute, value, rank)
    cand = latest_by_order(rows.where(current), group, attribute, value, rank, precedence, unstamped)
    big = F.lit(2**31 - 1).cast("long")
    order = F.struct(
        *[F.coalesce(t.cast("double"), F.lit(float("inf"))).alias(f"t{i}") for i, t in enumerate(trust)],
        F.coalesce(-F.col(rank).cast("long"), big).alias("recency"),
        F.when(F.col("is_latest"), 0).otherwise(1).alias("late"),
        F.col(row_id).alias("id"),
    )
    cand = cand.withColumn("__o", order)
    usable = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c))
    filled = [F.min_by(usable(c), F.when(usable(c).isNotNull(), F.col("__o"))).alias(c) for c in fill]
    out = cand.groupBy(*group).agg(F.min_by(row_id, "__o").alias(row_id), *filled, F.count(F.lit(1)).alias("group_rows"))
    return out.where(F.col("group_rows") >= least_rows)
