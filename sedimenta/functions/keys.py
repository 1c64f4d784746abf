"""Key, value and release normal forms shared by the operators (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lower-case cell texts that only say that nothing is known, recorded or applicable.
PLACEHOLDER_PATTERN = (
    r"^(?:[-–—?.*_/]+|#?n[./ ]?\s?a\.?|nan|nd|n\.d\.|n/d|null|none|nil|missing(?:\b.*)?|unknown|unk|unspecified|undetermined|"
    r"undefined|unavailable|unreported|no data|no information|no value|tbd|blank|empty|restricted access|withheld|"
    r"(?:data )?not[ _-](?:applicable|available|recorded|collected|provided|known|reported|specified|determined|stated|given|"
    r"measured|documented|disclosed|done|entered|noted|assessed)(?:\b.*)?)$"
)


def squeezed(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[\s ]+", " "))


def entity_key(c: Column) -> Column:
    """Identifiers are compared trimmed of white space and in upper case."""
    return F.upper(squeezed(c))


def folded(c: Column) -> Column:
    """Texts compared without regard to case and outer blanks."""
    return F.lower(squeezed(c))


def normal_key(c: Column) -> Column:
    """Lower case, every run of characters other than a-z and 0-9 as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def is_placeholder(c: Column) -> Column:
    """True for null, blank, or a text that only says nothing is known, recorded or applicable."""
    s = folded(c)
    return c.isNull() | (s == "") | s.rlike(PLACEHOLDER_PATTERN)


def canonical_value(c: Column) -> Column:
    """One text per class of equal values: equal as numbers, or as texts without case and outer blanks."""
    s = folded(c)
    n = F.when(s.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$"), s.try_cast("double"))
    return F.coalesce((n + F.lit(0.0)).cast("string"), s)


def release_ranks(releases: DataFrame) -> DataFrame:
    """(``release_text``, ``release_id``, ``release_rank``): every accepted spelling of each release, lower case.

    A release id, its package version, and the version with a leading ``v`` mean the same release; ranks follow
    ``release_date`` (then ``release_id``) and start at 1. Rows without an id or date are left out.
    """
    r = releases.where(F.col("release_id").isNotNull() & F.col("release_date").isNotNull())
    r = r.groupBy(F.trim("release_id").alias("release_id")).agg(
        F.min("release_date").alias("d"), F.min(F.trim("package_version")).alias("v")
    )
    # A release list is bounded by the number of publications, so one sorted array is small.
    ranked = r.agg(F.array_sort(F.collect_list(F.struct("d", "release_id", "v"))).alias("a")).select(
        F.posexplode("a").alias("pos", "s")
    )
    names = F.array_distinct(
        F.filter(
            F.array(
                F.lower("s.release_id"),
                F.regexp_replace(F.lower("s.release_id"), "^v(?=[0-9])", ""),
                F.concat(F.lit("v"), F.regexp_replace(F.lower("s.release_id"), "^v(?=[0-9])", "")),
                F.regexp_replace(F.lower("s.v"), "^v(?=[0-9])", ""),
                F.concat(F.lit("v"), F.regexp_replace(F.lower("s.v"), "^v(?=[0-9])", "")),
            ),
            lambda x: x.isNotNull(),
        )
    )
    texts = ranked.select(F.explode(names).alias("release_text"), "s.release_id", (F.col("pos") + 1).alias("release_rank"))
    # If two releases share a spelling, the release whose own id it is wins, then the later one.
    own = F.when(F.col("release_text") == F.lower("release_id"), 1).otherwise(0)
    return texts.groupBy("release_text").agg(
        F.max_by("release_id", F.struct(own, "release_rank")).alias("release_id"),
        F.max_by("release_rank", F.struct(own, "release_rank")).alias("release_rank"),
    )


#: A release list longer than this is joined by a shuffle instead of being sent to every executor.
MAX_BROADCAST_RELEASES = 20_000


def release_map(releases: DataFrame) -> Column | None:
    """A literal map text -> rank, for lists of bounded length; None beyond the bound."""
    rows = release_ranks(releases).limit(MAX_BROADCAST_RELEASES + 1).collect()
    if len(rows) > MAX_BROADCAST_RELEASES:
        return None
    if not rows:
        return F.create_map().cast("map<string,int>")
    return F.create_map(*[F.lit(x) for r in rows for x in (r.release_text, int(r.release_rank))])


def with_release_rank(df: DataFrame, releases: DataFrame, text_col: str, rank_col: str) -> DataFrame:
    """``df`` with the rank of the release that ``text_col`` names (null where it names none).

    The list is size-checked: up to ``MAX_BROADCAST_RELEASES`` rows it is a broadcast hash join, beyond that a plain
    join that the planner may shuffle.
    """
    ranks = release_ranks(releases).select(F.col("release_text").alias("__t"), F.col("release_rank").alias(rank_col))
    n = releases.limit(MAX_BROADCAST_RELEASES // 4 + 1).count()
    if n <= MAX_BROADCAST_RELEASES // 4:
        ranks = F.broadcast(ranks)
    return df.withColumn("__k", folded(F.col(text_col))).join(ranks, F.col("__k") == F.col("__t"), "left").drop("__k", "__t")
