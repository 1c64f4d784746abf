"""Contracts, masks, collections, scopes, work lists and classification by weighted evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.texts import has_code, ladder
from sedimenta.operators.resolve import rank_all


def canonicalise(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """For each canonical name the first alias that the frame has, else an empty text."""
    pick = lambda names: next((F.col(n) for n in names if n in df.columns), F.lit(""))
    return df.select(*[pick(names).alias(c) for c, names in aliases.items()])


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The frame with exactly the contract's columns and types; missing ones are null, unknown ones an error."""
    extra = [c for c in df.columns if c not in columns]
    if extra:
        raise ValueError(f"columns outside the contract: {extra}")
    return df.select(*[(F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in columns.items()])


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, failures) of all row checks, in one aggregate."""
    one = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n in checks])).alias("x")).select("x.*")


def validate_list(c: Column, allowed: list[str]) -> Column:
    """A ``;`` list with its valid codes sorted and distinct, null if none is left."""
    kept = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x.isin(*allowed))))
    return F.when(F.size(kept) > 0, F.array_join(kept, ";"))


def qc_filter(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows with none of the flags; absent flag columns are ignored, null is false."""
    cond = F.lit(True)
    for f in flags:
        if f in df.columns:
            cond = cond & ~F.coalesce(F.col(f).cast("boolean"), F.lit(False))
    return df.where(cond)


def collection(df: DataFrame, spec: dict, key: str, subject: str | None = None) -> tuple[DataFrame, list[str]]:
    """Rows of listed keys that pass all filters (list = any of, ``min``/``max`` inclusive), and the names of unknown columns, which select nothing."""
    unknown = [c for c in spec.get("filters", {}) if c not in df.columns]
    out = df.where(F.lit(not unknown))
    if spec.get("keys") is not None:
        out = out.where(F.col(key).isin(*spec["keys"]))
    for c, f in spec.get("filters", {}).items():
        if c in unknown:
            continue
        if isinstance(f, dict):
            out = out.where(F.col(c) >= f["min"]) if "min" in f else out
            out = out.where(F.col(c) <= f["max"]) if "max" in f else out
        else:
            out = out.where(F.col(c).isin(*f))
    if subject and spec.get("least_per_subject"):
        n = out.groupBy(subject).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= spec["least_per_subject"])
        out = out.join(n.select(subject), subject, "left_semi")
    return out, unknown


def predicate(params: dict, columns: dict[str, str]) -> Column:
    """A filter from interactive parameters: ``text`` (accession by shape, else a title search), equality, ``None`` for IS NULL, (from, to) years."""
    cond = F.lit(True)
    for name, value in params.items():
        c = F.col(columns[name])
        if name == "text":
            cond = cond & (F.col(columns["accession"]) == value if value[:3] in ("PRJ", "SAM") else c.ilike(f"%{value}%"))
        elif value is None:
            cond = cond & c.isNull()
        elif isinstance(value, tuple):
            y = F.substring(c.cast("string"), 1, 4).try_cast("int")
            cond = cond & y.between(*value)
        elif isinstance(value, list):
            cond = cond & c.isin(*value)
        else:
            cond = cond & (c == value)
    return cond


def scopes(rules: dict[str, Column]) -> Column:
    """The ordered ``;`` list of scopes whose rule holds."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()])), ";")


def classify(df: DataFrame, key: str, sources: dict[str, tuple[str, float]], classes: dict[str, str], least: float) -> DataFrame:
    """(key, class, score, confidence, evidence): weighted evidence over labelled text sources.

    ``sources`` maps a source name to (column, weight), ``classes`` a class to its pattern. The class with the greatest summed weight wins (ties by
    name) if it reaches ``least``; confidence is its share of all weight; ``evidence`` lists the sources that spoke for it.
    """
    cand = []
    for c, p in classes.items():
        hits = [F.when(F.coalesce(F.col(col).rlike(p), F.lit(False)), F.lit(w)).otherwise(0.0) for col, w in sources.values()]
        names = F.array_join(F.array_compact(F.array(*[F.when(h > 0, F.lit(n)) for n, h in zip(sources, hits)])), ";")
        cand.append(F.struct((-sum(hits, F.lit(0.0))).alias("neg"), F.lit(c).alias("class"), names.alias("evidence")))
    x = df.withColumn("__c", F.array_sort(F.array(*cand)))
    best = F.get("__c", 0)
    total = F.aggregate("__c", F.lit(0.0), lambda a, v: a - v["neg"])
    won = -best["neg"] >= least
    return x.select(
        key, F.when(won, best["class"]).otherwise("unknown").alias("class"), (-best["neg"]).alias("score"), F.round(F.coalesce(F.try_divide(-best["neg"], total), F.lit(0.0)), 6).alias("confidence"),
        F.when(won, best["evidence"]).alias("evidence"),
    )


def merge_replicates(a: DataFrame, b: DataFrame, key: str, fields: list[str], conf: str) -> DataFrame:
    """(key, fields.., conf, status): two replicates that agree on all fields are merged with the mean confidence, others queued with nulls."""
    j = a.select(key, *[F.col(f).alias(f"__a_{f}") for f in fields], F.col(conf).alias("__ca")).join(b, key, "full_outer")
    agree = F.col("__ca").isNotNull() & F.col(conf).isNotNull()
    for f in fields:
        agree = agree & F.col(f"__a_{f}").eqNullSafe(F.col(f))
    return j.select(key, *[F.when(agree, F.col(f)).alias(f) for f in fields], F.when(agree, (F.col("__ca") + F.col(conf)) / 2).alias(conf), F.when(agree, "merged").otherwise("queue").alias("status"))


def adjudicate(conflicts: DataFrame, decisions: DataFrame, pattern: list[str]) -> DataFrame:
    """Conflicts grouped into patterns, each pattern decided once, the decision fanned back; undecided patterns are ``open``."""
    return conflicts.join(decisions, pattern, "left").withColumn("decision", F.coalesce("decision", F.lit("open")))


def worklist(coverage: DataFrame, group: str, size: str, weights: dict[str, float], blockers: list[tuple[str, Column]], full: float = 1.0) -> DataFrame:
    """(group, missing, score, blocker, place): groups ordered by weighted missing coverage times the logarithm of their size."""
    score = sum((F.lit(w) * (1 - F.coalesce(F.col(f), F.lit(0.0))) for f, w in weights.items()), F.lit(0.0)) * F.log10(F.col(size) + 1)
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(F.col(f), F.lit(0.0)) < full, F.lit(f)) for f in weights])), ";")
    x = coverage.select(group, size, missing.alias("missing"), F.round(score, 6).alias("score"), ladder([(c, n) for n, c in blockers], "none").alias("blocker"))
    return rank_all(x.where("missing <> ''"), [F.desc("score"), F.desc(size), F.asc(group)], "place")


# Comparative wording, which bounds a value instead of stating it.
COMPARATIVE = r"(?i)\b(?:less|more|greater|fewer|older|younger|higher|lower) than\b|\b(?:at (?:least|most)|up to|under|over|below|above|within)\b|[<>≤≥]"


def threshold_filter(df: DataFrame, is_group: Column, value: str, quote: str, supports_default: Column) -> DataFrame:
    """``df`` without numeric group statements quoted from comparative wording, unless the quote supports the default class."""
    bound = is_group & F.col(value).try_cast("double").isNotNull() & F.col(quote).rlike(COMPARATIVE) & ~F.coalesce(supports_default, F.lit(False))
    return df.where(~F.coalesce(bound, F.lit(False)))


def in_list(df: DataFrame, column: str, code: str) -> DataFrame:
    """Rows whose ``;`` list holds a code."""
    return df.where(has_code(F.col(column), code))


def parse_batch(results: DataFrame, ids: DataFrame, key: str, fields: dict[str, object]) -> DataFrame:
    """One row per requested id: its result, or the given sentinel values; results for ids not asked for are dropped."""
    r = results.groupBy(key).agg(F.min(F.struct(*fields)).alias("__r"))
    j = ids.select(key).distinct().join(r, key, "left")
    return j.select(key, *[F.coalesce(F.col(f"__r.{f}"), F.lit(v)).alias(f) for f, v in fields.items()])
