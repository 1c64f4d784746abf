"""Registry operators: classification by weighted evidence, assembly, member tier, quality flags, profile summaries, universe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.texts import has_term, ladder, quote_around, term_regex
from sedimenta.operators.aggregate import bray_curtis
from sedimenta.operators.resolve import best_row


def weigh_evidence(
    df: DataFrame, key: str, sources: dict[str, tuple[str, float, bool]], vocabulary: dict[str, tuple[list[str], list[str]]], prior: Column | None = None, least: float = 1.0
) -> DataFrame:
    """(key, ``code``, ``score``, ``confidence``, ``stage``, ``reasons``, ``evidence``): each row classified from its labelled texts.

    ``sources`` maps a label to (column, weight, strong); ``vocabulary`` a code to (terms, negative phrases). Every source in which a term of a code stands outside
    the negatives gives the code its weight. The code with the greatest sum wins (ties by code) if it reaches ``least``, else ``unknown``. A
    ``prior`` code is taken as it is (``stage`` prior, confidence 0.95). Confidence is the winner's share of all weight, at most 0.6 where no strong
    source speaks for it. ``reasons`` (``;`` list) ask for review: ``no evidence``, ``below threshold``, ``weak sources only``, ``conflict`` (the second code has half of the winner's
    weight or more). ``evidence`` lists ``label: quote`` of the sources that spoke for the winner. One expression, no exchange; a null text says nothing.
    """
    cand = []
    for code, (terms, negatives) in vocabulary.items():
        hits = {n: has_term(F.col(c), terms, negatives) for n, (c, _, _) in sources.items()}
        score = sum((F.when(h, F.lit(float(sources[n][1]))).otherwise(F.lit(0.0)) for n, h in hits.items()), F.lit(0.0))
        strong = F.lit(False)
        for n, h in hits.items():
            strong = strong | (h if sources[n][2] else F.lit(False))
        pattern = "|".join(term_regex(t) for t in terms)
        quotes = F.array_compact(F.array(*[F.when(h, F.concat(F.lit(f"{n}: "), quote_around(F.col(sources[n][0]), pattern))) for n, h in hits.items()]))
        cand.append(F.struct((-score).alias("neg"), F.lit(code).alias("code"), strong.alias("strong"), quotes.alias("quotes")))
    x = df.withColumn("__c", F.array_sort(F.array(*cand))).withColumn("__prior", prior if prior is not None else F.lit(None).cast("string"))
    first, second = F.get("__c", 0), F.get("__c", 1)
    total = F.aggregate("__c", F.lit(0.0), lambda a, v: a - v["neg"])
    won, fixed = -first["neg"] >= least, F.col("__prior").isNotNull()
    share = F.coalesce(F.try_divide(-first["neg"], total), F.lit(0.0))
    reasons = F.array_compact(
        F.array(
            F.when(total == 0, "no evidence"),
            F.when((total > 0) & ~won, "below threshold"),
            F.when(won & ~first["strong"], "weak sources only"),
            F.when(won & (second["neg"] * 2 <= first["neg"]), "conflict"),
        )
    )
    return x.select(
        key,
        F.when(fixed, F.col("__prior")).when(won, first["code"]).otherwise("unknown").alias("code"),
        F.when(fixed, 0.0).otherwise(-first["neg"]).alias("score"),
        F.round(F.when(fixed, 0.95).when(~won, 0.0).when(first["strong"], share).otherwise(F.least(share, F.lit(0.6))), 6).alias("confidence"),
        F.when(fixed, "prior").otherwise("rule").alias("stage"),
        F.when(fixed, "").otherwise(F.array_join(reasons, ";")).alias("reasons"),
        F.when(fixed, "prior").when(won, F.array_join(first["quotes"], " | ")).otherwise("").alias("evidence"),
    )


def assemble(base: DataFrame, key: str, prior: DataFrame, model: DataFrame, codes: list[str], facts: list[str]) -> DataFrame:
    """(key, ``facts``, ``code``, ``stage``, ``problem``): the registry row of each key by precedence.

    A prior decision (``key``, ``code``) beats the rule's own code in ``base``, the model's beats an ``unknown`` of the rule only; a code outside ``codes`` counts as
    not given and is named in ``problem``. Keys that only the prior knows are carried with null facts. Prior and model may repeat a key: their smallest code counts.
    """
    one = lambda df, name: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("code").alias(name))
    j = base.select(key, *facts, F.col("code").alias("__rule")).join(one(prior, "__prior"), key, "full_outer").join(one(model, "__model"), key, "left")
    ok = lambda c: F.when(F.col(c).isin(*codes), F.col(c))
    rule = F.when(F.col("__rule") != "unknown", ok("__rule"))
    bad = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & ~F.col(c).isin(*codes, "unknown"), F.concat(F.lit(f"{c[2:]}: "), F.col(c))) for c in ("__prior", "__rule", "__model")]))
    stage = ladder([(ok("__prior").isNotNull(), "prior"), (rule.isNotNull(), "rule"), (ok("__model").isNotNull(), "model")], "none")
    return j.select(key, *facts, F.coalesce(ok("__prior"), rule, ok("__model"), F.lit("unknown")).alias("code"), stage.alias("stage"), F.array_join(bad, ";").alias("problem"))


def member_tier(rows: DataFrame, norm: DataFrame, fields: list[str], entity: str, field: str, value: str, order: list[Column], unknown: str = "unknown") -> DataFrame:
    """One row per entity with, per field, ``<field>_code`` and ``<field>_raw``: its best normalised value.

    ``norm`` maps (``field``, ``value``) to ``code`` and may list a value twice (the smallest code counts). Rows with a code go before rows without, then by
    ``order``; an entity that has a value for the field but no code gets ``unknown``, one without a value null. Rows are reduced to one per
    entity and field before they are widened.
    """
    n = norm.groupBy(F.col("field").alias("__f"), F.col("value").alias("__v")).agg(F.min("code").alias("__code"))
    j = rows.join(n, (F.col(field) == F.col("__f")) & (F.col(value) == F.col("__v")), "left").where(F.col(value).isNotNull() & F.col(entity).isNotNull())
    best = best_row(j.select(entity, field, value, "__code", *[o.alias(f"__o{i}") for i, o in enumerate(order)]), [entity, field], [F.col("__code").isNull(), *[F.col(f"__o{i}") for i in range(len(order))]])
    pick = lambda f, c: F.max(F.when(F.col(field) == f, c))
    cols = [x for f in fields for x in (pick(f, F.coalesce("__code", F.lit(unknown))).alias(f"{f}_code"), pick(f, F.col(value)).alias(f"{f}_raw"))]
    return best.groupBy(entity).agg(*cols)


# Organism names of communities and of records without an organism, and how RNA libraries are named.
COMMUNITY = r"(?i)microbiom|microbiota|\bcommunity\b|consortium|environmental sample"
NO_ORGANISM = r"(?i)^(?:unidentified|unclassified|unknown|other|none)\b"
RNA_STRATEGIES = ["RNA-Seq", "ncRNA-Seq", "miRNA-Seq", "ssRNA-seq"]
RNA_SOURCES = ["TRANSCRIPTOMIC", "METATRANSCRIPTOMIC", "VIRAL RNA"]


def qc_flags(organism: Column, strategy: Column, source: Column, low_complexity: Column, warning: Column) -> dict[str, Column]:
    """Quality flags of a sequencing record; null texts are empty. The strict flags spare records whose organism is a placeholder, and RNA sources that
    are common mislabels (single-cell transcripts)."""
    org, strat, src = [F.coalesce(c, F.lit("")) for c in (organism, strategy, source)]
    src = F.upper(src)
    named = (org != "") & ~org.rlike("(?i)metagenome") & ~org.rlike(COMMUNITY)
    return {
        "non_metagenome_strict": named & ~org.rlike(NO_ORGANISM),
        "non_metagenome_loose": named,
        "synthetic": org.rlike("(?i)synthetic|simulat") | (src == "SYNTHETIC"),
        "rna_strict": strat.isin(*RNA_STRATEGIES) | src.isin(*RNA_SOURCES),
        "rna_loose": strat.isin(*RNA_STRATEGIES) | src.contains("RNA") | src.contains("TRANSCRIPT"),
        "low_complexity": F.coalesce(F.lower(F.trim(low_complexity)) == "yes", F.lit(False)),
        "warning": F.coalesce(F.trim(warning) != "", F.lit(False)),
    }


def profile_summary(rows: DataFrame, sample: str, run: str, taxon: str, amount: str, indicators: dict[str, list[str]], shallow: float, apart: float = 0.5) -> DataFrame:
    """One row per sample: ``runs``, ``root`` (summed amount), ``richness``, ``top_taxon`` with ``top_share``, ``entropy``, a share per indicator (named taxa), ``is_shallow``
    (root below ``shallow``) and ``is_discordant`` (two runs differ by more than ``apart`` in Bray-Curtis dissimilarity).

    Amounts of a taxon are summed over the runs of a sample first. Runs that share no taxon differ by 1. Runs are compared within their sample through
    the taxa they share: a sample has few runs. Rows without sample, run or taxon, or with an amount not above 0, are ignored.
    """
    r = rows.where(F.col(sample).isNotNull() & F.col(run).isNotNull() & F.col(taxon).isNotNull() & (F.col(amount) > 0))
    t = r.groupBy(sample, taxon).agg(F.sum(amount).alias("v"))
    v = F.col("v")
    share = lambda c: F.coalesce(F.sum(c), F.lit(0.0)) / F.sum(v)
    g = t.groupBy(sample).agg(
        F.sum(v).alias("root"),
        F.count(F.lit(1)).alias("richness"),
        F.min_by(F.struct(F.col(taxon).alias("t"), v.alias("v")), F.struct((-v).alias("a"), F.col(taxon).alias("b"))).alias("__top"),
        (F.ln(F.sum(v)) - F.sum(v * F.ln(v)) / F.sum(v)).alias("entropy"),
        *[share(F.when(F.col(taxon).isin(*taxa), v)).alias(name) for name, taxa in indicators.items()],
    )
    n = r.select(sample, run).distinct().groupBy(sample).agg(F.count(F.lit(1)).alias("runs"))
    pairs = bray_curtis(r, sample, run, taxon, amount).groupBy(sample).agg(F.count(F.lit(1)).alias("__pairs"), F.max("dissimilarity").alias("__far"))
    j = g.join(n, sample).join(pairs, sample, "left")
    all_pairs = F.col("runs") * (F.col("runs") - 1) / 2
    far = F.when(F.coalesce("__pairs", F.lit(0)) < all_pairs, 1.0).otherwise(F.coalesce("__far", F.lit(0.0)))
    return j.select(
        sample, "runs", "root", "richness", F.col("__top.t").alias("top_taxon"), (F.col("__top.v") / F.col("root")).alias("top_share"), "entropy", *indicators,
        (F.col("root") < shallow).alias("is_shallow"), (far > apart).alias("is_discordant"),
    )


def universe(runs: DataFrame, study: str, run: str, signals: dict[str, str], text: str, prior: DataFrame) -> DataFrame:
    """(study, ``n_runs``, a count per signal, ``signal``, ``ambiguous``, ``prior_verdict``, ``class``): runs aggregated to studies and classified.

    ``signals`` maps a class to its pattern. ``signal`` is the class with most runs (ties by name), ``none`` without any; ``ambiguous`` where a second class has a third of them
    or more. A prior verdict decides the class; else the signal, ``review`` if ambiguous. Counts are 64-bit integers; columns come in a fixed order.
    """
    g = runs.where(F.col(study).isNotNull()).groupBy(study).agg(
        F.count_distinct(run).alias("n_runs"), *[F.count_if(F.coalesce(F.col(text).rlike(p), F.lit(False))).cast("long").alias(n) for n, p in signals.items()]
    )
    ranked = F.array_sort(F.array(*[F.struct((-F.col(n)).alias("k"), F.lit(n).alias("n")) for n in signals]))
    first, second = F.get(ranked, 0), F.get(ranked, 1)
    verdicts = prior.where(F.col(study).isNotNull()).groupBy(study).agg(F.min("verdict").alias("prior_verdict"))
    x = g.withColumn("signal", F.when(first["k"] < 0, first["n"]).otherwise("none")).withColumn("ambiguous", (second["k"] < 0) & (second["k"] * 3 <= first["k"]))
    j = x.join(verdicts, study, "left")
    cls = F.coalesce("prior_verdict", F.when(F.col("ambiguous"), "review").otherwise(F.col("signal")))
    return j.select(study, "n_runs", *signals, "signal", "ambiguous", F.coalesce("prior_verdict", F.lit("not_screened")).alias("prior_verdict"), cls.alias("class"))
