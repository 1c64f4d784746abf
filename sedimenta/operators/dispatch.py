"""Attribute rows dispatched by a field map: each key's parser makes a determination or a rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import texts as T
from sedimenta.functions.codes import BOOKS, coded
from sedimenta.functions.keys import folded, is_placeholder
from sedimenta.functions.quantities import dimension, parse_quantity, to_common, unit_of
from sedimenta.functions.times import keep, let

#: Parser names of code books: ``categorical_delivery`` uses the book ``delivery``, and so on.
PREFIX = "categorical_"


def apply_field_map(rows: DataFrame, latest_year: int = 2100) -> DataFrame:
    """(``attr_id``, ``sample_key``, ``study_accession``, ``field_name``, ``field_value``, ``value_normalized``, ``evidence_source``,
    ``evidence_quote``, ``note``, ``accepted``) of attribute rows with their field map columns (``eav.attributes``).

    One expression dispatches on ``parser``: quantities (``age_``, ``ga_``, ``bw_``, ``mass_``, ``length_``, ``temp_``) to the common unit of the text's own
    unit or the map's default, ``categorical_`` code books, ``timestamp_text`` a partial date, ``country`` and ``vocabulary`` the folded text, ``identifier`` and ``label``
    the trimmed text, ``percent_feeding`` the feeding book. Placeholders give no row; a value its parser cannot read is rejected with a note.
    The quote has at most twelve words. No exchange.
    """
    v, p, dim = F.col("value"), F.lower("parser"), dimension(F.col("parser"))

    def quantity(q: Column) -> Column:
        unit = F.coalesce(q["unit"], unit_of(F.col("unit_default"), dim))
        common = to_common(q, unit, dim)
        text = F.when(dim.isin("time", "mass"), F.round(common).cast("long").cast("string")).otherwise(F.round(common, 2).cast("string"))
        note = F.when(q.isNull(), "no quantity").when(common.isNull(), "bare number, no unit").otherwise(F.concat(F.lit("unit "), F.coalesce(unit, F.lit("in text"))))
        return F.struct(text.alias("code"), note.alias("note"))

    said = lambda c, note: F.struct(c.cast("string").alias("code"), F.lit(note).alias("note"))
    made = F.when(dim.isNotNull(), let(F.struct(parse_quantity(v, dim).alias("q")), lambda x: quantity(x["q"])))
    for name, rules in BOOKS.items():
        made = made.when(p == f"{PREFIX}{name}", coded(F.col("attr_key_norm"), v, rules))
    made = (
        made.when(p == "percent_feeding", coded(F.col("attr_key_norm"), v, BOOKS["feeding"]))
        .when(p == "timestamp_text", said(T.partial_date(v, latest_year), "date"))
        .when(p.isin("country", "vocabulary"), said(folded(v), "text"))
        .when(p.isin("identifier", "label"), said(F.trim(v), "text"))
        .otherwise(said(F.lit(None), "no parser"))
    )
    out = keep(rows.where(~is_placeholder(v)), "__c", made)
    key = F.col("attr_key_norm")
    quote = F.array_join(F.slice(F.split(F.concat(key, F.lit("="), F.trim(v)), r"\s+"), 1, 12), " ")
    return out.select(
        "attr_id", "sample_key", "study_accession", "field_name", F.substring(v, 1, 120).alias("field_value"), F.col("__c.code").alias("value_normalized"),
        F.concat(F.lit("sample.attr."), key).alias("evidence_source"), quote.alias("evidence_quote"), F.col("__c.note").alias("note"), F.col("__c.code").isNotNull().alias("accepted"),
    )
