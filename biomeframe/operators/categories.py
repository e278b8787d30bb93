"""Keyword-classified reports of resistance and virulence hits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biomeframe.functions.text import (
    RESISTANCE_CLASSES,
    VIRULENCE_CATEGORIES,
    fmt_sci,
    keyword_category,
    shorten,
)
from biomeframe.operators.hits import high_quality, top_hits

KINDS = {
    "amr": (RESISTANCE_CLASSES, "antimicrobial resistance genes", "resistance_classes"),
    "vf": (VIRULENCE_CATEGORIES, "virulence factors", "virulence_categories"),
}


def classify_hits(
    hits: DataFrame, dictionary: Mapping[str, Sequence[str]], lower_keywords: bool = True
) -> DataFrame:
    """High-quality hits with their category; a narrow step without shuffle."""
    return high_quality(hits).withColumn(
        "category", keyword_category("stitle", dictionary, lower_keywords=lower_keywords)
    )


def category_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def category_members(classified: DataFrame) -> DataFrame:
    """Long form of the members: one row per hit, ordered by ``ord``.

    A category may hold any share of the hits, so it is never gathered into
    one array; sort or write by (category, ord) to get the nested order.
    """
    return classified.select(
        "category",
        F.col("sseqid").alias("gene"),
        F.col("pident").alias("identity"),
        "evalue",
        F.col("stitle").alias("description"),
        "ord",
    )


def category_report(hits: DataFrame, kind: str) -> dict[str, DataFrame]:
    """The report of one scan, of one shape at any size.

    ``summary``, ``counts``, ``members`` and ``top_hits`` are frames.
    ``document`` is one JSON row with the summary, the total, the count of each
    category and the ten best hits; ``member_lines`` has the members as JSON,
    one line each, to be written in the order of (category, ord). A scan
    without hits gives zeros.
    """
    dictionary, label, field = KINDS[kind]
    classified = classify_hits(hits, dictionary)
    members = category_members(classified)
    counts = category_counts(classified)
    best = top_hits(classified, 10)
    summary = classified.agg(F.count(F.lit(1)).alias("total_hits")).select(
        F.when(F.col("total_hits") == 0, F.lit(f"No {label} detected"))
        .otherwise(F.format_string(f"Detected %d high-confidence {label}", "total_hits"))
        .alias("summary"),
        "total_hits",
    )
    per_category = counts.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("category", "n")))).alias("x")
    )
    record = F.struct("sseqid", "pident", "evalue", "stitle").alias("r")
    first = best.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("bitscore")).alias("s"), "ord", record))),
            lambda x: x["r"],
        ).alias("x")
    )
    document = summary.select(
        F.to_json(
            F.struct(
                "summary",
                "total_hits",
                per_category.scalar().alias(field),
                first.scalar().alias("top_hits"),
            )
        ).alias("json")
    )
    line = F.to_json(F.struct("category", "gene", "identity", "evalue", "description"))
    return {
        "summary": summary,
        "counts": counts,
        "members": members,
        "top_hits": best.select("sseqid", "pident", "evalue", "stitle"),
        "document": document,
        "member_lines": members.select("category", "ord", line.alias("json")),
    }


def top_factor_table(hits: DataFrame, n: int = 15, ties: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Printed columns of the best high-quality hits: identity to one digit, short texts."""
    return top_hits(high_quality(hits), n, ties).select(
        F.col("sseqid").alias("gene_id"),
        F.bround("pident", 1).alias("identity_pct"),
        fmt_sci("evalue").alias("e_value"),
        shorten("stitle", 50).alias("description"),
    )
