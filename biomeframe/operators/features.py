"""Feature files, and the manifest of produced files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Name parts that put a file into a report group.
ARTIFACT_TERMS = {
    "taxonomy": ["taxonomy", "kraken", "bracken", "krona"],
    "functional": ["swissprot", "prokka", "functional", "3d_annotation"],
    "pathogen": ["pathogen", "blast"],
    "quality": ["length", "gc", "quality", "summary"],
}

DASHBOARD = "analysis_dashboard.html"

# Files the analysis summary looks for.
KEY_ARTIFACTS = [
    "taxonomy_overview.html",
    "pathogen_summary.html",
    "annotation_quality.html",
    "krona.html",
]


def feature_counts(gff: DataFrame) -> DataFrame:
    return gff.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def annotation_stats(gff: DataFrame, contigs: DataFrame) -> DataFrame:
    """One row: contigs, bases and coding features."""
    cds = gff.agg(F.count_if(F.col("type") == "CDS").alias("n")).scalar()
    return contigs.agg(
        F.count(F.lit(1)).alias("contigs"),
        F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("bases"),
    ).select("contigs", "bases", cds.alias("cds"))


def artifact_groups(manifest: DataFrame) -> DataFrame:
    """One row per HTML report and group it belongs to; ``other`` if to none.

    Other files are no reports, and the dashboard does not list itself.
    """
    reports = manifest.filter(F.col("name").endswith(".html") & (F.col("name") != DASHBOARD))
    tags = []
    for tag, terms in ARTIFACT_TERMS.items():
        hit = F.lit(False)
        for term in terms:
            hit = hit | F.col("name").contains(term)
        tags.append(F.when(hit, tag))
    found = F.array_compact(F.array(*tags))
    groups = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("other")))
    return reports.withColumn("group", F.explode(groups))


def report_counts(manifest: DataFrame) -> DataFrame:
    return artifact_groups(manifest).groupBy("group").agg(F.count(F.lit(1)).alias("n"))


def ungrouped_artifacts(manifest: DataFrame) -> DataFrame:
    return artifact_groups(manifest).filter(F.col("group") == "other").drop("group")


def key_artifacts(manifest: DataFrame) -> DataFrame:
    """Expected report files that exist."""
    return manifest.filter(F.col("name").isin(KEY_ARTIFACTS))


def missing_items(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected ``(label, path, required)`` without a matching present ``path``."""
    label = F.when(F.col("required"), "required").otherwise("optional")
    return expected.join(present.select("path"), "path", "left_anti").withColumn("need", label)
