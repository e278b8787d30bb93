"""Filters, projections and aggregates over search results and hit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biomeframe.functions.text import identity_band, IDENTITY_BANDS
from biomeframe.operators.skew import salted_join, with_key_stats


# --- results to hits ---------------------------------------------------------


def drop_errors(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNull())


def explode_hits(results: DataFrame) -> DataFrame:
    """One row per hit of the successful results; ``pos`` is its place."""
    return drop_errors(results).select(
        "ord", "query_id", "query_length", F.posexplode("hits").alias("pos", "h")
    ).select("ord", "query_id", "query_length", "pos", "h.*")


def hit_metrics(alignments: DataFrame) -> DataFrame:
    """Add ``identity`` and ``query_cover`` in percent to raw alignments."""
    span = F.col("query_end") - F.col("query_start") + 1
    return alignments.withColumn(
        "identity", F.col("identities") / F.col("align_length") * 100
    ).withColumn("query_cover", span / F.col("query_length") * 100)


def significant_hits(hits: DataFrame, max_evalue: float = 1e-5) -> DataFrame:
    return hits.filter(F.col("e_value") <= max_evalue)


def high_quality(hits: DataFrame, min_pident: float = 70, max_evalue: float = 1e-10) -> DataFrame:
    return hits.filter((F.col("pident") >= min_pident) & (F.col("evalue") <= max_evalue))


def top_columns(hits: DataFrame) -> DataFrame:
    return hits.select("sseqid", "pident", "evalue", "stitle")


# --- organisms ---------------------------------------------------------------


def organism_hit_counts(hits: DataFrame) -> DataFrame:
    """``(organism, total_hits, sequences_with_hits, avg_hits_per_sequence,
    first_seen)``.

    Counted per (organism, sequence) first, so an organism that owns most hits
    is spread over its sequences before it meets in one reducer. ``first_seen``
    is the place (ord, pos) as one number, which hash aggregates can hold.
    """
    place = F.col("ord").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos")
    named = hits.select(
        F.coalesce("organism", F.lit("Unknown")).alias("organism"), "query_id", place.alias("seen")
    )
    per_query = named.groupBy("organism", "query_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("seen").alias("seen")
    )
    out = per_query.groupBy("organism").agg(
        F.sum("n").alias("total_hits"),
        F.count(F.lit(1)).alias("sequences_with_hits"),
        F.min("seen").alias("first_seen"),
    )
    return out.select(
        "organism",
        "total_hits",
        "sequences_with_hits",
        avg_hits(F.col("total_hits"), F.col("sequences_with_hits")).alias("avg_hits_per_sequence"),
        "first_seen",
    )


def avg_hits(hits: Column, sequences: Column) -> Column:
    return F.when(sequences > 0, hits / sequences).otherwise(F.lit(0.0))


def organism_order() -> list[Column]:
    """Most hits first; equal counts in the order in which they were seen."""
    return [F.desc("total_hits"), F.asc("first_seen")]


def top_organisms(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(*organism_order()).limit(n)


def _ranked(counts: DataFrame, n: int) -> DataFrame:
    """The first ``n`` organisms with their place; the window sees n rows."""
    top = top_organisms(counts, n)
    place = F.row_number().over(Window.orderBy(*organism_order()))
    return top.withColumn("rank_no", place)


def organism_table(results: DataFrame, n: int) -> DataFrame:
    """Top-n comparison: organism, hits, sequences, hits per sequence, place."""
    return _ranked(organism_hit_counts(explode_hits(results)), n).select(
        "rank_no", "organism", "total_hits", "sequences_with_hits", "avg_hits_per_sequence"
    )


def organism_comparison(results: DataFrame, n: int = 10) -> DataFrame:
    return organism_table(results, n)


def classification_metrics(results: DataFrame) -> DataFrame:
    """One row of totals. Failed searches count as analysed, and only there."""
    ok = F.col("error").isNull()
    n_hits = F.when(ok, F.coalesce(F.size("hits"), F.lit(0))).otherwise(0)
    organisms = explode_hits(results).agg(
        F.count_distinct(F.coalesce("organism", F.lit("Unknown"))).alias("n")
    )
    totals = results.agg(
        F.count(F.lit(1)).alias("n_results"),
        F.count_if(ok).alias("n_ok"),
        F.count_if(n_hits > 0).alias("n_with_hits"),
        F.coalesce(F.sum(n_hits), F.lit(0)).cast("long").alias("total_hits"),
    )
    n, hit = F.col("n_results"), F.col("n_with_hits")
    return totals.select(
        "*",
        organisms.scalar().alias("n_organisms"),
        F.when(n > 0, hit / n * 100).alias("classification_rate"),
        F.when(hit > 0, F.col("total_hits") / hit).alias("mean_hits_per_classified"),
    )


def kraken_style_report(results: DataFrame) -> DataFrame:
    """Six report columns and ``first_seen``/``top`` to order them by.

    The first row (``top`` = 1) is the share of unclassified sequences; the
    percentages of the other rows are shares of all hits.
    """
    counts = organism_hit_counts(explode_hits(results))
    m = classification_metrics(results).select("n_ok", "n_with_hits", "total_hits")
    missed = F.col("n_ok") - F.col("n_with_hits")
    head = m.select(
        F.lit(1).alias("top"),
        F.when(F.col("n_ok") > 0, missed / F.col("n_ok") * 100).otherwise(0.0).alias("percentage"),
        missed.alias("clade_reads"),
        missed.alias("taxon_reads"),
        F.lit("U").alias("rank"),
        F.lit(0).cast("long").alias("taxid"),
        F.lit("unclassified").alias("name"),
        F.lit(None).cast(counts.schema["first_seen"].dataType).alias("first_seen"),
    )
    all_hits = m.select("total_hits").scalar()
    rows = counts.select(
        F.lit(0).alias("top"),
        (F.col("total_hits") / all_hits * 100).alias("percentage"),
        F.col("total_hits").alias("clade_reads"),
        F.col("sequences_with_hits").alias("taxon_reads"),
        F.lit("S").alias("rank"),
        F.lit(0).cast("long").alias("taxid"),
        F.col("organism").alias("name"),
        "first_seen",
    )
    return head.unionByName(rows)


def report_order() -> list[Column]:
    return [F.desc("top"), F.desc("clade_reads"), F.asc("first_seen")]


def krona_rows(report: DataFrame, min_percentage: float = 0.1) -> DataFrame:
    """``(hit_count, organism)`` of the rows above a printed percentage."""
    shown = F.bround("percentage", 2)
    return report.filter((F.col("name") != "unclassified") & (shown > min_percentage)).select(
        F.col("clade_reads").alias("hit_count"), F.col("name").alias("organism")
    )


# --- hit tables --------------------------------------------------------------


def within_top_percent(hits: DataFrame, percent: float, spread: list[str] | None = None) -> DataFrame:
    """Hits whose bit score is within ``percent`` % of their query's best."""
    best = with_key_stats(hits, ["qseqid"], F.max("bitscore").alias("_best"), spread=spread)
    return best.filter(F.col("bitscore") >= F.col("_best") * (1 - percent / 100)).drop("_best")


def hit_limit(hits: DataFrame, n: int = 10) -> DataFrame:
    """All alignments of the ``n`` best subjects of each query.

    The rank filter is applied per map task before the shuffle, so a query
    with very many subjects sends only ``n`` rows from each task.
    """
    subjects = hits.groupBy("qseqid", "sseqid").agg(
        F.max("bitscore").alias("_best"), F.min("ord").alias("_first")
    )
    place = Window.partitionBy("qseqid").orderBy(F.desc("_best"), "_first", "sseqid")
    kept = subjects.withColumn("_r", F.row_number().over(place)).filter(F.col("_r") <= n)
    return salted_join(hits, kept.select("qseqid", "sseqid"), ["qseqid", "sseqid"], "left_semi")


def top_hits(hits: DataFrame, n: int, ties: tuple[str, ...] = ("ord",)) -> DataFrame:
    """The ``n`` best bit scores; equal scores in file order."""
    return hits.orderBy(F.desc("bitscore"), *ties).limit(n)


def head_rows(df: DataFrame, n: int, order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """The first ``n`` rows in file order."""
    return df.orderBy(*order).limit(n)


def quality_scatter(hits: DataFrame) -> DataFrame:
    """Points of the identity/e-value plot; log10 of a zero e-value is null."""
    log = F.when(F.col("evalue") > 0, F.log10("evalue"))
    return hits.select(
        "pident", "evalue", log.alias("log10_evalue"), "bitscore", "sseqid", "stitle"
    )


def identity_histogram(hits: DataFrame, bins: int = 20) -> DataFrame:
    """``(bin, low, high, n)`` over equal bins of 0..100, last one closed."""
    width = 100.0 / bins
    index = F.least(F.floor(F.col("pident") / width), F.lit(bins - 1)).cast("int")
    return (
        hits.filter(F.col("pident").between(0, 100))
        .groupBy(index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("bin") * width).alias("low"), ((F.col("bin") + 1) * width).alias("high"), "n")
    )


def quality_distribution(hits: DataFrame) -> DataFrame:
    """``(band, n)`` for all five identity bands, empty ones as 0."""
    labels = [label for _, _, label in IDENTITY_BANDS]
    counts = hits.agg(*[F.count_if(identity_band("pident") == b).alias(b) for b in labels])
    return counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"`{b}`").alias("n")) for b in labels])
        ).alias("x")
    ).select("x.*")


def annotation_summary(hits: DataFrame) -> DataFrame:
    p = F.col("pident")
    return hits.agg(
        F.count(F.lit(1)).alias("n_annotations"),
        F.avg(p).alias("mean_pident"),
        F.count_if(p > 70).alias("n_high_quality"),
        F.count_if(p > 90).alias("n_excellent"),
    )


def pathogenic_counts(hits: DataFrame) -> DataFrame:
    """``(Pathogenic, n)``, nulls dropped, most frequent first."""
    return (
        hits.filter(F.col("Pathogenic").isNotNull())
        .groupBy("Pathogenic")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "Pathogenic")
    )


def significant_taxa(abundance: DataFrame, min_fraction: float = 0.001) -> DataFrame:
    return abundance.filter(F.col("fraction_total_reads") > min_fraction)


def clean_names(abundance: DataFrame) -> DataFrame:
    return abundance.withColumn("name", F.trim("name"))


def taxa_overview(abundance: DataFrame, n: int = 10, by_size: bool = False) -> DataFrame:
    """Rows of the taxa chart, ascending by share.

    The first ``n`` significant taxa in file order, or the largest ones.
    """
    rows = clean_names(significant_taxa(abundance))
    order = [F.desc("fraction_total_reads"), F.asc("ord")] if by_size else [F.asc("ord")]
    return rows.orderBy(*order).limit(n).orderBy("fraction_total_reads", F.desc("ord"))
