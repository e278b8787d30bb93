"""The analyses as dictionaries of lazy frames built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biomeframe.functions.sequence import translate_cds
from biomeframe.functions.text import organism_of
from biomeframe.operators import cache as cache_ops
from biomeframe.operators import hits as hit_ops
from biomeframe.operators import sequences as seq_ops
from biomeframe.operators import taxonomy as tax_ops
from biomeframe.operators.categories import category_report, top_factor_table
from biomeframe.operators.classify import classify_reads
from biomeframe.operators.orfs import orf_scan, orf_sequences
from biomeframe.operators.search import (
    Tier,
    similarity_search,
    tag_pathogenic,
    tiered_annotation,
    translated_search,
)
from biomeframe.session import stored
from biomeframe.sources.sequences import deinterleave, pair_up


def reads_to_abundance(
    reads: DataFrame,
    db: DataFrame,
    tree: DataFrame,
    k: int,
    kmer_distr: DataFrame | None = None,
    key: str = "ord",
    level: str = "S",
    threshold: int = 10,
) -> dict[str, DataFrame]:
    """FASTQ analysis: classified reads, clade report, abundance, chart rows.

    Without a k-mer distribution the clade report stands in for the abundance,
    as it does when the re-estimation fails.
    """
    calls = stored(classify_reads(reads, db, tree, k, key), "classified")
    report = stored(
        tax_ops.with_report_order(tax_ops.taxon_report(calls, tree), tree), "clade-report"
    )
    out = {"classified": calls, "report": report, "ranks": tax_ops.rank_profile(report)}
    if kmer_distr is None:
        shares = report.select("name", (F.col("percentage") / 100).alias("fraction_total_reads"), "ord")
    else:
        plain = report.withColumn("name", F.trim("name"))
        est = tax_ops.reestimate_abundance(plain, kmer_distr, tree, level, threshold)
        out["abundance"] = tax_ops.bracken_table(est)
        out["abundance_report"] = tax_ops.bracken_clade_report(est, tree)
        shares = est.join(
            report.select(F.col("taxid").alias("taxonomy_id"), "ord"), "taxonomy_id"
        ).select("name", "fraction_total_reads", "ord")
    out["overview"] = hit_ops.taxa_overview(shares)
    out["largest_taxa"] = hit_ops.taxa_overview(shares, by_size=True)
    return out


def reads_to_annotation(
    reads: DataFrame, tiers: list[tuple[str, DataFrame, float, float | None]], interleaved: bool = False,
    **options,
) -> dict[str, DataFrame]:
    """The functional half of a FASTQ analysis: reads as FASTA, then genes and proteins.

    ``interleaved`` says that mates alternate in ``reads``; ``pairs`` then tells
    which belong together. ``options`` go to ``annotate_contigs``.
    """
    fasta = stored(seq_ops.fastq_to_fasta(reads), "reads-fasta")
    out = {"fasta": fasta, **annotate_contigs(fasta, tiers, **options)}
    if interleaved:
        out["pairs"] = pair_up(deinterleave(reads))
    return out


def hits_to_results(work: DataFrame, hits: DataFrame, now: float) -> DataFrame:
    """Nest search hits into one result per searched sequence.

    A result is one value and holds all hits of its sequence; set a hit limit
    where a sequence may have millions.
    """
    record = F.struct(
        F.col("sseqid").alias("hit_id"),
        F.col("stitle").alias("hit_def"),
        F.col("length"),
        F.col("evalue").alias("e_value"),
        F.col("bitscore").alias("bit_score"),
        F.col("pident").alias("identity"),
        (F.col("query_span") / F.col("query_length") * 100).alias("query_cover"),
        organism_of("stitle").alias("organism"),
    )
    sized = hits.withColumn("query_span", F.col("qend") - F.col("qstart") + 1).join(
        work.select("ord", F.length("seq").alias("query_length")), "ord"
    )
    order = F.struct((-F.col("bitscore")).alias("s"), "sseqid", "qstart", record.alias("r"))
    nested = sized.groupBy("ord").agg(
        F.transform(F.sort_array(F.collect_list(order)), lambda x: x["r"]).alias("hits")
    )
    empty = F.array().cast(nested.schema["hits"].dataType)
    return work.join(nested, "ord", "left").select(
        F.col("id").alias("query_id"),
        F.length("seq").alias("query_length"),
        F.coalesce("hits", empty).alias("hits"),
        F.lit(float(now)).alias("timestamp"),
        F.lit(None).cast("string").alias("error"),
        "ord",
        "seq_md5",
    )


def organism_reports(results: DataFrame) -> dict[str, DataFrame]:
    """All organism tables of one stored frame of results."""
    report = hit_ops.kraken_style_report(results)
    return {
        "metrics": hit_ops.classification_metrics(results),
        "counts": hit_ops.organism_hit_counts(hit_ops.explode_hits(results)),
        "report": report,
        "comparison": hit_ops.organism_comparison(results),
        "krona": hit_ops.krona_rows(report),
    }


def contigs_to_organisms(
    contigs: DataFrame,
    ref: DataFrame,
    cache: DataFrame,
    now: float,
    k: int = 28,
    max_sequences: int | None = None,
    min_len: int = 50,
    hitlist: int | None = None,
) -> dict[str, DataFrame]:
    """FASTA analysis: search what the cache lacks, then count organisms.

    ``cache`` is ``(seq_md5, result, timestamp)``. The first-n limit and the limit
    of subjects (``hitlist``) are part of the interface and off by default. New results are returned as ``to_cache``.
    """
    chosen = contigs if max_sequences is None else seq_ops.take_first(contigs, max_sequences)
    chosen = seq_ops.min_length(chosen, min_len)
    known = cache_ops.latest_per_key(cache_ops.fresh_entries(cache, now))
    found, work = cache_ops.lookup_cache(chosen, known.select("seq_md5", "result"))
    work = stored(work, "search-work")
    limited = stored(similarity_search(work, ref, k), "search-hits")
    if hitlist is not None:
        named = limited.drop("qseqid").withColumn("qseqid", F.col("ord").cast("string"))
        limited = hit_ops.hit_limit(named, hitlist)
    fresh = stored(hits_to_results(work, limited, now), "search-results")
    keyed = seq_ops.with_seq_key(chosen).select("id", "ord", "seq_md5", F.length("seq").alias("n"))
    columns = ["hits", "timestamp", "error"]
    new = keyed.join(fresh.select("seq_md5", *columns), "seq_md5").select(
        F.col("id").alias("query_id"), F.col("n").alias("query_length"), *columns, "ord"
    )
    old = found.select(
        F.col("id").alias("query_id"),
        F.length("seq").alias("query_length"),
        *[F.col(f"result.{c}").alias(c) for c in columns],
        "ord",
    )
    results = stored(new.unionByName(old), "results")
    to_cache = cache_ops.cacheable(fresh).select(
        "seq_md5",
        F.struct("query_id", "query_length", "hits", "timestamp", "error").alias("result"),
        "timestamp",
    )
    return {"results": results, "to_cache": to_cache, **organism_reports(results)}


def scan_contigs(
    contigs: DataFrame, proteins: DataFrame, kind: str, k: int = 5, top_percent: float = 5, **search
) -> dict[str, DataFrame]:
    """Resistance (``amr``) or virulence (``vf``) scan and its report tables.

    ``search`` goes to ``translated_search``: a matrix, gaps and spaced seeds find
    relatives that share few words of ``k`` letters.
    """
    hits = stored(translated_search(contigs, proteins, k, **search), "scan-hits")
    best = stored(hit_ops.within_top_percent(hits, top_percent), "scan-best")
    good = hit_ops.high_quality(best)
    return {
        "hits": best,
        **category_report(best, kind),
        "top_factors": top_factor_table(best),
        "histogram": hit_ops.identity_histogram(good),
        "scatter": hit_ops.quality_scatter(good),
    }


def scan_pathogens(
    contigs: DataFrame,
    proteins: DataFrame,
    id2taxid: DataFrame,
    taxids: DataFrame,
    k: int = 5,
    top_percent: float = 3,
    **search,
) -> dict[str, DataFrame]:
    """Pathogen screen: tagged hits, counts per tag, first 20 rows. ``search`` as in ``scan_contigs``."""
    hits = stored(translated_search(contigs, proteins, k, **search), "pathogen-hits")
    best = hit_ops.within_top_percent(hits, top_percent)
    tagged = stored(tag_pathogenic(best, id2taxid, taxids), "pathogen-tagged")
    return {
        "hits": tagged,
        "counts": hit_ops.pathogenic_counts(tagged),
        "table": hit_ops.head_rows(tagged, 20).select("staxids", "pident", "bitscore"),
    }


def annotate_contigs(
    contigs: DataFrame, tiers: list[tuple[str, DataFrame, float, float | None]], k: int = 5,
    min_len: int = 90, top_percent: float = 1, swissprot: DataFrame | None = None,
    max_evalue: float = 1e-5,
) -> dict[str, DataFrame]:
    """Gene finding and protein annotation.

    ``tiers`` are ``(name, proteins, max_evalue, min_cover)`` in order. ``hits``,
    ``quality`` and ``summary`` come from a search of their own, of all proteins
    in ``swissprot`` at ``max_evalue``, within ``top_percent`` of the best score.
    """
    orfs = orf_scan(contigs, min_len)
    genes = translate_cds(orf_sequences(orfs, contigs), "cds")
    place = F.concat_ws("_", "id", F.col("start").cast("string"), F.col("end").cast("string"), "strand")
    proteins = stored(genes.withColumn("qseqid", F.concat_ws(":", F.col("ord").cast("string"), place)), "proteins")
    queries = proteins.select(
        F.col("qseqid").alias("id"), F.xxhash64("qseqid").alias("ord"), F.col("protein").alias("seq")
    )
    lengths = proteins.select("qseqid", F.length("protein").alias("qlen"))
    built = []
    for name, ref, limit, min_cover in tiers:
        hits = similarity_search(queries, ref, k, max_evalue=limit, protein=True)
        hits = hits.join(lengths, "qseqid").withColumn("cover", F.col("length") / F.col("qlen") * 100)
        built.append(Tier(name, hits, limit, min_cover))
    out = {"orfs": orfs, "proteins": proteins}
    if built:
        out["annotation"] = tiered_annotation(proteins, built)
    if swissprot is not None:
        hits = stored(similarity_search(queries, swissprot, k, max_evalue=max_evalue, protein=True), "protein-hits")
        best = stored(hit_ops.within_top_percent(hits, top_percent), "protein-best")
        out["hits"] = best
        out["quality"] = hit_ops.quality_distribution(best)
        out["summary"] = hit_ops.annotation_summary(best)
    return out
