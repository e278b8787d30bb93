"""Writers for sequences, reports, tables and the search cache."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biomeframe.functions.text import fmt_fixed
from biomeframe.operators.hits import (
    classification_metrics,
    krona_rows,
    organism_table,
    report_order,
)
from biomeframe.operators.sequences import unique_ids
from biomeframe.session import stored

#: Keys in one JSON object of a written cache.
CACHE_OBJECT_KEYS = 1000
REPORT_COLUMNS = ["percentage", "clade_reads", "taxon_reads", "rank", "taxid", "name"]


def write_fasta(df: DataFrame, path: str, mode: str = "errorifexists", rename: bool = True) -> None:
    """``>id`` and sequence lines in file order, repeated ids renamed.

    The sort is a range shuffle: the part files, read by name, are in order.
    """
    rows = unique_ids(df, out="id") if rename else df
    rows.orderBy("ord").select(F.format_string(">%s\n%s", "id", "seq").alias("value")).write.mode(
        mode
    ).text(path)


def write_fastq(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Four-line records in file order, as ``deinterleave`` mates need."""
    line = F.format_string("@%s\n%s\n+\n%s", "id", "seq", "qual")
    df.orderBy("ord").select(line.alias("value")).write.mode(mode).text(path)


def report_lines(report: DataFrame) -> DataFrame:
    """Six-column lines with a two-digit percentage; ``ord`` gives the order.

    Unclassified reads have no taxid, which is printed as 0.
    """
    cells = [fmt_fixed("percentage")] + [F.col(c).cast("string") for c in REPORT_COLUMNS[1:]]
    cells[4] = F.coalesce(cells[4], F.lit("0"))
    cells = [F.coalesce(c, F.lit("")) for c in cells]
    return report.select(F.concat_ws("\t", *cells).alias("value"), "ord")


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    report_lines(report).orderBy("ord").select("value").write.mode(mode).text(path)


def taxonomy_summary_text(results: DataFrame, n: int = 20) -> str:
    """The organism summary as text; collects one metrics row and ``n`` rows."""
    m = classification_metrics(results).first()
    head = [
        "BLAST TAXONOMIC CLASSIFICATION SUMMARY",
        "=" * 50,
        "",
        f"Total sequences analyzed: {m.n_results}",
        f"Sequences with hits: {m.n_with_hits}",
        f"Total BLAST hits: {m.total_hits}",
        f"Unique organisms identified: {m.n_organisms}",
        "",
    ]
    rule = "-" * 40
    if m.n_organisms:
        lines = (
            organism_table(results, n)
            .select(
                "rank_no",
                F.concat_ws(
                    " ",
                    F.rpad(F.substring("organism", 1, 29), 30, " "),
                    F.rpad(F.col("total_hits").cast("string"), 10, " "),
                    F.rpad(F.col("sequences_with_hits").cast("string"), 10, " "),
                    F.rpad(fmt_fixed("avg_hits_per_sequence", 1), 12, " "),
                ).alias("line"),
            )
            .orderBy("rank_no")
            .collect()
        )
        titles = f"{'Organism':<30} {'Total Hits':<10} {'Sequences':<10} {'Avg Hits/Seq':<12}"
        head += ["TOP ORGANISMS BY TOTAL HITS:", rule, titles, rule, *[r.line for r in lines]]
    else:
        head.append("No significant taxonomic matches found.")
    rate = "n/a" if m.classification_rate is None else f"{m.classification_rate:.1f}%"
    tail = ["", "QUALITY METRICS:", "-" * 20, f"Classification rate: {rate}"]
    if m.n_with_hits:
        tail.append(f"Average hits per classified sequence: {m.mean_hits_per_classified:.1f}")
    return "\n".join(head + tail) + "\n"


def annotation_summary_text(summary: DataFrame) -> str:
    """The four-line annotation summary of the one-row ``annotation_summary``."""
    r = summary.first()
    mean = "nan" if r.mean_pident is None else f"{r.mean_pident:.2f}"
    return (
        "Functional Annotation Summary\n" + "=" * 30 + "\n"
        f"Total Annotations: {r.n_annotations}\n"
        f"Mean Identity %: {mean}\n"
        f"High Quality Hits (>70%): {r.n_high_quality}\n"
        f"Excellent Hits (>90%): {r.n_excellent}\n"
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per line, so that any number of tasks can write."""
    df.write.mode(mode).json(path)


def json_array(df: DataFrame, order: str, limit: int) -> DataFrame:
    """One row holding a JSON array of the first ``limit`` rows by ``order``.

    For report tables that are a top-n by definition.
    """
    top = df.orderBy(order).limit(limit)
    columns = [c for c in df.columns if c != order]
    rows = F.sort_array(F.collect_list(F.struct(order, F.struct(*columns).alias("r"))))
    return top.agg(F.to_json(F.transform(rows, lambda x: x["r"])).alias("json"))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> None:
    df.write.mode(mode).option("header", header).option("sep", "\t").option("quote", "").csv(path)


def write_krona_input(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``hit_count`` and ``organism`` lines of a search report, in its order."""
    write_tsv(krona_rows(report.orderBy(*report_order())), path, mode)


def save_hit_cache(df: DataFrame, path: str) -> None:
    """Append results to the cache table, one folder per leading key digits.

    Old rows stay; ``latest_per_key`` picks the newest when the cache is read.
    Sorted ranges of keys give each task few folders, and narrow key ranges
    to the row groups.
    """
    (
        df.withColumn("bucket", F.substring("seq_md5", 1, 2))
        .repartitionByRange("seq_md5")
        .sortWithinPartitions("seq_md5")
        .write.mode("append")
        .partitionBy("bucket")
        .parquet(path)
    )


def write_hit_cache_json(df: DataFrame, path: str, per_object: int = CACHE_OBJECT_KEYS) -> None:
    """``(seq_md5, result)`` with one row per key as JSON objects, one per line.

    Keys are dealt by their hash to objects of about ``per_object`` keys, so no
    task or value grows with the cache. ``load_hit_cache`` reads the folder with
    ``multiline=False``.
    """
    df = stored(df, "cache-rows")
    objects = ceil(df.count() / per_object) or 1
    entries = F.collect_list(F.struct("seq_md5", "result"))
    (
        df.groupBy(F.pmod(F.xxhash64("seq_md5"), F.lit(objects)).alias("part"))
        .agg(F.to_json(F.map_from_entries(entries)).alias("value"))
        .select("value").write.text(path)
    )


def output_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(path, name, size_mb)`` of all files below ``path``; reads no content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.bround(F.col("length") / (1024 * 1024), 1).alias("size_mb"),
    ).orderBy("path")
