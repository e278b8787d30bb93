"""Open reading frames without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biomeframe.functions.sequence import START_CODONS, STOP_CODONS, codons, strand_frames


def _mark(codon):
    return (
        F.when(codon.isin(*STOP_CODONS), "*").when(codon.isin(*START_CODONS), "M").otherwise(".")
    )


def orf_scan(df: DataFrame, min_len: int = 90, keep: tuple[str, ...] = ("id", "ord")) -> DataFrame:
    """``(keep, start, end, strand, frame)`` of the maximal ORFs on both strands.

    An ORF runs from the first start codon (ATG, GTG, TTG) after a stop to the
    next stop, which it includes. Positions are 1-based on the forward strand.

    Each frame becomes a string with one mark per codon; the stops cut it into
    islands that are exploded into rows. Everything happens inside the row of
    a sequence, so nothing is shuffled and a long contig is no group of rows.
    """
    rows = strand_frames(df.select(*keep, "seq"), keep=keep)
    marks = rows.select(
        *keep,
        "strand",
        "frame",
        F.length("_dna").alias("n"),
        F.explode(F.array(F.array_join(codons("_dna", F.col("frame"), _mark), "").cast("binary"))).alias("m"),
    )
    stops = F.filter(
        F.when(F.length("m") > 0, F.sequence(F.lit(1), F.length("m"))),
        lambda i: F.col("m").substr(i, F.lit(1)) == F.lit(b"*"),
    )
    pairs = marks.withColumn("stops", F.explode(F.array(stops))).select(
        *keep,
        "strand",
        "frame",
        "n",
        "m",
        F.explode(
            F.arrays_zip(
                F.concat(F.array(F.lit(0)), F.col("stops")).alias("prev"),
                F.col("stops").alias("stop"),
            )
        ).alias("p"),
    )
    prev, stop = F.col("p.prev"), F.col("p.stop")
    island = F.col("m").substr(prev + 1, stop - prev).cast("string")
    found = (
        pairs.filter(stop.isNotNull())
        .withColumn("at", F.instr(island, "M"))
        .filter(F.col("at") > 0)
        .select(
            *keep,
            "strand",
            "frame",
            "n",
            (F.col("frame") + (prev + F.col("at") - 1) * 3).alias("s"),
            (F.col("frame") + stop * 3 - 1).alias("e"),
        )
        .filter(F.col("e") - F.col("s") + 1 >= min_len)
    )
    plus = F.col("strand") == "+"
    return found.select(
        *keep,
        F.when(plus, F.col("s")).otherwise(F.col("n") - F.col("e") + 1).alias("start"),
        F.when(plus, F.col("e")).otherwise(F.col("n") - F.col("s") + 1).alias("end"),
        "strand",
        "frame",
    )


def orf_sequences(orfs: DataFrame, contigs: DataFrame, key: str = "ord") -> DataFrame:
    """Add ``cds``, the coding sequence of each ORF on its own strand."""
    from biomeframe.functions.sequence import reverse_complement

    piece = F.expr("cast(substring(_bin, start, end - start + 1) as string)")
    text = contigs.select(key, F.upper("seq").cast("binary").alias("_bin"))
    return orfs.join(text, key).select(
        *orfs.columns,
        F.when(F.col("strand") == "+", piece).otherwise(reverse_complement(piece)).alias("cds"),
    )
