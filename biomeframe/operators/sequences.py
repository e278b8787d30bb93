"""Operators over sequence tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biomeframe.functions.sequence import gc_fraction, seq_key
from biomeframe.functions.text import base_id, mean_quality
from biomeframe.operators.skew import BROADCAST_ROWS, running_total
from biomeframe.session import stored


def min_length(df: DataFrame, n: int = 50) -> DataFrame:
    return df.filter(F.length("seq") >= n)


def take_first(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` sequences by file order, short ones included."""
    return df.orderBy("ord").limit(n)


def with_seq_key(df: DataFrame) -> DataFrame:
    return df.withColumn("seq_md5", seq_key("seq"))


def read_quality_filter(df: DataFrame, min_len: int = 35, min_q: float = 20) -> DataFrame:
    """Reads long enough and with a mean Phred+33 quality of at least ``min_q``."""
    return df.filter((F.length("seq") >= min_len) & (mean_quality("qual") >= min_q))


def unique_ids(df: DataFrame, out: str = "unique_id", bucket: int = 1 << 20) -> DataFrame:
    """Rename repeated ids in file order; ``ord`` must be unique.

    The first record of an id keeps its first header token; later ones become
    ``id_N`` with one counter over all ids. Only ids and places are counted:
    the first records come from a map-side combined minimum, so an id with a
    third of all records is no hot key, the counter is a running sum over order
    ranges of the repeats alone, and the new names are joined back by place.
    """
    places = df.select("ord", base_id("id").alias("_base"))
    firsts = places.groupBy("_base").agg(F.min("ord").alias("ord"))
    repeats = stored(places.join(firsts.select("ord"), "ord", "left_anti"), "repeats")
    counted = running_total(repeats.withColumn("_one", F.lit(1)), "ord", "_one", "_n", bucket)
    names = counted.select(
        "ord", F.concat_ws("_", "_base", (F.col("_n") - 1).cast("string")).alias("_name")
    )
    renamed = df.join(F.broadcast(names) if repeats.count() <= BROADCAST_ROWS else names, "ord", "left")
    return renamed.withColumn(out, F.coalesce("_name", base_id("id"))).drop("_name")


def fastq_to_fasta(reads: DataFrame) -> DataFrame:
    """Reads without quality, repeated ids renamed."""
    return unique_ids(reads.select("id", "seq", "ord"), out="id")


def merge_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """All of R1, then all of R2, as one set with a joint ``ord``.

    Mate 2 is shifted by the last ordinal of mate 1, a scalar subquery.
    """
    shift = r1.agg(F.coalesce(F.max("ord") + 1, F.lit(0)).alias("n")).scalar()
    first = r1.withColumn("mate", F.lit(1))
    second = r2.withColumn("mate", F.lit(2)).withColumn("ord", F.col("ord") + shift)
    return first.unionByName(second)


def validate_sequences(df: DataFrame, min_len: int = 50, max_sequences: int = 1000) -> DataFrame:
    """One row ``(ok, message)``."""
    t = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.length("seq") >= min_len).alias("valid")
    )
    n, valid = F.col("n"), F.col("valid")
    return t.select(
        ((n > 0) & (valid > 0)).alias("ok"),
        F.when(n == 0, "No sequences found in FASTA file")
        .when(valid == 0, f"No sequences longer than {min_len} bp found")
        .when(
            n > max_sequences,
            F.format_string(
                f"Warning: %d sequences found, will process first {max_sequences}", n
            ),
        )
        .otherwise(F.format_string("Ready to process %d sequences", valid))
        .alias("message"),
    )


def nx(lengths: DataFrame, share: float = 0.5, length: str = "len") -> DataFrame:
    """N50 (or another share): one row ``nx``.

    Lengths are counted first, so the running sum covers distinct lengths, in
    ranges; a length shared by a third of all contigs is one row.
    """
    per_length = lengths.groupBy(F.col(length).cast("long").alias("len")).agg(
        F.sum(F.col(length).cast("long")).alias("bases")
    )
    running = running_total(
        per_length.withColumn("_desc", -F.col("len")), "_desc", "bases", "covered", 1 << 16
    )
    total = per_length.agg(F.sum("bases").alias("t")).scalar()
    return running.filter(F.col("covered") >= total * share).agg(F.max("len").alias("nx"))


def assembly_stats(df: DataFrame) -> DataFrame:
    """One row: contigs, bases, length distribution, GC and N50."""
    n = F.length("seq")
    gc = n - F.length(F.translate("seq", "GCgc", ""))
    t = df.agg(
        F.count(F.lit(1)).alias("contigs"),
        F.sum(n).alias("bases"),
        F.min(n).alias("min_len"),
        F.max(n).alias("max_len"),
        F.avg(n).alias("mean_len"),
        F.median(n).alias("median_len"),
        F.sum(gc).alias("_gc"),
    )
    n50 = nx(df.select(n.alias("len"))).scalar()
    return t.select(
        "contigs",
        "bases",
        "min_len",
        "max_len",
        "mean_len",
        "median_len",
        F.when(F.col("bases") > 0, F.col("_gc") / F.col("bases")).alias("gc"),
        n50.alias("n50"),
    )


def length_distribution(df: DataFrame, width: int = 100) -> DataFrame:
    """``(bin, low, contigs, bases)`` over length bins of ``width``."""
    n = F.length("seq").cast("long")
    return (
        df.groupBy(F.floor(n / width).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("contigs"), F.sum(n).alias("bases"))
        .select("bin", (F.col("bin") * width).alias("low"), "contigs", "bases")
    )


def gc_content(df: DataFrame) -> DataFrame:
    return df.withColumn("gc", gc_fraction("seq"))
