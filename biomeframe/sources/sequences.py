"""FASTA and FASTQ readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biomeframe.functions.text import base_id
from biomeframe.sources.lines import file_ord, numbered_records


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """``(id, description, seq, ord)`` of multi-line FASTA records.

    The record separator is ``\\n>``, so plain files are split and every task
    reads whole records. A record must fit in one row (2 GB).
    """
    records = numbered_records(spark, path, "\n>")
    text = F.regexp_replace("value", r"^>", "")
    parsed = records.filter(F.trim(F.col("value")) != "").select(
        F.trim(F.regexp_extract(text, r"^([^\r\n]*)", 1)).alias("description"),
        F.regexp_replace(F.regexp_replace(text, r"^[^\n]*(\n|$)", ""), r"\s", "").alias("seq"),
        file_ord().alias("ord"),
    )
    return parsed.select(base_id("description").alias("id"), "description", "seq", "ord")


def read_fastq(spark: SparkSession, path, strict: bool = True) -> DataFrame:
    """``(id, seq, qual, ord)`` of four-line FASTQ records, plain or gzip.

    Lines are numbered first: a quality line may begin with ``@``, so the text
    cannot be cut at that sign. ``strict`` stops on a record whose lines do not
    fit together; otherwise such records are left out. Reads of no letters are
    reads; blank lines after the last record are not.
    """
    lines = numbered_records(spark, path)
    place = F.col("n") % 4
    record = lines.groupBy("file_rank", F.floor(F.col("n") / 4).cast("long").alias("rec")).agg(
        *[
            F.max(F.when(place == i, F.regexp_replace("value", r"\r$", ""))).alias(name)
            for i, name in enumerate(["head", "seq", "plus", "qual"])
        ]
    )
    # Reads may be empty; four blank lines or fewer are the end of a file.
    blank = F.trim(F.concat_ws("", "head", "seq", "plus", "qual")) == ""
    record = record.filter(~blank)
    fits = F.coalesce(
        F.col("head").startswith("@")
        & F.col("plus").startswith("+")
        & (F.length("seq") == F.length("qual")),
        F.lit(False),
    )
    if strict:
        bad = F.raise_error(F.format_string("malformed FASTQ record %d", F.col("rec")))
        record = record.withColumn("seq", F.when(fits, F.col("seq")).otherwise(bad.cast("string")))
    else:
        record = record.filter(fits)
    return record.select(
        base_id(F.expr("substring(head, 2)")).alias("id"),
        "seq",
        "qual",
        file_ord("file_rank", "rec").alias("ord"),
    )


def read_paired(spark: SparkSession, r1, r2) -> DataFrame:
    """Two mate files in one frame; record i of each gets the same ``pair_id``."""
    mates = [
        read_fastq(spark, p).withColumn("mate", F.lit(m)).withColumn("pair_id", F.col("ord"))
        for m, p in ((1, r1), (2, r2))
    ]
    return mates[0].unionByName(mates[1])


def deinterleave(reads: DataFrame) -> DataFrame:
    """Add ``mate`` (1, 2 alternating in file order) and ``pair_id``."""
    return reads.withColumn("mate", (F.col("ord") % 2 + 1).cast("int")).withColumn(
        "pair_id", F.floor(F.col("ord") / 2).cast("long")
    )


def pair_up(reads: DataFrame) -> DataFrame:
    """Wide pairs ``(pair_id, id1, seq1, qual1, id2, seq2, qual2)``.

    A conditional aggregate joins the mates with one shuffle. ``same_name``
    compares the ids without a trailing /1 or /2.
    """
    sides = [
        F.max(F.when(F.col("mate") == m, F.col(c))).alias(f"{c}{m}")
        for m in (1, 2)
        for c in ("id", "seq", "qual")
    ]
    bare = [F.regexp_replace(f"id{m}", r"/[12]$", "") for m in (1, 2)]
    return reads.groupBy("pair_id").agg(*sides).withColumn("same_name", bare[0] == bare[1])
