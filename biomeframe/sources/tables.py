"""Hit tables, taxonomy reports, feature files and search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biomeframe.sources.lines import file_ord, numbered_records

REPORT_SCHEMA = (
    "percentage double, clade_reads long, taxon_reads long, rank string, taxid long, name string"
)
ABUNDANCE_SCHEMA = (
    "name string, taxonomy_id long, taxonomy_lvl string, kraken_assigned_reads long, "
    "added_reads long, new_est_reads long, fraction_total_reads double"
)
HITS_7 = (
    "qseqid string, sseqid string, pident double, length int, evalue double, "
    "bitscore double, stitle string"
)
HITS_13 = (
    "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, "
    "qstart int, qend int, sstart int, send int, evalue double, bitscore double, stitle string"
)
HIT = (
    "struct<hit_id:string, hit_def:string, length:int, e_value:double, bit_score:double, "
    "identity:double, query_cover:double, organism:string>"
)
RESULT_SCHEMA = (
    f"query_id string, query_length int, hits array<{HIT}>, timestamp double, error string"
)
ANNOTATION_SCHEMA = (
    "locus_tag string, ftype string, length_bp int, gene string, EC_number string, "
    "COG string, product string"
)


def _split_line(lines: DataFrame, schema: str, order: bool = True) -> DataFrame:
    """Tab-split numbered lines into typed columns, keeping the file order."""
    fields = T.StructType.fromDDL(schema).fields
    cells = F.split("value", "\t")
    typed = [
        F.get(cells, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)
    ]
    return lines.select(*typed, *([file_ord().alias("ord")] if order else []))


def read_report(spark: SparkSession, path) -> DataFrame:
    """Clade report, six columns without header; keeps the indented names.

    The taxid 0 of the row of unclassified reads becomes null.
    """
    lines = numbered_records(spark, path).filter(F.trim(F.col("value")) != "")
    none = (F.col("rank") == "U") & (F.col("taxid") == 0)
    return _split_line(lines, REPORT_SCHEMA).withColumn("taxid", F.when(~none, F.col("taxid")))


def read_bracken(spark: SparkSession, path) -> DataFrame:
    """Abundance table, seven columns with a header line."""
    lines = numbered_records(spark, path).filter((F.col("n") > 0) & (F.trim(F.col("value")) != ""))
    return _split_line(lines, ABUNDANCE_SCHEMA)


def read_abundance(spark: SparkSession, path) -> DataFrame:
    """``(name, fraction_total_reads, ord)`` from either kind of report.

    The header line decides: with a ``fraction_total_reads`` column the file
    is an abundance table, else a clade report whose percentages are divided.
    """
    first = spark.read.text(path).limit(1).first()
    if first is not None and "fraction_total_reads" in first[0].split("\t"):
        return read_bracken(spark, path).select("name", "fraction_total_reads", "ord")
    return read_report(spark, path).select(
        "name", (F.col("percentage") / 100).alias("fraction_total_reads"), "ord"
    )


def read_diamond(spark: SparkSession, path, columns: int = 7, ordered: bool = True) -> DataFrame:
    """Headerless protein hits with 7 or 13 columns; lines from ``#`` are notes.

    With ``ordered=False`` the ``ord`` column, and the pass that counts lines
    per block, are left out.
    """
    schema = {7: HITS_7, 13: HITS_13}[columns]
    if not ordered:
        return (
            spark.read.schema(schema).option("sep", "\t").option("quote", "")
            .option("comment", "#").csv(path)
        )
    lines = numbered_records(spark, path).filter(
        (F.trim(F.col("value")) != "") & ~F.col("value").startswith("#")
    )
    return _split_line(lines, schema)


def read_flagged_hits(spark: SparkSession, path) -> DataFrame:
    """Hits with a header line, as they may carry ``Pathogenic`` or ``staxids``, and ``ord``.

    Every file has the same header; a file that holds only a ``#`` note gives
    an empty frame.
    """
    lines = numbered_records(spark, path).filter(
        (F.trim(F.col("value")) != "") & ~F.col("value").startswith("#")
    )
    first = spark.read.text(path).filter(
        (F.trim(F.col("value")) != "") & ~F.col("value").startswith("#")
    ).first()
    header = first[0] if first else ""
    known = {f.name: f.dataType for f in T.StructType.fromDDL(HITS_13).fields}
    cells = F.split("value", "\t", -1)
    columns = []
    for i, name in enumerate(header.rstrip("\r").split("\t") if header else []):
        cell = F.nullif(F.regexp_replace(F.get(cells, F.lit(i)), "\r$", ""), F.lit(""))
        columns.append((cell.try_cast(known[name]) if name in known else cell).alias(name))
    return lines.filter(F.col("value") != header).select(*columns, file_ord().alias("ord"))


def read_gff(spark: SparkSession, path) -> DataFrame:
    """Nine feature columns, attributes as a map. The FASTA tail falls out.

    Values of an attribute that is given several times are joined by commas;
    empty attributes (``;;``) fall out.
    """
    cells = F.split("value", "\t")
    rows = (
        spark.read.text(path)
        .filter(~F.col("value").startswith("#") & (F.size(cells) >= 3))
        .select(cells.alias("p"))
    )

    def cell(i: int):
        return F.get("p", F.lit(i))

    return rows.select(
        cell(0).alias("seqid"),
        cell(1).alias("source"),
        cell(2).alias("type"),
        cell(3).try_cast("long").alias("start"),
        cell(4).try_cast("long").alias("end"),
        cell(5).alias("score"),
        cell(6).alias("strand"),
        cell(7).alias("phase"),
        _attributes(cell(8)).alias("attributes"),
    )


def _attributes(text: Column) -> Column:
    def pair(x: Column) -> Column:
        key = F.substring_index(x, "=", 1)
        value = F.when(F.contains(x, F.lit("=")), x.substr(F.length(key) + 2, F.length(x)))
        return F.struct(key.alias("k"), value.alias("v"))

    pairs = F.transform(F.filter(F.split(text, ";"), lambda x: F.trim(x) != ""), pair)
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))

    def joined(k: Column) -> Column:
        values = F.transform(F.filter(pairs, lambda p: (p["k"] == k) & p["v"].isNotNull()), lambda p: p["v"])
        return F.when(F.size(values) > 0, F.array_join(values, ","))

    return F.map_from_arrays(keys, F.transform(keys, joined))


def read_annotation(spark: SparkSession, path) -> DataFrame:
    return (
        spark.read.schema(ANNOTATION_SCHEMA).option("header", True).option("sep", "\t")
        .option("quote", "").csv(path)
    )


def read_blast_results(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Search results as one JSON array per file, or one result per line.

    ``ord`` is unique and grows along each file.
    """
    rows = spark.read.schema(RESULT_SCHEMA).option("multiLine", multiline).json(path)
    return rows.withColumn("ord", F.monotonically_increasing_id())


def load_hit_cache(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """``(seq_md5, result, timestamp)`` from the cache table, or from JSON objects.

    A missing or unreadable JSON cache is an empty cache. The JSON form holds
    one object per file, or without ``multiline`` one per line, and is meant for
    the first import; after that the Parquet table of ``save_hit_cache`` is read.
    """
    result = T.StructType.fromDDL(RESULT_SCHEMA).simpleString()
    empty = spark.createDataFrame([], f"seq_md5 string, result {result}, timestamp double")
    if not str(path).endswith(".json"):
        try:
            return spark.read.parquet(path)
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return empty
            raise
    try:
        text = spark.read.text(path, wholetext=multiline)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return empty
        raise
    parsed = F.from_json("value", f"map<string,{result}>")
    return text.select(F.explode(parsed).alias("seq_md5", "result")).withColumn(
        "timestamp", F.col("result.timestamp")
    )


def read_taxonomy(spark: SparkSession, nodes, names) -> DataFrame:
    """``(taxid, parent, rank, name)`` from the two taxonomy dump files.

    The root's link to itself becomes a null parent; of the names only the
    scientific ones are kept.
    """
    def cells(path):
        return spark.read.text(path).select(F.split("value", r"\t\|\t?").alias("p"))

    def cell(i: int):
        return F.get("p", F.lit(i))

    node = cells(nodes).select(
        cell(0).cast("long").alias("taxid"),
        cell(1).cast("long").alias("parent"),
        cell(2).alias("rank"),
    )
    name = (
        cells(names)
        .filter(cell(3) == "scientific name")
        .select(cell(0).cast("long").alias("taxid"), cell(1).alias("name"))
    )
    node = node.withColumn("parent", F.when(F.col("parent") != F.col("taxid"), F.col("parent")))
    return node.join(name, "taxid", "left")


def read_id_map(spark: SparkSession, path) -> DataFrame:
    """``(sseqid, taxid)`` from a two-column table."""
    return spark.read.schema("sseqid string, taxid long").option("sep", "\t").option(
        "quote", ""
    ).csv(path)
