"""Whole tables of the test data seen as sequences, hits, results and trees.

Each Spark stand-in has the same definition as SQL text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biomeframe.operators.classify import build_kmer_db
from biomeframe.operators.taxonomy import taxonomy_tree
from biomeframe.session import stored

_BUILT: dict[tuple[str, str, str], DataFrame] = {}


def built_once(name: str, spark: SparkSession, d: str, build) -> DataFrame:
    """Reference data (trees, k-mer tables) is stored once per session."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


DNA = "upper(regexp_replace(lower({c}), '[^acgt]', '', 'g'))"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def sequence_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A text table with ``seq`` worked out, stored once per session.

    A file below the size of a row group is one task however many cores wait,
    so small tables are spread; larger ones keep their partitions.
    """

    def build() -> DataFrame:
        path = f"{d}/{name}.parquet"
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        size = files.agg(F.sum("length").alias("n")).first().n
        cores = spark.sparkContext.defaultParallelism
        df = spark.read.parquet(path)
        if size < cores * (128 << 20):
            df = df.repartition(cores)
        return stored(df.withColumn("seq", dna("text")), name)

    return built_once(f"seq-{name}", spark, d, build)


def dna(c: str):
    return F.upper(F.regexp_replace(F.lower(c), "[^acgt]", ""))


# --- sequences ---------------------------------------------------------------

SEQS = f"seqs AS (SELECT source AS id, doc_id AS ord, {DNA.format(c='text')} AS seq FROM documents)"


def seqs(spark, d) -> DataFrame:
    return sequence_table(spark, d, "documents").select(
        F.col("source").alias("id"), F.col("doc_id").alias("ord"), "seq"
    )


READS = (
    "reads AS (SELECT conv_id || '.' || turn AS id, conv_id * 1000 + turn AS ord, "
    f"{DNA.format(c='text')} AS seq FROM conversations)"
)


def reads(spark, d) -> DataFrame:
    return sequence_table(spark, d, "conversations").select(
        F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"),
        "seq",
    )


QUALS = "fastq AS (SELECT id, ord, seq, translate(seq, 'ACGT', '@I5+') AS qual FROM reads)"


def fastq(spark, d) -> DataFrame:
    return reads(spark, d).withColumn("qual", F.translate("seq", "ACGT", "@I5+"))


REFS = (
    f"refs AS (SELECT 'item' || item_id AS id, text AS description, {DNA.format(c='text')} AS seq "
    "FROM benchmark)"
)


def refs(spark, d) -> DataFrame:
    return sequence_table(spark, d, "benchmark").select(
        F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("id"),
        F.col("text").alias("description"),
        "seq",
    )


# --- hit tables --------------------------------------------------------------

HITS = (
    "hits AS (SELECT l_orderkey AS qseqid, l_partkey AS sseqid, l_quantity * 2.0 AS pident, "
    "l_linenumber AS ord, l_tax * 1.5e-9 AS evalue, l_extendedprice AS bitscore, p_name AS stitle "
    "FROM lineitem JOIN part ON l_partkey = p_partkey)"
)


def hits(spark, d) -> DataFrame:
    line = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice"
    )
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return line.join(part, "l_partkey").select(
        F.col("l_orderkey").alias("qseqid"),
        F.col("l_partkey").alias("sseqid"),
        (F.col("l_quantity") * 2.0).alias("pident"),
        F.col("l_linenumber").alias("ord"),
        (F.col("l_tax") * 1.5e-9).alias("evalue"),
        F.col("l_extendedprice").alias("bitscore"),
        F.col("p_name").alias("stitle"),
    )


FINISHES = {"warm": ["red", "hot"], "cool": ["blue", "cold"], "fastener": ["bolt"]}
FINISH_SQL = (
    "CASE WHEN stitle LIKE '%red%' OR stitle LIKE '%hot%' THEN 'warm' "
    "WHEN stitle LIKE '%blue%' OR stitle LIKE '%cold%' THEN 'cool' "
    "WHEN stitle LIKE '%bolt%' THEN 'fastener' ELSE 'other' END"
)

# --- search results ----------------------------------------------------------

RESULTS = (
    "results AS (SELECT event_id AS ord, 'q' || user_id AS query_id, event_type AS kind, "
    "CASE WHEN event_type = 'error' THEN 'timed out' END AS error, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id, ts FROM events)"
)
RESULT_HITS = (
    "flat AS (SELECT ord, query_id, 0 AS pos, "
    "CASE WHEN k = 50 THEN 'Unknown' ELSE 'org' || k END AS organism FROM results "
    "WHERE error IS NULL AND kind <> 'view' "
    "UNION ALL SELECT ord, query_id, 1 AS pos, 'org' || (user_id % 10) AS organism FROM results "
    "WHERE error IS NULL AND kind = 'purchase')"
)


def results(spark, d) -> DataFrame:
    """One result per event: errors, empty results, one hit, or two hits."""
    return built_once("results", spark, d, lambda: stored(_results(spark, d), "results"))


def _results(spark, d) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    name = F.when(k != 50, F.concat(F.lit("org"), k.cast("string")))
    second = F.concat(F.lit("org"), (F.col("user_id") % 10).cast("string"))

    def hit(organism):
        return F.struct(
            F.lit("s").alias("hit_id"),
            organism.alias("hit_def"),
            F.lit(100).alias("length"),
            F.lit(1e-9).alias("e_value"),
            F.col("value").alias("bit_score"),
            F.lit(99.0).alias("identity"),
            F.lit(90.0).alias("query_cover"),
            organism.alias("organism"),
        )

    listed = (
        F.when(F.col("event_type").isin("view", "error"), F.slice(F.array(hit(name)), 1, 0))
        .when(F.col("event_type") == "purchase", F.array(hit(name), hit(second)))
        .otherwise(F.array(hit(name)))
    )
    return table(spark, d, "events").select(
        F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("query_id"),
        F.lit(6000).alias("query_length"),
        listed.alias("hits"),
        F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("timestamp"),
        F.when(F.col("event_type") == "error", F.lit("timed out")).alias("error"),
        F.col("event_id").alias("ord"),
    )


# --- trees -------------------------------------------------------------------

PLACES = (
    "places AS (SELECT 1::BIGINT AS taxid, NULL::BIGINT AS parent, 'R' AS rank, 'world' AS name "
    "UNION ALL SELECT 10 + r_regionkey, 1, 'G', r_name FROM region "
    "UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'S', n_name FROM nation "
    "UNION ALL SELECT 1000 + c_custkey, 100 + c_nationkey, 'S1', c_name FROM customer)"
)
PLACE_CLOSURE = (
    "place_up AS (SELECT taxid, taxid AS ancestor, 0 AS dist FROM places "
    "UNION ALL SELECT taxid, parent, 1 FROM places WHERE parent IS NOT NULL "
    "UNION ALL SELECT c.taxid, p.parent, 2 FROM places c JOIN places p ON c.parent = p.taxid "
    "WHERE p.parent IS NOT NULL UNION ALL SELECT c.taxid, g.parent, 3 FROM places c "
    "JOIN places p ON c.parent = p.taxid JOIN places g ON p.parent = g.taxid WHERE g.parent IS NOT NULL)"
)
ORDER_TAXA = (
    "calls AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL "
    "WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 1000 + c_custkey "
    "WHEN o_orderstatus = 'F' THEN 100 + n_nationkey WHEN o_orderstatus = 'O' THEN 10 + n_regionkey "
    "ELSE 1 END::BIGINT AS taxid FROM orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey)"
)


def place_nodes(spark, d) -> DataFrame:
    region = table(spark, d, "region").select(
        (F.col("r_regionkey") + 10).cast("long").alias("taxid"),
        F.lit(1).cast("long").alias("parent"),
        F.lit("G").alias("rank"),
        F.col("r_name").alias("name"),
    )
    nation = table(spark, d, "nation").select(
        (F.col("n_nationkey") + 100).cast("long").alias("taxid"),
        (F.col("n_regionkey") + 10).cast("long").alias("parent"),
        F.lit("S").alias("rank"),
        F.col("n_name").alias("name"),
    )
    root = region.agg(F.lit(1).cast("long").alias("taxid")).select(
        "taxid", F.lit(None).cast("long").alias("parent"), F.lit("R").alias("rank"),
        F.lit("world").alias("name"),
    )
    customer = table(spark, d, "customer").select(
        (F.col("c_custkey") + 1000).cast("long").alias("taxid"),
        (F.col("c_nationkey") + 100).cast("long").alias("parent"),
        F.lit("S1").alias("rank"),
        F.col("c_name").alias("name"),
    )
    return root.unionByName(region).unionByName(nation).unionByName(customer)


def place_tree(spark, d) -> DataFrame:
    return built_once("places", spark, d, lambda: taxonomy_tree(place_nodes(spark, d)))


def order_taxa(spark, d) -> DataFrame:
    """One row per order: a customer, a nation, a region, the root, or nothing."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    taxid = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == 0), F.col("o_custkey") + 1000)
        .when(F.col("o_orderstatus") == "F", F.col("n_nationkey") + 100)
        .when(F.col("o_orderstatus") == "O", F.col("n_regionkey") + 10)
        .otherwise(F.lit(1))
    )
    return orders.join(customer, "o_custkey").join(nation, "n_nationkey").select(
        taxid.cast("long").alias("taxid")
    )


LEAVES = f"leaves AS (SELECT lang || '|' || source AS taxid, lang, {DNA.format(c='text')} AS seq FROM documents)"


def genomes(spark, d) -> DataFrame:
    """Documents as reference sequences of the leaf (lang, source)."""
    return sequence_table(spark, d, "documents").select(
        F.concat_ws("|", "lang", "source").alias("taxid"), "lang", "seq"
    )


def language_tree(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("lang", "source").distinct()
    leaf = docs.select(
        F.concat_ws("|", "lang", "source").alias("taxid"),
        F.col("lang").alias("parent"),
        F.lit("S").alias("rank"),
        F.concat_ws(" ", "lang", "source").alias("name"),
    )
    lang = docs.select("lang").distinct().select(
        F.col("lang").alias("taxid"), F.lit("root").alias("parent"), F.lit("G").alias("rank"),
        F.col("lang").alias("name"),
    )
    root = docs.agg(F.lit("root").alias("taxid")).select(
        "taxid", F.lit(None).cast("string").alias("parent"), F.lit("R").alias("rank"),
        F.lit("root").alias("name"),
    )
    nodes = root.unionByName(lang).unionByName(leaf)
    return built_once("languages", spark, d, lambda: taxonomy_tree(nodes))


def language_kmers(spark, d) -> DataFrame:
    tree = language_tree(spark, d)
    return built_once("kmers", spark, d, lambda: build_kmer_db(genomes(spark, d), tree, 11))
