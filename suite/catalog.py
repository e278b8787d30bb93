"""Every registered query with its oracle SQL, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biomeframe.functions import sequence as fs
from biomeframe.functions import text as ft
from biomeframe.operators import alignment as al
from biomeframe.operators import cache as oc
from biomeframe.operators import categories as cat
from biomeframe.operators import classify as cl
from biomeframe.operators import features as fe
from biomeframe.operators import hits as oh
from biomeframe.operators import orfs as oo
from biomeframe.operators import search as se
from biomeframe.operators import sequences as os_
from biomeframe.operators import taxonomy as tx
from biomeframe.plans import pipelines as pl
from biomeframe.session import scratch_path, stored
from biomeframe.sinks import writers as wr
from biomeframe.sources import sequences as ss
from biomeframe.sources import tables as st
from biomeframe.streaming import feeds
from suite import standins as sd

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


# --- organisms in search results --------------------------------------------

R = _with(sd.RESULTS, sd.RESULT_HITS)
COUNTS = (
    "counts AS (SELECT organism, count(*) AS total_hits, count(DISTINCT query_id) AS seqs, "
    "min(ord * 10 + pos) AS seen FROM flat GROUP BY organism)"
)
RC = _with(sd.RESULTS, sd.RESULT_HITS, COUNTS)


@query(
    "organism_hit_counts",
    RC + "SELECT organism, total_hits, seqs AS sequences_with_hits, "
    "round(total_hits / seqs, 6) AS avg_hits_per_sequence FROM counts",
)
def organism_hit_counts(spark, d):
    out = oh.organism_hit_counts(oh.explode_hits(sd.results(spark, d)))
    return out.select(
        "organism", "total_hits", "sequences_with_hits",
        F.round("avg_hits_per_sequence", 6).alias("avg_hits_per_sequence"),
    )


REPORT_SQL = (
    "SELECT round(100.0 * (n_ok - n_hit) / n_ok, 6)::DOUBLE AS percentage, n_ok - n_hit AS clade_reads, "
    "n_ok - n_hit AS taxon_reads, 'U' AS rank, 0::BIGINT AS taxid, 'unclassified' AS name FROM "
    "(SELECT count(*) AS n_ok, count(*) FILTER (WHERE kind <> 'view') AS n_hit FROM results "
    "WHERE error IS NULL) "
    "UNION ALL SELECT round(100.0 * total_hits / (SELECT count(*) FROM flat), 6)::DOUBLE, total_hits, seqs, "
    "'S', 0::BIGINT, organism FROM counts"
)


@query("kraken_style_report", RC + REPORT_SQL)
def kraken_style_report(spark, d):
    return oh.kraken_style_report(sd.results(spark, d)).select(
        F.round("percentage", 6).alias("percentage"),
        "clade_reads", "taxon_reads", "rank", "taxid", "name",
    )


@query(
    "classification_metrics",
    R + "SELECT (SELECT count(*) FROM results) AS n_results, "
    "(SELECT count(*) FROM results WHERE error IS NULL) AS n_ok, "
    "count(DISTINCT ord) AS n_with_hits, count(*) AS total_hits, "
    "count(DISTINCT organism) AS n_organisms, "
    "round(100.0 * count(DISTINCT ord) / (SELECT count(*) FROM results), 6)::DOUBLE AS classification_rate, "
    "round(count(*) / count(DISTINCT ord), 6)::DOUBLE AS mean_hits_per_classified FROM flat",
)
def classification_metrics(spark, d):
    m = oh.classification_metrics(sd.results(spark, d))
    return m.select(
        "n_results", "n_ok", "n_with_hits", "total_hits", "n_organisms",
        F.round("classification_rate", 6).alias("classification_rate"),
        F.round("mean_hits_per_classified", 6).alias("mean_hits_per_classified"),
    )


def _top_sql(n: int) -> str:
    return (
        RC + "SELECT CAST(row_number() OVER (ORDER BY total_hits DESC, seen) AS INTEGER) AS rank_no, "
        "organism, total_hits, seqs AS sequences_with_hits, "
        "round(total_hits / seqs, 6) AS avg_hits_per_sequence FROM counts "
        f"QUALIFY rank_no <= {n}"
    )


def _top(spark, d, n):
    return oh.organism_table(sd.results(spark, d), n).withColumn(
        "avg_hits_per_sequence", F.round("avg_hits_per_sequence", 6)
    )


@query("organism_comparison", _top_sql(10))
def organism_comparison(spark, d):
    return _top(spark, d, 10)


@query("top_organisms", _top_sql(20))
def top_organisms(spark, d):
    return _top(spark, d, 20)


@query(
    "krona_rows",
    RC + f"SELECT clade_reads AS hit_count, name AS organism FROM ({REPORT_SQL}) "
    "WHERE name <> 'unclassified' AND round(percentage, 2) > 0.1",
)
def krona_rows(spark, d):
    return oh.krona_rows(oh.kraken_style_report(sd.results(spark, d)))


@query(
    "taxonomy_summary_rows",
    RC + "SELECT rpad(substring(organism, 1, 29), 30, ' ') AS organism, total_hits FROM counts "
    "ORDER BY total_hits DESC, seen LIMIT 20",
)
def taxonomy_summary_rows(spark, d):
    return oh.organism_table(sd.results(spark, d), 20).select(
        F.rpad(F.substring("organism", 1, 29), 30, " ").alias("organism"), "total_hits"
    )


@query(
    "comparison_json",
    RC + "SELECT len(x) AS n, x[1].organism AS first, CAST(list_sum(list_transform(x, lambda r: r.total_hits)) AS BIGINT) "
    "AS hits FROM (SELECT list(c ORDER BY total_hits DESC, seen) AS x FROM (SELECT * FROM counts "
    "ORDER BY total_hits DESC, seen LIMIT 10) c)",
)
def comparison_json(spark, d):
    doc = wr.json_array(oh.organism_comparison(sd.results(spark, d)), "rank_no", 10)
    parsed = F.from_json("json", "array<struct<organism:string,total_hits:long>>")
    return doc.select(parsed.alias("x")).select(
        F.size("x").cast("long").alias("n"),
        F.get("x", F.lit(0))["organism"].alias("first"),
        F.aggregate("x", F.lit(0).cast("long"), lambda a, r: a + r["total_hits"]).alias("hits"),
    )


@query(
    "organism_names",
    "WITH t AS (SELECT doc_id, text, "
    rf"regexp_extract(text, '{ft.GENUS_SPECIES}', 1) AS g, regexp_extract(text, '{ft.GENUS_SPECIES}', 2) AS s, "
    r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS words FROM documents) "
    "SELECT doc_id, CASE WHEN contains(text, '[') AND contains(text, ']') "
    "THEN trim(replace(split_part(text, '[', -1), ']', '')) "
    "WHEN g <> '' THEN g || ' ' || s ELSE array_to_string(words[1:3], ' ') END AS organism FROM t",
)
def organism_names(spark, d):
    return sd.table(spark, d, "documents").select("doc_id", ft.organism_of("text").alias("organism"))


# --- hit tables --------------------------------------------------------------

H = _with(sd.HITS)
GOOD = "good AS (SELECT * FROM hits WHERE pident >= 70 AND evalue <= 1e-10)"
HG = _with(sd.HITS, GOOD)


@query(
    "high_quality_hits",
    HG + "SELECT qseqid, sseqid, pident, round(evalue * 1e9, 6) AS evalue_e9, bitscore, stitle FROM good",
)
def high_quality_hits(spark, d):
    return oh.high_quality(sd.hits(spark, d)).select(
        "qseqid", "sseqid", "pident", F.round(F.col("evalue") * 1e9, 6).alias("evalue_e9"),
        "bitscore", "stitle",
    )


@query(
    "significant_hits",
    H + "SELECT count(*) AS n, round(sum(bitscore), 2) AS bits FROM hits WHERE evalue <= 6e-11",
)
def significant_hits(spark, d):
    h = sd.hits(spark, d).withColumnRenamed("evalue", "e_value")
    return oh.significant_hits(h, 6e-11).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("bitscore"), 2).alias("bits")
    )


@query("category_counts", HG + f"SELECT {sd.FINISH_SQL} AS category, count(*) AS n FROM good GROUP BY 1")
def category_counts(spark, d):
    return cat.category_counts(cat.classify_hits(sd.hits(spark, d), sd.FINISHES))


@query(
    "category_members",
    HG + f"SELECT {sd.FINISH_SQL} AS category, sseqid AS gene, pident AS identity, "
    "stitle AS description, ord FROM good",
)
def category_members(spark, d):
    members = cat.category_members(cat.classify_hits(sd.hits(spark, d), sd.FINISHES))
    return members.select("category", "gene", "identity", "description", "ord")


GENE_WORDS = [
    ("red", "penicillin"), ("hot", "Gentamicin"), ("blue", "doxycycline"), ("cold", "quinolone"),
    ("small", "Type III"), ("large", "flagellar"), ("old", "stress"), ("new", "Fimbrial"),
    ("bolt", "vancomycin"), ("ring", "hemolysin"), ("rod", "LPS"), ("gear", "sensor"),
]


def _gene_sql() -> str:
    out = "stitle"
    for a, b in GENE_WORDS:
        out = f"replace({out}, '{a}', '{b}')"
    return out


def _case(dictionary) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower(title), '{w.lower()}')" for w in words) + f" THEN '{c}'"
        for c, words in dictionary.items()
    )
    return f"CASE {whens} ELSE 'other' END"


GENES = f"genes AS (SELECT *, {_gene_sql()} AS title FROM good)"


def _gene_hits(spark, d):
    title = F.col("stitle")
    for a, b in GENE_WORDS:
        title = F.replace(title, F.lit(a), F.lit(b))
    return sd.hits(spark, d).withColumn("stitle", title)


@query(
    "amr_classes",
    _with(sd.HITS, GOOD, GENES) + f"SELECT {_case(ft.RESISTANCE_CLASSES)} AS category, "
    "count(*) AS n FROM genes GROUP BY 1",
)
def amr_classes(spark, d):
    return cat.category_counts(cat.classify_hits(_gene_hits(spark, d), ft.RESISTANCE_CLASSES))


@query(
    "vf_categories",
    _with(sd.HITS, GOOD, GENES) + f"SELECT {_case(ft.VIRULENCE_CATEGORIES)} AS category, "
    "count(*) AS n FROM genes GROUP BY 1",
)
def vf_categories(spark, d):
    return cat.category_counts(cat.classify_hits(_gene_hits(spark, d), ft.VIRULENCE_CATEGORIES))


@query(
    "category_report",
    _with(sd.HITS, GOOD, GENES) + f", c AS (SELECT {_case(ft.RESISTANCE_CLASSES)} AS category, * FROM genes) "
    "SELECT 'member' AS part, category, CAST(sseqid AS VARCHAR) AS gene, pident, evalue, title AS text, "
    "NULL::BIGINT AS n FROM c UNION ALL "
    "SELECT 'count', category, NULL, NULL, NULL, NULL, count(*) FROM c GROUP BY category UNION ALL "
    "SELECT 'summary', NULL, NULL, NULL, NULL, CASE WHEN count(*) = 0 THEN 'No antimicrobial resistance genes "
    "detected' ELSE 'Detected ' || count(*) || ' high-confidence antimicrobial resistance genes' END, count(*) FROM c",
)
def category_report(spark, d):
    """The document's summary and counts, and all member lines, read back from their JSON."""
    out = cat.category_report(_gene_hits(spark, d), "amr")
    doc = out["document"].select(
        F.from_json("json", "summary string, total_hits long, resistance_classes map<string, long>").alias("j")
    )
    names = ["part", "category", "gene", "pident", "evalue", "text", "n"]
    types = ["string", "string", "string", "double", "double", "string", "long"]

    def rows(df, part, **cells):
        cells["part"] = F.lit(part)
        return df.select(*[cells.get(c, F.lit(None)).cast(t).alias(c) for c, t in zip(names, types)])

    m = out["member_lines"].select(F.from_json(
        "json", "category string, gene string, identity double, evalue double, description string"
    ).alias("j"))
    counts = doc.select(F.explode("j.resistance_classes").alias("category", "n"))
    return (
        rows(m, "member", category=F.col("j.category"), gene=F.col("j.gene"), pident=F.col("j.identity"),
             evalue=F.col("j.evalue"), text=F.col("j.description"))
        .unionByName(rows(counts, "count", category=F.col("category"), n=F.col("n")))
        .unionByName(rows(doc, "summary", text=F.col("j.summary"), n=F.col("j.total_hits")))
    )


TIES = ("qseqid", "sseqid", "pident", "evalue")
TOP_ORDER = "ORDER BY bitscore DESC, qseqid, sseqid, pident, evalue"


@query("top_hits", H + f"SELECT qseqid, sseqid, pident, bitscore, stitle FROM hits {TOP_ORDER} LIMIT 10")
def top_hits(spark, d):
    return oh.top_hits(sd.hits(spark, d), 10, TIES).select(
        "qseqid", "sseqid", "pident", "bitscore", "stitle"
    )


@query(
    "top_factor_table",
    HG + "SELECT sseqid AS gene_id, pident AS identity_pct, format('{:.2e}', evalue) AS e_value, "
    "CASE WHEN length(stitle) > 50 THEN substring(stitle, 1, 50) || '...' ELSE stitle END AS description "
    f"FROM good {TOP_ORDER} LIMIT 15",
)
def top_factor_table(spark, d):
    return cat.top_factor_table(sd.hits(spark, d), 15, TIES)


@query("top_columns", H + "SELECT sseqid, pident, evalue, stitle FROM hits")
def top_columns(spark, d):
    return oh.top_columns(sd.hits(spark, d))


@query("head_rows", H + "SELECT qseqid, sseqid, pident, bitscore FROM hits ORDER BY ord, qseqid, sseqid, pident, bitscore LIMIT 20")
def head_rows(spark, d):
    return oh.head_rows(
        sd.hits(spark, d), 20, ("ord", "qseqid", "sseqid", "pident", "bitscore")
    ).select("qseqid", "sseqid", "pident", "bitscore")


BAND_SQL = (
    "CASE WHEN pident > 0 AND pident <= 30 THEN 'Poor (<30%)' WHEN pident > 30 AND pident <= 50 THEN "
    "'Low (30-50%)' WHEN pident > 50 AND pident <= 70 THEN 'Moderate (50-70%)' WHEN pident > 70 AND "
    "pident <= 90 THEN 'Good (70-90%)' WHEN pident > 90 AND pident <= 100 THEN 'Excellent (>90%)' END"
)


@query("identity_bands", H + f"SELECT {BAND_SQL} AS band, count(*) AS n FROM hits GROUP BY 1")
def identity_bands(spark, d):
    return oh.quality_distribution(sd.hits(spark, d))


@query(
    "identity_histogram",
    H + "SELECT CAST(least(floor(pident / 5.0), 19) AS INTEGER) AS bin, "
    "CAST(least(floor(pident / 5.0), 19) * 5.0 AS DOUBLE) AS low, "
    "CAST((least(floor(pident / 5.0), 19) + 1) * 5.0 AS DOUBLE) AS high, "
    "count(*) AS n FROM hits WHERE pident BETWEEN 0 AND 100 GROUP BY 1, 2, 3",
)
def identity_histogram(spark, d):
    return oh.identity_histogram(sd.hits(spark, d))


@query(
    "annotation_summary",
    H + "SELECT count(*) AS n_annotations, round(avg(pident), 6) AS mean_pident, "
    "count(*) FILTER (WHERE pident > 70) AS n_high_quality, "
    "count(*) FILTER (WHERE pident > 90) AS n_excellent FROM hits",
)
def annotation_summary(spark, d):
    return oh.annotation_summary(sd.hits(spark, d)).withColumn("mean_pident", F.round("mean_pident", 6))


@query(
    "within_top_percent",
    H + "SELECT qseqid, sseqid, pident, bitscore FROM (SELECT *, max(bitscore) OVER "
    "(PARTITION BY qseqid) AS best FROM hits) WHERE bitscore >= best * (1 - 5 / 100)",
)
def within_top_percent(spark, d):
    return oh.within_top_percent(sd.hits(spark, d), 5).select("qseqid", "sseqid", "pident", "bitscore")


@query(
    "hit_limit",
    H + "SELECT h.qseqid, h.sseqid, h.ord, h.bitscore FROM hits h JOIN (SELECT qseqid, sseqid FROM "
    "(SELECT qseqid, sseqid, max(bitscore) AS b, min(ord) AS o FROM hits GROUP BY 1, 2) "
    "QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY b DESC, o, sseqid) <= 3) USING (qseqid, sseqid)",
)
def hit_limit(spark, d):
    return oh.hit_limit(sd.hits(spark, d), 3).select("qseqid", "sseqid", "ord", "bitscore")


@query(
    "quality_scatter",
    H + "SELECT pident, round(CASE WHEN evalue > 0 THEN log10(evalue) END, 6) AS log10_evalue, "
    "bitscore, sseqid, stitle FROM hits",
)
def quality_scatter(spark, d):
    return oh.quality_scatter(sd.hits(spark, d)).select(
        "pident", F.round("log10_evalue", 6).alias("log10_evalue"), "bitscore", "sseqid", "stitle"
    )


@query(
    "hit_metrics",
    "SELECT l_orderkey, l_linenumber, round(l_quantity / 50 * 100, 6) AS identity, "
    "round((l_linenumber + l_quantity - l_linenumber + 1) / l_extendedprice * 100, 6) AS query_cover FROM lineitem",
)
def hit_metrics(spark, d):
    raw = sd.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("identities"),
        F.lit(50).alias("align_length"), F.col("l_linenumber").alias("query_start"),
        (F.col("l_linenumber") + F.col("l_quantity")).alias("query_end"),
        F.col("l_extendedprice").alias("query_length"),
    )
    return oh.hit_metrics(raw).select(
        "l_orderkey", "l_linenumber", F.round("identity", 6).alias("identity"),
        F.round("query_cover", 6).alias("query_cover"),
    )


TAGGED = (
    "ids AS (SELECT s_suppkey AS sseqid, s_nationkey AS taxid FROM supplier WHERE s_acctbal >= 0), "
    "listed AS (SELECT n_nationkey AS taxid FROM nation JOIN region ON n_regionkey = r_regionkey "
    "WHERE r_name IN ('ASIA', 'AFRICA')), "
    "tagged AS (SELECT l_orderkey AS qseqid, l_suppkey AS sseqid, i.taxid AS staxids, CASE WHEN i.taxid IS NULL "
    "THEN 'Unknown' WHEN t.taxid IS NOT NULL THEN 'Pathogenic' ELSE 'Non-pathogenic' END AS \"Pathogenic\", "
    "l_linenumber AS ord FROM lineitem LEFT JOIN ids i ON l_suppkey = i.sseqid LEFT JOIN listed t ON i.taxid = t.taxid)"
)


def _tagged(spark, d):
    h = sd.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("qseqid"), F.col("l_suppkey").alias("sseqid"),
        F.col("l_linenumber").alias("ord"),
    )
    ids = sd.table(spark, d, "supplier").filter("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("sseqid"), F.col("s_nationkey").alias("taxid")
    )
    region = sd.table(spark, d, "region").filter(F.col("r_name").isin("ASIA", "AFRICA"))
    listed = sd.table(spark, d, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("taxid"))
    return se.tag_pathogenic(h, ids, listed)


@query("tag_pathogenic", f'WITH {TAGGED} SELECT qseqid, sseqid, staxids, "Pathogenic", ord FROM tagged')
def tag_pathogenic(spark, d):
    return _tagged(spark, d).select("qseqid", "sseqid", "staxids", "Pathogenic", "ord")


@query("pathogenic_counts", f'WITH {TAGGED} SELECT "Pathogenic", count(*) AS n FROM tagged GROUP BY 1')
def pathogenic_counts(spark, d):
    return oh.pathogenic_counts(_tagged(spark, d))


TIER_RULES = [("IS", "R", 2e-11, 60.0), ("AMR", "A", 5e-11, 40.0), ("sprot", "N", 9e-11, None)]


def _tier_sql() -> str:
    parts = []
    for i, (name, flag, e, cover) in enumerate(TIER_RULES):
        more = f" AND l_discount * 1000 >= {cover}" if cover is not None else ""
        parts.append(
            f"SELECT l_orderkey, {i} AS no, '{name}' AS tier, l_extendedprice AS b, l_partkey, p_name "
            f"FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = '{flag}' "
            f"AND l_tax * 1.5e-9 <= {e}{more}"
        )
    return (
        "WITH h AS (" + " UNION ALL ".join(parts) + "), best AS (SELECT * FROM h QUALIFY row_number() OVER "
        "(PARTITION BY l_orderkey ORDER BY no, b DESC, l_partkey) = 1) "
        "SELECT o_orderkey AS qseqid, tier, l_partkey AS subject, coalesce(p_name, 'hypothetical protein') "
        "AS product FROM orders LEFT JOIN best ON o_orderkey = l_orderkey"
    )


@query("tiered_annotation", _tier_sql())
def tiered_annotation(spark, d):
    line = sd.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("qseqid"), F.col("l_partkey").alias("sseqid"), "l_returnflag",
        (F.col("l_tax") * 1.5e-9).alias("evalue"), (F.col("l_discount") * 1000).alias("cover"),
        F.col("l_extendedprice").alias("bitscore"),
    )
    part = sd.table(spark, d, "part").select(F.col("p_partkey").alias("sseqid"), F.col("p_name").alias("stitle"))
    h = line.join(part, "sseqid")
    tiers = [se.Tier(n, h.filter(F.col("l_returnflag") == f), e, c) for n, f, e, c in TIER_RULES]
    proteins = sd.table(spark, d, "orders").select(F.col("o_orderkey").alias("qseqid"))
    return se.tiered_annotation(proteins, tiers)


@query(
    "attach_genes",
    H + "SELECT qseqid, sseqid, ord, bitscore, o_orderpriority AS product FROM hits JOIN orders ON qseqid = o_orderkey",
)
def attach_genes(spark, d):
    annotation = sd.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("locus_tag"), F.col("o_orderpriority").alias("product")
    )
    return se.attach_genes(sd.hits(spark, d), annotation).select(
        "qseqid", "sseqid", "ord", "bitscore", "product"
    )


@query(
    "significant_taxa",
    "WITH t AS (SELECT '  ' || p_name AS name, count(*) AS n FROM part GROUP BY 1), "
    "f AS (SELECT name, n / sum(n) OVER () AS fraction FROM t) "
    "SELECT trim(name) AS name, round(fraction, 9) AS fraction FROM f WHERE fraction > 0.015",
)
def significant_taxa(spark, d):
    part = sd.table(spark, d, "part")
    n = part.agg(F.count(F.lit(1)).alias("n")).scalar()
    shares = part.groupBy(F.concat(F.lit("  "), "p_name").alias("name")).agg(
        (F.count(F.lit(1)) / n).alias("fraction_total_reads")
    )
    return oh.clean_names(oh.significant_taxa(shares, 0.015)).select(
        "name", F.round("fraction_total_reads", 9).alias("fraction")
    )


@query(
    "taxa_overview",
    "WITH t AS (SELECT p_name AS name, min(p_partkey) AS ord, count(*) / (SELECT count(*) FROM part) AS fraction "
    "FROM part GROUP BY 1) SELECT name, ord, round(fraction, 9) AS fraction FROM t WHERE fraction > 0.001 "
    "ORDER BY ord LIMIT 10",
)
def taxa_overview(spark, d):
    part = sd.table(spark, d, "part")
    total = part.agg(F.count(F.lit(1)).alias("n")).scalar()
    shares = part.groupBy(F.col("p_name").alias("name")).agg(
        F.min("p_partkey").alias("ord"), (F.count(F.lit(1)) / total).alias("fraction_total_reads")
    )
    return oh.taxa_overview(shares, 10).select(
        "name", "ord", F.round("fraction_total_reads", 9).alias("fraction")
    )


# --- sequences ---------------------------------------------------------------

S = _with(sd.SEQS)


@query(
    "min_length_first_n",
    S + "SELECT id, ord, seq FROM (SELECT * FROM seqs ORDER BY ord LIMIT 50) WHERE length(seq) >= 50",
)
def min_length_first_n(spark, d):
    return os_.min_length(os_.take_first(sd.seqs(spark, d), 50)).select("id", "ord", "seq")


@query("min_length", S + "SELECT id, ord FROM seqs WHERE length(seq) >= 50")
def min_length(spark, d):
    return os_.min_length(sd.seqs(spark, d)).select("id", "ord")


@query(
    "validate_sequences",
    S + "SELECT n > 0 AND valid > 0 AS ok, CASE WHEN n = 0 THEN 'No sequences found in FASTA file' "
    "WHEN valid = 0 THEN 'No sequences longer than 50 bp found' WHEN n > 1000 THEN 'Warning: ' || n || "
    "' sequences found, will process first 1000' ELSE 'Ready to process ' || valid || ' sequences' END AS message "
    "FROM (SELECT count(*) AS n, count(*) FILTER (WHERE length(seq) >= 50) AS valid FROM seqs)",
)
def validate_sequences(spark, d):
    return os_.validate_sequences(sd.seqs(spark, d))


@query("seq_keys", S + "SELECT ord, md5(seq) AS seq_md5 FROM seqs")
def seq_keys(spark, d):
    return os_.with_seq_key(sd.seqs(spark, d)).select("ord", "seq_md5")


UNIQUE = (
    "u AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM seqs), "
    "named AS (SELECT ord, seq, CASE WHEN rn = 1 THEN id ELSE id || '_' || "
    "(CAST(sum(CASE WHEN rn > 1 THEN 1 ELSE 0 END) OVER (ORDER BY ord) AS BIGINT) - 1) END AS unique_id FROM u)"
)


@query("unique_ids", _with(sd.SEQS, UNIQUE) + "SELECT ord, unique_id FROM named")
def unique_ids(spark, d):
    return os_.unique_ids(sd.seqs(spark, d)).select("ord", "unique_id")


@query(
    "gc_content",
    S + "SELECT ord, round(CASE WHEN length(seq) > 0 THEN (length(seq) - length(translate(seq, 'GC', ''))) "
    "/ length(seq) END, 6) AS gc FROM seqs",
)
def gc_content(spark, d):
    return os_.gc_content(sd.seqs(spark, d)).select("ord", F.round("gc", 6).alias("gc"))


N50_SQL = (
    "(SELECT max(len) FROM (SELECT length(seq) AS len, sum(length(seq)) OVER "
    "(ORDER BY length(seq) DESC, ord) AS run, sum(length(seq)) OVER () AS total FROM seqs) WHERE run * 2 >= total)"
)


@query(
    "assembly_stats",
    S + "SELECT count(*) AS contigs, CAST(sum(length(seq)) AS BIGINT) AS bases, min(length(seq)) AS min_len, "
    "max(length(seq)) AS max_len, round(avg(length(seq)), 6) AS mean_len, median(length(seq)) AS median_len, "
    "round((sum(length(seq)) - sum(length(translate(seq, 'GC', '')))) / sum(length(seq)), 6) AS gc, "
    f"{N50_SQL} AS n50 FROM seqs",
)
def assembly_stats(spark, d):
    t = os_.assembly_stats(sd.seqs(spark, d))
    return t.select(
        "contigs", "bases", F.col("min_len").cast("long").alias("min_len"),
        F.col("max_len").cast("long").alias("max_len"), F.round("mean_len", 6).alias("mean_len"),
        "median_len", F.round("gc", 6).alias("gc"), "n50",
    )


@query(
    "n50",
    "SELECT max(n_chars) AS nx FROM (SELECT n_chars, sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id) AS run, "
    "sum(n_chars) OVER () AS total FROM documents) WHERE run * 2 >= total",
)
def n50(spark, d):
    return os_.nx(sd.table(spark, d, "documents").select(F.col("n_chars").alias("len")))


@query("reverse_complement", S + "SELECT ord, translate(reverse(seq), 'ACGT', 'TGCA') AS rc FROM seqs")
def reverse_complement(spark, d):
    return sd.seqs(spark, d).select("ord", fs.reverse_complement("seq").alias("rc"))


KMERS = (
    "kmers AS (SELECT ord, p AS pos, substring(seq, p, {k}) AS kmer FROM "
    "(SELECT ord, seq, unnest(range(1, length(seq) - {k} + 2)) AS p FROM {t}))"
)


@query(
    "kmer_counts",
    _with(sd.SEQS, KMERS.format(k=11, t="seqs")) + "SELECT kmer, count(*) AS n FROM kmers GROUP BY kmer",
)
def kmer_counts(spark, d):
    return fs.explode_kmers(sd.seqs(spark, d), 11).groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))


@query(
    "minimizers",
    _with(sd.SEQS, KMERS.format(k=15, t="seqs"))
    + "SELECT minimizer, count(*) AS n FROM (SELECT list_min(list_transform(range(1, 8), "
    "lambda i: substring(kmer, i, 9))) AS minimizer FROM kmers) GROUP BY 1",
)
def minimizers(spark, d):
    m = fs.explode_minimizers(sd.seqs(spark, d), 15, 9)
    return m.groupBy("minimizer").agg(F.count(F.lit(1)).alias("n"))


STRANDS = (
    "strands AS (SELECT ord, '+' AS strand, seq AS dna FROM seqs UNION ALL "
    "SELECT ord, '-', translate(reverse(seq), 'ACGT', 'TGCA') FROM seqs)"
)
AMINO_SQL = (
    f"substring('{fs.CODON_AMINO_ACIDS}', (16 * (strpos('TCAG', substring(dna, p, 1)) - 1) + "
    "4 * (strpos('TCAG', substring(dna, p + 1, 1)) - 1) + strpos('TCAG', substring(dna, p + 2, 1)))::BIGINT, 1)"
)


@query(
    "translate_frames",
    _with(sd.SEQS, STRANDS)
    + "SELECT ord, strand, CAST(f AS INTEGER) AS frame, coalesce(array_to_string(list_transform("
    f"range(f, length(dna) - 1, 3), lambda p: {AMINO_SQL}), ''), '') AS protein "
    "FROM strands, range(1, 4) t(f)",
)
def translate_frames(spark, d):
    return fs.translate_frames(sd.seqs(spark, d), keep=("ord",))


ORF_SQL = (
    "cod AS (SELECT ord, strand, n, p, (p - 1) % 3 AS f, substring(dna, p, 3) AS c FROM (SELECT ord, strand, "
    "dna, length(dna) AS n, unnest(range(1, length(dna) - 1)) AS p FROM strands)), "
    "isl AS (SELECT *, sum(CASE WHEN c IN ('TAA', 'TAG', 'TGA') THEN 1 ELSE 0 END) OVER "
    "(PARTITION BY ord, strand, f ORDER BY p) - CASE WHEN c IN ('TAA', 'TAG', 'TGA') THEN 1 ELSE 0 END AS g FROM cod), "
    "orf AS (SELECT ord, strand, f, n, min(CASE WHEN c IN ('ATG', 'GTG', 'TTG') THEN p END) AS s, "
    "max(CASE WHEN c IN ('TAA', 'TAG', 'TGA') THEN p + 2 END) AS e FROM isl GROUP BY ord, strand, f, n, g)"
)


@query(
    "orf_scan",
    _with(sd.SEQS, STRANDS, ORF_SQL)
    + "SELECT ord, CAST(CASE WHEN strand = '+' THEN s ELSE n - e + 1 END AS INTEGER) AS start, "
    "CAST(CASE WHEN strand = '+' THEN e ELSE n - s + 1 END AS INTEGER) AS \"end\", strand, "
    "CAST(f + 1 AS INTEGER) AS frame FROM orf WHERE s IS NOT NULL AND e IS NOT NULL AND e - s + 1 >= 90",
)
def orf_scan(spark, d):
    return oo.orf_scan(sd.seqs(spark, d), 90, keep=("ord",))


@query(
    "deinterleave",
    S + "SELECT id, ord, CAST(ord % 2 + 1 AS INTEGER) AS mate, ord // 2 AS pair_id FROM seqs",
)
def deinterleave(spark, d):
    return ss.deinterleave(sd.seqs(spark, d)).select("id", "ord", "mate", "pair_id")


@query(
    "paired_reads",
    S + "SELECT a.ord // 2 AS pair_id, a.id AS id1, b.id AS id2, length(a.seq) AS len1, length(b.seq) AS len2 "
    "FROM seqs a LEFT JOIN seqs b ON b.ord = a.ord + 1 WHERE a.ord % 2 = 0",
)
def paired_reads(spark, d):
    wide = ss.pair_up(ss.deinterleave(sd.seqs(spark, d)).withColumn("qual", F.lit("")))
    return wide.select(
        "pair_id", "id1", "id2", F.length("seq1").cast("long").alias("len1"),
        F.length("seq2").cast("long").alias("len2"),
    )


@query(
    "merge_mates",
    S + "SELECT id, CAST(1 AS INTEGER) AS mate, ord FROM seqs UNION ALL "
    "SELECT id, 2, ord + (SELECT max(ord) + 1 FROM seqs) FROM seqs",
)
def merge_mates(spark, d):
    s = sd.seqs(spark, d)
    return os_.merge_mates(s, s).select("id", "mate", "ord")


@query(
    "read_quality_filter",
    _with(sd.READS, sd.QUALS) + "SELECT id, length(seq) AS len FROM fastq WHERE length(seq) >= 35 AND "
    "list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) / length(qual) >= 27",
)
def read_quality_filter(spark, d):
    kept = os_.read_quality_filter(sd.fastq(spark, d), 35, 27)
    return kept.select("id", F.length("seq").cast("long").alias("len"))


@query(
    "search_time_label",
    "SELECT o_orderkey, CASE WHEN o_orderkey * 2 < 60 THEN '~' || (o_orderkey * 2) || ' seconds' "
    "WHEN o_orderkey * 2 < 3600 THEN '~' || (m // 10) || '.' || (m % 10) || ' minutes' "
    "ELSE '~' || (h // 10) || '.' || (h % 10) || ' hours' END AS label "
    "FROM (SELECT o_orderkey, (40 * o_orderkey + 60) // 120 AS m, (40 * o_orderkey + 3600) // 7200 AS h FROM orders)",
)
def search_time_label(spark, d):
    return sd.table(spark, d, "orders").select("o_orderkey", ft.search_time_label("o_orderkey").alias("label"))


@query(
    "number_formats",
    "SELECT l_orderkey, l_linenumber, format('{:.2e}', l_tax * 1.5e-9) AS sci, "
    "format('{:.2f}', l_extendedprice) AS fixed FROM lineitem",
)
def number_formats(spark, d):
    return sd.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", ft.fmt_sci(F.col("l_tax") * 1.5e-9).alias("sci"),
        ft.fmt_fixed("l_extendedprice").alias("fixed"),
    )


@query(
    "product_fields",
    "SELECT p_partkey, p_name AS product, p_type AS organism, CAST(p_size AS BIGINT) AS taxid, p_brand AS gene FROM part",
)
def product_fields(spark, d):
    title = F.concat(
        F.lit("sp|"), F.col("p_partkey").cast("string"), F.lit(" "), F.col("p_name"), F.lit(" OS="),
        F.col("p_type"), F.lit(" OX="), F.col("p_size").cast("string"), F.lit(" GN="), F.col("p_brand"),
        F.lit(" PE=4 SV=1"),
    )
    part = sd.table(spark, d, "part").select("p_partkey", ft.product_fields(title).alias("x"))
    return part.select("p_partkey", "x.*")


@query(
    "length_distribution",
    S + "SELECT CAST(length(seq) // 100 AS BIGINT) AS bin, CAST(length(seq) // 100 * 100 AS BIGINT) AS low, "
    "count(*) AS contigs, CAST(sum(length(seq)) AS BIGINT) AS bases FROM seqs GROUP BY 1, 2",
)
def length_distribution(spark, d):
    return os_.length_distribution(sd.seqs(spark, d), 100)


@query(
    "krona_file",
    RC + f"SELECT clade_reads AS hit_count, name AS organism FROM ({REPORT_SQL}) "
    "WHERE name <> 'unclassified' AND round(percentage, 2) > 0.1",
)
def krona_file(spark, d):
    path = scratch_path(spark, "krona")
    wr.write_krona_input(oh.kraken_style_report(sd.results(spark, d)), path)
    return spark.read.schema("hit_count long, organism string").option("sep", "\t").csv(path)


# --- taxonomy ----------------------------------------------------------------

P = _with(sd.PLACES, sd.PLACE_CLOSURE)
CALLS = _with(sd.PLACES, sd.PLACE_CLOSURE, sd.ORDER_TAXA)


@query(
    "taxonomy_tree",
    P + "SELECT taxid, parent, rank, name, CAST(CASE rank WHEN 'R' THEN 0 WHEN 'G' THEN 1 WHEN 'S' THEN 2 ELSE 3 END AS INTEGER) AS depth, "
    "row_number() OVER (ORDER BY path) - 1 AS pre, "
    "(SELECT count(*) FROM place_up u WHERE u.ancestor = places.taxid) AS size FROM places "
    "JOIN (SELECT taxid, list(ancestor ORDER BY dist DESC) AS path FROM place_up GROUP BY taxid) USING (taxid)",
)
def taxonomy_tree(spark, d):
    return tx.taxonomy_tree(sd.place_nodes(spark, d)).select(
        "taxid", "parent", "rank", "name", "depth", "pre", (F.col("last") - F.col("pre") + 1).alias("size")
    )


@query("lineage", P + "SELECT taxid, ancestor, dist FROM place_up")
def lineage(spark, d):
    return tx.lineage(sd.place_tree(spark, d))


CLADES = (
    "clades AS (SELECT ancestor AS taxid, count(*) AS clade_reads, "
    "count(*) FILTER (WHERE dist = 0) AS taxon_reads FROM calls JOIN place_up USING (taxid) GROUP BY 1)"
)
CALLED = _with(sd.PLACES, sd.PLACE_CLOSURE, sd.ORDER_TAXA, CLADES)


@query(
    "clade_report",
    CALLED + "SELECT round(100.0 * clade_reads / (SELECT count(*) FROM calls), 6)::DOUBLE AS percentage, "
    "clade_reads, taxon_reads, rank, taxid, name FROM clades JOIN places USING (taxid) UNION ALL "
    "SELECT round(100.0 * count(*) / (SELECT count(*) FROM calls), 6)::DOUBLE, count(*), count(*), 'U', NULL, "
    "'unclassified' FROM calls WHERE taxid IS NULL",
)
def clade_report(spark, d):
    r = tx.taxon_report(sd.order_taxa(spark, d), sd.place_tree(spark, d))
    return r.select(
        F.round("percentage", 6).alias("percentage"), "clade_reads", "taxon_reads", "rank", "taxid", "name"
    )


@query(
    "rank_profile",
    CALLED + "SELECT rank, count(*) AS taxa, CAST(sum(taxon_reads) AS BIGINT) AS taxon_reads, "
    "CAST(sum(clade_reads) AS BIGINT) AS clade_reads FROM clades JOIN places USING (taxid) GROUP BY rank "
    "UNION ALL SELECT 'U', 1, count(*), count(*) FROM calls WHERE taxid IS NULL",
)
def rank_profile(spark, d):
    r = tx.taxon_report(sd.order_taxa(spark, d), sd.place_tree(spark, d))
    return tx.rank_profile(r)


@query(
    "report_file_tree",
    CALLED + "SELECT taxid, clade_reads, taxon_reads, parent AS parent_taxid, rank, name, "
    "CAST(CASE rank WHEN 'R' THEN 0 WHEN 'G' THEN 1 WHEN 'S' THEN 2 ELSE 3 END AS INTEGER) AS depth "
    "FROM clades JOIN places USING (taxid) UNION ALL "
    "SELECT NULL, count(*), count(*), NULL, 'U', 'unclassified', 0 FROM calls WHERE taxid IS NULL",
)
def report_file_tree(spark, d):
    """Write the clade report as text, read it back, rebuild the tree."""
    tree = sd.place_tree(spark, d)
    calls = sd.order_taxa(spark, d)
    path = scratch_path(spark, "report")
    wr.write_report(tx.with_report_order(tx.taxon_report(calls, tree), tree), path)
    parsed = tx.parse_report_tree(st.read_report(spark, path))
    return parsed.select("taxid", "clade_reads", "taxon_reads", "parent_taxid", "rank", "name", "depth")


# Share of each nation's customers by balance: at the customer, kept, at the region, at the root.
DISTR = (
    "distr AS (SELECT species, node, count(*) / sum(count(*)) OVER (PARTITION BY species) AS p FROM "
    "(SELECT 100 + n_nationkey AS species, CASE WHEN c_acctbal >= 6000 THEN 1000 + c_custkey WHEN c_acctbal >= 3000 THEN 100 + n_nationkey "
    "WHEN c_acctbal >= 0 THEN 10 + n_regionkey ELSE 1 END AS node FROM customer JOIN nation "
    "ON c_nationkey = n_nationkey) GROUP BY 1, 2)"
)
ESTIMATE = (
    "sp AS (SELECT c.taxid, pl.name, clade_reads, clade_reads / p AS g FROM clades c JOIN places pl USING (taxid) "
    "JOIN (SELECT species, sum(p) AS p FROM distr JOIN place_up u ON node = u.taxid AND species = u.ancestor GROUP BY 1) o "
    "ON o.species = c.taxid WHERE pl.rank = 'S' AND clade_reads >= 10), "
    "pull AS (SELECT species, node, p * g AS w, taxon_reads FROM distr JOIN sp ON species = sp.taxid "
    "JOIN clades c ON c.taxid = node JOIN place_up u ON u.taxid = species AND u.ancestor = node AND u.dist > 0), "
    "added AS (SELECT species, sum(w / tot * taxon_reads) AS a FROM (SELECT *, sum(w) OVER (PARTITION BY node) AS tot "
    "FROM pull) GROUP BY species), "
    "est AS (SELECT name, taxid AS taxonomy_id, clade_reads AS kraken_assigned_reads, coalesce(a, 0) AS added, "
    "clade_reads + coalesce(a, 0) AS estimate FROM sp LEFT JOIN added ON species = taxid)"
)


def _estimate(spark, d, tree):
    calls = sd.order_taxa(spark, d)
    nation = sd.table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    own = (F.col("c_nationkey") + 100).cast("long")
    seen = (
        F.when(F.col("c_acctbal") >= 6000, (F.col("c_custkey") + 1000).cast("long"))
        .when(F.col("c_acctbal") >= 3000, own)
        .when(F.col("c_acctbal") >= 0, (F.col("n_regionkey") + 10).cast("long"))
        .otherwise(F.lit(1).cast("long"))
    )
    draws = sd.table(spark, d, "customer").join(nation, "c_nationkey").select(
        own.alias("species"), seen.alias("taxid")
    )
    report = stored(tx.taxon_report(calls, tree), "report")
    return tx.reestimate_abundance(report, tx.kmer_distribution(draws), tree)


@query(
    "reestimate_abundance",
    _with(sd.PLACES, sd.PLACE_CLOSURE, sd.ORDER_TAXA, CLADES, DISTR, ESTIMATE)
    + "SELECT name, taxonomy_id, 'S' AS taxonomy_lvl, kraken_assigned_reads, round(added, 6) AS added, "
    "round(estimate, 6) AS estimate, round(estimate / (SELECT sum(estimate) FROM est), 9) AS fraction_total_reads FROM est",
)
def reestimate_abundance(spark, d):
    est = _estimate(spark, d, sd.place_tree(spark, d))
    return est.select(
        "name", "taxonomy_id", "taxonomy_lvl", "kraken_assigned_reads", F.round("added", 6).alias("added"),
        F.round("estimate", 6).alias("estimate"),
        F.round("fraction_total_reads", 9).alias("fraction_total_reads"),
    )


@query(
    "bracken_clade_report",
    _with(sd.PLACES, sd.PLACE_CLOSURE, sd.ORDER_TAXA, CLADES, DISTR, ESTIMATE)
    + "SELECT ancestor AS taxid, round(sum(estimate) * 100 / (SELECT sum(estimate) FROM est), 6) AS percentage, "
    "CAST(floor(sum(estimate) + 1e-6) AS BIGINT) AS clade_reads, "
    "CAST(floor(coalesce(sum(estimate) FILTER (dist = 0), 0) + 1e-6) AS BIGINT) AS taxon_reads "
    "FROM est JOIN place_up ON taxonomy_id = taxid GROUP BY 1",
)
def bracken_clade_report(spark, d):
    tree = sd.place_tree(spark, d)
    r = tx.bracken_clade_report(stored(_estimate(spark, d, tree), "est"), tree)
    return r.select("taxid", F.round("percentage", 6).alias("percentage"), "clade_reads", "taxon_reads")


CANON = "least({c}, translate(reverse({c}), 'ACGT', 'TGCA'))"
DB_SQL = (
    "leaf_kmers AS (SELECT DISTINCT taxid, lang, {canon} AS kmer FROM (SELECT taxid, lang, "
    "substring(seq, p, 11) AS km FROM (SELECT taxid, lang, seq, unnest(range(1, length(seq) - 9)) AS p FROM leaves))), "
    "db AS (SELECT kmer, CASE WHEN count(DISTINCT taxid) = 1 THEN min(taxid) WHEN count(DISTINCT lang) = 1 "
    "THEN min(lang) ELSE 'root' END AS taxid FROM leaf_kmers GROUP BY kmer)"
).format(canon=CANON.format(c="km"))


@query("kmer_db_lca", _with(sd.LEAVES, DB_SQL) + "SELECT kmer, taxid FROM db")
def kmer_db_lca(spark, d):
    db = cl.build_kmer_db(sd.genomes(spark, d), sd.language_tree(spark, d), 11)
    return db.select(fs.kmer_text("kmer", 11).alias("kmer"), "taxid")


CLASSIFY_SQL = (
    "rk AS (SELECT ord, {canon} AS kmer FROM (SELECT ord, substring(seq, p, 11) AS km FROM "
    "(SELECT ord, seq, unnest(range(1, length(seq) - 9)) AS p FROM reads))), "
    "rh AS (SELECT ord, taxid, count(*) AS n FROM rk JOIN db USING (kmer) GROUP BY 1, 2), "
    "up AS (SELECT taxid, taxid AS a FROM (SELECT DISTINCT taxid FROM db) UNION ALL "
    "SELECT DISTINCT taxid, split_part(taxid, '|', 1) FROM db WHERE contains(taxid, '|') UNION ALL "
    "SELECT DISTINCT taxid, 'root' FROM db WHERE taxid <> 'root'), "
    "sc AS (SELECT h.ord, h.taxid, CAST(sum(g.n) AS BIGINT) AS score FROM rh h JOIN up USING (taxid) "
    "JOIN rh g ON g.ord = h.ord AND g.taxid = up.a GROUP BY 1, 2), "
    "bs AS (SELECT *, max(score) OVER (PARTITION BY ord) AS best FROM sc), "
    "win AS (SELECT ord, max(best) AS score, CASE WHEN count(*) = 1 THEN min(taxid) "
    "WHEN count(DISTINCT split_part(taxid, '|', 1)) = 1 THEN min(split_part(taxid, '|', 1)) ELSE 'root' END AS taxid "
    "FROM bs WHERE score = best GROUP BY ord) "
).format(canon=CANON.format(c="km"))


@query(
    "classify_reads",
    _with(sd.LEAVES, DB_SQL, sd.READS, CLASSIFY_SQL)
    + "SELECT CASE WHEN taxid IS NULL THEN 'U' ELSE 'C' END AS status, r.id, taxid, length(seq) AS length, score, r.ord "
    "FROM reads r LEFT JOIN win w ON r.ord = w.ord",
)
def classify_reads(spark, d):
    tree = sd.language_tree(spark, d)
    return cl.classify_reads(sd.reads(spark, d), sd.language_kmers(spark, d), tree, 11)


@query(
    "kmer_join",
    _with(sd.LEAVES, DB_SQL, sd.READS, CLASSIFY_SQL) + "SELECT ord, CAST(sum(n) AS BIGINT) AS n, count(*) AS taxa FROM rh GROUP BY ord",
)
def kmer_join(spark, d):
    found = cl.kmer_join(sd.reads(spark, d), sd.language_kmers(spark, d), 11)
    return found.groupBy("ord").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("taxa"))


# --- similarity search -------------------------------------------------------

def _search_sql(
    k: int, match: int, mismatch: int, lam: str, kappa: str, reach: int = 500,
    passing: str = "length(qs) * (SELECT sum(length(rs)) FROM rd) * pow(2::DOUBLE, -bits) <= 1e-5", least: int = 15,
) -> str:
    """Maximal-scoring segments by their definition, on tables ``qd (q, qs)`` and ``rd (r, rs)``.

    ``st`` and ``en`` are the places where stretches of equal letters begin and
    end, with the score summed up to there. A pair of them is a candidate if its
    e-value passes, all other begins inside have higher sums and all other ends
    inside lower ones; a segment is a candidate no other candidate contains.
    """
    key = "q, r, diag, region"
    return (
        f"qk AS (SELECT q, p AS qpos, substring(qs, p, {k}) AS kmer FROM (SELECT q, qs, unnest(range(1, length(qs) - {k - 2})) AS p FROM qd)), "
        f"rk AS (SELECT r, p AS rpos, substring(rs, p, {k}) AS kmer FROM (SELECT r, rs, unnest(range(1, length(rs) - {k - 2})) AS p FROM rd)), "
        "sp AS (SELECT q, r, qpos - rpos AS diag, qpos FROM qk JOIN rk USING (kmer) WHERE NOT regexp_matches(kmer, '[*X]')), "
        f"sg AS (SELECT *, CASE WHEN qpos - lag(qpos) OVER w > {2 * reach + k} THEN 1 ELSE 0 END AS nu FROM sp WINDOW w AS (PARTITION BY q, r, diag ORDER BY qpos)), "
        "si AS (SELECT q, r, diag, qpos, sum(nu) OVER (PARTITION BY q, r, diag ORDER BY qpos) AS region FROM sg), "
        f"reg AS (SELECT {key}, greatest(min(qpos) - {reach}, 1, diag + 1) AS s, max(qpos) + {k - 1 + reach} AS e FROM si GROUP BY {key}), "
        f"pos AS (SELECT {key}, qs, rs, unnest(range(s, least(e, length(qs), length(rs) + diag) + 1)) AS p FROM reg JOIN qd USING (q) JOIN rd USING (r)), "
        f"eq AS (SELECT {key}, p, qs[p] = rs[p - diag] AS same FROM pos), "
        f"run AS (SELECT *, lag(same) OVER w AS prev, lead(same) OVER w AS nxt, sum(CASE WHEN same THEN {match} ELSE {mismatch} END) OVER w AS up "
        f"FROM eq WINDOW w AS (PARTITION BY {key} ORDER BY p)), "
        f"st AS (SELECT {key}, p AS i, up - {match} AS low FROM run WHERE same AND prev IS NOT TRUE), "
        f"en AS (SELECT {key}, p AS j, up AS high FROM run WHERE same AND nxt IS NOT TRUE), "
        f"bits AS (SELECT {key}, i, j, low, high, ((high - low) * {lam}::DOUBLE - ln({kappa}::DOUBLE)) / ln(2::DOUBLE) AS bits FROM st JOIN en USING ({key}) "
        f"WHERE j >= i AND high - low >= {least}), "
        "pass AS (SELECT bits.*, length(qs) * (SELECT sum(length(rs)) FROM rd) * pow(2::DOUBLE, -bits) AS evalue, length(qs) AS qlen "
        f"FROM bits JOIN qd USING (q) WHERE {passing}), "
        f"cand AS (SELECT * FROM pass c WHERE NOT EXISTS (SELECT 1 FROM st x WHERE (x.q, x.r, x.diag, x.region) = (c.q, c.r, c.diag, c.region) AND x.i > c.i AND x.i <= c.j AND x.low <= c.low) "
        f"AND NOT EXISTS (SELECT 1 FROM en x WHERE (x.q, x.r, x.diag, x.region) = (c.q, c.r, c.diag, c.region) AND x.j >= c.i AND x.j < c.j AND x.high >= c.high)), "
        "seg AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand x WHERE (x.q, x.r, x.diag, x.region) = (c.q, c.r, c.diag, c.region) "
        "AND x.i <= c.i AND x.j >= c.j AND x.j - x.i > c.j - c.i) "
        f"AND EXISTS (SELECT 1 FROM sp WHERE (sp.q, sp.r, sp.diag) = (c.q, c.r, c.diag) AND sp.qpos >= c.i AND sp.qpos + {k - 1} <= c.j)), "
        f"ev AS (SELECT {key}, i AS qstart, j AS qend, j - i + 1 AS length, ((high - low) - (j - i + 1) * {mismatch}) // {match - mismatch} AS matches, high - low AS raw, bits, evalue, qlen FROM seg) "
    )


_NUCLEOTIDES = se.matrix_scoring(al.nucleotide_matrix())
_LAM, _KAPPA = repr(_NUCLEOTIDES.lam), repr(_NUCLEOTIDES.kappa)

_STRANDS = (
    "sides AS (SELECT id, ord, '+' AS strand, seq FROM seqs UNION ALL SELECT id, ord, '-', translate(reverse(seq), 'ACGT', 'TGCA') FROM seqs), "
    "qd AS (SELECT md5(seq) AS q, any_value(seq) AS qs FROM sides GROUP BY 1), "
    "rd AS (SELECT md5(seq) AS r, any_value(seq) AS rs FROM refs GROUP BY 1)"
)


@query(
    "similarity_search",
    _with(sd.SEQS, sd.REFS, _STRANDS, _search_sql(15, 1, -2, "1.33", "0.621"))
    + "SELECT s.id AS qseqid, f.id AS sseqid, s.ord, strand, round(100.0 * matches / length, 6)::DOUBLE AS pident, "
    "CAST(length AS INTEGER) AS length, CAST(CASE strand WHEN '+' THEN qstart ELSE qlen - qend + 1 END AS INTEGER) AS qstart, "
    "CAST(CASE strand WHEN '+' THEN qend ELSE qlen - qstart + 1 END AS INTEGER) AS qend, "
    "CAST(qstart - diag AS INTEGER) AS sstart, round(bits, 6) AS bitscore "
    "FROM ev JOIN sides s ON md5(s.seq) = q JOIN refs f ON md5(f.seq) = r",
)
def similarity_search(spark, d):
    """All segments on both strands."""
    out = se.similarity_search(sd.seqs(spark, d), sd.refs(spark, d), 15)
    return out.select(
        "qseqid", "sseqid", "ord", "strand", F.round("pident", 6).alias("pident"), "length", "qstart",
        "qend", "sstart", F.round("bitscore", 6).alias("bitscore"),
    )


def _frames_sql(name: str, source: str, columns: str) -> str:
    """Six-frame translation of a table with ``seq``: ``strand``, ``f`` and ``protein``."""
    return (
        f"{name}_s AS (SELECT {columns}, '+' AS strand, seq AS dna FROM {source} UNION ALL "
        f"SELECT {columns}, '-', translate(reverse(seq), 'ACGT', 'TGCA') FROM {source}), "
        f"{name} AS (SELECT {columns}, strand, length(dna) AS n, CAST(f AS INTEGER) AS f, coalesce(array_to_string(list_transform("
        f"range(f, length(dna) - 1, 3), lambda p: {AMINO_SQL}), ''), '') AS protein FROM {name}_s, range(1, 4) t(f))"
    )


@query(
    "translated_search",
    _with(
        sd.SEQS, sd.REFS, _frames_sql("qf", "seqs", "id, ord"), _frames_sql("rf", "refs", "id"),
        "qd AS (SELECT md5(protein) AS q, any_value(protein) AS qs FROM qf GROUP BY 1)",
        "rp AS (SELECT id, protein FROM rf WHERE strand = '+' AND f = 1)",
        "rd AS (SELECT md5(protein) AS r, any_value(protein) AS rs FROM rp GROUP BY 1)",
        _search_sql(5, 5, -2, repr(se.PROTEIN.lam), repr(se.PROTEIN.kappa)),
    )
    + "SELECT s.id AS qseqid, p.id AS sseqid, s.ord, strand, CAST(CASE strand WHEN '+' THEN f + (qstart - 1) * 3 "
    "ELSE n - (f + qend * 3 - 1) + 1 END AS INTEGER) AS qstart, CAST(CASE strand WHEN '+' THEN f + qend * 3 - 1 "
    "ELSE n - (f + (qstart - 1) * 3) + 1 END AS INTEGER) AS qend, round(100.0 * matches / length, 6)::DOUBLE AS pident, "
    "CAST(length AS INTEGER) AS length, round(bits, 6) AS bitscore "
    "FROM ev JOIN qf s ON md5(s.protein) = q JOIN rp p ON md5(p.protein) = r",
)
def translated_search(spark, d):
    """Six frames of the documents in the first frame of the benchmark items."""
    frames = fs.translate_frames(sd.refs(spark, d), keep=("id", "description"))
    proteins = frames.filter("strand = '+' AND frame = 1").select(
        "id", "description", F.col("protein").alias("seq")
    )
    return se.translated_search(sd.seqs(spark, d), proteins, 5).select(
        "qseqid", "sseqid", "ord", "strand", "qstart", "qend", F.round("pident", 6).alias("pident"), "length",
        F.round("bitscore", 6).alias("bitscore"),
    )


def _extension_sql(match: int, mismatch: int, first: int, more: int, xdrop: int, band: int) -> str:
    """Gapped extension of the segments ``ev`` to both sides, one anti-diagonal a step: ``ext``.

    A cell ``c`` holds the last two anti-diagonals of the diagonal ``c - band - 1``: scores
    of alignments that end with a pair (h), a letter of the query (f) or of the subject
    (e) against a gap, and their counts: matches, 2^20 for a gap, 2^40 for a column.
    """
    never, gap, col = -(1 << 28), 1 << 20, 1 << 40
    new = first + more
    return (
        "hit AS (SELECT row_number() OVER () AS n, ev.*, qstart - diag AS sstart, qend - diag AS send, qs, rs FROM ev JOIN qd USING (q) JOIN rd USING (r)), "
        "side AS (SELECT 2 * n AS n, reverse(qs[1 : qstart - 1]) AS a, reverse(rs[1 : sstart - 1]) AS b FROM hit UNION ALL "
        "SELECT 2 * n + 1, qs[qend + 1 :], rs[send + 1 :] FROM hit), "
        f"step AS (SELECT n, c, 0 AS d, CASE WHEN c = {band + 1} THEN 0 ELSE {never} END AS h, {never} AS e, {never} AS f, "
        f"0::BIGINT AS hc, 0::BIGINT AS ec, 0::BIGINT AS fc, 0 AS best, 0::BIGINT AS bc, 0 AS bi, 0 AS bj FROM side, range(1, {2 * band + 2}) t(c) "
        "UNION ALL SELECT n, c, d, "
        f"CASE WHEN NOT act THEN h WHEN now >= top - {xdrop} THEN now ELSE {never} END, "
        f"CASE WHEN NOT act THEN e WHEN fits AND en >= top - {xdrop} THEN en ELSE {never} END, "
        f"CASE WHEN NOT act THEN f WHEN fits AND fn >= top - {xdrop} THEN fn ELSE {never} END, "
        "CASE WHEN act THEN cnt ELSE hc END, CASE WHEN act THEN enc ELSE ec END, CASE WHEN act THEN fnc ELSE fc END, top, "
        "CASE WHEN top > best THEN peak.cnt ELSE bc END, CASE WHEN top > best THEN peak.i ELSE bi END, CASE WHEN top > best THEN peak.j ELSE bj END "
        "FROM (SELECT *, greatest(best, max(now) FILTER (act) OVER g) AS top, "
        "arg_max({'cnt': cnt, 'i': i, 'j': j}, now::BIGINT * 100000 - c) FILTER (act) OVER g AS peak "
        f"FROM (SELECT *, CASE WHEN NOT fits THEN {never} WHEN greatest(pn, fn) < en THEN en WHEN pn < fn THEN fn ELSE pn END AS now, "
        "CASE WHEN greatest(pn, fn) < en THEN enc WHEN pn < fn THEN fnc ELSE pc END AS cnt FROM ("
        f"SELECT *, i >= 0 AND j >= 0 AND (i + j) = d AND (d + c + {band + 1}) % 2 = 0 AS act, i <= length(a) AND j <= length(b) AS fits, "
        f"greatest(hu - {new}, fu - {more}) AS fn, CASE WHEN hu - {new} >= fu - {more} THEN huc + {gap} ELSE fuc END + {col} AS fnc, "
        f"greatest(hd - {new}, ed - {more}) AS en, CASE WHEN hd - {new} >= ed - {more} THEN hdc + {gap} ELSE edc END + {col} AS enc, "
        f"CASE WHEN i > 0 AND j > 0 THEN h + CASE WHEN a[i] = b[j] THEN {match} ELSE {mismatch} END ELSE {never} END AS pn, "
        f"hc + {col} + CASE WHEN a[i] = b[j] THEN 1 ELSE 0 END AS pc "
        f"FROM (SELECT step.* REPLACE (d + 1 AS d), a, b, (d + 1 + c - {band + 1}) // 2 AS i, (d + 1 - c + {band + 1}) // 2 AS j, "
        + ", ".join(
            f"coalesce({way}({x}{y}) OVER o, {default}) AS {x}{to}{y}"
            for way, to, names in (("lag", "u", "hf"), ("lead", "d", "he"))
            for x in names for y, default in (("", never), ("c", 0))
        )
        + " FROM step JOIN side USING (n) WINDOW o AS (PARTITION BY n ORDER BY c))) x) y WINDOW g AS (PARTITION BY n)) z "
        f"QUALIFY max(CASE WHEN act THEN CASE WHEN now >= top - {xdrop} THEN 1 ELSE 0 END ELSE CASE WHEN h > {never // 2} THEN 1 ELSE 0 END END) OVER (PARTITION BY n) = 1 "
        "OR max(top - best) OVER (PARTITION BY n) > 0), "
        "found AS (SELECT n, arg_max({'s': best, 'c': bc, 'i': bi, 'j': bj}, d) AS x FROM step GROUP BY n), "
        f"grown AS (SELECT q, r, qlen, hit.diag, qstart - l.x.i AS qstart, qend + t.x.i AS qend, sstart - l.x.j AS sstart, send + t.x.j AS send, "
        f"raw + l.x.s + t.x.s AS raw, matches + (l.x.c + t.x.c) % {gap} AS matches, ((l.x.c + t.x.c) // {gap}) % {gap} AS gapopen, "
        f"length + (l.x.c + t.x.c) // {col} AS length FROM hit JOIN found l ON l.n = 2 * hit.n JOIN found t ON t.n = 2 * hit.n + 1), "
        "ext AS (SELECT * FROM (SELECT * FROM grown QUALIFY row_number() OVER (PARTITION BY q, r, qstart, sstart ORDER BY raw DESC, qend, send, diag) = 1) "
        "QUALIFY row_number() OVER (PARTITION BY q, r, qend, send ORDER BY raw DESC, qstart, sstart, diag) = 1) "
    )


#: Stand-ins for relatives: the items' sequences with a letter less and two more.
GAPPED_REFS = (
    "cut AS (SELECT id, seq, length(seq) // 3 AS t FROM refs), "
    "kin AS (SELECT id, seq[1 : t] || seq[t + 2 : 2 * t] || 'AC' || seq[2 * t + 1 :] AS seq FROM cut)"
)


@query(
    "gapped_search",
    _with(
        sd.SEQS, sd.REFS, GAPPED_REFS, "qd AS (SELECT md5(seq) AS q, any_value(seq) AS qs FROM seqs GROUP BY 1)",
        "rd AS (SELECT md5(seq) AS r, any_value(seq) AS rs FROM kin GROUP BY 1)",
        _search_sql(13, 1, -2, _LAM, _KAPPA, passing="bits >= 18", least=9)[:-1],
        _extension_sql(1, -2, 2, 2, 12, 8),
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    + "SELECT s.id AS qseqid, k.id AS sseqid, s.ord, round(100.0 * matches / ext.length, 6)::DOUBLE AS pident, "
    "CAST(ext.length AS INTEGER) AS length, CAST(qend - qstart + send - sstart + 2 - ext.length - matches AS INTEGER) AS mismatch, "
    "CAST(gapopen AS INTEGER) AS gapopen, CAST(qstart AS INTEGER) AS qstart, CAST(qend AS INTEGER) AS qend, "
    "CAST(sstart AS INTEGER) AS sstart, CAST(send AS INTEGER) AS send, round(bits, 6) AS bitscore, k.id AS stitle "
    f"FROM (SELECT *, (raw * {_LAM}::DOUBLE - ln({_KAPPA}::DOUBLE)) / ln(2::DOUBLE) AS bits FROM ext) ext "
    "JOIN seqs s ON md5(s.seq) = q JOIN kin k ON md5(k.seq) = r "
    "WHERE qlen * (SELECT sum(length(rs)) FROM rd) * pow(2::DOUBLE, -bits) <= 1e-5",
)
def gapped_search(spark, d):
    """The documents in relatives of the items, over gaps."""
    t = F.expr("length(seq) div 3")
    kin = F.concat(
        F.col("seq").substr(F.lit(1), t), F.col("seq").substr(t + 2, t - 1), F.lit("AC"), F.col("seq").substr(2 * t + 1, F.length("seq")),
    )
    refs = sd.refs(spark, d).select("id", F.col("id").alias("description"), kin.alias("seq"))
    out = se.similarity_search(
        sd.seqs(spark, d), refs, 13, strands=False, scoring=_NUCLEOTIDES, gaps=se.Gaps(xdrop=12, band=8, trigger_bits=18)
    )
    return out.select(
        "qseqid", "sseqid", "ord", F.round("pident", 6).alias("pident"), "length", "mismatch", "gapopen", "qstart",
        "qend", "sstart", "send", F.round("bitscore", 6).alias("bitscore"), "stitle",
    )


# --- cache -------------------------------------------------------------------

LATEST = (
    "latest AS (SELECT md5('q' || user_id) AS seq_md5, arg_max(event_id, ts) AS result, "
    "max(epoch_us(ts))::DOUBLE AS timestamp FROM events GROUP BY 1)"
)


def _cache(spark, d):
    return sd.table(spark, d, "events").select(
        F.md5(F.concat(F.lit("q"), F.col("user_id").cast("string"))).alias("seq_md5"),
        F.col("event_id").alias("result"),
        F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("timestamp"),
    )


@query("latest_per_key", f"WITH {LATEST} SELECT seq_md5, result, timestamp FROM latest")
def latest_per_key(spark, d):
    return oc.latest_per_key(_cache(spark, d))


@query(
    "fresh_entries",
    "SELECT event_id FROM events WHERE epoch_us(ts) / 1e6 > 1706659200.0 - 7 * 86400.0",
)
def fresh_entries(spark, d):
    cache = sd.table(spark, d, "events").select("event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("timestamp"))
    return oc.fresh_entries(cache, 1706659200.0, 7).select("event_id")


@query(
    "cache_lookup",
    f"WITH {LATEST}, q AS (SELECT o_orderkey AS ord, md5('q' || o_custkey) AS m FROM orders) "
    "SELECT ord, 'hit' AS state, result, 1::BIGINT AS copies FROM q JOIN latest ON m = seq_md5 UNION ALL "
    "SELECT min(ord), 'search', NULL, count(*) FROM q WHERE m NOT IN (SELECT seq_md5 FROM latest) GROUP BY m",
)
def cache_lookup(spark, d):
    s = sd.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("q"), F.col("o_custkey").cast("string")).alias("seq"),
    )
    found, todo = oc.lookup_cache(s, oc.latest_per_key(_cache(spark, d)))
    one = F.lit(1).cast("long")
    return found.select("ord", F.lit("hit").alias("state"), "result", one.alias("copies")).unionByName(
        todo.select("ord", F.lit("search").alias("state"), F.lit(None).cast("long").alias("result"), "copies")
    )


# --- files -------------------------------------------------------------------


@query("fasta_round_trip", _with(sd.SEQS, UNIQUE) + "SELECT unique_id AS id, length(seq) AS len, md5(seq) AS m FROM named")
def fasta_round_trip(spark, d):
    path = scratch_path(spark, "fasta")
    wr.write_fasta(sd.seqs(spark, d), path)
    return ss.read_fasta(spark, path).select(
        "id", F.length("seq").cast("long").alias("len"), F.md5("seq").alias("m")
    )


@query("fastq_round_trip", _with(sd.READS, sd.QUALS) + "SELECT id, seq, qual FROM fastq")
def fastq_round_trip(spark, d):
    path = scratch_path(spark, "fastq")
    wr.write_fastq(sd.fastq(spark, d), path)
    return ss.read_fastq(spark, path).select("id", "seq", "qual")


@query(
    "fastq_to_fasta",
    _with(sd.READS) + "SELECT id, seq FROM reads",
)
def fastq_to_fasta(spark, d):
    return os_.fastq_to_fasta(sd.fastq(spark, d)).select("id", "seq")


@query(
    "hit_file_7",
    H + "SELECT stitle, count(*) AS n, round(sum(bitscore), 2) AS bits, round(avg(pident), 6) AS pident FROM hits GROUP BY 1",
)
def hit_file_7(spark, d):
    path = scratch_path(spark, "hits7")
    h = sd.hits(spark, d).withColumn("length", F.lit(100))
    wr.write_tsv(h.select("qseqid", "sseqid", "pident", "length", "evalue", "bitscore", "stitle"), path)
    return st.read_diamond(spark, path, ordered=False).groupBy("stitle").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("bitscore"), 2).alias("bits"),
        F.round(F.avg("pident"), 6).alias("pident"),
    )


@query("hit_file_13", H + "SELECT qseqid::VARCHAR AS qseqid, sseqid::VARCHAR AS sseqid, pident, bitscore, stitle FROM hits")
def hit_file_13(spark, d):
    path = scratch_path(spark, "hits13")
    filler = ["length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send"]
    h = sd.hits(spark, d).select(
        "qseqid", "sseqid", "pident", *[F.lit(i).alias(c) for i, c in enumerate(filler)],
        "evalue", "bitscore", "stitle",
    )
    wr.write_tsv(h, path)
    return st.read_diamond(spark, path, 13).select("qseqid", "sseqid", "pident", "bitscore", "stitle")


@query("flagged_hits_file", f'WITH {TAGGED} SELECT "Pathogenic", staxids::VARCHAR AS staxids, count(*) AS n FROM tagged GROUP BY 1, 2')
def flagged_hits_file(spark, d):
    path = scratch_path(spark, "flagged")
    wr.write_tsv(_tagged(spark, d).select("qseqid", "sseqid", "staxids", "Pathogenic"), path, header=True)
    return st.read_flagged_hits(spark, path).groupBy("Pathogenic", "staxids").agg(F.count(F.lit(1)).alias("n"))


@query("results_file", RC + "SELECT organism, total_hits FROM counts")
def results_file(spark, d):
    path = scratch_path(spark, "results")
    wr.write_json(sd.results(spark, d).drop("ord"), path)
    r = st.read_blast_results(spark, path, multiline=False)
    return oh.organism_hit_counts(oh.explode_hits(r)).select("organism", "total_hits")


@query("hit_cache_file", f"WITH {LATEST} SELECT seq_md5, result FROM latest")
def hit_cache_file(spark, d):
    path = scratch_path(spark, "cache")
    wr.save_hit_cache(_cache(spark, d), path)
    return oc.latest_per_key(st.load_hit_cache(spark, path)).select("seq_md5", "result")


@query("csv_report", RC + "SELECT organism, total_hits FROM counts ORDER BY total_hits DESC, seen LIMIT 10")
def csv_report(spark, d):
    path = scratch_path(spark, "csv")
    wr.write_csv(oh.organism_comparison(sd.results(spark, d)), path)
    return spark.read.option("header", True).schema(
        "rank_no int, organism string, total_hits long, sequences_with_hits long, avg_hits_per_sequence double"
    ).csv(path).select("organism", "total_hits")


GFF_TYPE = "CASE l_returnflag WHEN 'R' THEN 'CDS' WHEN 'A' THEN 'tRNA' ELSE 'rRNA' END"


def _gff(spark, d):
    path = scratch_path(spark, "gff")
    kind = F.when(F.col("l_returnflag") == "R", "CDS").when(F.col("l_returnflag") == "A", "tRNA").otherwise("rRNA")
    cells = [
        F.col("l_orderkey").cast("string"), F.lit("tool"), kind, F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.lit("."), F.lit("+"), F.lit("0"),
        F.concat(F.lit("ID=g"), F.col("l_partkey").cast("string"), F.lit(";product=p "), F.col("l_linestatus")),
    ]
    line = sd.table(spark, d, "lineitem").select(F.concat_ws("\t", *cells).alias("value"))
    head = line.limit(1).select(F.lit("##gff-version 3").alias("value"))
    line.unionByName(head).write.text(path)
    return st.read_gff(spark, path)


@query("feature_counts", f"SELECT {GFF_TYPE} AS type, count(*) AS n FROM lineitem GROUP BY 1")
def feature_counts(spark, d):
    return fe.feature_counts(_gff(spark, d))


@query(
    "gff_attributes",
    f"SELECT {GFF_TYPE} AS type, 'p ' || l_linestatus AS product, count(DISTINCT 'g' || l_partkey) AS ids, "
    "CAST(sum(l_linenumber) AS BIGINT) AS starts FROM lineitem GROUP BY 1, 2",
)
def gff_attributes(spark, d):
    g = _gff(spark, d)
    return g.groupBy("type", F.col("attributes")["product"].alias("product")).agg(
        F.count_distinct(F.col("attributes")["ID"]).alias("ids"), F.sum("start").alias("starts")
    )


@query(
    "annotation_stats",
    S + "SELECT count(*) AS contigs, CAST(sum(length(seq)) AS BIGINT) AS bases, "
    "(SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS cds FROM seqs",
)
def annotation_stats(spark, d):
    return fe.annotation_stats(_gff(spark, d), sd.seqs(spark, d))


@query(
    "annotation_file",
    "SELECT o_orderkey::VARCHAR AS locus_tag, 'CDS' AS ftype, CAST(o_custkey AS INTEGER) AS length_bp, "
    "o_orderpriority AS product FROM orders",
)
def annotation_file(spark, d):
    path = scratch_path(spark, "annotation")
    none = F.lit(None).cast("string")
    table = sd.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("locus_tag"), F.lit("CDS").alias("ftype"),
        F.col("o_custkey").alias("length_bp"), none.alias("gene"), none.alias("EC_number"),
        none.alias("COG"), F.col("o_orderpriority").alias("product"),
    )
    wr.write_tsv(table, path, header=True)
    return st.read_annotation(spark, path).select("locus_tag", "ftype", "length_bp", "product")


@query(
    "taxonomy_files",
    _with(sd.PLACES) + "SELECT taxid, parent, rank, name FROM places",
)
def taxonomy_files(spark, d):
    nodes, names = scratch_path(spark, "nodes"), scratch_path(spark, "names")
    t = sd.place_nodes(spark, d)
    bar = "\t|\t"
    t.select(
        F.concat(F.concat_ws(bar, F.col("taxid").cast("string"), F.coalesce("parent", "taxid").cast("string"), "rank"), F.lit("\t|")).alias("value")
    ).write.text(nodes)
    t.select(
        F.concat(F.concat_ws(bar, F.col("taxid").cast("string"), "name", F.lit(""), F.lit("scientific name")), F.lit("\t|")).alias("value")
    ).write.text(names)
    return st.read_taxonomy(spark, nodes, names).select("taxid", "parent", "rank", "name")


MANIFEST = (
    "man0 AS (SELECT '/out/' || p_partkey || '/' || name AS path, name FROM (SELECT p_partkey, CASE "
    "WHEN p_brand = 'Brand#1' THEN 'taxonomy_overview.html' WHEN p_brand = 'Brand#2' THEN 'pathogen_summary.html' "
    "WHEN p_brand = 'Brand#3' THEN 'prokka.txt' WHEN p_brand = 'Brand#4' THEN 'analysis_dashboard.html' "
    "ELSE replace(p_name, ' ', '_') || '.html' END AS name FROM part)), "
    "man AS (SELECT * FROM man0 WHERE name LIKE '%.html' AND name <> 'analysis_dashboard.html')"
)
TAGS_SQL = (
    "tags AS (SELECT path, name, t.tag FROM man JOIN (VALUES "
    + ", ".join(f"('{g}', '{t}')" for g, ts in fe.ARTIFACT_TERMS.items() for t in ts)
    + ") t(tag, term) ON contains(name, term)), grp AS (SELECT DISTINCT path, name, tag AS \"group\" FROM tags "
    "UNION ALL SELECT path, name, 'other' FROM man WHERE path NOT IN (SELECT path FROM tags))"
)


def _manifest(spark, d):
    brand = F.col("p_brand")
    name = (
        F.when(brand == "Brand#1", "taxonomy_overview.html")
        .when(brand == "Brand#2", "pathogen_summary.html")
        .when(brand == "Brand#3", "prokka.txt")
        .when(brand == "Brand#4", "analysis_dashboard.html")
        .otherwise(F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".html")))
    )
    return sd.table(spark, d, "part").select(
        F.concat(F.lit("/out/"), F.col("p_partkey").cast("string"), F.lit("/"), name).alias("path"),
        name.alias("name"),
    )


@query("artifact_groups", _with(MANIFEST, TAGS_SQL) + 'SELECT path, name, "group" FROM grp')
def artifact_groups(spark, d):
    return fe.artifact_groups(_manifest(spark, d))


@query("report_counts", _with(MANIFEST, TAGS_SQL) + 'SELECT "group", count(*) AS n FROM grp GROUP BY 1')
def report_counts(spark, d):
    return fe.report_counts(_manifest(spark, d))


@query("ungrouped_artifacts", _with(MANIFEST, TAGS_SQL) + "SELECT path, name FROM grp WHERE \"group\" = 'other'")
def ungrouped_artifacts(spark, d):
    return fe.ungrouped_artifacts(_manifest(spark, d))


@query(
    "key_artifacts",
    _with(MANIFEST) + "SELECT path, name FROM man WHERE name IN ('taxonomy_overview.html', "
    "'pathogen_summary.html', 'annotation_quality.html', 'krona.html')",
)
def key_artifacts(spark, d):
    return fe.key_artifacts(_manifest(spark, d))


@query(
    "missing_items",
    "SELECT 'o' || o_orderkey AS path, o_orderpriority AS label, o_totalprice > 100000 AS required, CASE WHEN "
    "o_totalprice > 100000 THEN 'required' ELSE 'optional' END AS need FROM orders "
    "WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def missing_items(spark, d):
    expected = sd.table(spark, d, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_orderpriority").alias("label"), (F.col("o_totalprice") > 100000).alias("required"),
    )
    present = sd.table(spark, d, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("path")
    )
    return fe.missing_items(expected, present)


# --- more files --------------------------------------------------------------


@query(
    "paired_files",
    _with(sd.READS, sd.QUALS, "n AS (SELECT row_number() OVER (ORDER BY ord) - 1 AS i, * FROM fastq)")
    + "SELECT a.id AS id1, a.seq AS seq1, a.qual AS qual1, b.seq AS seq2, a.id = b.id AS same_name "
    "FROM n a JOIN n b ON a.i = b.i",
)
def paired_files(spark, d):
    """Mates written to two files and read back side by side; mate 2 is the reverse of mate 1."""
    paths = [scratch_path(spark, f"mate{m}") for m in (1, 2)]
    for path in paths:
        wr.write_fastq(sd.fastq(spark, d), path)
    wide = ss.pair_up(ss.read_paired(spark, *paths))
    return wide.select("id1", "seq1", "qual1", "seq2", "same_name")


_BRACKEN = (
    _with(sd.PLACES, sd.PLACE_CLOSURE, sd.ORDER_TAXA, CLADES, DISTR, ESTIMATE)
    + "SELECT name, taxonomy_id, 'S' AS taxonomy_lvl, kraken_assigned_reads, "
    "CAST(floor(estimate + 1e-9) AS BIGINT) - kraken_assigned_reads AS added_reads, "
    "CAST(floor(estimate + 1e-9) AS BIGINT) AS new_est_reads, "
    "round(estimate / (SELECT sum(estimate) FROM est), 5) AS fraction_total_reads FROM est"
)


def _bracken_file(spark, d):
    path = scratch_path(spark, "bracken")
    table = tx.bracken_table(_estimate(spark, d, sd.place_tree(spark, d)))
    wr.write_tsv(table.coalesce(1), path, header=True)
    return path


@query("bracken_file", _BRACKEN)
def bracken_file(spark, d):
    return st.read_bracken(spark, _bracken_file(spark, d)).drop("ord")


@query("abundance_file", f"SELECT name, fraction_total_reads FROM ({_BRACKEN})")
def abundance_file(spark, d):
    return st.read_abundance(spark, _bracken_file(spark, d)).select("name", "fraction_total_reads")


@query("id_map_file", "SELECT p_name AS sseqid, p_partkey AS taxid FROM part")
def id_map_file(spark, d):
    path = scratch_path(spark, "ids")
    wr.write_tsv(sd.table(spark, d, "part").select("p_name", "p_partkey"), path)
    return st.read_id_map(spark, path)


@query(
    "hit_cache_json",
    _with(sd.RESULTS) + ", last AS (SELECT query_id, max(ord) AS ord FROM results GROUP BY 1) "
    "SELECT md5(query_id) AS seq_md5, query_id, epoch_us(ts)::DOUBLE AS timestamp, error "
    "FROM results JOIN last USING (query_id, ord)",
)
def hit_cache_json(spark, d):
    """The last result of each query as JSON objects of some thousand keys, imported with its times."""
    path = scratch_path(spark, "cache") + ".json"
    last = sd.results(spark, d).groupBy("query_id").agg(F.max_by(F.struct("*"), "ord").alias("r"))
    wr.write_hit_cache_json(last.select(F.md5("query_id").alias("seq_md5"), F.col("r").alias("result")), path)
    cache = oc.latest_per_key(st.load_hit_cache(spark, path, multiline=False))
    return cache.select("seq_md5", "result.query_id", "timestamp", "result.error")


@query(
    "annotation_summary_text",
    H + "SELECT * FROM (SELECT unnest([1, 2, 3, 4, 5, 6]) AS line_no, unnest(['Functional Annotation Summary', "
    "repeat('=', 30), 'Total Annotations: ' || count(*), format('Mean Identity %: {:.2f}', avg(pident)), "
    "'High Quality Hits (>70%): ' || count(*) FILTER (pident > 70), "
    "'Excellent Hits (>90%): ' || count(*) FILTER (pident > 90)]) AS line FROM hits)",
)
def annotation_summary_text(spark, d):
    text = wr.annotation_summary_text(oh.annotation_summary(sd.hits(spark, d)))
    return spark.createDataFrame(list(enumerate(text.splitlines(), 1)), "line_no int, line string")


@query(
    "taxonomy_summary_text",
    RC + ", m AS (SELECT (SELECT count(*) FROM results) AS n, count(DISTINCT ord) AS hit, count(*) AS total, "
    "count(DISTINCT organism) AS orgs FROM flat) "
    "SELECT unnest(['Total sequences analyzed: ' || n, 'Sequences with hits: ' || hit, 'Total BLAST hits: ' || total, "
    "'Unique organisms identified: ' || orgs, format('Classification rate: {:.1f}%', 100 * hit / n)]) AS line FROM m "
    "UNION ALL SELECT rpad(substring(organism, 1, 29), 30, ' ') || ' ' || rpad(total_hits::VARCHAR, 10, ' ') || ' ' || "
    "rpad(seqs::VARCHAR, 10, ' ') || ' ' || rpad((t // 10) || '.' || (t % 10), 12, ' ') "
    "FROM (SELECT *, (20 * total_hits + seqs) // (2 * seqs) AS t FROM counts ORDER BY total_hits DESC, seen LIMIT 20)",
)
def taxonomy_summary_text(spark, d):
    """The counted lines and the top table of the written summary."""
    text = wr.taxonomy_summary_text(sd.results(spark, d))
    kept = [x for x in text.splitlines() if ": " in x and "Average" not in x or x.startswith(("org", "Unknown"))]
    return spark.createDataFrame([(x,) for x in kept], "line string")


# --- pipelines ---------------------------------------------------------------


@query(
    "reads_to_abundance",
    _with(sd.LEAVES, DB_SQL, sd.READS, CLASSIFY_SQL[:-1],
          "cw AS (SELECT w.taxid, u.a AS ancestor FROM win w JOIN up u USING (taxid))")
    + "SELECT ancestor AS taxid, count(*) AS clade_reads, count(*) FILTER (ancestor = taxid) AS taxon_reads, "
    "round(100.0 * count(*) / (SELECT count(*) FROM reads), 6)::DOUBLE AS percentage FROM cw GROUP BY 1 UNION ALL "
    "SELECT NULL, n, n, round(100.0 * n / (SELECT count(*) FROM reads), 6)::DOUBLE FROM "
    "(SELECT count(*) AS n FROM reads WHERE ord NOT IN (SELECT ord FROM win)) WHERE n > 0",
)
def reads_to_abundance(spark, d):
    """The FASTQ analysis: all reads classified against all documents, as a clade report."""
    out = pl.reads_to_abundance(sd.reads(spark, d), sd.language_kmers(spark, d), sd.language_tree(spark, d), 11)
    return out["report"].select(
        "taxid", "clade_reads", "taxon_reads", F.round("percentage", 6).alias("percentage")
    )


_LONG = "lg AS (SELECT * FROM seqs WHERE length(seq) >= 50)"
_ORGANISM = (
    rf"CASE WHEN contains(description, '[') AND contains(description, ']') THEN trim(replace(split_part(description, '[', -1), ']', '')) "
    rf"WHEN regexp_extract(description, '{ft.GENUS_SPECIES}', 1) <> '' THEN regexp_extract(description, '{ft.GENUS_SPECIES}', 1) "
    rf"|| ' ' || regexp_extract(description, '{ft.GENUS_SPECIES}', 2) ELSE array_to_string(list_filter("
    r"regexp_split_to_array(description, '\s+'), lambda w: w <> '')[1:3], ' ') END"
)


@query(
    "contigs_to_organisms",
    _with(sd.SEQS, sd.REFS, _LONG, _STRANDS.replace("FROM seqs", "FROM lg"), _search_sql(15, 1, -2, "1.33", "0.621"))
    + f"SELECT {_ORGANISM} AS organism, count(*) AS total_hits, count(DISTINCT s.id) AS sequences_with_hits "
    "FROM ev JOIN sides s ON md5(s.seq) = q JOIN refs f ON md5(f.seq) = r GROUP BY 1",
)
def contigs_to_organisms(spark, d):
    """The FASTA analysis with an empty cache: organisms of all hits of all contigs."""
    empty = st.load_hit_cache(spark, scratch_path(spark, "no-cache"))
    out = pl.contigs_to_organisms(sd.seqs(spark, d), sd.refs(spark, d), empty, 0.0, k=15)
    return out["counts"].select("organism", "total_hits", "sequences_with_hits")


_PROTEIN_HITS = _with(
    sd.SEQS, sd.REFS, _frames_sql("qf", "seqs", "id, ord"), _frames_sql("rf", "refs", "id, description"),
    "qd AS (SELECT md5(protein) AS q, any_value(protein) AS qs FROM qf GROUP BY 1)",
    "rp AS (SELECT id, description, protein FROM rf WHERE strand = '+' AND f = 1)",
    "rd AS (SELECT md5(protein) AS r, any_value(protein) AS rs FROM rp GROUP BY 1)",
    _search_sql(5, 5, -2, repr(se.PROTEIN.lam), repr(se.PROTEIN.kappa))[:-1],
    "ht AS (SELECT s.id AS qseqid, p.description AS title, bits, evalue, 100.0 * matches / length AS pident "
    "FROM ev JOIN qf s ON md5(s.protein) = q JOIN rp p ON md5(p.protein) = r)",
    "bt AS (SELECT * FROM ht QUALIFY bits >= max(bits) OVER (PARTITION BY qseqid) * 0.95)",
)


@query(
    "scan_contigs",
    _PROTEIN_HITS + f"SELECT {_case(ft.RESISTANCE_CLASSES)} AS category, count(*) AS n FROM bt "
    "WHERE pident >= 70 AND evalue <= 1e-10 GROUP BY 1",
)
def scan_contigs(spark, d):
    """The resistance scan: best hits of all contigs within 5 % of the top score, by class."""
    frames = fs.translate_frames(sd.refs(spark, d), keep=("id", "description"))
    proteins = frames.filter("strand = '+' AND frame = 1").select("id", "description", F.col("protein").alias("seq"))
    return pl.scan_contigs(sd.seqs(spark, d), proteins, "amr")["counts"]


# --- streams -----------------------------------------------------------------


def _event_stream(spark, d):
    schema = sd.table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query(
    "stream_organism_counts",
    "SELECT date_trunc('hour', ts) AS window_start, 'org' || json_extract_string(props, '$.k') AS organism, "
    "count(*) AS hits FROM events GROUP BY 1, 2",
)
def stream_organism_counts(spark, d):
    feed = _event_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "organism", F.concat(F.lit("org"), F.get_json_object("props", "$.k"))
    )
    out = scratch_path(spark, "stream-counts")
    feeds.run_available(feeds.stream_organism_counts(feed), out, scratch_path(spark, "stream-cp"), "update")
    rows = spark.read.parquet(out)
    start = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return rows.groupBy(start, "organism").agg(F.max_by("hits", "batch").alias("hits"))


@query("stream_dedup_sequences", "SELECT DISTINCT md5('s' || user_id || event_type) AS seq_md5 FROM events")
def stream_dedup_sequences(spark, d):
    feed = _event_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "seq", F.concat(F.lit("s"), F.col("user_id").cast("string"), F.col("event_type"))
    )
    out = scratch_path(spark, "stream-seqs")
    feeds.run_available(
        feeds.stream_dedup_sequences(feed).select("seq_md5"), out, scratch_path(spark, "stream-cp")
    )
    return spark.read.schema("seq_md5 string").parquet(out)
