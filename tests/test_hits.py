import json

import pytest
from pyspark.sql import functions as F

from biomeframe.operators import categories as cat
from biomeframe.operators import hits as oh
from biomeframe.sinks import writers as wr
from biomeframe.sources.tables import RESULT_SCHEMA

ORGANISMS = ["Escherichia coli"] * 2 + ["Salmonella enterica"] * 10 + ["Escherichia coli"] * 4
ORGANISMS += ["Klebsiella pneumoniae", "Cloning vector"] * 2


def results_frame(spark, rows):
    """rows: (query, [organisms] or None for an error)"""
    data = []
    for i, (query, organisms) in enumerate(rows):
        hits = [("h", "d", 10, 0.0, 1.0, 100.0, 50.0, o) for o in organisms or []]
        data.append((query, 6477, hits, 1.0, None if organisms is not None else "timed out", i))
    return spark.createDataFrame(data, RESULT_SCHEMA + ", ord long")


@pytest.fixture
def golden(spark):
    return results_frame(spark, [("NZ_CP162098.1", ORGANISMS)])


def test_golden_report(spark, golden):
    rows = oh.kraken_style_report(golden).orderBy(*oh.report_order()).collect()
    got = [(f"{r.percentage:.2f}", r.clade_reads, r.taxon_reads, r["rank"], r.taxid, r.name) for r in rows]
    assert got == [
        ("0.00", 0, 0, "U", 0, "unclassified"),
        ("50.00", 10, 1, "S", 0, "Salmonella enterica"),
        ("30.00", 6, 1, "S", 0, "Escherichia coli"),
        ("10.00", 2, 1, "S", 0, "Klebsiella pneumoniae"),
        ("10.00", 2, 1, "S", 0, "Cloning vector"),
    ]
    krona = oh.krona_rows(oh.kraken_style_report(golden)).collect()
    assert {tuple(r) for r in krona} == {
        (10, "Salmonella enterica"), (6, "Escherichia coli"), (2, "Klebsiella pneumoniae"),
        (2, "Cloning vector"),
    }


def test_golden_summary_text(spark, golden):
    text = wr.taxonomy_summary_text(golden)
    assert text == (
        "BLAST TAXONOMIC CLASSIFICATION SUMMARY\n" + "=" * 50 + "\n\n"
        "Total sequences analyzed: 1\nSequences with hits: 1\nTotal BLAST hits: 20\n"
        "Unique organisms identified: 4\n\nTOP ORGANISMS BY TOTAL HITS:\n" + "-" * 40 + "\n"
        "Organism                       Total Hits Sequences  Avg Hits/Seq\n" + "-" * 40 + "\n"
        "Salmonella enterica            10         1          10.0        \n"
        "Escherichia coli               6          1          6.0         \n"
        "Klebsiella pneumoniae          2          1          2.0         \n"
        "Cloning vector                 2          1          2.0         \n"
        "\nQUALITY METRICS:\n" + "-" * 20 + "\nClassification rate: 100.0%\n"
        "Average hits per classified sequence: 20.0\n"
    )


def test_metrics_keep_errors_and_empty_results_apart(spark):
    r = results_frame(spark, [("a", ["x", None]), ("a", ["y"]), ("b", []), ("c", None)])
    m = oh.classification_metrics(r).first()
    assert (m.n_results, m.n_ok, m.n_with_hits, m.total_hits, m.n_organisms) == (4, 3, 2, 3, 3)
    assert m.classification_rate == 50.0 and m.mean_hits_per_classified == 1.5
    top = oh.kraken_style_report(r).filter("top = 1").first()
    assert (round(top.percentage, 4), top.clade_reads) == (33.3333, 1)
    counts = {x.organism: (x.total_hits, x.sequences_with_hits)
              for x in oh.organism_hit_counts(oh.explode_hits(r)).collect()}
    assert counts == {"x": (1, 1), "y": (1, 1), "Unknown": (1, 1)}


def test_empty_results(spark):
    r = results_frame(spark, [("a", ["x"])]).filter("false")
    m = oh.classification_metrics(r).first()
    assert m.n_results == 0 and m.classification_rate is None
    text = wr.taxonomy_summary_text(r)
    assert "No significant taxonomic matches found." in text


def test_same_sequence_counts_once(spark):
    r = results_frame(spark, [("a", ["x", "x"]), ("a", ["x"]), ("b", ["x"])])
    c = oh.organism_hit_counts(oh.explode_hits(r)).first()
    assert (c.total_hits, c.sequences_with_hits, c.avg_hits_per_sequence) == (4, 2, 2.0)


def hit_frame(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "ord long, qseqid string, sseqid string, pident double, evalue double, bitscore double, stitle string",
    )


@pytest.fixture
def table(spark):
    return hit_frame(
        spark,
        [
            ("q1", "a", 70.0, 1e-10, 50.0, "Penicillin-binding toxin"),
            ("q1", "b", 95.0, 1e-30, 99.0, "gentamicin acetyltransferase"),
            ("q2", "c", 69.9, 1e-30, 80.0, "penicillin"),
            ("q2", "d", 90.0, 1e-9, 80.0, "penicillin"),
            ("q2", "e", 90.0, 0.0, 99.0, "type III effector"),
        ],
    )


def test_category_report(spark, table):
    out = cat.category_report(table, "amr")
    doc = json.loads(out["document"].first().json)
    assert doc["total_hits"] == 3
    assert doc["summary"] == "Detected 3 high-confidence antimicrobial resistance genes"
    assert doc["resistance_classes"] == {"beta-lactam": 1, "aminoglycoside": 1, "other": 1}
    lines = [json.loads(r.json) for r in out["member_lines"].orderBy("category", "ord").collect()]
    assert [(x["category"], x["gene"]) for x in lines] == [
        ("aminoglycoside", "b"), ("beta-lactam", "a"), ("other", "e"),
    ]
    assert [h["sseqid"] for h in doc["top_hits"]] == ["b", "e", "a"]
    vf = cat.category_report(table, "vf")
    assert {r.category: r.n for r in vf["counts"].collect()} == {
        "adhesion": 1, "other": 1, "secretion_system": 1,
    }
    assert out["members"].count() == 3 and out["member_lines"].count() == 3


def test_category_report_without_hits(spark, table):
    out = cat.category_report(table.filter("pident > 1000"), "vf")
    assert out["summary"].first().summary == "No virulence factors detected"
    doc = json.loads(out["document"].first().json)
    assert doc["total_hits"] == 0 and doc["top_hits"] == [] and not doc.get("virulence_categories")


def test_top_hits_ties_follow_the_file(spark, table):
    assert [r.sseqid for r in oh.top_hits(table, 3).collect()] == ["b", "e", "c"]
    rows = cat.top_factor_table(table, 1).collect()
    assert tuple(rows[0]) == ("b", 95.0, "1.00e-30", "gentamicin acetyltransferase")


def test_within_top_percent(spark):
    h = hit_frame(spark, [("q", "a", 1.0, 0.0, 100.0, ""), ("q", "b", 1.0, 0.0, 95.0, ""),
                          ("q", "c", 1.0, 0.0, 94.9, ""), ("r", "d", 1.0, 0.0, 1.0, "")])
    assert {r.sseqid for r in oh.within_top_percent(h, 5).collect()} == {"a", "b", "d"}


def test_hit_limit_keeps_all_alignments_of_a_subject(spark):
    h = hit_frame(spark, [("q", s, 1.0, 0.0, b, "") for s, b in
                          [("a", 5.0), ("b", 9.0), ("b", 1.0), ("c", 5.0), ("d", 1.0)]])
    assert sorted(r.sseqid for r in oh.hit_limit(h, 2).collect()) == ["a", "b", "b"]


def test_bands_histogram_summary(spark):
    h = hit_frame(spark, [("q", "s", p, 0.0, 1.0, "") for p in (0.0, 30.0, 95.0, 100.0)])
    bands = {r.band: r.n for r in oh.quality_distribution(h).collect()}
    assert bands == {"Poor (<30%)": 1, "Low (30-50%)": 0, "Moderate (50-70%)": 0,
                     "Good (70-90%)": 0, "Excellent (>90%)": 2}
    assert {r.bin: r.n for r in oh.identity_histogram(h).collect()} == {0: 1, 6: 1, 19: 2}
    three = hit_frame(spark, [("q", "s", 100.0, 0.0, 1.0, "")] * 3)
    assert wr.annotation_summary_text(oh.annotation_summary(three)) == (
        "Functional Annotation Summary\n" + "=" * 30 + "\nTotal Annotations: 3\n"
        "Mean Identity %: 100.00\nHigh Quality Hits (>70%): 3\nExcellent Hits (>90%): 3\n"
    )


def test_taxa_overview(spark):
    df = spark.createDataFrame(
        [(" a", 0.5, 0), (" b", 0.001, 1), ("c", 0.3, 2), ("d", 0.4, 3)],
        "name string, fraction_total_reads double, ord long",
    )
    assert [r.name for r in oh.taxa_overview(df, 2).collect()] == ["c", "a"]
    assert [r.name for r in oh.taxa_overview(df, 2, by_size=True).collect()] == ["d", "a"]


def test_hit_metrics(spark):
    df = spark.createDataFrame([(90, 100, 11, 60, 200)],
                               "identities int, align_length int, query_start int, query_end int, query_length int")
    r = oh.hit_metrics(df).first()
    assert (r.identity, r.query_cover) == (90.0, 25.0)


def test_quality_scatter_has_no_log_of_zero(spark, table):
    logs = [r.log10_evalue for r in oh.quality_scatter(table).orderBy("sseqid").collect()]
    assert logs[4] is None and logs[0] == pytest.approx(-10)


def test_pathogenic_counts(spark):
    df = spark.createDataFrame([("Unknown",), (None,), ("Pathogenic",), ("Unknown",)], "Pathogenic string")
    assert [tuple(r) for r in oh.pathogenic_counts(df).collect()] == [("Unknown", 2), ("Pathogenic", 1)]
