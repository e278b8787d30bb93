import random

from pyspark.sql import functions as F

from biomeframe.functions.text import organism_of
from biomeframe.operators import classify as cl
from biomeframe.operators import taxonomy as tx
from biomeframe.plans import pipelines as pl
from biomeframe.sources.tables import RESULT_SCHEMA


def dna(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def test_reads_to_abundance(spark):
    rng = random.Random(30)
    nodes = [(1, None, "R", "root"), (2, 1, "G", "Aa"), (3, 2, "S", "Aa bb"), (4, 2, "S", "Aa cc")]
    tree = tx.taxonomy_tree(spark.createDataFrame(nodes, "taxid long, parent long, rank string, name string"))
    shared, b, c = dna(rng, 300), dna(rng, 300), dna(rng, 300)
    genomes = {3: shared + b, 4: shared + c}
    db = cl.build_kmer_db(spark.createDataFrame(list(genomes.items()), "taxid long, seq string"), tree, 15)
    draws = [(t, g[i : i + 60]) for t, g in genomes.items() for i in range(0, 540, 20)]
    train = spark.createDataFrame([(t, i, f"d{i}", s) for i, (t, s) in enumerate(draws)], "species long, ord long, id string, seq string")
    calls = cl.classify_reads(train, db, tree, 15).join(train.select("ord", "species"), "ord")
    distr = tx.kmer_distribution(calls.select("species", "taxid"))
    reads = [genomes[3][i : i + 60] for i in range(0, 540, 10)] + [genomes[4][i : i + 60] for i in range(300, 540, 60)]
    reads += [dna(rng, 60) for _ in range(5)]
    df = spark.createDataFrame([(f"r{i}", i, s) for i, s in enumerate(reads)], "id string, ord long, seq string")
    out = pl.reads_to_abundance(df, db, tree, 15, distr, threshold=2)
    report = {r.taxid: r for r in out["report"].collect()}
    assert report[1].clade_reads + report[None].clade_reads == len(reads)
    assert report[2].clade_reads == report[2].taxon_reads + report[3].clade_reads + report[4].clade_reads
    est = {r.taxonomy_id: r for r in out["abundance"].collect()}
    assert est[3].new_est_reads > est[4].new_est_reads
    moved = sum(r.added_reads for r in est.values())
    assert report[2].taxon_reads - 2 <= moved <= report[2].taxon_reads
    assert out["abundance_report"].filter("taxid = 1").first().percentage == 100.0
    assert {r.name for r in out["overview"].collect()} == {"Aa bb", "Aa cc"}
    plain = pl.reads_to_abundance(df, db, tree, 15)
    assert "abundance" not in plain and plain["overview"].count() >= 3


def test_contigs_to_organisms_fills_and_uses_the_cache(spark):
    rng = random.Random(31)
    genes = [dna(rng, 200) for _ in range(3)]
    titles = ["Escherichia coli strain 1", "Salmonella enterica plasmid", "x [Vibrio cholerae]"]
    ref = spark.createDataFrame([(f"g{i}", t, s) for i, (t, s) in enumerate(zip(titles, genes))], "id string, description string, seq string")
    seqs = [genes[0][:150], genes[1][20:180], genes[0][:150], dna(rng, 120), "ACGT"]
    contigs = spark.createDataFrame([(f"c{i}", i, s) for i, s in enumerate(seqs)], "id string, ord long, seq string")
    result = spark.createDataFrame([], RESULT_SCHEMA).schema.simpleString()
    empty = spark.createDataFrame([], f"seq_md5 string, result {result}, timestamp double")
    out = pl.contigs_to_organisms(contigs, ref, empty, now=1000.0, k=20)
    m = out["metrics"].first()
    assert (m.n_results, m.n_with_hits, m.total_hits, m.n_organisms) == (4, 3, 3, 2)
    assert {r.organism: r.total_hits for r in out["counts"].collect()} == {"Escherichia coli": 2, "Salmonella enterica": 1}
    assert out["report"].count() == 3
    cache = out["to_cache"]
    assert cache.count() == 3
    again = pl.contigs_to_organisms(contigs, ref.filter("false"), cache, now=2000.0, k=20)
    first = {(r.query_id, r.hits[0].organism if r.hits else None) for r in out["results"].collect()}
    assert {(r.query_id, r.hits[0].organism if r.hits else None) for r in again["results"].collect()} == first
    assert again["to_cache"].count() == 0


CODON = {"M": "ATG", "K": "AAA", "W": "TGG", "D": "GAT", "F": "TTC", "C": "TGT", "H": "CAT", "E": "GAA", "Q": "CAG"}


def gene(rng, n=80):
    protein = "M" + "".join(rng.choices("KWDFCHEQ", k=n))
    return protein, "".join(CODON[a] for a in protein)


def test_scans_and_annotation(spark):
    rng = random.Random(32)
    (p1, d1), (p2, d2) = gene(rng), gene(rng)
    contigs = spark.createDataFrame(
        [("c1", 0, "CCTAA" + d1 + "TAACC"), ("c2", 1, "TGA" + d2 + "TAG")], "id string, ord long, seq string"
    )
    proteins = spark.createDataFrame(
        [("a1", "penicillin hydrolase", p1), ("a2", "strange protein", p2)], "id string, description string, seq string"
    )
    amr = pl.scan_contigs(contigs, proteins, "amr")
    assert {r.category: r.n for r in amr["counts"].collect()} == {"beta-lactam": 1, "other": 1}
    assert amr["summary"].first().total_hits == 2 and amr["histogram"].first().bin == 19
    ids = spark.createDataFrame([("a1", 5)], "sseqid string, taxid long")
    tagged = pl.scan_pathogens(contigs, proteins, ids, ids.select("taxid"))
    assert {r.Pathogenic: r.n for r in tagged["counts"].collect()} == {"Pathogenic": 1, "Unknown": 1}
    assert tagged["table"].columns == ["staxids", "pident", "bitscore"]
    tiers = [("IS", proteins.filter("id = 'a2'"), 1e-9, 90), ("sprot", proteins.filter("id = 'a1'"), 1e-9, 80)]
    out = pl.annotate_contigs(contigs, tiers, min_len=150, swissprot=proteins)
    found = {(r.id, r.tier, r["product"]) for r in out["annotation"].collect() if r.tier}
    assert found == {("c1", "sprot", "penicillin hydrolase"), ("c2", "IS", "strange protein")}
    assert out["summary"].first().n_excellent == 2
    reads = contigs.select("id", "seq", F.repeat(F.lit("I"), F.length("seq").cast("int")).alias("qual"), "ord")
    out = pl.reads_to_annotation(reads, tiers, interleaved=True, min_len=150)
    assert {(r.id, r.tier) for r in out["annotation"].collect() if r.tier} == {("c1", "sprot"), ("c2", "IS")}
    assert set(out["fasta"].columns) == {"id", "seq", "ord"} and out["pairs"].count() == 1


def test_results_keep_organism_rule(spark):
    df = spark.createDataFrame([("protein X [Vibrio cholerae]",)], "stitle string")
    assert df.select(organism_of("stitle").alias("o")).first().o == "Vibrio cholerae"
