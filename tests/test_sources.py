import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from biomeframe.operators import features as fe
from biomeframe.operators import sequences as sq
from biomeframe.operators import taxonomy as tx
from biomeframe.operators.cache import latest_per_key
from biomeframe.sinks import writers as wr
from biomeframe.sources import sequences as ss
from biomeframe.sources import tables as st


def put(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture
def small_splits(spark):
    """Cut files into many blocks."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def random_fasta(rng, n):
    records, text = [], ""
    for i in range(n):
        seq = "".join(rng.choices("ACGTN", k=rng.randrange(1, 400)))
        head = f"s{i} some note {i}"
        records.append((f"s{i}", head, seq))
        width = rng.choice([60, 70, 1000])
        text += f">{head}\n" + "".join(seq[j : j + width] + "\n" for j in range(0, len(seq), width))
    return records, text


def test_fasta_many_splits_and_files(spark, tmp_path, small_splits):
    rng = random.Random(4)
    a, text_a = random_fasta(rng, 300)
    b, text_b = random_fasta(rng, 50)
    put(tmp_path / "a.fasta", text_a)
    put(tmp_path / "b.fasta", text_b)
    df = ss.read_fasta(spark, str(tmp_path))
    got = [(r.id, r.description, r.seq) for r in df.orderBy("ord").collect()]
    assert got == a + b
    assert df.select("ord").distinct().count() == len(a) + len(b)


def test_fasta_corner_cases(spark, tmp_path):
    path = put(tmp_path / "x.fa", ">a\r\nAC\r\nGT\r\n>b  two words\n\nAC GT\n>empty\n>last\nTT")
    got = [(r.id, r.seq) for r in ss.read_fasta(spark, path).orderBy("ord").collect()]
    assert got == [("a", "ACGT"), ("b", "ACGT"), ("empty", ""), ("last", "TT")]


def random_fastq(rng, n, name="r"):
    rows = []
    for i in range(n):
        m = rng.randrange(1, 150)
        rows.append((f"{name}{i}", "".join(rng.choices("ACGT", k=m)), "".join(rng.choices("@+>I!~", k=m))))
    return rows, "".join(f"@{i} note\n{s}\n+\n{q}\n" for i, s, q in rows)


@pytest.mark.parametrize("zipped", [False, True])
def test_fastq(spark, tmp_path, small_splits, zipped):
    rows, text = random_fastq(random.Random(6), 400)
    path = str(tmp_path / ("x.fastq.gz" if zipped else "x.fastq"))
    opener = gzip.open if zipped else open
    with opener(path, "wt") as f:
        f.write(text)
    got = ss.read_fastq(spark, path).orderBy("ord").collect()
    assert [(r.id, r.seq, r.qual) for r in got] == rows
    assert [r.ord for r in got] == list(range(400))


def test_fastq_empty_reads_and_trailing_blanks(spark, tmp_path):
    path = put(tmp_path / "empty.fastq", "@a\n\n+\n\n@b\nAC\n+\nII\n@c\n\n+\n\n\n\n")
    for strict in (True, False):
        got = ss.read_fastq(spark, path, strict=strict).orderBy("ord").collect()
        assert [(r.id, r.seq, r.qual) for r in got] == [("a", "", ""), ("b", "AC", "II"), ("c", "", "")]


def test_fastq_malformed(spark, tmp_path):
    path = put(tmp_path / "bad.fastq", "@a\nACGT\n+\nIIII\n@b\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="malformed FASTQ record 1"):
        ss.read_fastq(spark, path).collect()
    assert [r.id for r in ss.read_fastq(spark, path, strict=False).collect()] == ["a"]


def test_pairs(spark, tmp_path):
    r1, t1 = random_fastq(random.Random(7), 60, "x")
    r2, t2 = random_fastq(random.Random(8), 60, "x")
    paired = ss.read_paired(spark, put(tmp_path / "1.fastq", t1), put(tmp_path / "2.fastq", t2))
    wide = ss.pair_up(paired).orderBy("pair_id").collect()
    assert [(r.seq1, r.seq2, r.same_name) for r in wide] == [(a[1], b[1], True) for a, b in zip(r1, r2)]
    both = "".join(x + y for x, y in zip(_records(t1), _records(t2)))
    mixed = ss.deinterleave(ss.read_fastq(spark, put(tmp_path / "12.fastq", both)))
    assert ss.pair_up(mixed).orderBy("pair_id").select("seq1", "seq2").collect() == [
        (a[1], b[1]) for a, b in zip(r1, r2)
    ]
    halves = [mixed.filter(F.col("mate") == m).select("id", "seq", F.col("pair_id").alias("ord")) for m in (1, 2)]
    merged = sq.merge_mates(*halves).orderBy("ord").collect()
    assert [r.seq for r in merged] == [x[1] for x in r1 + r2]


def _records(text):
    lines = text.splitlines(keepends=True)
    return ["".join(lines[i : i + 4]) for i in range(0, len(lines), 4)]


def test_fasta_and_fastq_writers(spark, tmp_path):
    rows = [(i, x, "ACGT" * (i + 1), "IIII" * (i + 1)) for i, x in enumerate("aabab")]
    df = spark.createDataFrame(rows, "ord long, id string, seq string, qual string").repartition(3)
    wr.write_fasta(df, str(tmp_path / "fa"))
    got = ss.read_fasta(spark, str(tmp_path / "fa")).orderBy("ord").collect()
    assert [r.id for r in got] == ["a", "a_0", "b", "a_1", "b_2"]
    assert [r.seq for r in got] == [r[2] for r in rows]
    wr.write_fastq(df, str(tmp_path / "fq"))
    back = ss.read_fastq(spark, str(tmp_path / "fq")).orderBy("ord").collect()
    assert [(r.id, r.qual) for r in back] == [(r[1], r[3]) for r in rows]


REPORT = (
    "100.00\t50\t0\tR\t1\troot\n"
    " 90.00\t45\t5\tD\t2\t  Bacteria\n"
    " 60.00\t30\t30\tS\t30\t    Aa bb\n"
    " 20.00\t10\t4\tG\t31\t    Cc\n"
    " 12.00\t6\t6\tS\t32\t      Cc dd\n"
    " 10.00\t5\t5\tD\t3\t  Archaea\n"
)


def test_report_tree(spark, tmp_path):
    path = put(tmp_path / "report.txt", REPORT)
    rows = tx.parse_report_tree(st.read_report(spark, path)).orderBy("ord").collect()
    assert [(r.name, r.depth, r.parent_taxid) for r in rows] == [
        ("root", 0, None), ("Bacteria", 1, 1), ("Aa bb", 2, 2), ("Cc", 2, 2), ("Cc dd", 3, 31), ("Archaea", 1, 1),
    ]
    for r in rows:
        assert r.clade_reads == r.taxon_reads + sum(c.clade_reads for c in rows if c.parent_taxid == r.taxid)
    shares = st.read_abundance(spark, path).orderBy("ord").collect()
    assert shares[1].fraction_total_reads == pytest.approx(0.9) and shares[1].name == "  Bacteria"


def test_bracken_table(spark, tmp_path):
    path = put(
        tmp_path / "b.tsv",
        "name\ttaxonomy_id\ttaxonomy_lvl\tkraken_assigned_reads\tadded_reads\tnew_est_reads\tfraction_total_reads\n"
        "Aerococcus urinae\t1376\tS\t48\t345\t393\t0.02163\n",
    )
    r = st.read_bracken(spark, path).first()
    assert (r.taxonomy_id, r.new_est_reads, r.fraction_total_reads) == (1376, 393, 0.02163)
    assert st.read_abundance(spark, path).first().name == "Aerococcus urinae"


def test_diamond_tables(spark, tmp_path):
    line = "k_2\tsp|P07114|MOBC\t100\t94\t0\t0\t1\t94\t1\t94\t3.58e-58\t176\tMobilization \"C\" OS=E coli\n"
    r = st.read_diamond(spark, put(tmp_path / "13.tsv", line + line), 13).orderBy("ord").collect()
    assert (r[1].pident, r[1].evalue, r[1].stitle, r[1].ord) == (100.0, 3.58e-58, 'Mobilization "C" OS=E coli', 1)
    seven = "q\ts\t99.5\t10\t1e-5\t50\ttitle\n"
    for ordered in (True, False):
        df = st.read_diamond(spark, put(tmp_path / "7.tsv", seven), ordered=ordered)
        assert df.first().pident == 99.5
    empty = put(tmp_path / "none.txt", "# No pathogen hits found\n")
    assert st.read_diamond(spark, empty).count() == 0
    assert st.read_flagged_hits(spark, empty).count() == 0
    flagged = put(tmp_path / "f.tsv", "qseqid\tstaxids\tpident\tPathogenic\nq\t562\t99.5\tUnknown\n")
    r = st.read_flagged_hits(spark, flagged).first()
    assert (r.staxids, r.pident, r.Pathogenic) == ("562", 99.5, "Unknown")


def test_gff(spark, tmp_path):
    text = (
        "##gff-version 3\n##sequence-region c 1 99\n"
        "c\tP:1\tCDS\t1\t55\t.\t+\t0\tID=k_1;gene=rdmC;product=Some product\n"
        "c\tP:1\tCDS\t60\t90\t.\t-\t0\tID=k_2;product=hypothetical protein\n"
        "c\tP:1\ttRNA\t95\t99\t.\t+\t.\tID=k_3\n##FASTA\n>c\nACGT\n"
    )
    gff = st.read_gff(spark, put(tmp_path / "x.gff", text))
    assert {r.type: r.n for r in fe.feature_counts(gff).collect()} == {"CDS": 2, "tRNA": 1}
    assert gff.filter("start = 60").first().attributes["product"] == "hypothetical protein"
    contigs = spark.createDataFrame([("c", "ACGT")], "id string, seq string")
    assert tuple(fe.annotation_stats(gff, contigs).first()) == (1, 4, 2)


def test_annotation_and_id_map(spark, tmp_path):
    path = put(tmp_path / "a.tsv", "locus_tag\tftype\tlength_bp\tgene\tEC_number\tCOG\tproduct\nk_1\tCDS\t555\trdmC\t3.1.1.95\t\tSome\n")
    r = st.read_annotation(spark, path).first()
    assert (r.length_bp, r.COG, r.product) == (555, None, "Some")
    assert tuple(st.read_id_map(spark, put(tmp_path / "m", "x\t562\n")).first()) == ("x", 562)


def test_taxonomy_dump(spark, tmp_path):
    nodes = put(tmp_path / "nodes.dmp", "1\t|\t1\t|\tno rank\t|\t\t|\n2\t|\t1\t|\tdomain\t|\t\t|\n")
    names = put(
        tmp_path / "names.dmp",
        "1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tBacteria\t|\tB\t|\tscientific name\t|\n2\t|\teubacteria\t|\t\t|\tsynonym\t|\n",
    )
    assert st.read_taxonomy(spark, nodes, names).orderBy("taxid").collect() == [
        (1, None, "no rank", "root"), (2, 1, "domain", "Bacteria"),
    ]


def test_result_files_and_cache(spark, tmp_path):
    result = {"query_id": "q", "query_length": 9, "timestamp": 5.0, "hits": [
        {"hit_id": "h", "hit_def": "d", "length": 3, "e_value": 0.0, "bit_score": 1.5, "identity": 100.0,
         "query_cover": 50.0, "organism": "o"}]}
    failed = {"query_id": "r", "query_length": 9, "timestamp": 6.0, "hits": [], "error": "no"}
    path = put(tmp_path / "r.json", json.dumps([result, failed], indent=2))
    rows = st.read_blast_results(spark, path).orderBy("query_id").collect()
    assert rows[0].hits[0].organism == "o" and rows[1].error == "no"
    cache = st.load_hit_cache(spark, put(tmp_path / "c.json", json.dumps({"abc": result}, indent=2)))
    assert cache.first().seq_md5 == "abc" and cache.first().result.hits[0].bit_score == 1.5
    assert st.load_hit_cache(spark, str(tmp_path / "none.json")).count() == 0
    assert st.load_hit_cache(spark, str(tmp_path / "none")).count() == 0
    assert st.load_hit_cache(spark, put(tmp_path / "broken.json", "{oops")).count() == 0
    table = str(tmp_path / "cache")
    timed = cache
    assert timed.first().timestamp == 5.0
    assert st.load_hit_cache(spark, str(tmp_path / "none")).columns == timed.columns
    wr.save_hit_cache(timed, table)
    wr.save_hit_cache(timed.withColumn("timestamp", F.lit(9.0)), table)
    back = latest_per_key(st.load_hit_cache(spark, table)).collect()
    assert len(back) == 1 and back[0].timestamp == 9.0


def test_json_cache_in_bounded_objects(spark, tmp_path):
    rows = [(f"k{k}", (f"q{k}", float(k))) for k in range(500)]
    frame = spark.createDataFrame(rows, "seq_md5 string, result struct<query_id: string, timestamp: double>")
    path = str(tmp_path / "many.json")
    wr.write_hit_cache_json(frame, path, 20)
    objects = [len(json.loads(r.value)) for r in spark.read.text(path).collect()]
    assert sum(objects) == 500 and len(objects) > 15 and max(objects) < 60
    back = st.load_hit_cache(spark, path, multiline=False)
    assert {(r.seq_md5, r.result.query_id, r.timestamp) for r in back.collect()} == {(a, b, c) for a, (b, c) in rows}
    wr.write_hit_cache_json(frame.limit(0), str(tmp_path / "none2.json"))
    assert st.load_hit_cache(spark, str(tmp_path / "none2.json"), multiline=False).count() == 0


def test_manifest_and_report_files(spark, tmp_path):
    os.mkdir(tmp_path / "sub")
    for name in ("taxonomy_overview.html", "sub/x.txt", "blast_summary.html", "sub/y.html", "analysis_dashboard.html"):
        (tmp_path / name).write_bytes(b"x" * 200_000)
    m = wr.output_manifest(spark, str(tmp_path))
    assert {(r.name, r.size_mb) for r in m.collect()} == {
        ("taxonomy_overview.html", 0.2), ("x.txt", 0.2), ("blast_summary.html", 0.2), ("y.html", 0.2),
        ("analysis_dashboard.html", 0.2)}
    groups = {(r.name, r.group) for r in fe.artifact_groups(m).collect()}
    assert groups == {("taxonomy_overview.html", "taxonomy"), ("y.html", "other"),
                      ("blast_summary.html", "pathogen"), ("blast_summary.html", "quality")}
    assert [r.name for r in fe.key_artifacts(m).collect()] == ["taxonomy_overview.html"]
    assert [r.name for r in fe.ungrouped_artifacts(m).collect()] == ["y.html"]
    expected = spark.createDataFrame([("db", "/nowhere", True), ("opt", "/none", False)], "label string, path string, required boolean")
    assert {(r.label, r.need) for r in fe.missing_items(expected, m).collect()} == {("db", "required"), ("opt", "optional")}


def test_gff_repeated_attributes(spark, tmp_path):
    text = "c\tx\tCDS\t1\t9\t.\t+\t0\tID=a;Dbxref=p:1;;Dbxref=q:2;note=x=y;flag;flag\nc\tx\tgene\t1\t9\n"
    rows = st.read_gff(spark, put(tmp_path / "y.gff", text)).collect()
    assert rows[0].attributes == {"ID": "a", "Dbxref": "p:1,q:2", "note": "x=y", "flag": None}
    assert rows[1].attributes is None


def test_records_are_counted_without_a_sort(spark, tmp_path, monkeypatch):
    """The count of records per block is a hash aggregate: its memory does not grow with a block."""
    from biomeframe.sources import lines

    plans, real = [], lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or real(df, name))
    spark.range(50).selectExpr("cast(id as string) value").coalesce(1).write.text(f"{tmp_path}/x")
    got = lines.numbered_records(spark, f"{tmp_path}/x").collect()
    assert sorted(r.n for r in got) == list(range(50)) and all(r.value == str(r.n) for r in got)
    assert len(plans) == 1 and "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]
