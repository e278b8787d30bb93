import hashlib
import random

import pytest
from pyspark.sql import functions as F

from biomeframe.functions import sequence as fs
from biomeframe.functions import text as ft

COMPLEMENT = str.maketrans("ACGTN", "TGCAN")


def rc(s):
    return s.translate(COMPLEMENT)[::-1]


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "text, want",
    [
        ("Escherichia coli strain E-T654 plasmid punnamed3, complete sequence", "Escherichia coli"),
        ("Cloning vector pHRP308 DNA, complete sequence", "Cloning vector"),
        ("protein X [Vibrio cholerae]", "Vibrio cholerae"),
        ("a [b] c [Genus one] tail", "Genus one tail"),
        ("uncultured soil clone A1", "uncultured soil clone"),
        ("two words", "two words"),
        ("", ""),
    ],
)
def test_organism_of(spark, text, want):
    assert one(spark, text, ft.organism_of("v")) == want


@pytest.mark.parametrize(
    "p, want",
    [(0.0, None), (30.0, "Poor (<30%)"), (30.1, "Low (30-50%)"), (70.0, "Moderate (50-70%)"),
     (90.0, "Good (70-90%)"), (100.0, "Excellent (>90%)"), (100.1, None)],
)
def test_identity_band(spark, p, want):
    assert one(spark, p, ft.identity_band("v"), "double") == want


def test_keyword_categories(spark):
    title = "Type III secretion LPS penicillin-binding protein"
    assert one(spark, title, ft.amr_class("v")) == "beta-lactam"
    assert one(spark, title, ft.vf_category("v")) == "adhesion"
    assert one(spark, "type IV protein", ft.vf_category("v")) == "secretion_system"
    assert one(spark, "type IV protein", ft.vf_category("v", compat=True)) == "other"
    assert one(spark, "nothing known", ft.amr_class("v")) == "other"


def test_formats(spark):
    assert one(spark, 3.58e-58, ft.fmt_sci("v"), "double") == "3.58e-58"
    assert one(spark, 0.0, ft.fmt_sci("v"), "double") == "0.00e+00"
    assert one(spark, "x" * 51, ft.shorten("v")) == "x" * 50 + "..."
    assert one(spark, "x" * 50, ft.shorten("v")) == "x" * 50
    assert one(spark, ">abc def", ft.base_id("v")) == "abc"
    labels = [one(spark, n, ft.search_time_label("v"), "long") for n in (29, 30, 1800)]
    assert labels == ["~58 seconds", "~1.0 minutes", "~1.0 hours"]


def test_product_fields(spark):
    title = "sp|P07112|MOBA2_ECOLX Mobilization protein A OS=Escherichia coli OX=562 GN=mobA PE=1 SV=4"
    r = one(spark, title, ft.product_fields("v"))
    assert tuple(r) == ("Mobilization protein A", "Escherichia coli", 562, "mobA")


def test_mean_quality(spark):
    assert one(spark, "!I", ft.mean_quality("v")) == 20.0
    assert one(spark, "", ft.mean_quality("v")) is None


def test_sequence_columns(spark):
    s = "ACGTNacgtRY"
    assert one(spark, s, fs.seq_key("v")) == hashlib.md5(s.encode()).hexdigest()
    assert one(spark, "ACGGN", fs.gc_fraction("v")) == pytest.approx(0.6)
    assert one(spark, "", fs.gc_fraction("v")) is None
    assert one(spark, "AACGRN", fs.reverse_complement("v")) == "NYCGTT"


@pytest.mark.parametrize("k", [3, 18, 19, 31])
@pytest.mark.parametrize("strands", [False, True])
@pytest.mark.parametrize("packed", [False, True])
def test_kmers(spark, k, strands, packed):
    rng = random.Random(k)
    seqs = ["".join(rng.choices("ACGT", k=n)) for n in (0, 2, k, 70)]
    seqs += ["".join(rng.choices("ACGTN", weights=[9, 9, 9, 9, 1], k=90)), "acgt" * 12]
    df = spark.createDataFrame(list(enumerate(seqs)), "ord long, seq string")
    got = fs.explode_kmers(df, k, keep=("ord",), strands=strands, packed=packed)
    if packed:
        got = got.withColumn("kmer", fs.kmer_text("kmer", k))
    want = set()
    for i, s in enumerate(seqs):
        s = s.upper()
        for p in range(len(s) - k + 1):
            kmer = s[p : p + k]
            if set(kmer) <= set("ACGT"):
                want.add((i, p + 1, min(kmer, rc(kmer)) if strands else kmer))
    assert {tuple(r) for r in got.collect()} == want


def test_packed_code_agrees_with_text(spark):
    df = spark.createDataFrame([("ACGTACGTACGTACGTACG",), ("ACG",)], "kmer string")
    for text in ("ACG", "TTTTTTTTTTTTTTTTTT", "TTTTTTTTTTTTTTTTTTTTTTTTTTTTTTT"):
        k = len(text)
        code = df.select(fs.kmer_code(F.lit(text), k).alias("c")).first().c
        assert df.select(fs.kmer_text(F.lit(code), k).alias("t")).first().t == text


def test_minimizers(spark):
    df = spark.createDataFrame([(0, "GATTACAGATT")], "ord long, seq string")
    got = fs.explode_minimizers(df, 7, 3, keep=("ord",)).orderBy("pos").collect()
    s = "GATTACAGATT"
    want = [min(s[p + i : p + i + 3] for i in range(5)) for p in range(5)]
    assert [r.minimizer for r in got] == want


def _codon_table():
    order = [a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"]
    return dict(zip(order, fs.CODON_AMINO_ACIDS))


def test_translation(spark):
    table = _codon_table()
    assert table["ATG"] == "M" and table["TGA"] == "*" and table["TGG"] == "W" and table["AAA"] == "K"
    rng = random.Random(5)
    seqs = ["", "AT", "ATGN" * 5, "".join(rng.choices("ACGT", k=100))]
    df = spark.createDataFrame(list(enumerate(seqs)), "ord long, seq string")
    got = {
        (r.ord, r.strand, r.frame): r.protein
        for r in fs.translate_frames(df, keep=("ord",)).collect()
    }
    for i, s in enumerate(seqs):
        for strand, dna in (("+", s), ("-", rc(s))):
            for f in (1, 2, 3):
                want = "".join(
                    table.get(dna[p : p + 3], "X") for p in range(f - 1, len(dna) - 2, 3)
                )
                assert got[i, strand, f] == want


def test_translate_cds(spark):
    df = spark.createDataFrame([("GTGAAATAA",), ("CTGTAG",)], "seq string")
    assert [r.protein for r in fs.translate_cds(df).collect()] == ["MK", "L"]


def test_low_complexity(spark):
    for kmer, want in [("A" * 15, True), ("ATATATATATATATC", True), ("ACGTACGTACGTACG", False)]:
        assert one(spark, kmer, fs.low_complexity("v", 15)) is want


def test_frames_are_translated_in_batches(spark):
    """Empty, short, odd and null sequences beside each other: no codon crosses to the next one."""
    seqs = ["", "A", "AC", "ATG", "ATGN", None, "atgtaaRYG", "GGGCCCA", "A.TTT", "ÄATG"] * 60
    df = spark.createDataFrame([(i, (i, s)) for i, s in enumerate(seqs)], "ord int, pair struct<n int, seq string>")
    frames = fs.translate_frames(df.withColumn("seq", F.col("pair.seq")), keep=("ord", "pair"))
    assert "MapInArrow" in frames._jdf.queryExecution().toString()
    got = {(r.ord, r.strand, r.frame): r.protein for r in frames.filter("pair.n = ord").collect()}
    assert len(got) == 6 * len(seqs)
    for (i, strand, frame), protein in got.items():
        text = (seqs[i] or "").upper()
        if strand == "-":
            text = text.translate(str.maketrans(fs.IUPAC_BASES, fs.IUPAC_COMPLEMENTS))[::-1]
        dna = text.encode("utf-8")
        codons = [dna[p : p + 3].decode("latin1") for p in range(frame - 1, len(dna) - 2, 3)]
        code = {a + b + c: fs.CODON_AMINO_ACIDS[16 * x + 4 * y + z] for x, a in enumerate("TCAG")
                for y, b in enumerate("TCAG") for z, c in enumerate("TCAG")}
        assert protein == "".join(code.get(x, "X") for x in codons)
