import random

import pytest

from biomeframe.operators import orfs
from biomeframe.operators import sequences as sq


def frame(spark, seqs):
    return spark.createDataFrame([(f"s{i}", i, s) for i, s in enumerate(seqs)], "id string, ord long, seq string")


def test_first_then_length(spark):
    df = frame(spark, ["A" * 49, "A" * 50, "A" * 99])
    assert [r.id for r in sq.min_length(sq.take_first(df, 2)).collect()] == ["s1"]


@pytest.mark.parametrize(
    "seqs, want",
    [
        ([], (False, "No sequences found in FASTA file")),
        (["A"], (False, "No sequences longer than 50 bp found")),
        (["A" * 50] * 4, (True, "Warning: 4 sequences found, will process first 3")),
        (["A" * 50, "A"], (True, "Ready to process 1 sequences")),
    ],
)
def test_validation(spark, seqs, want):
    assert tuple(sq.validate_sequences(frame(spark, seqs), 50, 3).first()) == want


def test_assembly_stats(spark):
    r = sq.assembly_stats(frame(spark, ["G" * 8, "A" * 8, "C" * 4, "T" * 2, ""])).first()
    assert (r.contigs, r.bases, r.min_len, r.max_len, r.median_len, r.n50) == (5, 22, 0, 8, 4.0, 8)
    assert r.gc == pytest.approx(12 / 22)


def test_nx_brute_force(spark):
    rng = random.Random(9)
    for _ in range(3):
        lengths = [rng.randrange(1, 50) for _ in range(101)]
        half, run = sum(lengths) / 2, 0
        for n in sorted(lengths, reverse=True):
            run += n
            if run >= half:
                break
        df = spark.createDataFrame([(x,) for x in lengths], "len long")
        assert sq.nx(df).first().nx == n


def test_read_quality_filter(spark):
    df = spark.createDataFrame(
        [("a", "A" * 35, "5" * 35), ("b", "A" * 35, "4" * 35), ("c", "A" * 34, "I" * 34)],
        "id string, seq string, qual string",
    )
    assert [r.id for r in sq.read_quality_filter(df).collect()] == ["a"]


COMPLEMENT = str.maketrans("ACGT", "TGCA")


def brute_orfs(s, min_len):
    found = set()
    for strand, dna in (("+", s), ("-", s.translate(COMPLEMENT)[::-1])):
        for f in range(3):
            start = None
            for p in range(f, len(dna) - 2, 3):
                codon = dna[p : p + 3]
                if codon in ("TAA", "TAG", "TGA"):
                    if start is not None and p + 3 - start >= min_len:
                        a, b = start + 1, p + 3
                        if strand == "-":
                            a, b = len(s) - b + 1, len(s) - a + 1
                        found.add((a, b, strand, f + 1))
                    start = None
                elif start is None and codon in ("ATG", "GTG", "TTG"):
                    start = p
    return found


def test_orfs(spark):
    rng = random.Random(10)
    seqs = ["".join(rng.choices("ACGT", k=n)) for n in (0, 2, 3, 400, 901)] + ["ATGTAA", "C" * 3000]
    got = orfs.orf_scan(frame(spark, seqs), 6).collect()
    for i, s in enumerate(seqs):
        assert {(r.start, r.end, r.strand, r.frame) for r in got if r.ord == i} == brute_orfs(s, 6)


def test_orf_sequences(spark):
    rng = random.Random(11)
    df = frame(spark, ["".join(rng.choices("ACGT", k=600))])
    for r in orfs.orf_sequences(orfs.orf_scan(df, 30), df).collect():
        assert r.cds[:3] in ("ATG", "GTG", "TTG") and r.cds[-3:] in ("TAA", "TAG", "TGA")
        assert len(r.cds) == r.end - r.start + 1
