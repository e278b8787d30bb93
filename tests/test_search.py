import math
import random

import pytest
from pyspark.sql import functions as F

from biomeframe.operators import cache as oc
from biomeframe.operators import search as se
from biomeframe.operators import skew

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(COMPLEMENT)[::-1]


def mutate(rng, s, rate):
    return "".join(rng.choice("ACGT") if rng.random() < rate else c for c in s)


def low(kmer):
    counts = sorted((kmer.count(b) for b in "ACGT"), reverse=True)
    return counts[0] + counts[1] >= len(kmer) - len(kmer) // 8


def maximal(scores):
    """All maximal-scoring segments by their definition: the best one, then both sides of it."""
    found, todo = [], [(0, len(scores))]
    while todo:
        a, b = todo.pop()
        best = max(
            ((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) if scores[i] > 0
             for j in range(i + 1, b + 1) if scores[j - 1] > 0),
            default=(0,),
        )
        if best[0] > 0:
            i, j = best[3], best[4]
            found.append((i, j))
            todo += [(a, i), (j, b)]
    return found


def brute(queries, refs, k, max_evalue=1e-5, mask=False, min_seeds=1, match=1, mismatch=-2):
    n_db = sum(len(s) for s in {s for _, s in refs})
    out = set()
    for qid, q in queries:
        for strand, s in (("+", q), ("-", rc(q))):
            for rid, r in refs:
                diags = {}
                for i in range(len(s) - k + 1):
                    for j in range(len(r) - k + 1):
                        if s[i : i + k] == r[j : j + k] and not (mask and low(s[i : i + k])):
                            diags.setdefault(i - j, []).append(i)
                for d, places in diags.items():
                    lo, hi = max(0, d), min(len(s), len(r) + d)
                    for a, b in maximal([match if s[x] == r[x - d] else mismatch for x in range(lo, hi)]):
                        a, b = a + lo, b + lo
                        if sum(a <= x and x + k <= b for x in places) < min_seeds:
                            continue
                        same = sum(s[x] == r[x - d] for x in range(a, b))
                        bits = (1.33 * (same * match + (b - a - same) * mismatch) - math.log(0.621)) / math.log(2)
                        if len(s) * n_db * 2**-bits <= max_evalue:
                            span = (a + 1, b) if strand == "+" else (len(s) - b + 1, len(s) - a)
                            out.add((qid, rid, strand, *span, a - d + 1, b - d, same, round(bits, 6)))
    return out


def test_two_matches_on_one_diagonal(spark):
    """More similarity never gives fewer hits: both blocks are found, as is each alone."""
    rng = random.Random(8)
    dna = lambda n: "".join(rng.choices("ACGT", k=n))
    one, two, gap_q, gap_r = dna(200), dna(40), dna(3000), dna(3000)
    q, r = frames(spark, [("both", one + gap_q + two), ("first", one + gap_q + dna(40))], [("s", one + gap_r + two)])
    hits = se.similarity_search(q, r, 28)
    got = sorted((h.qseqid, h.qstart <= 5, h.length >= 200) for h in hits.collect() if h.strand == "+")
    assert got == [("both", False, False), ("both", True, True), ("first", True, True)]


def test_statistics():
    lam, kappa = se.karlin_altschul(1, -2, 0.25)
    assert abs(lam - 1.33) < 0.005 and abs(kappa - 0.621) < 0.01
    assert 0.3 < se.PROTEIN.lam < 0.6 and 0 < se.PROTEIN.kappa < 1


@pytest.fixture(scope="module")
def homologs():
    rng = random.Random(20)
    genes = ["".join(rng.choices("ACGT", k=150)) for _ in range(5)]
    refs = [(f"r{i}", mutate(rng, g, 0.03)) for i, g in enumerate(genes)] + [("copy", genes[0]), ("copy2", genes[0])]
    refs.append(("poly", "A" * 120))
    queries = [(f"q{i}", mutate(rng, rng.choice(genes)[20:130], 0.03)) for i in range(8)]
    queries += [("same", queries[0][1]), ("rev", rc(genes[1])), ("g0", genes[0][5:140]), ("polyq", "A" * 100), ("short", "ACG")]
    return queries, refs


def frames(spark, queries, refs):
    q = spark.createDataFrame([(i, n, s) for n, (i, s) in enumerate(queries)], "id string, ord long, seq string")
    r = spark.createDataFrame([(i, "title " + i, s) for i, s in refs], "id string, description string, seq string")
    return q, r


def rows(hits):
    return {
        (h.qseqid, h.sseqid, h.strand, h.qstart, h.qend, h.sstart, h.send, h.length - h.mismatch, round(h.bitscore, 6))
        for h in hits.collect()
    }


@pytest.mark.parametrize("mask", [True, False])
@pytest.mark.parametrize("min_seeds", [1, 40])
def test_search_equals_brute_force(spark, homologs, mask, min_seeds):
    queries, refs = homologs
    q, r = frames(spark, queries, refs)
    want = brute(queries, refs, 11, mask=mask, min_seeds=min_seeds)
    got = rows(se.similarity_search(q, r, 11, mask=mask, min_seeds=min_seeds))
    assert got == want and len(want) > (10 if min_seeds == 1 else 3)
    assert any(h[0] == "polyq" for h in got) is not mask


def test_search_with_hot_seeds(spark, homologs, monkeypatch):
    queries, refs = homologs
    q, r = frames(spark, queries, refs)
    want = rows(se.similarity_search(q, r, 11))
    for name in ("salted_join", "salted_pair_join"):
        real = getattr(skew, name)
        monkeypatch.setattr(se, name, lambda *a, _f=real, **o: _f(*a, **{**o, "min_rows": 3}))
    assert rows(se.similarity_search(q, r, 11)) == want


def test_translated_search(spark):
    rng = random.Random(21)
    codon = {"M": "ATG", "K": "AAA", "W": "TGG", "D": "GAT", "F": "TTT", "C": "TGT", "H": "CAT", "E": "GAA"}
    protein = "".join(rng.choices("MKWDFCHE", k=60))
    dna = "".join(codon[a] for a in protein)
    contigs = [("plus", "CC" + dna + "C"), ("minus", rc("G" + dna + "TT"))]
    q = spark.createDataFrame([(i, n, s) for n, (i, s) in enumerate(contigs)], "id string, ord long, seq string")
    p = spark.createDataFrame([("p1", "title", protein)], "id string, description string, seq string")
    got = {(h.qseqid, h.strand, h.qstart, h.qend, h.pident, h.length) for h in se.translated_search(q, p).collect()}
    assert got == {("plus", "+", 3, 182, 100.0, 60), ("minus", "-", 3, 182, 100.0, 60)}


def test_tiers_equal_the_chain(spark):
    rng = random.Random(22)
    proteins = [f"p{i}" for i in range(30)]
    data = [
        (t, rng.choice(proteins), f"s{i}", rng.choice([1e-40, 1e-12, 1e-3]), rng.choice([50.0, 95.0]), float(i))
        for i, t in enumerate(rng.choices([0, 1, 2], k=90))
    ]
    df = spark.createDataFrame(data, "t int, qseqid string, sseqid string, evalue double, cover double, bitscore double")
    df = df.withColumn("stitle", F.concat(F.lit("product "), "sseqid"))
    rules = [("IS", 1e-30, 90), ("sprot", 1e-9, 80), ("HAMAP", 1e-9, None)]
    tiers = [se.Tier(n, df.filter(F.col("t") == i), e, c) for i, (n, e, c) in enumerate(rules)]
    left, want = set(proteins), {}
    for i, (name, e, c) in enumerate(rules):
        for p in sorted(left):
            ok = [x for x in data if x[0] == i and x[1] == p and x[3] <= e and (c is None or x[4] >= c)]
            if ok:
                want[p] = (name, "product " + max(ok, key=lambda x: x[5])[2])
                left.discard(p)
    for p in left:
        want[p] = (None, "hypothetical protein")
    base = spark.createDataFrame([(p,) for p in proteins], "qseqid string")
    assert {r.qseqid: (r.tier, r["product"]) for r in se.tiered_annotation(base, tiers).collect()} == want


def test_tags_and_genes(spark):
    hits = spark.createDataFrame([("q1", "a"), ("q2", "b"), ("q3", "c")], "qseqid string, sseqid string")
    ids = spark.createDataFrame([("a", 562), ("b", 9)], "sseqid string, taxid long")
    listed = spark.createDataFrame([(562,), (562,)], "taxid long")
    got = {(r.sseqid, r.staxids, r.Pathogenic) for r in se.tag_pathogenic(hits, ids, listed).collect()}
    assert got == {("a", 562, "Pathogenic"), ("b", 9, "Non-pathogenic"), ("c", None, "Unknown")}
    genes = spark.createDataFrame([("q1", "mobA")], "locus_tag string, gene string")
    assert [(r.qseqid, r.gene) for r in se.attach_genes(hits, genes).collect()] == [("q1", "mobA")]


def test_cache(spark):
    seqs = spark.createDataFrame([("a", 0, "AC"), ("b", 1, "AC"), ("c", 2, "GG"), ("d", 3, "GG")], "id string, ord long, seq string")
    entries = spark.createDataFrame(
        [("AC", "old", 10.0), ("AC", "new", 20.0), ("TT", "undated", None), ("CC", "stale", 1.0)],
        "seq string, result string, timestamp double",
    ).withColumn("seq_md5", F.md5("seq")).drop("seq")
    day = 24 * 60 * 60.0
    fresh = oc.fresh_entries(entries, 30 * day + 5)
    assert {r.result for r in fresh.collect()} == {"old", "new", "undated"}
    latest = oc.latest_per_key(fresh)
    assert {r.result for r in latest.collect()} == {"new", "undated"}
    found, todo = oc.lookup_cache(seqs, latest)
    assert {(r.id, r.result) for r in found.collect()} == {("a", "new"), ("b", "new")}
    assert [(r.id, r.copies) for r in todo.collect()] == [("c", 2)]
