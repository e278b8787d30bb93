import random

import pytest
from pyspark.sql import functions as F

from biomeframe.operators import classify as cl
from biomeframe.operators import skew
from biomeframe.operators import taxonomy as tx

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def random_tree(rng, n):
    parents = {1: None}
    ids = rng.sample(range(2, 10 * n), n - 1)
    for i in ids:
        parents[i] = rng.choice(list(parents))
    return parents


def path(parents, t):
    out = []
    while t is not None:
        out.append(t)
        t = parents[t]
    return out[::-1]


def lca(parents, taxa):
    paths = [path(parents, t) for t in taxa]
    out = None
    for level in zip(*paths):
        if len(set(level)) > 1:
            break
        out = level[0]
    return out


def build(spark, parents):
    rows = [(t, p, "R" if p is None else "S", f"n{t}") for t, p in parents.items()]
    return tx.taxonomy_tree(spark.createDataFrame(rows, "taxid long, parent long, rank string, name string"))


@pytest.fixture(scope="module")
def world(spark):
    parents = random_tree(random.Random(12), 60)
    return parents, build(spark, parents)


def test_tree_numbers(world):
    parents, tree = world
    rows = {r.taxid: r for r in tree.collect()}
    assert sorted(r.pre for r in rows.values()) == list(range(60))
    for t, r in rows.items():
        assert list(r.path) == path(parents, t) and r.depth == len(r.path) - 1
        assert [s.taxid for s in r.spans] == list(r.path)
        inside = {u for u, x in rows.items() if r.pre <= x.pre <= r.last}
        assert inside == {u for u in parents if t in path(parents, u)}


def test_deep_chain_and_cycle(spark):
    deep = {i: (i - 1 or None) for i in range(1, 101)}
    assert build(spark, deep).agg(F.max("depth")).first()[0] == 99
    with pytest.raises(ValueError):
        build(spark, {1: None, 2: 3, 3: 2})


def test_lineage(world):
    parents, tree = world
    got = {(r.taxid, r.ancestor, r.dist) for r in tx.lineage(tree).collect()}
    want = {(t, a, i) for t in parents for i, a in enumerate(reversed(path(parents, t)))}
    assert got == want


@pytest.mark.parametrize("small", [True, False])
def test_lca_of_random_sets(spark, world, monkeypatch, small):
    parents, tree = world
    if not small:
        monkeypatch.setattr(tx, "fits_broadcast", lambda df: False)
    rng = random.Random(13)
    sets = [rng.sample(sorted(parents), rng.randrange(1, 5)) for _ in range(80)]
    rows = [(i, t) for i, s in enumerate(sets) for t in s]
    members = spark.createDataFrame(rows, "i int, taxid long").join(tree.select("taxid", "pre"), "taxid")
    ranges = members.groupBy("i").agg(F.min("pre").alias("lo"), F.max("pre").alias("hi"))
    got = {r.i: r.lca.taxid for r in tx.with_lca(ranges, tree).collect()}
    assert got == {i: lca(parents, s) for i, s in enumerate(sets)}


def test_clade_report(spark, world):
    parents, tree = world
    rng = random.Random(14)
    calls = [rng.choice(sorted(parents)) if rng.random() < 0.9 else None for _ in range(500)]
    df = spark.createDataFrame([(c,) for c in calls], "taxid long")
    report = tx.taxon_report(df, tree)
    rows = {r.taxid: r for r in report.collect()}
    assert rows[None].clade_reads == calls.count(None)
    for t, r in rows.items():
        if t is not None:
            below = [c for c in calls if c is not None and t in path(parents, c)]
            assert (r.taxon_reads, r.clade_reads) == (calls.count(t), len(below))
            assert r.percentage == pytest.approx(100 * len(below) / 500)
    printed = tx.with_report_order(report, tree).orderBy("ord").collect()
    assert printed[0].name == "unclassified" and printed[1].taxid == 1
    parsed = tx.parse_report_tree(tx.with_report_order(report.filter("taxid is not null"), tree))
    assert all(r.parent_taxid == parents[r.taxid] for r in parsed.collect())
    siblings = {}
    for r in printed[1:]:
        siblings.setdefault(parents[r.taxid], []).append(r.clade_reads)
    assert all(c == sorted(c, reverse=True) for c in siblings.values())


def test_reestimation_toy(spark):
    report = spark.createDataFrame(
        [(1, "G", "genus", 145, 100), (2, "S", "A", 30, 30), (3, "S", "B", 10, 10), (4, "S", "C", 5, 5)],
        "taxid long, rank string, name string, clade_reads long, taxon_reads long",
    )
    distr = spark.createDataFrame(
        [(2, 2, 0.5), (2, 1, 0.5), (3, 3, 0.75), (3, 1, 0.25), (4, 4, 1.0)], "species long, node long, p double"
    )
    tree = build(spark, {1: None, 2: 1, 3: 1, 4: 1})
    table = tx.bracken_table(tx.reestimate_abundance(report, distr, tree)).orderBy("name").collect()
    assert [(r.name, r.kraken_assigned_reads, r.added_reads, r.new_est_reads) for r in table] == [
        ("A", 30, 90, 120), ("B", 10, 10, 20)
    ]
    assert [r.fraction_total_reads for r in table] == [0.85714, 0.14286]
    rolled = tx.bracken_clade_report(tx.reestimate_abundance(report, distr, tree), tree).collect()
    assert {r.taxid: (r.clade_reads, r.taxon_reads) for r in rolled} == {1: (140, 0), 2: (120, 120), 3: (20, 20)}


def test_reads_below_a_species_count_once(spark):
    """Reads of a strain are in the clade count of its species already."""
    report = spark.createDataFrame(
        [(1, "G", "genus", 140, 100), (2, "S", "A", 40, 20), (5, "S1", "A1", 20, 20)],
        "taxid long, rank string, name string, clade_reads long, taxon_reads long",
    )
    distr = spark.createDataFrame(
        [(2, 2, 0.4), (2, 5, 0.4), (2, 1, 0.2)], "species long, node long, p double"
    )
    tree = build(spark, {1: None, 2: 1, 5: 2})
    row = tx.reestimate_abundance(report, distr, tree).first()
    assert (row.added, row.estimate) == (100.0, 140.0)


def test_deep_tree_and_cycle(spark):
    deep = {1: None} | {k: k - 1 for k in range(2, 200)}
    assert build(spark, deep).agg(F.max("depth")).first()[0] == 198
    with pytest.raises(ValueError, match="cycle"):
        build(spark, {1: None, 2: 3, 3: 2})


def test_kmer_distribution(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 9), (1, None), (2, 9)], "species long, taxid long")
    assert {(r.species, r.node): round(r.p, 4) for r in tx.kmer_distribution(df).collect()} == {
        (1, 1): 0.6667, (1, 9): 0.3333, (2, 9): 1.0}


def kmers(s, k):
    for p in range(len(s) - k + 1):
        x = s[p : p + k]
        if set(x) <= set("ACGT"):
            yield min(x, x.translate(COMPLEMENT)[::-1])


def brute_classify(parents, db, seq, k, confidence=0.0):
    hits = {}
    for x in kmers(seq, k):
        if x in db:
            hits[db[x]] = hits.get(db[x], 0) + 1
    if not hits:
        return None, None
    score = {t: sum(hits.get(a, 0) for a in path(parents, t)) for t in hits}
    best = max(score.values())
    call = lca(parents, [t for t in score if score[t] == best])
    need = confidence * max(len(seq) - k + 1, 0)
    while call is not None and confidence > 0:
        if sum(n for t, n in hits.items() if call in path(parents, t)) >= need:
            break
        call = parents[call]
    return call, best if call is not None else None


@pytest.mark.parametrize("k", [5, 33])
@pytest.mark.parametrize("small", [True, False])
def test_database_and_classification(spark, world, monkeypatch, k, small):
    if not small:
        monkeypatch.setattr(cl, "fits_broadcast", lambda *a: False)
    parents, tree = world
    rng = random.Random(k)
    core = "".join(rng.choices("ACGT", k=400))
    refs = []
    for t in rng.sample(sorted(parents), 12):
        s = core[: rng.randrange(60, 200)] + "".join(rng.choices("ACGTN", weights=[9, 9, 9, 9, 1], k=60))
        refs += [(t, s)] * rng.randrange(1, 3)
    taxa = {}
    for t, s in refs:
        for x in kmers(s, k):
            taxa.setdefault(x, set()).add(t)
    want_db = {x: lca(parents, ts) for x, ts in taxa.items()}
    db = cl.build_kmer_db(spark.createDataFrame(refs, "taxid long, seq string"), tree, k)
    if k <= 31:
        from biomeframe.functions.sequence import kmer_text

        db_text = db.withColumn("kmer", kmer_text("kmer", k))
    else:
        db_text = db
    assert {r.kmer: r.taxid for r in db_text.collect()} == want_db
    reads = [s[i : i + 70] for _, s in refs for i in (0, 40)] + ["ACG", "", "T" * 70]
    reads = [r if i % 2 else r.translate(COMPLEMENT)[::-1].replace("N", "A") for i, r in enumerate(reads)]
    df = spark.createDataFrame([(f"r{i}", i, s) for i, s in enumerate(reads)], "id string, ord long, seq string")
    for confidence in (0.0, 0.6):
        got = {r.ord: r for r in cl.classify_reads(df, db, tree, k, confidence=confidence).collect()}
        assert len(got) == len(reads)
        for i, s in enumerate(reads):
            call, score = brute_classify(parents, want_db, s, k, confidence)
            assert (got[i].taxid, got[i].status) == (call, "U" if call is None else "C")
            if confidence == 0:
                assert got[i].score == score
            assert got[i].length == len(s)


def test_classification_with_a_hot_kmer(spark, world, monkeypatch):
    parents, tree = world
    refs = spark.createDataFrame([(2 if 2 in parents else 1, "A" * 40), (1, "ACGTTGCATT" * 4)], "taxid long, seq string")
    db = cl.build_kmer_db(refs, tree, 7)
    df = spark.createDataFrame([(f"r{i}", i, "A" * 30 + "ACGTTGCATT") for i in range(50)], "id string, ord long, seq string")
    plain = {(r.ord, r.taxid, r.score) for r in cl.classify_reads(df, db, tree, 7).collect()}
    monkeypatch.setattr(cl, "fits_broadcast", lambda *a: False)
    real = skew.salted_join
    monkeypatch.setattr(cl, "salted_join", lambda *a, **o: real(*a, **{**o, "min_rows": 100}))
    assert {(r.ord, r.taxid, r.score) for r in cl.classify_reads(df, db, tree, 7).collect()} == plain


def test_mates_are_pooled(spark, world):
    parents, tree = world
    db = cl.build_kmer_db(spark.createDataFrame([(1, "ACGTTGCATTGGCA")], "taxid long, seq string"), tree, 7)
    df = spark.createDataFrame([("a/1", 0, "ACGTTGCA"), ("a/2", 0, "TTTTTTTT")], "id string, pair_id long, seq string")
    r = cl.classify_reads(df, db, tree, 7, key="pair_id").collect()
    assert [(x.status, x.taxid, x.length, x.score) for x in r] == [("C", 1, 16, 2)]
