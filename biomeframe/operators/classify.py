"""k-mer databases with lowest common ancestors, and read classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biomeframe.functions.sequence import explode_kmers
from biomeframe.operators.skew import (
    BROADCAST_CHARS,
    fits_broadcast,
    hash_side,
    lookup_join,
    salted_join,
)
from biomeframe.operators.taxonomy import with_lca
from biomeframe.session import stored

# Rows of three longs; 64 MB of printed text is the second limit.
BROADCAST_KMERS = 2_000_000


def _kmers(df: DataFrame, k: int, keep: tuple[str, ...], strands: bool) -> DataFrame:
    """k-mers packed into longs while they fit; longer ones stay text."""
    return explode_kmers(df, k, keep=keep, strands=strands, packed=k <= 31)


def build_kmer_db(refs: DataFrame, tree: DataFrame, k: int, strands: bool = True) -> DataFrame:
    """``(kmer, pre, last, taxid)``: every reference k-mer with the LCA of its taxa.

    ``refs`` has ``(seq, taxid)``. One hash aggregate keeps the smallest and
    the largest pre-order number per k-mer; it combines on the map side, so
    k-mers found all over the references shuffle as one row per task. The
    table is stored, since every classification reads it.
    """
    placed = lookup_join(refs, tree.select("taxid", "pre"), ["taxid"], "inner", spread=["seq"])
    ranges = (
        _kmers(placed, k, ("pre",), strands)
        .groupBy("kmer")
        .agg(F.min("pre").alias("lo"), F.max("pre").alias("hi"))
    )
    return with_lca(stored(ranges, "kmer-ranges"), tree).select("kmer", "lca.*")


def kmer_join(
    reads: DataFrame,
    db: DataFrame,
    k: int,
    key: str = "ord",
    strands: bool = True,
    max_broadcast: int = BROADCAST_KMERS,
) -> DataFrame:
    """``(key, pre, last, n)``: k-mers of each read found in the database, by taxon.

    The database has one row per k-mer, so the join never multiplies rows. A
    database counted small is broadcast: the k-mers of a read then never leave
    their task and are summed before the only shuffle. Beyond that k-mers are
    shuffled, and one that fills the reads is spread over many tasks.
    """
    kmers = _kmers(reads, k, (key,), strands).select(key, "kmer")
    table = db.select("kmer", "pre", "last")
    if fits_broadcast(table, max_broadcast, BROADCAST_CHARS):
        found = kmers.join(F.broadcast(table), "kmer")
    else:
        found = salted_join(kmers, hash_side(table), ["kmer"], "inner", spread=[key])
    return found.groupBy(key, "pre", "last").agg(F.count(F.lit(1)).alias("n"))


def best_taxa(hits: DataFrame, key: str = "ord") -> DataFrame:
    """``(key, lo, hi, score)``: range of the best-scoring taxa of each read.

    The score of a taxon is the number of hits on its path to the root. Each
    hit opens at ``pre`` and closes after ``last``; the running sum over the
    openings and closings of a read is the score at every node, without
    comparing the taxa of a read with one another. A partition is one read
    and has at most two rows per distinct taxon hit in it.
    """
    events = hits.select(
        key,
        F.explode(
            F.array(
                F.struct(F.col("pre").alias("at"), F.col("n").alias("d"), F.col("pre").alias("node")),
                F.struct(
                    (F.col("last") + 1).alias("at"),
                    (-F.col("n")).alias("d"),
                    F.lit(None).cast("long").alias("node"),
                ),
            )
        ).alias("e"),
    ).select(key, "e.*")
    read = Window.partitionBy(key)
    running = read.orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    scored = (
        events.withColumn("score", F.sum("d").over(running))
        .filter(F.col("node").isNotNull())
        .withColumn("best", F.max("score").over(read))
        .filter(F.col("score") == F.col("best"))
    )
    return scored.groupBy(key).agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("best").alias("score")
    )


def _lift(calls: DataFrame, hits: DataFrame, reads: DataFrame, tree: DataFrame, key: str,
          confidence: float) -> DataFrame:
    """Move calls up until their clade holds the wanted share of all k-mers."""
    nodes = tree.select("pre", "spans")
    clades = (
        lookup_join(hits.select(key, "pre", "n"), nodes, ["pre"], "left", spread=[key])
        .select(key, "n", F.explode("spans.pre").alias("anc"))
        .groupBy(key, "anc")
        .agg(F.sum("n").alias("clade"))
    )
    up = lookup_join(
        calls.select(key, "score", F.col("lca.pre").alias("pre")), nodes, ["pre"], "left", spread=[key]
    ).select(key, "score", F.posexplode("spans").alias("i", "span"))
    steps = up.withColumn("anc", F.col("span.pre")).join(clades, [key, "anc"])
    enough = steps.join(reads.select(key, "kmers"), key).filter(
        F.col("clade") >= F.col("kmers") * confidence
    )
    return enough.groupBy(key).agg(
        F.max(F.struct("i", F.col("span").alias("lca"), "score")).alias("x")
    ).select(key, "x.lca", "x.score")


def classify_reads(
    reads: DataFrame,
    db: DataFrame,
    tree: DataFrame,
    k: int,
    key: str = "ord",
    confidence: float = 0.0,
    strands: bool = True,
) -> DataFrame:
    """Per read: ``status`` (C/U), ``id``, ``taxid``, ``length``, ``score``, key.

    Taxa with equal best scores are resolved to their LCA. Mates are pooled by
    passing a frame with one ``key`` for both (``pair_id``).
    """
    hits = kmer_join(reads, db, k, key, strands)
    if confidence > 0:
        hits = stored(hits, "kmer-hits")
    calls = with_lca(best_taxa(hits, key), tree)
    info = reads.groupBy(key).agg(
        F.min("id").alias("id"),
        F.sum(F.length("seq")).alias("length"),
        F.sum(F.greatest(F.length("seq") - (k - 1), F.lit(0))).alias("kmers"),
    )
    if confidence > 0:
        calls = _lift(calls, hits, info, tree, key, confidence)
    out = info.join(calls.select(key, F.col("lca.taxid").alias("taxid"), "score"), key, "left")
    return out.select(
        F.when(F.col("taxid").isNull(), "U").otherwise("C").alias("status"),
        "id",
        "taxid",
        "length",
        "score",
        key,
    )
