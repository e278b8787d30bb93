"""Taxonomy trees, clade reports and abundance re-estimation.

A tree is a frame ``(taxid, parent, rank, name, depth, path, pre, last,
spans)``. ``pre`` numbers the nodes in pre-order and ``last`` is the highest
number in the node's subtree, so "a is an ancestor of b" is a range test and
the lowest common ancestor of any set depends on its smallest and largest
``pre`` alone: LCAs become hash aggregates of two longs. ``taxid`` may have
any type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biomeframe.operators.skew import (
    fits_broadcast,
    global_row_number,
    lookup_join,
    salted_join,
)
from biomeframe.session import stored

def _root_paths(nodes: DataFrame) -> DataFrame:
    """``(taxid, path)`` with the ids from the root down, by pointer doubling.

    Each round doubles the known part of every path, so a tree of depth d
    takes log2(d) joins; each round is stored. No path is longer than there
    are nodes: more rounds than that allows mean a cycle.
    """
    rounds = max(nodes.count(), 1).bit_length() + 1
    paths = nodes.select("taxid", F.array("taxid").alias("path"), F.col("parent").alias("top"))
    for _ in range(rounds):
        up = paths.select(
            F.col("taxid").alias("top"), F.col("path").alias("up_path"), F.col("top").alias("up_top")
        )
        joined = lookup_join(paths, up, ["top"], "left", spread=["taxid"])
        whole = F.when(F.col("up_path").isNull(), F.col("path")).otherwise(
            F.concat("up_path", "path")
        )
        paths = stored(
            joined.select("taxid", whole.alias("path"), F.col("up_top").alias("top")), "paths"
        )
        if paths.filter(F.col("top").isNotNull()).limit(1).count() == 0:
            return paths.select("taxid", "path")
    raise ValueError("the taxonomy has a cycle")


def taxonomy_tree(nodes: DataFrame) -> DataFrame:
    """Build the tree from ``(taxid, parent, rank, name)``; null parent = root.

    Built once per taxonomy and stored; all later uses are joins to it.
    """
    numbered = global_row_number(_root_paths(nodes), ["path"], "pre")
    sizes = (
        numbered.select(F.explode("path").alias("taxid"))
        .groupBy("taxid")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    base = stored(
        numbered.join(sizes, "taxid").select(
            "taxid", "path", "pre", (F.col("pre") + F.col("size") - 1).alias("last")
        ),
        "numbered",
    )
    span = base.select(
        F.col("taxid").alias("anc"), F.struct("pre", "last", "taxid").alias("span")
    )
    steps = base.select("pre", F.posexplode("path").alias("i", "anc"))
    spans = (
        lookup_join(steps, span, ["anc"], "inner", spread=["pre"])
        .groupBy("pre")
        .agg(F.sort_array(F.collect_list(F.struct("i", "span"))).alias("s"))
        .select("pre", F.transform("s", lambda x: x["span"]).alias("spans"))
    )
    tree = (
        base.join(spans, "pre")
        .join(nodes.select("taxid", "parent", "rank", "name"), "taxid")
        .select(
            "taxid", "parent", "rank", "name", (F.size("path") - 1).alias("depth"), "path",
            "pre", "last", "spans",
        )
    )
    return stored(tree, "tree")


def lineage(tree: DataFrame) -> DataFrame:
    """Ancestor closure ``(taxid, ancestor, dist)``; dist 0 is the node itself."""
    return tree.select("taxid", "depth", F.posexplode("path").alias("i", "ancestor")).select(
        "taxid", "ancestor", (F.col("depth") - F.col("i")).alias("dist")
    )


def with_lca(df: DataFrame, tree: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Add ``lca``, the struct (pre, last, taxid) of the LCA of a ``pre`` range.

    A tree counted small is broadcast. Beyond that only the distinct ranges
    that span more than one node meet the tree, and the join back is salted.
    """
    nodes = tree.select(F.col("pre").alias(lo), "spans")

    def deepest(c):
        return F.element_at(F.filter("spans", lambda s: s["last"] >= c), -1)

    if fits_broadcast(nodes):
        return (
            df.join(F.broadcast(nodes), lo, "left")
            .withColumn("lca", deepest(F.col(hi)))
            .drop("spans")
        )
    df = stored(df, "lca-input")
    ranges = df.select(lo, hi).distinct()
    lcas = ranges.join(nodes, lo).select(lo, hi, deepest(F.col(hi)).alias("lca"))
    return salted_join(df, lcas, [lo, hi], "left")


def roll_up(weights: DataFrame, tree: DataFrame, value: str = "n") -> DataFrame:
    """Node and clade sums ``(taxid, taxon, clade)`` of ``(taxid, value)`` rows.

    Rows are summed per taxon before they are copied to their ancestors, so
    the copies number at most taxa x depth whatever the number of rows.
    """
    direct = weights.groupBy("taxid").agg(F.sum(value).alias("taxon"))
    placed = direct.join(tree.select("taxid", "path"), "taxid")
    clades = (
        placed.select(F.explode("path").alias("taxid"), "taxon")
        .groupBy("taxid")
        .agg(F.sum("taxon").alias("clade"))
    )
    return clades.join(direct, "taxid", "left").select(
        "taxid", F.coalesce("taxon", F.lit(0)).alias("taxon"), "clade"
    )


def taxon_report(assignments: DataFrame, tree: DataFrame) -> DataFrame:
    """Clade report of one row per read ``(taxid)``; null taxid = unclassified.

    ``percentage`` is the share of all reads. The row of unclassified reads has
    a null taxid and rank U.
    """
    direct = assignments.groupBy("taxid").agg(F.count(F.lit(1)).alias("n"))
    total = direct.agg(F.sum("n").alias("t")).scalar()
    rolled = roll_up(direct.filter(F.col("taxid").isNotNull()), tree)
    known = rolled.join(tree.select("taxid", "rank", "name", "depth"), "taxid").select(
        (F.col("clade") / total * 100).alias("percentage"),
        F.col("clade").alias("clade_reads"),
        F.col("taxon").alias("taxon_reads"),
        "rank",
        "taxid",
        "name",
        "depth",
    )
    unknown = direct.filter(F.col("taxid").isNull()).select(
        (F.col("n") / total * 100).alias("percentage"),
        F.col("n").alias("clade_reads"),
        F.col("n").alias("taxon_reads"),
        F.lit("U").alias("rank"),
        "taxid",
        F.lit("unclassified").alias("name"),
        F.lit(0).alias("depth"),
    )
    return known.unionByName(unknown)


def with_report_order(report: DataFrame, tree: DataFrame) -> DataFrame:
    """Add ``ord`` for the printed order and indent the names.

    Pre-order with the larger clade first; the sort key of a node is the list
    of (minus clade, taxid) along its path, at most ``depth`` entries.
    """
    clades = report.filter(F.col("taxid").isNotNull()).select(
        F.col("taxid").alias("anc"), F.struct((-F.col("clade_reads")).alias("c"), "taxid").alias("k")
    )
    steps = report.join(tree.select("taxid", "path"), "taxid").select(
        "taxid", F.posexplode("path").alias("i", "anc")
    )
    keys = (
        steps.join(clades, "anc")
        .groupBy("taxid")
        .agg(F.sort_array(F.collect_list(F.struct("i", "k"))).alias("s"))
        .select("taxid", F.transform("s", lambda x: x["k"]).alias("sort_key"))
    )
    keyed = report.join(keys, "taxid", "left")
    named = keyed.withColumn("name", F.concat(F.expr("repeat('  ', depth)"), F.col("name")))
    return global_row_number(named, [F.asc_nulls_first("sort_key")], "ord").drop("sort_key")


def parse_report_tree(report: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``depth`` and ``parent_taxid`` from the indentation of the names.

    The parent is the last earlier row one level up. Every row takes part as a
    child on the level above and as a parent on its own level, so one window
    per level finds it; ``by`` names columns that tell reports apart.
    """
    blanks = F.length("name") - F.length(F.ltrim("name"))
    rows = report.withColumn("depth", F.floor(blanks / 2).cast("int"))
    sides = rows.withColumn(
        "_side",
        F.explode(
            F.array(
                F.struct((F.col("depth") - 1).alias("level"), F.lit(1).alias("child")),
                F.struct(F.col("depth").alias("level"), F.lit(0).alias("child")),
            )
        ),
    )
    w = Window.partitionBy(*by, "_side.level").orderBy("ord").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parent = F.last(F.when(F.col("_side.child") == 0, F.col("taxid")), ignorenulls=True).over(w)
    return (
        sides.withColumn("parent_taxid", parent)
        .filter(F.col("_side.child") == 1)
        .withColumn("name", F.trim("name"))
        .drop("_side")
    )


def rank_profile(report: DataFrame, rank: str | None = None) -> DataFrame:
    """Taxa and reads per rank code, or the rows of one rank."""
    if rank is not None:
        return report.filter(F.col("rank") == rank)
    return report.groupBy("rank").agg(
        F.count(F.lit(1)).alias("taxa"),
        F.sum("taxon_reads").alias("taxon_reads"),
        F.sum("clade_reads").alias("clade_reads"),
    )


def kmer_distribution(assignments: DataFrame) -> DataFrame:
    """``(species, node, p)`` from classified reference reads.

    Input rows are ``(species, taxid)``: where a read drawn from a species was
    classified. ``p`` is the share of the species' classified reads per node.
    """
    counts = (
        assignments.filter(F.col("taxid").isNotNull())
        .groupBy("species", F.col("taxid").alias("node"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("species").agg(F.sum("n").alias("t"))
    return counts.join(totals, "species").select("species", "node", (F.col("n") / F.col("t")).alias("p"))


def reestimate_abundance(
    report: DataFrame, kmer_distr: DataFrame, tree: DataFrame, level: str = "S", threshold: int = 10
) -> DataFrame:
    """Move reads held by ancestors down to the taxa of one level.

    A taxon with at least ``threshold`` clade reads takes part with weight
    clade reads / P(own clade | taxon), its own clade being the taxon and all
    below it, whose reads its clade count already holds. The direct reads of
    each proper ancestor are split in proportion to P(node | taxon) x weight.
    Reads of nodes without a taking-part taxon below them are left out, as are
    shares of nodes elsewhere in the tree. Estimates stay fractional.
    """
    place = tree.select("taxid", "pre", "last")

    def at(side: str) -> DataFrame:
        return place.select(
            F.col("taxid").alias(side), F.col("pre").alias(f"{side}_pre"), F.col("last").alias(f"{side}_last")
        )

    shares = kmer_distr.filter(F.col("p") > 0).join(at("species"), "species").join(at("node"), "node")
    below = (F.col("node_pre") >= F.col("species_pre")) & (F.col("node_pre") <= F.col("species_last"))
    over = (F.col("node_pre") < F.col("species_pre")) & (F.col("node_last") >= F.col("species_last"))
    own = shares.filter(below).groupBy(F.col("species").alias("taxid")).agg(F.sum("p").alias("p_own"))
    species = (
        report.filter((F.col("rank") == level) & (F.col("clade_reads") >= threshold))
        .join(own, "taxid", "left")
        .select(
            "taxid",
            "name",
            "clade_reads",
            (F.col("clade_reads") / F.col("p_own")).alias("weight"),
        )
    )
    above = report.filter(F.col("taxon_reads") > 0).select(
        F.col("taxid").alias("node"), F.col("taxon_reads").alias("direct")
    )
    pull = (
        shares.filter(over)
        .join(species.select(F.col("taxid").alias("species"), "weight"), "species")
        .join(above, "node")
        .select("species", "node", "direct", (F.col("p") * F.col("weight")).alias("pull"))
    )
    sums = pull.groupBy("node").agg(F.sum("pull").alias("all_pull"))
    added = (
        pull.join(sums, "node")
        .groupBy(F.col("species").alias("taxid"))
        .agg(F.sum(F.col("pull") / F.col("all_pull") * F.col("direct")).alias("added"))
    )
    est = species.join(added, "taxid", "left").select(
        "name",
        F.col("taxid").alias("taxonomy_id"),
        F.lit(level).alias("taxonomy_lvl"),
        F.col("clade_reads").alias("kraken_assigned_reads"),
        F.coalesce("added", F.lit(0.0)).alias("added"),
        (F.col("clade_reads") + F.coalesce("added", F.lit(0.0))).alias("estimate"),
    )
    total = est.agg(F.sum("estimate").alias("t")).scalar()
    return est.withColumn("fraction_total_reads", F.col("estimate") / total)


def bracken_table(est: DataFrame) -> DataFrame:
    """The printed form: whole reads, shares to five digits."""
    whole = F.floor(F.col("estimate") + 1e-9).cast("long")
    return est.select(
        "name",
        "taxonomy_id",
        "taxonomy_lvl",
        "kraken_assigned_reads",
        (whole - F.col("kraken_assigned_reads")).alias("added_reads"),
        whole.alias("new_est_reads"),
        F.round("fraction_total_reads", 5).alias("fraction_total_reads"),
    )


def bracken_clade_report(est: DataFrame, tree: DataFrame) -> DataFrame:
    """Clade report rolled up again from the estimates, whole reads per row."""
    rolled = roll_up(est.select(F.col("taxonomy_id").alias("taxid"), "estimate"), tree, "estimate")
    total = est.agg(F.sum("estimate").alias("t")).scalar()
    return rolled.join(tree.select("taxid", "rank", "name", "depth"), "taxid").select(
        (F.col("clade") / total * 100).alias("percentage"),
        F.floor(F.col("clade") + 1e-9).cast("long").alias("clade_reads"),
        F.floor(F.col("taxon") + 1e-9).cast("long").alias("taxon_reads"),
        "rank",
        "taxid",
        "name",
        "depth",
    )
