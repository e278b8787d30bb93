"""Benchmark decontamination: which documents contain test items.

A document contains an item if it holds at least ``threshold`` of the item's
distinct word shingles. Size-partitioned MinHash search finds candidates:

* Shingle hashes are MinHash ranks. Of an item with n shingles, a containing
  document has at least ``need = ceil(threshold * n)``, so it has one of the
  item's ``n - need + 1`` smallest. This bottom-k sketch misses nothing.
* Documents fall into size classes (powers of two of their shingle count). A
  class is only searched for items it can hold: ``need`` is at most its upper
  bound. Its probe bound is the largest sketch value of those items; a
  document's own sketch is its shingle hashes up to that bound.

Candidates are verified on the shingles themselves. Only built-in expressions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biomeframe.llm.common import free_name, words
from biomeframe.session import stored

WIDTH = 5
THRESHOLD = 0.8
CLASSES = 32
BROADCAST_ROWS = 1_000_000
KEY = ["doc_id", "c1", "c2"]


def _shingle_hashes(w: str, width: int) -> Column:
    """Hashes of all ``width``-word windows of the array column ``w`` of word hashes."""
    args = ", ".join(f"{w}[i + {k}]" for k in range(width))
    return F.expr(
        f"CASE WHEN size({w}) < {width} THEN CAST(array() AS array<bigint>) ELSE"
        f" transform(sequence(0, size({w}) - {width}), i -> xxhash64({args}, {width})) END"
    )


def _shingles(w: str, width: int) -> Column:
    args = ", ".join(f"{w}[i + {k}]" for k in range(width))
    return F.expr(
        f"CASE WHEN size({w}) < {width} THEN CAST(array() AS array<string>) ELSE"
        f" transform(sequence(0, size({w}) - {width}), i -> concat_ws(' ', {args})) END"
    )


def _items(bench: DataFrame, item_id: str, text: str, threshold: float) -> DataFrame:
    """item_id, width, distinct shingles, need, sketch; one row for each item with words.

    Items of fewer than five words are one shingle of all their words. Repeated
    item rows are one item; several texts of one id are items of that id.
    """
    w = bench.select(F.col(item_id).alias("item_id"), words(F.lower(text)).alias("w")).distinct()
    w = w.filter(F.size("w") > 0)
    w = w.withColumn("width", F.least(F.size("w"), F.lit(WIDTH)))
    by_width = [(F.col("width") == k, k) for k in range(1, WIDTH + 1)]
    hashed = w.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    ranks = F.coalesce(*[F.when(is_k, _shingle_hashes("wh", k)) for is_k, k in by_width])
    texts = F.coalesce(*[F.when(is_k, _shingles("w", k)) for is_k, k in by_width])
    out = hashed.select(
        "item_id",
        "width",
        F.array_distinct(texts).alias("shingles"),
        F.array_sort(F.array_distinct(ranks)).alias("ranks"),
    )
    # Subtract a hair: 0.8 * 5 must need 4 shingles in floating point, too.
    need = F.ceil(F.size("ranks") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return out.withColumn("need", F.greatest(need, F.lit(1))).withColumn(
        "sketch", F.expr("slice(ranks, 1, size(ranks) - need + 1)")
    )


def _size_class(n: Column) -> Column:
    """k for 2^k <= n < 2^(k+1); 0 for empty documents."""
    return F.least(F.floor(F.log2(F.greatest(n, F.lit(1)))), F.lit(CLASSES - 1)).cast("int")


def contained_items(
    docs: DataFrame,
    bench: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Rows doc_id, c1, c2 (hashes of the text), item_id, n_found, n_shingles, containment.

    One row for each distinct (document row, item) at or above ``threshold``.
    Null texts and texts without words contain nothing and are contained in
    nothing. A null doc_id or item_id stays null. Repeated rows give one row.
    Text is compared in lower case, by words between ASCII white space.

    The items and their sketches are written to the shared folder; sketches are
    broadcast only if counted below ``BROADCAST_ROWS``, else joined by a shuffle.
    """
    items = stored(_items(bench, item_id, item_text, threshold), "items")
    sketch = stored(
        items.select(
            F.explode("sketch").alias("rank"),
            "item_id",
            "width",
            _size_class(F.col("need")).alias("least_class"),
        ),
        "sketch",
    )
    facts = sketch.groupBy("width", "least_class").agg(
        F.max("rank").alias("top"), F.count(F.lit(1)).alias("n")
    ).collect()  # at most 5 x 32 rows
    raw = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(raw).alias("c1"),
        F.xxhash64(raw, F.lit(1)).alias("c2"), words(F.lower(text)).alias("w"),
    )
    hashed = base.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x))).drop("w")
    small = sum(f.n for f in facts) <= BROADCAST_ROWS
    found = []
    for width in sorted({f.width for f in facts}):
        bounds = []
        for k in range(CLASSES):
            tops = [f.top for f in facts if f.width == width and f.least_class <= k]
            bounds.append(max(tops) if tops else -(1 << 63))
        least = F.array(*[F.lit(b).cast("long") for b in bounds])
        # The outer explode and the filter above it are on purpose: a filter that the
        # optimiser moves below would rebuild the hashed words for every element.
        probes = (
            hashed.select(*KEY, _shingle_hashes("wh", width).alias("ranks"))
            .select(
                *KEY, _size_class(F.size("ranks")).alias("class"),
                F.explode_outer("ranks").alias("rank"),
            )
            .filter(F.col("rank") <= F.get(least, F.col("class")))
        )
        side = sketch.filter(F.col("width") == width)
        side = side.select("rank", "item_id", "least_class")
        hits = probes.join(F.broadcast(side) if small else side, "rank")
        found.append(hits.filter(F.col("class") >= F.col("least_class")).select(*KEY, "item_id"))
    if not found:
        empty = hashed.select(*KEY).join(items.select("item_id"), F.lit(False))
        return empty.select(
            *KEY, "item_id", F.lit(0).alias("n_found"), F.lit(0).alias("n_shingles"),
            F.lit(0.0).alias("containment"),
        )
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    candidates = stored(pairs.distinct(), "candidates")
    return _verified(base, items, candidates, small).filter(
        F.col("n_found") >= F.col("need")
    ).drop("need")


def _verified(base: DataFrame, items: DataFrame, candidates: DataFrame, small: bool) -> DataFrame:
    """Exact containment of candidate pairs; documents without a candidate are left at once."""
    wanted = candidates.groupBy(*KEY).agg(F.collect_set(F.struct("item_id")).alias("wanted"))
    wanted = wanted.select(*[F.col(c).alias(f"k_{c}") for c in KEY], "wanted")
    same = base["doc_id"].eqNullSafe(wanted["k_doc_id"])
    for c in ("c1", "c2"):
        same = same & (base[c] == wanted[f"k_{c}"])
    texts = base.join(wanted, same).select(*KEY, "w", "wanted").dropDuplicates(KEY)
    pairs = texts.withColumn("want", F.explode("wanted")).select(
        *KEY, "w", F.col("want.item_id").alias("k_item")
    )
    side = items.select("item_id", "width", "shingles", "need")
    side = F.broadcast(side) if small else side
    both = pairs.join(side, pairs["k_item"].eqNullSafe(side["item_id"]))
    own = F.coalesce(
        *[F.when(F.col("width") == k, _shingles("w", k)) for k in range(1, WIDTH + 1)]
    )
    return (
        both.withColumn("own", own)
        .withColumn("n_found", F.size(F.array_intersect("shingles", "own")))
        .withColumn("n_shingles", F.size("shingles"))
        .select(
            *KEY, "item_id", "n_found", "n_shingles",
            (F.col("n_found") / F.col("n_shingles")).alias("containment"), "need",
        )
    )


def drop_contaminated(docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns."""
    bad = contained_items(docs, bench, threshold=threshold).select(*KEY).distinct()
    mark = free_name(docs, "text_hash")
    raw = F.coalesce(F.col("text"), F.lit(""))
    own = docs.withColumn(mark, F.xxhash64(raw))
    same = own["doc_id"].eqNullSafe(bad["doc_id"]) & (own[mark] == bad["c1"])
    return own.join(bad, same, "left_anti").drop(mark)
