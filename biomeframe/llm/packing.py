"""Packing into length buckets with the least padding, then token-budget batches.

Documents are cut into pieces of at most ``max_tokens``. The histogram of piece
lengths, counted over all documents, has at most ``max_tokens`` rows; a dynamic
programme over it finds the bucket boundaries with the least padding. Inside a
bucket, pieces in (doc_id, piece) order are dealt into batches of as many as the
token budget holds when padded to the boundary.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biomeframe.llm.common import words
from biomeframe.operators.skew import global_row_number
from biomeframe.session import stored

MAX_TOKENS = 2048
BUCKETS = 8
BATCH_TOKENS = 16_384


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Ascending bucket lengths (the last is the longest piece) with the least padding.

    Minimises the sum of boundary - length over all pieces with at most
    ``buckets`` buckets. Among equal costs the earlier cut is taken at each step,
    from the longest bucket down. O(buckets * n^2) in numpy for n lengths.
    """
    order = np.argsort(lengths)
    size = np.asarray(lengths, dtype=np.int64)[order]
    total = np.concatenate(([0], np.cumsum(np.asarray(counts, dtype=np.int64)[order])))
    n = len(size)
    if not n:
        return []
    best = np.full(n + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        # Cost of lengths i..j-1 in one bucket, up to the sum of their own lengths.
        nxt, cut = np.empty_like(best), np.zeros(n + 1, dtype=np.int64)
        nxt[0] = 0
        for j in range(1, n + 1):
            cost = best[:j] + size[j - 1] * (total[j] - total[:j])
            cut[j] = int(np.argmin(cost))
            nxt[j] = cost[cut[j]]
        best = nxt
        cuts.append(cut)
    out, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(size[j - 1]))
        j = int(cut[j])
    return out[::-1]


def pieces(docs: DataFrame, n_tokens: Column, doc_id: str, max_tokens: int) -> DataFrame:
    """doc_id, piece (from 0), n_tokens: documents cut at every ``max_tokens``."""
    n = docs.select(F.col(doc_id).alias("doc_id"), n_tokens.cast("long").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / F.lit(max_tokens)) - 1, F.lit(0)).cast("long")
    return n.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "doc_id",
        "piece",
        F.least(F.col("n") - F.col("piece") * max_tokens, F.lit(max_tokens)).alias("n_tokens"),
    )


def pack(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    n_tokens: Column | None = None,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """One row for each piece: doc_id, piece, n_tokens, bucket_len, batch, slot.

    ``n_tokens`` gives a row's length; by default its number of words. batch is
    numbered from 0 inside its bucket, slot from 0 inside its batch; a batch has
    ``batch_tokens // bucket_len`` slots, at least one. A null, empty or blank
    text is one piece of length 0, which no batch needs: its bucket_len, batch
    and slot are null. Repeated rows are pieces of their own; ties in
    (doc_id, piece) are ordered by length. Other columns are ignored.

    Pieces are three numbers wide; they are written once and numbered by a
    range-partitioned sort, so a bucket with most rows still spans many tasks.
    """
    count = F.size(words(F.col(text))) if n_tokens is None else n_tokens
    cut = stored(pieces(docs, count, doc_id, max_tokens), "pieces")
    filled = cut.filter("n_tokens > 0")
    histogram = filled.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    bounds = best_boundaries([r.n_tokens for r in histogram], [r.n for r in histogram], buckets)
    spark = docs.sparkSession
    sizes, before, low = [], 0, 0
    for bound in bounds:
        sizes.append((bound, before, max(batch_tokens // bound, 1)))
        before += sum(r.n for r in histogram if low < r.n_tokens <= bound)
        low = bound
    rows = ", ".join(f"({b}, {start}L, {slots})" for b, start, slots in sizes) or "(1, 0L, 1)"
    size = spark.sql(f"SELECT * FROM VALUES {rows} AS t(bound, start, slots)")
    ladder = F.array(*[F.lit(b) for b in bounds] or [F.lit(1)])
    bound = F.element_at(F.filter(ladder, lambda b: b >= F.col("n_tokens")), 1)
    numbered = global_row_number(
        filled.withColumn("bound", bound), ["bound", "doc_id", "piece", "n_tokens"], "row"
    )
    place = F.col("row") - F.col("start")
    batched = numbered.join(F.broadcast(size), "bound").select(
        "doc_id", "piece", "n_tokens", F.col("bound").cast("long").alias("bucket_len"),
        F.floor(place / F.col("slots")).cast("long").alias("batch"),
        (place % F.col("slots")).cast("long").alias("slot"),
    )
    none = F.lit(None).cast("long")
    blank = cut.filter("n_tokens = 0").select(
        "doc_id", "piece", "n_tokens", none.alias("bucket_len"), none.alias("batch"),
        none.alias("slot"),
    )
    return batched.unionByName(blank)
