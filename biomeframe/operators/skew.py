"""Joins and running numbers that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biomeframe.session import stored

BROADCAST_ROWS = 50_000
BROADCAST_CHARS = 64 << 20
HOT_KEYS = 1_000
HOT_SHARE = 1.0 / 2_000
HOT_ROWS = 1_000_000
HASH_ROWS = 1_000_000


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS
) -> bool:
    """True if ``df`` is counted small in rows and in printed size.

    Reads at most ``max_rows`` + 1 rows. For reference tables (taxonomy, id
    maps, dictionaries) that are stored or cheap to compute.
    """
    size = F.length(F.struct(*df.columns).cast("string"))
    seen = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("c")
    ).first()
    return seen.n <= max_rows and seen.c <= max_chars


def hash_side(df: DataFrame, rows_per_partition: int = HASH_ROWS) -> DataFrame:
    """Ask for a join that need not sort the other side, if ``df`` is small enough.

    Broadcast up to ``BROADCAST_ROWS`` rows, a hash join built on ``df`` while
    its share per partition is small, else Spark's choice. For stored tables of
    narrow rows, which are counted from file footers.
    """
    rows = df.count()
    if rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if rows <= partitions * rows_per_partition else df


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> dict[int, int]:
    """Hash of each frequent key and the number of pieces to cut it into.

    One map-side sketch pass over the key columns, at most ``HOT_KEYS`` entries
    out. The sketch only steers the placement of rows; no result depends on it.
    """
    sketch = (
        df.select(F.xxhash64(*keys).alias("_kh"))
        .agg(
            F.expr(f"approx_top_k(_kh, {HOT_KEYS}, {HOT_KEYS * 16})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
        .first()
    )
    room = max(sketch.n * HOT_SHARE, float(min_rows))
    # Pieces are bounded in rows, not in a share of the input that grows with it.
    return {t["item"]: ceil(t["count"] / min_rows) for t in sketch.top or () if t["count"] > room}


def _pieces(hot: dict[int, int], keys: Sequence[str]) -> Column:
    """Number of pieces of a row's key, 1 for all but the frequent ones."""
    if not hot:
        return F.lit(1)
    entries = [F.lit(x) for pair in hot.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.xxhash64(*keys)), F.lit(1))


def _cut(pieces: Column, spread: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*spread, F.lit(17)), pieces).cast("int")


def _copies(pieces: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), pieces - 1))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Shuffle join in which the frequent keys of ``big`` span many tasks.

    The keys of ``big`` are sketched first. Without a frequent key this is a
    plain join. Else the rows of a frequent key get a piece number from a hash
    of ``spread`` (default: the whole row), and the matching rows of ``small``
    are copied to each piece. Valid for joins that keep ``big``'s side: inner,
    left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} would repeat rows of the copied side")
    keys = list(keys)
    hot = hot_keys(big, keys, min_rows)
    if not hot:
        return big.join(small, keys, how)
    pieces = _pieces(hot, keys)
    left = big.withColumn("_salt", _cut(pieces, list(spread or big.columns)))
    right = small.withColumn("_salt", _copies(pieces))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def salted_pair_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_left: Sequence[str],
    spread_right: Sequence[str],
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join in which a key may be frequent on both sides.

    A frequent key is laid out on a grid: each side is cut into its own number
    of pieces and copied along the other side's pieces, so every pair of rows
    meets in exactly one of many tasks.
    """
    keys = list(keys)
    hot_left, hot_right = hot_keys(left, keys, min_rows), hot_keys(right, keys, min_rows)
    if not hot_left and not hot_right:
        return left.join(right, keys)
    rows, columns = _pieces(hot_left, keys), _pieces(hot_right, keys)
    a = left.withColumn("_row", _cut(rows, spread_left)).withColumn("_column", _copies(columns))
    b = right.withColumn("_column", _cut(columns, spread_right)).withColumn("_row", _copies(rows))
    return a.join(b, [*keys, "_row", "_column"]).drop("_row", "_column")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """Join to a reference table: broadcast if counted small, else salted."""
    if fits_broadcast(small, max_rows, max_chars):
        return big.join(F.broadcast(small), list(keys), how)
    return salted_join(big, small, keys, how, spread)


def with_key_stats(
    df: DataFrame, keys: Sequence[str], *stats: Column, spread: Sequence[str] | None = None
) -> DataFrame:
    """Add per-key aggregates to every row without a window.

    The aggregate combines on the map side, so a key with a third of all rows
    reaches its reducer as one row per map task; the join back is salted. The
    frame is read more than once: store it first if it is costly.
    """
    return salted_join(df, df.groupBy(*keys).agg(*stats), keys, "left", spread)


def running_total(
    df: DataFrame, order: str, value: str, out: str, bucket: int = 1 << 20
) -> DataFrame:
    """Inclusive running sum of ``value`` by the unique long column ``order``.

    Rows are cut into ranges of ``bucket`` consecutive order values; each range
    is summed on its own and shifted by the total of the ranges before it, so
    the only unpartitioned window sees one row per range.
    """
    cut = df.withColumn("_b", F.floor(F.col(order) / F.lit(bucket)).cast("long"))
    before = cut.groupBy("_b").agg(F.sum(value).alias("_t"))
    before = before.select(
        "_b",
        F.coalesce(
            F.sum("_t").over(
                Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_before"),
    )
    inner = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("_in", F.sum(value).over(inner))
        .join(before, "_b")
        .withColumn(out, F.col("_before") + F.col("_in"))
        .drop("_b", "_in", "_before")
    )


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str = "ord") -> DataFrame:
    """Dense 0-based position of every row in a total order.

    Range-partitioned sort, stored to pin the partitions, then one offset per
    partition (the broadcast has as many rows as partitions).
    """
    pinned = stored(
        df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "sorted"
    ).withColumn("_p", F.shiftright("_m", 33))
    offsets = pinned.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(
        "_p",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    local = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        pinned.join(F.broadcast(offsets), "_p")
        .withColumn(out, F.col("_off") + local)
        .drop("_p", "_m", "_off")
    )
