"""The md5-keyed cache of search results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biomeframe.functions.sequence import seq_key
from biomeframe.operators.skew import salted_join


def latest_per_key(cache: DataFrame, key: str = "seq_md5", value: str = "result",
                   timestamp: str = "timestamp") -> DataFrame:
    """The newest entry of each key; rows without a time come last.

    Of equally new entries a hash of the value decides, so repeats give the same.
    """
    time = F.coalesce(F.col(timestamp), F.lit(float("-inf")).cast("double"))
    return cache.groupBy(key).agg(
        F.max_by(F.col(value), F.struct(time, F.xxhash64(value))).alias(value), F.max(timestamp).alias(timestamp)
    )


def fresh_entries(cache: DataFrame, now: float, days: float = 30, timestamp: str = "timestamp") -> DataFrame:
    """Entries younger than ``days`` before ``now`` (epoch seconds), or undated."""
    cutoff = now - days * 24 * 60 * 60
    t = F.col(timestamp)
    return cache.filter(t.isNull() | (t > F.lit(float(cutoff))))


def lookup_cache(seqs: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``(id, seq, ord)`` into cached results and work to do.

    ``cache`` has one row per ``seq_md5``. The first frame has one result per
    sequence under its own id; the second one row per distinct missing
    sequence. A sequence with very many copies is spread over tasks.
    """
    keyed = seqs.withColumn("seq_md5", seq_key("seq"))
    found = salted_join(keyed, cache, ["seq_md5"], "inner", spread=["ord"])
    missing = salted_join(keyed, cache.select("seq_md5"), ["seq_md5"], "left_anti", spread=["ord"])
    work = missing.groupBy("seq_md5").agg(
        F.min("ord").alias("ord"), F.count(F.lit(1)).alias("copies")
    )
    todo = missing.join(work.select("ord", "copies"), "ord")
    return found, todo


def cacheable(results: DataFrame) -> DataFrame:
    """Results that may enter the cache: failed searches never do."""
    return results.filter(F.col("error").isNull())
