"""Text records numbered by their place in the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biomeframe.operators.skew import lookup_join
from biomeframe.session import stored

FILE_BITS = 40
#: Blocks of text whose numbers are broadcast: about 400 TB in blocks of 128 MB.
BLOCK_ROWS = 3_000_000
BLOCK_CHARS = 256 << 20


def numbered_records(spark: SparkSession, path, line_sep: str | None = None) -> DataFrame:
    """``(file_rank, n, value)``: records with their 0-based number in the file.

    A text scan knows the byte range (block) a record comes from, and the rows
    of a block stay in order. One pass counts the records of each block and
    stores that small table; its running sums then number the records without
    sorting or shuffling any raw text: it is broadcast up to some million blocks,
    which is checked in rows and bytes. Files are told apart by a hash of their
    path, which is checked to be one path each.
    """
    # Both passes must cut the files alike, also if executors come and go.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    rows = reader.text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("m"),
        "value",
    )
    counted = stored(
        # The path is a key: as an aggregate it would make Spark sort all records of a block.
        rows.groupBy("file", "path", "block").agg(F.min("m").alias("m0"), F.count(F.lit(1)).alias("c")),
        "blocks",
    )
    clash = F.raise_error(F.lit("two paths have the same hash")).cast("string")
    file = Window.partitionBy("file")
    one = F.min("path").over(file) == F.max("path").over(file)
    counted = counted.withColumn("path", F.when(one, F.col("path")).otherwise(clash))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.select(
        "file",
        "block",
        "m0",
        F.coalesce(F.sum("c").over(in_file), F.lit(0)).alias("before"),
        (F.dense_rank().over(Window.orderBy("path")) - 1).cast("long").alias("file_rank"),
    )
    joined = lookup_join(
        rows.drop("path"), blocks, ["file", "block"], "left", spread=["m"],
        max_rows=BLOCK_ROWS, max_chars=BLOCK_CHARS,
    )
    place = F.col("before") + F.col("m") - F.col("m0")
    lost = F.raise_error(F.lit("files were cut differently between two scans")).cast("long")
    return joined.select("file_rank", F.coalesce(place, lost).alias("n"), "value")


def file_ord(file_rank: str = "file_rank", n: str = "n") -> Column:
    """One long that sorts records by file, then by place in the file."""
    return F.shiftleft(F.col(file_rank), FILE_BITS) + F.col(n)
