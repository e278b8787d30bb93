import datetime as dt

from pyspark.sql import functions as F

from biomeframe.session import scratch_path
from biomeframe.streaming import feeds


def at(minute):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute)


def feed(spark, folder, schema, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/b={i}")
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True).parquet(folder)
    )


def test_counts_update_and_drop_late_rows(spark, tmp_path):
    batches = [
        [(at(1), "x"), (at(2), None)],
        [(at(70), "x"), (at(30), "x")],
        [(at(300), "y")],
        [(at(301), "y")],
        [(at(3), "x")],
    ]
    stream = feed(spark, str(tmp_path / "in"), "ts timestamp, organism string", batches)
    out = scratch_path(spark, "counts")
    feeds.run_available(feeds.stream_organism_counts(stream), out, scratch_path(spark, "cp"), "update")
    rows = spark.read.parquet(out).groupBy("window_start", "organism").agg(F.max_by("hits", "batch").alias("n"))
    got = {(r.window_start.hour, r.organism): r.n for r in rows.collect()}
    assert got == {(0, "x"): 2, (0, "Unknown"): 1, (1, "x"): 1, (5, "y"): 2}


def test_dedup(spark, tmp_path):
    batches = [[(at(0), "AC", "a")], [(at(5), "AC", "b"), (at(6), "GG", "c")], [(at(7), "GG", "d")]]
    stream = feed(spark, str(tmp_path / "in"), "ts timestamp, seq string, id string", batches)
    out = scratch_path(spark, "dedup")
    feeds.run_available(feeds.stream_dedup_sequences(stream), out, scratch_path(spark, "cp"))
    assert {r.id for r in spark.read.parquet(out).collect()} == {"a", "c"}
