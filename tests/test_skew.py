import random

import pytest
from pyspark.sql import functions as F

from biomeframe.operators import skew
from biomeframe.operators.sequences import unique_ids


@pytest.fixture
def hot(spark):
    """A third of the rows share one key."""
    rng = random.Random(1)
    rows = [(i, 0 if rng.random() < 0.34 else rng.randrange(1, 40)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, k int").repartition(4)


def test_hot_keys_finds_the_frequent_key(spark, hot):
    rows, df = hot
    found = skew.hot_keys(df, ["k"], min_rows=200)
    key = df.filter("k = 0").select(F.xxhash64("k").alias("h")).first().h
    assert set(found) == {key} and found[key] > 1
    assert skew.hot_keys(df, ["k"]) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, hot, how):
    _, df = hot
    small = spark.createDataFrame([(k, f"n{k}") for k in range(0, 30)], "k int, name string")
    want = sorted(map(str, df.join(small, ["k"], how).collect()))
    salted = skew.salted_join(df, small, ["k"], how, spread=["id"], min_rows=200)
    assert sorted(map(str, salted.select(*df.join(small, ["k"], how).columns).collect())) == want
    assert "_salt" in salted._jdf.queryExecution().toString()


def test_salted_join_refuses_outer(spark, hot):
    _, df = hot
    with pytest.raises(ValueError):
        skew.salted_join(df, df, ["k"], "full")


def test_pair_join_equals_plain_join(spark, hot):
    _, df = hot
    right = df.select(F.col("id").alias("other"), "k").filter("other < 600")
    got = skew.salted_pair_join(df, right, ["k"], ["id"], ["other"], min_rows=50)
    assert "_row" in got._jdf.queryExecution().toString()
    want = df.join(right, "k")
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_key_stats(spark, hot):
    rows, df = hot
    best = {}
    for i, k in rows:
        best[k] = max(best.get(k, -1), i)
    got = skew.with_key_stats(df, ["k"], F.max("id").alias("m"), spread=["id"]).collect()
    assert len(got) == len(rows) and all(r.m == best[r.k] for r in got)


def test_lookup_join_both_ways(spark, hot):
    _, df = hot
    small = spark.createDataFrame([(k, f"n{k}") for k in range(0, 30)], "k int, name string")
    by_size = [
        skew.lookup_join(df, small, ["k"], "left", max_rows=n).orderBy("id").collect()
        for n in (100, 5)
    ]
    assert by_size[0] == by_size[1]


def test_fits_broadcast_counts_rows_and_characters(spark):
    df = spark.range(100).withColumn("t", F.expr("repeat('x', 100)"))
    assert skew.fits_broadcast(df, 100, 20_000)
    assert not skew.fits_broadcast(df, 99, 20_000)
    assert not skew.fits_broadcast(df, 100, 5_000)


def test_running_total_over_ranges(spark):
    rng = random.Random(2)
    rows = sorted((o, rng.randrange(5)) for o in rng.sample(range(-500, 5000), 700))
    df = spark.createDataFrame(rows, "o long, v int").repartition(4)
    total, want = 0, {}
    for o, v in rows:
        total += v
        want[o] = total
    got = skew.running_total(df, "o", "v", "t", bucket=64).collect()
    assert {r.o: r.t for r in got} == want


def test_global_row_number(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(4)
    got = skew.global_row_number(df, ["x"], "n").collect()
    assert all(r.x == r.n for r in got) and len(got) == 1000


def _renamed(ids):
    seen, counter, out = set(), 0, []
    for i in ids:
        if i in seen:
            out.append(f"{i}_{counter}")
            counter += 1
        else:
            seen.add(i)
            out.append(i)
    return out


@pytest.mark.parametrize("bucket", [1 << 20, 8])
def test_unique_ids(spark, bucket):
    rng = random.Random(3)
    for ids in (list("aabab"), [rng.choice("aaaabcdef") for _ in range(200)]):
        df = spark.createDataFrame([(i, x + " note") for i, x in enumerate(ids)], "ord long, id string")
        got = unique_ids(df, bucket=bucket).orderBy("ord").collect()
        assert [r.unique_id for r in got] == _renamed(ids)
