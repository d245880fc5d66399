"""Running index over range partitions, and apportionment of large weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulso.operators import numbering
from pulso.operators.apportion import apportion
from pulso.operators.numbering import running_index


def test_index_follows_the_order_and_no_task_holds_a_group(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(numbering, "materialize", lambda df, name, f=numbering.materialize: seen.append(f(df, name)) or seen[-1])
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.range(20000).select((F.col("id") % 100 == 0).cast("int").alias("g"), (F.col("id") * 7919 % 20011).alias("k"), F.col("id").alias("u"))
        got = running_index(df.repartition(7), [F.col("g"), F.col("k").desc(), F.col("u")], "index").collect()
    finally:
        spark.conf.set(key, old)
    rows = sorted(got, key=lambda r: (r.g, -r.k, r.u))
    assert [r["index"] for r in rows] == list(range(20000))
    sizes = [r["count"] for r in seen[-1].groupBy("__part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 20000 / 4


def test_index_of_nothing_and_of_equal_keys(spark):
    df = spark.createDataFrame([], "a INT")
    assert running_index(df, [F.col("a")]).collect() == []
    same = spark.createDataFrame([(None,), (1,), (1,), (1,), (None,)], "a INT")
    got = running_index(same, [F.col("a").asc_nulls_first()]).collect()
    assert sorted((r["index"], r["a"]) for r in got) == [(0, None), (1, None), (2, 1), (3, 1), (4, 1)]


def test_shares_of_weights_near_the_top_of_bigint(spark):
    top = 2**63 - 1
    df = spark.createDataFrame([("g", 0, top), ("g", 1, top), ("g", 2, top), ("h", 0, 3), ("h", 1, 0)], "g STRING, i INT, w BIGINT")
    got = {(r.g, r.i): r.v for r in apportion(df, ["g"], "w", 10000, ["i"], "v").collect()}
    assert got == {("g", 0): 0.3334, ("g", 1): 0.3333, ("g", 2): 0.3333, ("h", 0): 1.0, ("h", 1): 0.0}
