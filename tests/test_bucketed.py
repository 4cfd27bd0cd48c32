"""Feature tables in entity buckets: layout from the size, no exchange on the stored side."""
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import bucketed as bk


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucket_count_follows_the_size():
    assert [bk.bucket_count(n, 100) for n in (0, 1, 100, 101, 250, 401, 100_000)] == [1, 1, 1, 2, 4, 8, 1024]
    assert bk.bucket_count(10 ** 18) == bk.MOST_BUCKETS


def test_lookup_shuffles_the_requests_alone(spark, no_broadcast):
    root = tempfile.mkdtemp(prefix="shelfwise-bucketed-")
    rows = spark.range(2000).select((F.col("id") * 3).alias("k"), F.col("id").alias("x"), F.lit("a'`b").alias("odd `name"))
    info = bk.write_bucketed(rows, root, "t", "k", bucket_bytes=4096)
    assert info["buckets"] == bk.bucket_count(bk.text_bytes(rows)[0], 4096) > 8 and info["rows"] == 2000
    asked = spark.range(0, 9000, 2).withColumnRenamed("id", "k")
    joined = asked.join(bk.read_bucketed(spark, root, "t"), "k", "left")
    text = plan(joined)
    assert text.count("Exchange") == 1 and text.index("Exchange") < text.index("Range (") < text.index("FileScan")
    assert f"SelectedBucketsCount: {info['buckets']} out of {info['buckets']}" in text
    got = {r.k: r.x for r in joined.collect()}
    assert got == {k: k // 3 if k % 3 == 0 and k < 6000 else None for k in range(0, 9000, 2)}
    assert bk.read_bucketed(spark, root, "t").where("k = 300").first().x == 100


def test_tables_of_two_sizes_line_up(spark, no_broadcast):
    root = tempfile.mkdtemp(prefix="shelfwise-bucketed-")
    bk.write_bucketed(spark.range(4000).selectExpr("id as k", "id + 1 as a"), root, "big", "k", bucket_bytes=4096)
    bk.write_bucketed(spark.range(500).selectExpr("id as k", "id + 2 as b"), root, "small", "k", bucket_bytes=4096)
    conf = {f"spark.sql.bucketing.coalesceBucketsInJoin.{k}": x for k, x in (("enabled", "true"), ("maxBucketRatio", "64"))}
    for k, x in conf.items():
        spark.conf.set(k, x)
    try:
        joined = bk.read_bucketed(spark, root, "big").join(bk.read_bucketed(spark, root, "small"), "k")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 500 and joined.where("a + 1 <> b").count() == 0
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_versions_and_odd_rows(spark):
    root = tempfile.mkdtemp(prefix="shelfwise-bucketed-")
    with pytest.raises(FileNotFoundError):
        bk.read_bucketed(spark, root, "t")
    rows = spark.createDataFrame([(None, 1.5), (1, None), (1, 2.0), (2, 3.0)], "k long, x double")
    assert bk.write_bucketed(rows, root, "t", "k")["buckets"] == 1
    held = bk.read_bucketed(spark, root, "t")
    bk.write_bucketed(rows.limit(0), root, "t", "k")
    rows.write.parquet(f"{root}/t/data/v=unfinished")          # a version that no record names
    assert bk.read_bucketed(spark, root, "t").count() == 0
    key = lambda df: sorted(map(str, df.collect()))
    assert key(held) == key(rows) == key(bk.read_bucketed(spark, root, "t", version=1))
    other = spark.newSession()
    assert key(bk.read_bucketed(other, root, "t", version=1)) == key(rows)
