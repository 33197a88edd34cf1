"""Join helpers: salted join equals the plain left join; the broadcast check is bounded."""
from pyspark.sql import functions as F

from metricyard.operators import joins


def test_salted_left_join_equals_plain(spark):
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("p"), F.col("id"))
    small = spark.createDataFrame([("HOT", 1), ("HOT", 2), ("k1", 1), ("zz", 9)], "p string, lane int")
    plain = sorted(tuple(r) for r in big.join(small, ["p"], "left").collect())
    salted = sorted(tuple(r) for r in joins.salted_left_join(big, small, ["p"], salt=16, salt_from=["id"]).collect())
    assert plain == salted
    assert len([r for r in salted if r[0] == "k2"]) == len([r for r in plain if r[0] == "k2"])   # no lanes -> NULL row


def test_hot_keys_bounded(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 400, F.lit("A")).otherwise(F.col("id").cast("string")).alias("k"))
    assert [r["k"] for r in joins.hot_keys(big, ["k"], 0.1).collect()] == ["A"]


def test_fits_broadcast(spark):
    small = spark.range(10).select(F.col("id").cast("string").alias("k"))
    assert joins.fits_broadcast(small)
    assert not joins.fits_broadcast(small, max_bytes=16)
    assert not joins.fits_broadcast(small, max_bytes=-1)
