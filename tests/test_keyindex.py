"""Appends by key index and Bloom filter against plain anti-joins; what their plans read and move."""
import os

from metricyard.operators import merge
from metricyard.operators.keyindex import KeyIndex
from metricyard.session import cut_lineage
from metricyard.sources.tables import read_evolving

SCHEMA = "a string, b double, c string, n int"
ROWS = [("x", 1.0, None, 1), ("x", 1.0, "", 2), (None, None, None, 3), ("", 0.0, "y", 4), ("x", -0.0, "z", 5), ("12", 1.0, "3", 6),
        ("1", 1.0, "23", 7), ("a=1", None, "b", 8), ("x", 1.0, None, 9), ("", -0.0, "y", 10), (None, None, None, 11)]


def absent(stored, batch, key):
    """SQL grouping: NULLs match, -0.0 is 0.0, first row of a key by n."""
    at = [SCHEMA.replace(" string", "").replace(" double", "").replace(" int", "").split(", ").index(k) for k in key]
    of = lambda r: tuple(r[i] for i in at)
    seen, out = {of(r) for r in stored}, []
    for r in sorted(batch, key=lambda r: r[3]):
        if of(r) not in seen:
            seen.add(of(r))
            out.append(r)
    return sorted(out, key=str)


def test_index_appends_like_an_anti_join(spark, tmpdir_path):
    key = ["a", "b", "c"]
    path = os.path.join(tmpdir_path, "t")
    spark.createDataFrame(ROWS[:4], SCHEMA).write.parquet(path)                 # a table that had no index
    index = KeyIndex(spark, path, key, buckets=8).ensure()
    batch = cut_lineage(spark.createDataFrame(ROWS, SCHEMA))
    assert index.append(batch, order_col="n") == len(absent(ROWS[:4], ROWS, key))
    got = sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
    assert got == sorted(ROWS[:4] + absent(ROWS[:4], ROWS, key), key=str)
    assert KeyIndex(spark, path, key).ensure().append(batch) == 0 and KeyIndex(spark, path, key).buckets == 8


def test_index_after_a_writer_that_died(spark, tmpdir_path):
    """Rows were written, their digests were not: the next writer finds out and adds nothing twice."""
    path = os.path.join(tmpdir_path, "t")
    index = KeyIndex(spark, path, ["a"], buckets=4).ensure()
    index.append(cut_lineage(spark.createDataFrame(ROWS[:5], SCHEMA)), order_col="n")
    spark.createDataFrame([("lost", 1.0, "q", 99)], SCHEMA).write.mode("append").parquet(path)
    again = KeyIndex(spark, path, ["a"]).ensure()
    assert again.append(cut_lineage(spark.createDataFrame([("lost", 2.0, "r", 100), ("new", 1.0, None, 101)], SCHEMA))) == 1
    assert again.digests().count() == spark.read.parquet(path).count()


def test_whole_row_digests_survive_new_columns(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    index = KeyIndex(spark, path, buckets=4).ensure()
    one = spark.createDataFrame([(1, "p"), (2, None)], "id int, v string")
    two = spark.createDataFrame([("p", 1, None), (None, 2, None), (None, 2, "w")], "v string, id int, w string")
    assert index.append(cut_lineage(one)) == 2 and index.append(cut_lineage(two)) == 1
    assert KeyIndex(spark, path).ensure().append(cut_lineage(one.unionByName(two, allowMissingColumns=True))) == 0
    assert sorted(read_evolving(spark, path, "id int").columns) == ["id", "v", "w"]


def test_a_batch_reads_its_buckets_and_no_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    spark.range(2000).selectExpr("id", "id AS v").write.parquet(path)
    index = KeyIndex(spark, path, ["id"], buckets=16).ensure()
    batch = cut_lineage(spark.createDataFrame([(1, 0), (5000, 0)], "id long, v long"))
    new = index.absent(batch)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert [r["id"] for r in new.collect()] == [5000]
    assert f"{path}]" not in plan and f"{path}.keys" in plan and "PartitionFilters: [bucket" in plan
    read = [line for line in plan.split("\n") if "FileScan" in line and ".keys" in line]
    assert len(read) == 1 and " IN (" in read[0]
    before = plan[: plan.index(".keys")].rsplit("\n", 8)[-8:]                 # what stands right above the scan of the index
    assert not any("hashpartitioning" in line for line in before)


def test_bloom_filter_keeps_the_target_where_it_lies(spark, monkeypatch):
    """A batch too large to broadcast: only target rows that share a bit with it are shuffled."""
    target = cut_lineage(spark.range(20_000).selectExpr("id AS k", "IF(id % 10 = 0, NULL, CAST(id AS STRING)) AS s", "1 AS v"))
    batch = cut_lineage(spark.range(19_000, 21_000).selectExpr("id AS k", "IF(id % 10 = 0, NULL, CAST(id AS STRING)) AS s", "2 AS v"))
    monkeypatch.setattr(merge, "fits_broadcast", lambda df: False)
    new = merge.new_rows_if_absent(target, batch, ["k", "s"], batch_stored=True)
    assert sorted(r["k"] for r in new.collect()) == list(range(20_000, 21_000))
    kept = merge.likely_in(target, batch, ["k", "s"])
    assert 1000 <= kept.count() < 3000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("FileScan") == 2
    assert "hashpartitioning(k" not in plan and "hashpartitioning(pmod" not in plan
    crowded = merge.likely_in(target, batch, ["k", "s"], most_bits=1 << 10)       # a full filter only lets more pass
    assert crowded.count() >= kept.count()
