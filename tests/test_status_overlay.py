"""Status updates as events beside the table (U1, U2): every reader sees them, and the table's files change in a fold alone."""
import os

from pyspark.sql import functions as F

from metricyard.operators import merge, sinks, status
from metricyard.operators.status import StatusOverlay
from metricyard.plans import runs

SCHEMA = "Application string, Project_run_type string, Sample_Name string, ProjStatus string"
ROWS = [("rnaseq", "r1", "s1", "Delivered"), ("rnaseq", "r1", "s1", "Delivered"), ("rnaseq", "r1", "s1", "Pending"),
        ("rnaseq", "r2", None, "Delivered"), ("wgs", "r2", "s3", "Delivered"), ("wgs", None, "s4", "Delivered"),
        (None, "r2", "s5", None), ("o'x y=1", "r2", "s6", "Delivered")]


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def table(spark, path, partitioned=True):
    writer = spark.createDataFrame(ROWS, SCHEMA).repartition(3).write
    (writer.partitionBy("Application") if partitioned else writer).parquet(path)
    return StatusOverlay(spark, path)


def seen(df):
    return sorted(tuple(r) for r in df.select("Application", "Project_run_type", "Sample_Name", "ProjStatus").na.fill("-").collect())


def expected(change):
    return sorted(tuple(x or "-" for x in (*r[:3], change(r))) for r in ROWS)


def test_update_writes_events_alone(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    o = table(spark, path)
    before = files_of(path)
    assert seen(o.read()) == expected(lambda r: r[3])                        # no event yet
    assert o.update("r9") == 0 and not os.path.exists(o.root)
    assert o.update("r1", spark.createDataFrame([("s1",), ("s1",), (None,)], "name string")) == 2
    assert o.update("r1") == 0                                                # the next update sees the first
    assert files_of(path) == before
    first = lambda r: "Undelivered" if r[1] == "r1" and r[3] == "Delivered" else r[3]
    assert seen(o.read()) == expected(first)
    # rows stored later, equal to changed ones in every stored column, keep their own status
    sinks.append_rows(spark.createDataFrame(ROWS[:1], SCHEMA), path, ["Application"])
    assert o.read().filter("Project_run_type = 'r1' AND ProjStatus = 'Delivered'").count() == 1
    assert o.update("r1", from_status="Undelivered", to_status="Archived") == 2      # the newest event of a row holds
    assert o.read().filter("ProjStatus = 'Archived'").count() == 2


def test_fold_and_what_it_touches(spark, tmpdir_path):
    for partitioned in (True, False):
        path = os.path.join(tmpdir_path, f"t{partitioned}")
        o = table(spark, path, partitioned)
        kept = [f for f in files_of(path) if "=rnaseq" in f or "__HIVE" in f]
        assert o.update("r2") == 3
        now = seen(o.read())
        again = StatusOverlay(spark, path)
        assert seen(again.read()) == now
        o.fold()
        assert o.pending() == [] and seen(spark.read.parquet(path)) == now and seen(o.read()) == now
        if partitioned:
            assert not [f for f in kept if "__HIVE" in f and f not in files_of(path)]        # no event, not written
        o.fold()                                                              # nothing pending
        assert o.update("r1") == 2 and o.update("r1") == 0 and len(o.pending()) == 1


def test_fold_that_died_is_repeated(spark, tmpdir_path):
    """The table was replaced, the note was not written: the events name files that are gone."""
    path = os.path.join(tmpdir_path, "t")
    o = table(spark, path)
    o.update("r2")
    now = seen(o.read())
    o.fold()
    os.rename(os.path.join(o.root, "folded=1"), os.path.join(o.root, "lost"))
    assert o.pending() == [1] and seen(o.read()) == now
    files = files_of(path)
    o.fold()
    assert files_of(path) == files and o.pending() == []
    os.makedirs(os.path.join(o.root, "v=7"))                                  # an update that died
    assert o.pending() == [] and o.update("r1") == 2 and o.pending() == [8]


def test_ways_of_merging_agree_and_leave_the_table_in_place(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    rows = spark.range(0, 5000, 1, 5).select(F.concat(F.lit("a"), F.col("id") % 3).alias("Application"), F.concat(
        F.lit("r"), F.col("id") % 2).alias("Project_run_type"), F.col("id").cast("string").alias("Sample_Name"),
        F.lit("Delivered").alias("ProjStatus"))
    rows.write.partitionBy("Application").parquet(path)
    o = StatusOverlay(spark, path)
    n = o.update("r1", rows.filter("Application = 'a1'").select("Sample_Name"))
    assert 0 < n < 1667
    want = seen(o.read())
    assert sum(r[3] == "Undelivered" for r in want) == n
    plan = o.read().select("ProjStatus")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1                      # the events are grouped, the table stays
    assert "struct<ProjStatus:string,_tmp_metadata_row_index:bigint>" in plan      # one column, and the place
    for limit in (2000, 1):                  # names of files are broadcast; nothing is
        assert seen(o.rows(limit).drop("_file", "_row")) == want


def test_runs_see_events(spark, tmpdir_path):
    path, export = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "x")
    table(spark, path)
    before = files_of(path)
    assert runs.run_status_update(spark, path, "r2", export, fold=False) == 3
    assert files_of(path) == before
    tsv = spark.read.option("header", True).option("sep", "\t").csv(export)
    assert tsv.count() == 4 and tsv.filter("ProjStatus = 'Undelivered'").count() == 3
    # U1 + M2: a batch that repeats what readers see adds nothing; the status before the update is another row
    target = runs.with_status(spark, path, spark.read.parquet(path))
    assert merge.new_rows_except(target, spark.createDataFrame([("wgs", "r2", "s3", "Undelivered")], SCHEMA)).count() == 0
    assert merge.new_rows_except(target, spark.createDataFrame([("wgs", "r2", "s3", "Delivered")], SCHEMA)).count() == 1
    assert runs.fold_status(spark, tmpdir_path, ["t", "absent"]) == ["t"]
    assert spark.read.parquet(path).filter("ProjStatus = 'Undelivered'").count() == 3
    assert runs.fold_status(spark, tmpdir_path, ["t", "absent"]) == []


def test_empty_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    o = StatusOverlay(spark, path)
    assert o.update("r1") == 0 and o.read().count() == 0
    o.fold()
    assert o.read().columns == ["Application", "Project_run_type", "Sample_Name", "ProjStatus"]


def test_place_of_a_row_is_found_without_going_back(spark):
    import re
    import time
    old = r"((?:[^/]+=[^/]*/)*[^/]+)$"
    paths = ["file:///a/t/part-0.parquet", "file:///a/t/k=1/l=/part-0.parquet", "/a/k=1/t/l=2/p=q", "part-0", "/t/=a/x", "/t/==a/x", "/k=1/t=/x=%20y/f"]
    assert [re.search(status.INSIDE, p)[1] for p in paths] == [re.search(old, p)[1] for p in paths]
    rows = spark.createDataFrame([(p,) for p in paths] + [("/".join(["b" * 30_000] * 30) + "/t/k=1/f",)], "p string")
    began = time.time()
    got = [r[0] for r in rows.select(F.regexp_extract("p", status.INSIDE, 1)).collect()]
    assert got == [re.search(old, p)[1] for p in paths] + ["k=1/f"]
    assert time.time() - began < 60                        # the old pattern tries each place against all that follow: 13 billion steps
