"""A1 by bitmaps and W6 by ranges against full recomputation."""
import os
import random

from metricyard.operators import marts
from metricyard.operators.appindex import AppIndex
from metricyard.operators.numbering import numbered


def test_bitmaps_equal_the_full_rollup(spark, tmpdir_path):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["f", "g", "h", None]), rnd.choice([None, *map(str, range(60))])) for _ in range(400)]
    rows += [("c", "only nulls", None)]
    table = spark.createDataFrame(rows, "Application string, Investigator_Folder string, S string")
    state = AppIndex(spark, os.path.join(tmpdir_path, "state"))
    full = sorted(map(tuple, marts.app_index([(table, "S")]).collect()))
    for part in (rows[:150], rows[100:300], rows[100:300]):              # overlapping, and one batch tried again
        state.add("t", spark.createDataFrame(part, table.schema), "S")
    assert state.catch_up("t", table, "S") and not state.catch_up("t", table, "S")
    assert sorted(map(tuple, state.index().collect())) == full
    state.add("u", table.limit(0), "S")
    state.add("u", table, "S")                                           # another source has rows of its own
    assert sorted(map(tuple, state.index().collect())) == sorted(full * 2)


def test_batches_write_only_their_applications(spark, tmpdir_path):
    state = AppIndex(spark, os.path.join(tmpdir_path, "state"))
    state.add("t", spark.createDataFrame([("a", "f", "1"), ("b", "f", "1")], "Application string, Investigator_Folder string, S string"), "S")
    of = lambda app: sorted(os.listdir(os.path.join(tmpdir_path, "state", "bitmaps", f"Application={app}")))
    before = of("b")
    state.add("t", spark.createDataFrame([("a", "f", "2")], "Application string, Investigator_Folder string, S string"), "S")
    assert of("b") == before and len(of("a")) > len(before) // 2
    assert sorted(map(tuple, state.index().collect())) == [("a", "f", 2), ("b", "f", 1)]


def test_numbers_follow_the_order_without_one_task(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "x", "y", "hot", "hot", "hot"]), rnd.randrange(50)) for _ in range(500)]
    out = numbered(spark.createDataFrame(rows, "k string, v int"), ["k", "v"], first=10, col="no")
    got = sorted(out.collect(), key=lambda r: r["no"])
    assert [r["no"] for r in got] == list(range(10, 510))
    assert [(r["k"], r["v"]) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert numbered(spark.createDataFrame([], "k string"), ["k"]).count() == 0
