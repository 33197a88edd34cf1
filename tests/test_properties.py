"""Properties of SURVEY §5 layer 3: split-invariant appends, reversible pivots, registry round trips."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metricyard.operators import merge, registry, shape

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.sampled_from(["x", "y"])),
                   min_size=0, max_size=12)
SCHEMA = "k1 string, k2 int, status string"


@settings(max_examples=5, deadline=None)
@given(stored=rows_st, batch=rows_st, cut=st.integers(0, 12))
def test_append_if_absent_does_not_depend_on_batch_split(spark, stored, batch, cut):
    key = ["k1", "k2"]
    target = merge.dedupe(spark.createDataFrame(stored, SCHEMA), key, None)
    target = spark.createDataFrame(sorted({(r[0], r[1]): r for r in target.collect()}.values(), key=str), SCHEMA)
    whole = merge.append_if_absent(target, spark.createDataFrame(batch, SCHEMA), key)
    first = merge.append_if_absent(target, spark.createDataFrame(batch[:cut], SCHEMA), key)
    split = merge.append_if_absent(first, spark.createDataFrame(batch[cut:], SCHEMA), key)
    keys = lambda df: sorted((r["k1"] or "", r["k2"]) for r in df.collect())
    assert keys(whole) == keys(split)
    assert keys(merge.append_if_absent(whole, spark.createDataFrame(batch, SCHEMA), key)) == keys(whole)
    # stored rows never change (first writer wins)
    got = {(r["k1"], r["k2"]): r["status"] for r in whole.collect()}
    for r in target.collect():
        assert got[(r["k1"], r["k2"])] == r["status"]


def test_pivot_long_then_pivot_back(spark):
    df = spark.createDataFrame([(1, "s1", 1.5, 2.0), (2, "s2", None, 3.25)], "id int, sample string, m1 double, m2 double")
    long = shape.pivot_long_from(df, anchor="m1")
    back = long.groupBy("id", "sample").pivot("name", ["m1", "m2"]).agg(F.first("value"))
    got = {r["id"]: (r["m1"], r["m2"]) for r in back.collect()}
    assert got == {1: ("1.5", "2.0"), 2: (None, "3.25")}


def test_register_then_remove_keeps_groups(spark):
    reg = spark.createDataFrame([], registry.REGISTRY_SCHEMA)
    groups = spark.createDataFrame([("g1",), ("g2",)], "Investigator_Folder string")
    reg = registry.register_groups(reg, registry.distinct_groups(groups))
    reg = registry.add_users(reg, spark.createDataFrame([("g1", "u", 1)], "grp string, user string, pos bigint"))
    reg = registry.remove_users(reg, spark.createDataFrame([("g1", "u"), ("g2", "v")], "grp string, user string"))
    assert sorted(r["grp"] for r in registry.export_registry(reg).collect()) == ["g1", "g2"]


def test_report_files_grow_with_the_table(spark):
    """report_rows: a file holds the customers of one nation and a bounded block of keys, and no row is lost."""
    import os
    import tempfile

    from metricyard.plans import catalog_runs

    folder = tempfile.mkdtemp(prefix="metricyard-test-")
    rows = [(k, f"Customer#{k}", 3 if k % 3 == 0 else k % 25) for k in range(1, 301)]          # nation 3 is hot
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int").write.parquet(
        os.path.join(folder, "customer.parquet"))
    files = catalog_runs._report_texts(spark, folder, keys=50).collect()
    assert len(files) > 25 and max(f["text"].count("\n") - 3 for f in files) <= 50
    assert len({f["path"] for f in files}) == len(files)
    out = sorted(map(tuple, catalog_runs.report_rows_q(spark, folder).collect()))
    assert out == sorted((f"n{n}", f"s{k}", f"{k * 1000}x", None if k % 4 == 0 else "9") for k, _, n in rows)
