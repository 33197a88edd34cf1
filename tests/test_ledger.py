"""One test for each entry of the deviation ledger, by its number."""
import json
import os

from conftest import write
from pyspark.sql import functions as F
from test_short_read import SPECIES, collect, make_project, settings

from metricyard.functions import clean, fixed
from metricyard.operators import enrich, incremental, marts, merge, registry, triage
from metricyard.plans import runs
from metricyard.sources import delimited, files, reports, tables


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_L01_rows_without_an_id_are_dropped(spark, tmpdir_path):
    make_project(tmpdir_path, "labA", "p1", settings=settings())
    rows, _ = collect(spark, tmpdir_path)
    assert {r["Sample_Name"] for r in rows.collect()} == {"n1", "n2"}          # the row of n3 has no id


def test_L02_ledger_matches_whole_paths(spark):
    ledger = spark.createDataFrame([("/q/p1",), ("",)], "project_dir string")
    found = spark.createDataFrame([("/q/p1",), ("/q/p10",), ("/q/p1/rnaseq",)], "project_dir string")
    assert {r[0] for r in incremental.new_projects(found, ledger).collect()} == {"/q/p10", "/q/p1/rnaseq"}


def test_L03_null_keys_are_equal(spark):
    t = spark.createDataFrame([("a", None), ("b", 1)], "k string, n int")
    for stored in (False, True):
        assert merge.new_rows_if_absent(t, t, ["k", "n"], batch_stored=stored).count() == 0


def test_L04_one_status_rule(spark):
    for folder, day, want in (("lab", "2024-01-01", "Delivered"), ("NULL", "2024-01-01", "Undelivered"), ("lab", "NULL", "Undelivered"),
                              ("", "2024-01-01", "Undelivered"), (None, None, "Undelivered")):
        assert value(spark, clean.proj_status(F.lit(folder), F.lit(day))) == want


def test_L05_append_is_by_row(spark):
    target = spark.createDataFrame([("p", 1), ("p", 2)], "p string, n int")
    batch = spark.createDataFrame([("p", 1), ("p", 2), ("p", 3)], "p string, n int")
    assert [r["n"] for r in merge.new_rows_if_absent(target, batch, ["p", "n"]).collect()] == [3]


def test_L06_white_space_around_a_cell(spark):
    cells = value(spark, delimited.quoted_cells(F.lit('a, b c ,"d, e"'), F.lit(",")))
    assert cells == ["a", " b c ", "d, e"]


def test_L07_values_stay_as_written(spark, tmpdir_path):
    write(os.path.join(tmpdir_path, "l.csv"), "1.50\n3\n3.0\n")
    assert {r["v"] for r in delimited.read_long_csv(spark, os.path.join(tmpdir_path, "l.csv"), ["v"]).collect()} == {"1.50", "3", "3.0"}


def test_L08_short_paths_have_no_folder(spark):
    assert value(spark, clean.delivery_folder(F.lit("/a/b/"), "PacBio")) is None
    assert value(spark, clean.delivery_folder(F.lit("/a/b/c/"), "PacBio")) == "a"
    assert value(spark, clean.delivery_folder(F.lit("//a/b/"))) == "a"


def test_L09_empty_release_date_is_missing(spark):
    for text in ("", "  ", None, "not a date"):
        assert value(spark, clean.release_date(F.lit(text).cast("string"))) is None


def test_L10_thresholds_are_parameters(spark):
    assert (fixed.ARCHIVE_RESCAN_DAYS, fixed.LEDGER_RESET_DAYS) == (5, 10)
    t = spark.createDataFrame([("a", "2024-01-01")], "application string, d string").select("application", F.to_date("d").alias("last_reset"))
    assert not incremental.reset_due(t, F.to_date(F.lit("2024-01-08"))).first()["reset"]
    assert incremental.reset_due(t, F.to_date(F.lit("2024-01-08")), reset_days=7).first()["reset"]


def test_L11_undetermined_counts_are_real(spark):
    paths = [(f"/q/Undetermined_S0_R1_{i}.fastq.gz",) for i in range(3)] + [("/q/S1_R1_1.fastq.gz",)]
    got = {r["tag"]: r["undetermined_total"] for r in triage.manifest_counts(spark.createDataFrame(paths, "path string")).collect()}
    assert got == {"R1_": 3, "all": 3}


def test_L12_lane_columns_are_bound_by_name(spark):
    text = "x,Cluster PF\nLane,Surface,Yield\n"
    first = "Yield,Surface,Lane,Cluster PF,Reads,Reads PF,%>=Q30,Error,Aligned\n7.5,-,2,95,4,3,92,0.2,1\nRead 2 (I)\n"
    lanes = reports.lane_block(spark.createDataFrame([("f", first), ("g", text)], "path string, text string")).collect()
    assert [r["Lane"] for r in lanes if r["path"] == "f"] == ["2"]


def test_L13_columns_are_dropped_whatever_their_case(spark):
    from metricyard.operators import shape
    names = F.array(*[F.lit(x) for x in ("species", "SPECIES", "Reads")])
    assert value(spark, shape.drop_names(names, ("Species",), case_insensitive=True)) == ["Reads"]


def test_L14_removing_a_user_does_not_dedupe(spark):
    reg = spark.createDataFrame([("g", "a", 1), ("g", "a", 2), ("g", "b", 3)], registry.REGISTRY_SCHEMA)
    left = registry.remove_users(reg, spark.createDataFrame([("g", "b")], "grp string, user string")).collect()
    assert sorted(r["pos"] for r in left) == [1, 2]


def test_L15_missing_groups_leave_the_index(spark):
    t = spark.createDataFrame([("rnaseq", "labA", "s"), ("rnaseq", None, "s")], "Application string, Investigator_Folder string, Sample_Name string")
    assert [r["Investigator_Folder"] for r in marts.app_index([(t, "Sample_Name")]).collect()] == ["labA"]


def test_L16_absent_tables_are_empty(spark, tmpdir_path):
    out = runs.build_marts(spark, os.path.join(tmpdir_path, "none"), run_date="2024-01-01")
    assert out["view_rows"] == 0 and out["delta"]["after_rows"] == 0
    assert tables.row_count_or_zero(spark, os.path.join(tmpdir_path, "none", "x")) == 0


def test_L17_L19_outputs_have_folders_of_their_own(spark, tmpdir_path):
    make_project(os.path.join(tmpdir_path, "r"), "labA", "p1", settings=settings())
    wh = os.path.join(tmpdir_path, "wh")
    runs.run_collector(spark, [os.path.join(tmpdir_path, "r")], "rnaseq", wh, run_date="2024-01-01")
    runs.run_speciesid(spark, [os.path.join(tmpdir_path, "r")], wh, run_date="2024-01-01")
    assert {"qc_illumina_metrics", "processed_ledger", "retry_projects", "speciesid_failed"} <= set(os.listdir(wh))
    assert spark.read.parquet(os.path.join(wh, "qc_illumina_metrics")).columns != []


def test_L18_scan_state_is_per_application(spark, tmpdir_path):
    plan = {"scope": "all", "reset": False}
    runs.note_scan(spark, "rnaseq", tmpdir_path, "2024-01-01", plan)
    runs.note_scan(spark, "wgs", tmpdir_path, "2024-01-09", plan)
    assert runs.scan_plan(spark, "rnaseq", tmpdir_path, "2024-01-10")["allow_undelivered"]
    assert not runs.scan_plan(spark, "wgs", tmpdir_path, "2024-01-10")["allow_undelivered"]


def test_L20_names_are_cleaned_before_the_insert(spark):
    target = spark.createDataFrame([("x", "1")], "name string, value string")
    batch = spark.createDataFrame([("A1", "x", "2")], "`Well no.` string, name string, value string")
    out = merge.evolve_append(target, batch, fixed_cols=("name", "value"))
    assert {r["Well_no"] for r in out.collect()} == {None, "A1"}


def test_L21_edited_files_are_read_by_the_batch_run(spark, tmpdir_path):
    src, root = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "reg")
    write(os.path.join(src, "a.metrics.txt"), "Investigator_Folder\nlabA\n")
    runs.run_groups(spark, src, root)
    write(os.path.join(src, "a.metrics.txt"), "Investigator_Folder\nlabA\nlabB\n")
    assert {r["grp"] for r in runs.run_groups(spark, src, root).collect()} == {"labA", "labB"}


def test_L22_inline_names_are_trimmed(spark):
    assert {r["name"] for r in delimited.read_value_list(spark, " a@x , ,b@x ").collect()} == {"a@x", "b@x"}


def test_L23_an_empty_species_file_is_no_match(spark, tmpdir_path):
    make_project(tmpdir_path, "labA", "p1", settings=settings(), species=SPECIES.split("\n")[0] + "\n")
    rows, failed = collect(spark, tmpdir_path)
    assert failed.count() == 0 and {r["value"] for r in rows.where("name = 'Species1'").collect()} <= {"NaN"}


def test_L24_status_is_part_of_one_key_only(spark):
    old = spark.createDataFrame([("s", "Undelivered", "1")], "Sample_Name string, ProjStatus string, value string")
    new = spark.createDataFrame([("s", "Delivered", "1")], "Sample_Name string, ProjStatus string, value string")
    assert merge.new_rows_if_absent(old, new, ["Sample_Name", "value"]).count() == 0
    assert merge.new_rows_except(old, new).count() == 1


def test_L25_L26_table_is_a_parameter_and_quotes_are_data(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "any_table")
    spark.createDataFrame([("r'1", "o'x", "Delivered")], "Project_run_type string, Sample_Name string, ProjStatus string").write.parquet(path)
    assert runs.run_status_update(spark, path, "r'1", os.path.join(tmpdir_path, "e"), samples_inline="o'x") == 1


def test_L27_full_duplicates_are_compared_as_text(spark):
    a = spark.createDataFrame([("1.0",), ("1",)], "v string")
    assert merge.append_distinct_all(a, a).count() == 2


def test_L28_routing_is_exact(spark):
    p = spark.createDataFrame([("ATACSeq,ATAC",), ("ATAC",), ("atac",)], "application string")
    assert [r["application"] for r in enrich.route_application(p).collect()] == ["ATAC"]


def test_dot_files_are_read_by_executors(spark, tmpdir_path):
    """Settings of folders, missing ones as NULL."""
    write(os.path.join(tmpdir_path, "a", ".settings.json"), json.dumps({"application": "x"}))
    dirs = spark.createDataFrame([(os.path.join(tmpdir_path, n),) for n in "ab"], "project_dir string")
    got = {r["project_dir"][-1]: r["json"] for r in files.read_settings(dirs).collect()}
    assert json.loads(got["a"]) == {"application": "x"} and got["b"] is None


def test_two_appends_shuffle_the_batch_once(spark, tmpdir_path):
    import datetime as dt
    from metricyard.plans.catalog import QUERIES
    row = lambda k, n, flag, q, day: (k, n, k, n, q, 10.5, 0.1, None, flag, "O", day)
    old, new = dt.datetime(1995, 5, 1), dt.datetime(1997, 5, 1)
    rows = [row(1, 1, "N", 2.0, old), row(1, 1, "N", 2.0, old), row(1, 2, "N", 3.0, new), row(2, 1, "N", 4.0, new), row(None, 1, "R", 5.0, None), row(3, 1, None, 6.0, old)]
    cols = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    spark.createDataFrame(rows, cols).write.parquet(os.path.join(tmpdir_path, "lineitem.parquet"))
    index = QUERIES["metrics_index"](spark, tmpdir_path)
    names = ("l_quantity", "l_extendedprice", "l_discount")
    assert sorted(map(tuple, index.collect())) == sorted([("N", x, 2) for x in names] + [("R", x, 0) for x in names])
    assert "value" not in "".join(line for line in index._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
                                  if "Exchange hashpartitioning" in line)
    typed = QUERIES["typed_csv"](spark, tmpdir_path)
    assert typed.count() == 3 == typed.distinct().count()          # null fields shift the others: rejected
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
