"""Short-read collector on hand-written project folders (FIXTURES.md §3 worked example)."""
import json
import os

from conftest import write
from pyspark.sql import functions as F

from metricyard.functions import fixed
from metricyard.operators import merge
from metricyard.plans import collectors
from metricyard.session import cut_lineage
from metricyard.sources import files

SUMMARY = """Run Summary,,,
MachineID,FlowCellID,Date
A01234,HXYZ123,2024-03-01
,,,
Lane,Surface,Cluster PF,Reads,Reads PF,%>=Q30,Yield,Error,Aligned
1,-,95.1,400.2,380.5,92.1,120.3,0.21,1.02
1,1,95.0,200.1,190.2,92.0,60.1,0.20,1.01
2,-,94.2,410.0,390.1,91.5,121.0,0.25,0.98
Read 2 (I),,,
3,-,1,1,1,1,1,1,1
"""

REPORT = 'GT_QC_Sample_ID,Sample_Name,Species,Reads_Total,%>=Q30\ns1,n1,human,"1,234",91.5\ns2,n2,marmoset,NaN,90.0\n,n3,human,5,1\n'

SPECIES = 'report preamble\nGT_QC_Sample_ID,Sample_Name,Domain1,Species1\ns1,n1,Eukaryota,Homo sapiens\ns2,zz,Eukaryota,Callithrix\n'


def make_project(root, lab, project, app="rnaseq", settings=None, report=REPORT, summary=SUMMARY, species=SPECIES):
    d = os.path.join(root, lab, project, app)
    if settings is not None:
        write(os.path.join(d, ".settings.json"), json.dumps(settings))
    if report is not None:
        write(os.path.join(d, f"{project}_QCreport.{app}.csv"), report)
    if species is not None:
        write(os.path.join(d, f"{project}_QCreport.speciesid.csv"), species)
    if summary is not None:
        write(os.path.join(d, "package", "Run_Metric_Summary.csv"), summary)
    write(os.path.join(d, "RunInfo.xml"), '<RunInfo><Run Id="240301_A01234_0001_HXYZ123" Number="1">\n'
                                          '<Flowcell>HXYZ123</Flowcell></Run></RunInfo>\n')
    return d


def settings(**kw):
    base = {"application": "mRNA", "projectId": "p1", "projectFinal": "p1_final",
            "deliveryFolder": "/x/labA/p1/", "releaseDate": "2024-03-05", "organism": ["human"]}
    base.update(kw)
    return base


def collect(spark, root):
    listing = files.list_files(spark, [root])
    projects = files.list_projects(listing, "rnaseq")
    return collectors.short_read_rows(spark, listing, projects, "rnaseq")[:2]


def test_worked_example(spark, tmpdir_path):
    make_project(tmpdir_path, "labA", "p1", settings=settings())
    rows, failed = collect(spark, tmpdir_path)
    got = rows.collect()
    assert rows.columns == list(fixed.SHORT_READ_COLUMNS)
    assert failed.count() == 0
    # two lanes (rows with 2nd cell '-' between the markers); the lane after 'Read 2 (I)' is out
    assert {r["Lane"] for r in got} == {"1", "2"}
    s1 = [r for r in got if r["GT_QC_Sample_ID"] == "s1" and r["Lane"] == "1"]
    by_name = {r["name"]: r["value"] for r in s1}
    assert by_name["Reads_Total"] == "1234"           # C4: quoted thousands separator removed
    assert by_name["PCT_GE_Q30"] == "91.5"            # C1 rule order: >= then %
    assert by_name["Cluster_PF_PCT"] == "95.1"        # lane metric bound by name
    assert by_name["Error_rate_PhiX_alignment"] == "0.21"
    assert by_name["Domain1"] == "Eukaryota"          # J3 by Sample_Name
    assert "Domain2" not in by_name                   # missing species column -> dropped as missing
    r0 = s1[0]
    assert (r0["Investigator_Folder"], r0["Project_ID"], r0["Project_run_type"]) == ("labA", "p1", "p1_final")
    assert r0["Release_Date"] == "2024-03-05" and r0["ProjStatus"] == "Delivered"
    assert r0["Species"] == "Homo sapiens" and r0["InstrumentID"] == "A01234"
    assert r0["FlowcellID"] == "HXYZ123" and r0["RunID"] == "240301_A01234_0001_HXYZ123"
    s2 = {r["name"]: r["value"] for r in got if r["GT_QC_Sample_ID"] == "s2" and r["Lane"] == "2"}
    assert "Reads_Total" not in s2                     # F7: NaN value row removed
    assert s2["PCT_GE_Q30"] == "90.0"
    assert s2["Domain1"] == "Eukaryota"                # J3 fallback by GT_QC_Sample_ID
    assert {r["Species"] for r in got if r["GT_QC_Sample_ID"] == "s2"} == {"Callithrix jacchus"}
    # F6 (ledger L-1): the row without a sample id is gone
    assert not [r for r in got if r["Sample_Name"] == "n3"]


def test_append_twice_and_status_survives(spark, tmpdir_path):
    make_project(tmpdir_path, "labA", "p1", settings=settings())
    rows, _ = collect(spark, tmpdir_path)
    rows = cut_lineage(rows)                           # the batch as written by one run
    key = list(fixed.SHORT_READ_KEY)
    empty = spark.createDataFrame([], rows.schema)
    once = cut_lineage(merge.append_if_absent(empty, rows, key))
    n1 = once.count()
    twice = cut_lineage(merge.append_if_absent(once, rows, key))
    assert twice.count() == n1                         # appending twice adds nothing
    updated = cut_lineage(merge.update_status(twice, "Project_run_type", "p1_final"))
    assert updated.filter(F.col("ProjStatus") == "Undelivered").count() == n1
    again = merge.append_if_absent(updated, rows, key)
    assert again.count() == n1                         # status is not in the key (M1 vs L-24)
    assert again.filter(F.col("ProjStatus") == "Delivered").count() == 0


def test_no_summary_gives_null_lane(spark, tmpdir_path):
    make_project(tmpdir_path, "labA", "p1", settings=settings(), summary=None)
    rows, _ = collect(spark, tmpdir_path)
    got = rows.collect()
    assert got and all(r["Lane"] is None for r in got)
    assert all(r["InstrumentID"] is None and r["FlowcellID"] is None and r["RunID"] is None for r in got)


def test_undelivered_and_failures(spark, tmpdir_path):
    make_project(tmpdir_path, "labA", "p1", settings=settings(releaseDate=""))       # L-9: empty date
    make_project(tmpdir_path, "labA", "p2", settings=settings(projectId="p2"), report="GT_QC_Sample_ID,Sample_Name,X\na,b,1\n")
    make_project(tmpdir_path, "labA", "p3", settings=settings(projectId="p3"), report=None)
    rows, failed = collect(spark, tmpdir_path)
    assert rows.count() == 0                          # p1 not delivered, p2 has no anchor
    reasons = {r["project_dir"].split("/")[-2]: r["reason"] for r in failed.collect()}
    assert reasons["p1"] == "not delivered"           # F11: retried, not recorded
    assert reasons["p2"] == "anchor column missing"
    assert reasons["p3"] == "report missing"
