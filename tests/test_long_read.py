"""PacBio and ONT collectors on hand-written project folders."""
import json
import os

from conftest import write

from metricyard.functions import fixed
from metricyard.plans import collectors
from metricyard.sources import files

PACBIO_REPORT = """PacBio QC report
Run,xyz
Sample Name,Sample Well,Plate Number,Movie Time (hours),Polymerase Reads,HiFi Yield (Gb),Mean QV,Status
bc1001,A01,2,24,"1,200,300",45.5,n.a.,Complete
bc1002,B01,2,24,"1,000",NaN,30,Complete
"""

ONT_REPORT = """ONT run report
"Sample_ID",Flow Cell,"Species",Reads,Yield %,N50
s1,FAX1,human,"2,000",55%,n.a
s2,FAX2,mouse,1500,40%,12000
"""


def pacbio_project(root, run="r84148_20240101", fallback=False, attrs=True):
    proj = os.path.join(root, run, "PacBio")
    raw = os.path.join(root, "raw", run)
    st = {"application": "PacBio", "projectId": "projF", "projectFinal": "projF",
          "deliveryFolder": "/d/labP/sub/projF/", "releaseDate": "2024-05-01", "organism": ["Zea mays"],
          "run": {"path": raw}}
    write(os.path.join(proj, ".settings.json"), json.dumps(st))
    name = "Run_Report_projF.csv" if fallback else "projF_2024_QC_Report.csv"
    write(os.path.join(proj, "package", name), PACBIO_REPORT)
    if attrs:
        write(os.path.join(raw, "outputs", "raw_data.report.json"), json.dumps({"attributes": [
            {"id": "raw_data_report.nreads", "value": 0}, {"id": "raw_data_report.nbases", "value": 123},
            {"value": 5}]}))
        write(os.path.join(raw, "outputs", "ccs.report.json"), json.dumps({"attributes": [
            {"id": "ccs2.percent_ccs_bases_q30", "value": 0.9512}, {"id": "ccs2.mean_npasses", "value": 7}]}))
    return os.path.dirname(proj) + "/PacBio"


def run(spark, root, app):
    listing = files.list_files(spark, [root])
    projects = files.list_projects(listing, app)
    return collectors.long_read_rows(spark, listing, projects, app)


def test_pacbio(spark, tmpdir_path):
    pacbio_project(tmpdir_path)
    rows, failed = run(spark, tmpdir_path, "PacBio")
    got = rows.collect()
    assert failed.count() == 0
    r = got[0]
    assert r["Investigator_Folder"] == "labP"        # PacBio: third part from the end
    assert r["InstrumentID"] == "CT_Revio_84148"      # C9 from the parent folder name (C10)
    assert r["Species"] == "Zea mays" and r["ProjStatus"] == "Delivered"
    b1 = {x["name"]: x["value"] for x in got if x["ids"]["Sample_Name"] == "bc1001"}
    assert b1["Polymerase_Reads"] == "1200300"        # C4
    assert b1["HiFi_Yield_Gb"] == "45.5"              # C3 then C1
    assert "Plate_Number" not in b1 and "Movie_Time_hours" not in b1   # numeric ids stay ids
    assert "Mean_QV" not in b1                         # first-row 'n.a.' -> id column (F4)
    assert "Sample_Well" not in b1 and "Status" not in b1              # F3 dropped
    assert b1["Polymerase_Reads_raw"] == "0"           # S10: numeric 0 kept
    assert b1["Polymerase_Read_Bases_raw"] == "123"
    assert b1["Q30_base_PCT_ccs_raw"] == "95.12"       # N1
    assert b1["HiFi_readlength_ccs_raw_mean"] is None  # absent attribute -> NULL
    ids = [x["ids"] for x in got if x["ids"]["Sample_Name"] == "bc1001"][0]
    assert ids["Plate_Number"] == "2" and ids["Mean_QV"] == "n.a."
    b2 = {x["name"]: x["value"] for x in got if x["ids"]["Sample_Name"] == "bc1002"}
    assert b2["HiFi_Yield_Gb"] is None                 # F8: NaN kept as NULL


def test_pacbio_fallback(spark, tmpdir_path):
    pacbio_project(tmpdir_path, fallback=True)
    rows, _ = run(spark, tmpdir_path, "PacBio")
    names = {x["name"] for x in rows.collect()}
    assert "Polymerase_Reads_raw" not in names and "Polymerase_Reads" in names


def test_ont(spark, tmpdir_path):
    proj = os.path.join(tmpdir_path, "GXB02036_host", "projO", "ONT")
    write(os.path.join(proj, ".settings.json"), json.dumps({
        "application": "ONT", "projectId": "projO", "projectFinal": "projO",
        "deliveryFolder": "labO/projO", "releaseDate": "2024-02-02", "organism": ["Mus musculus"]}))
    write(os.path.join(proj, "projO_QCreport.csv"), ONT_REPORT)
    write(os.path.join(proj, fixed.ONT_INSTRUMENT_FILE), '{\n  "hostname": "PC24B149-host",\n  "x": 1\n}\n')
    rows, failed = run(spark, tmpdir_path, "ONT")
    got = rows.collect()
    assert failed.count() == 0
    assert {x["InstrumentID"] for x in got} == {"CT_PromethION_PC24B149"}   # hostname wins over folder
    assert {x["Investigator_Folder"] for x in got} == {"labO"}
    s1 = {x["name"]: x["value"] for x in got if x["ids"]["Sample_ID"] == "s1"}
    assert s1 == {"Reads": "2000", "Yield_PCT": "55%", "N50": None}          # 'Species' dropped (L-13)
    assert all("Species" not in x["ids"] for x in got)
