"""Species-id collector: ordered validation reasons, flowcell sources, distinct append."""
import json
import os

from conftest import write

from metricyard.plans import runs
from metricyard.sources.tables import read_version

SPECIES = "preamble line\nGT_QC_Sample_ID,Sample_Name,Species1,Domain1\ns1,n1,Homo sapiens,Eukaryota\ns2,n2,Mus,Eukaryota\n"


def project(root, name, settings=True, report=True, runinfo=True, summary=None, st=None):
    d = os.path.join(root, name)
    if settings:
        write(os.path.join(d, ".settings.json"), json.dumps(st or {
            "projectFinal": name + "_f", "deliveryFolder": "/q/labS/" + name + "/", "releaseDate": "2024-05-05"}))
    if report:
        write(os.path.join(d, f"{name}_f_QCreport.speciesid.csv"), SPECIES)
    if runinfo:
        write(os.path.join(d, "RunInfo.xml"), '<Run Id="R1"><Flowcell>FC1</Flowcell></Run>')
    if summary:
        write(os.path.join(d, "Run_Metric_Summary.draft.csv"), summary)
    return d


def test_speciesid_run(spark, tmpdir_path):
    roots = os.path.join(tmpdir_path, "roots")
    wh = os.path.join(tmpdir_path, "wh")
    project(roots, "ok1")
    project(roots, "ok2", runinfo=False, summary="MachineID,FlowCellID\nM1,FC2\n")
    project(roots, "nosettings", settings=False)
    project(roots, "nometa", st={"projectFinal": "nometa_f", "deliveryFolder": "labS"})   # one part, no date
    project(roots, "noflow", runinfo=False, summary="MachineID,FlowCellID\nM1,!!!TBD!!!\n")
    out = runs.run_speciesid(spark, [roots], wh, run_date="2024-06-01")
    assert out["failed"] == {"settings missing": 1, "metadata incomplete": 1, "flowcell missing": 1}
    assert out["after"] == 4 and out["grew"]
    t = read_version(spark, os.path.join(wh, "speciesid_metrics", "current"), "x string")
    assert {r["FlowcellID"] for r in t.collect()} == {"FC1", "FC2"}
    assert {r["Investigator_Folder"] for r in t.collect()} == {"labS"}
    assert {r["Project_run_type"] for r in t.collect()} == {"ok1_f", "ok2_f"}
    again = runs.run_speciesid(spark, [roots], wh, run_date="2024-06-02")
    assert again["failed"] == {"settings missing": 1, "metadata incomplete": 1, "flowcell missing": 1}
    project(roots, "later")                                    # a new project joins the stored ones
    third = runs.run_speciesid(spark, [roots], wh, run_date="2024-06-03")
    assert (third["before"], third["after"]) == (4, 6)
    t = read_version(spark, os.path.join(wh, "speciesid_metrics", "current"), "x string")
    assert {r["Project_run_type"] for r in t.collect()} == {"ok1_f", "ok2_f", "later_f"}
