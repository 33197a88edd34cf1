"""The folder listing against os.walk, on names and shapes that a listing may lose."""
import os

import pytest
from conftest import write

from metricyard.plans import runs
from metricyard.sources import files, listing


def tree_of(root):
    out = set()
    for at, dirs, names in os.walk(root):
        out |= {(os.path.join(at, d), True) for d in dirs} | {(os.path.join(at, n), False) for n in names}
    return out


def odd_tree(base):
    root = os.path.join(base, "rnaseq")
    for p in ("p1/rnaseq/a.csv", "p2/rnaseq/package/b.csv", "a[1]/rnaseq/c.csv", "_c/rnaseq/d.csv", "d/_x/rnaseq/e.csv",
              ".hid/rnaseq/f.csv", "b c/{x}/rnaseq/rnaseq/g*.csv", "top.csv", "deep/1/2/3/4/5/6/rnaseq/h", "q=1/rnaseq/%20.csv", "é/rnaseq/i"):
        write(os.path.join(root, p), "x")
    os.makedirs(os.path.join(root, "empty", "rnaseq"))
    os.symlink(os.path.join(root, "p1"), os.path.join(root, "link"))
    return root


@pytest.mark.parametrize("shares, budget", [(1, 200_000), (8, 200_000), (3, 0), (8, 2)])
def test_tree_has_every_entry_once(spark, tmpdir_path, shares, budget):
    root = odd_tree(tmpdir_path)
    rows = [(r["path"], r["is_dir"]) for r in listing.list_tree(spark, [root, f"file:{root}/p1"], shares, budget).collect()]
    want = tree_of(root) - {(os.path.join(root, "link"), True)}
    assert sorted(rows) == sorted([*want, *tree_of(os.path.join(root, "p1"))])


def test_projects_of_every_level_and_name(spark, tmpdir_path):
    root = odd_tree(tmpdir_path)
    want = sorted(p for p, is_dir in tree_of(root) if is_dir and p.endswith("/rnaseq"))
    tree = listing.list_tree(spark, [root])
    assert sorted(r["project_dir"] for r in files.list_projects(tree, "rnaseq").collect()) == want
    with_files = sorted(r["project_dir"] for r in files.list_projects(files.list_files(spark, [root]), "rnaseq").collect())
    assert with_files == [p for p in want if "/empty/" not in p]
    assert files.list_projects(tree, "rna.eq").count() == 0 and files.list_projects(tree, "[1]").count() == 0
    reports = files.find_reports(files.list_files(spark, [root]), ".csv").collect()
    assert len(reports) == 9 and root in {r["project_dir"] for r in reports}


def test_many_folders_are_many_tasks_and_the_driver_lists_none(spark, tmpdir_path, monkeypatch):
    for i in range(2000):
        os.makedirs(os.path.join(tmpdir_path, "r", f"p{i}", "rnaseq"))
    roots = [os.path.join(tmpdir_path, "r")]
    reader = listing.FolderReader({"roots": f'["{roots[0]}"]', "shares": "16"})
    opened = []
    plain = listing.entries
    monkeypatch.setattr(listing, "entries", lambda folder: opened.append(folder) or plain(folder))
    shares = reader.partitions()
    assert len(shares) == 16 and opened == roots                      # the driver opened the root alone
    sizes = [sum(b.num_rows for b in reader.read(s)) for s in shares]
    assert sum(sizes) == 4000 and min(sizes) > 100
    assert listing.list_tree(spark, roots).rdd.getNumPartitions() > 1


def test_missing_root_and_foreign_scheme(spark, tmpdir_path):
    with pytest.raises(Exception, match="No such file"):
        listing.list_tree(spark, [os.path.join(tmpdir_path, "none")])
    with pytest.raises(ValueError):
        listing.list_tree(spark, ["hdfs://n/x"])
    os.makedirs(os.path.join(tmpdir_path, "r"))
    assert listing.list_tree(spark, [os.path.join(tmpdir_path, "r")]).count() == 0


def test_run_collects_projects_of_a_root_named_like_the_application(spark, tmpdir_path):
    """Two projects under such a root used to be merged into one; a bracket in a name used to end the run."""
    from test_short_read import make_project, settings
    root = os.path.join(tmpdir_path, "rnaseq")
    for p in ("p1", "a[1]", "_c"):
        make_project(root, "lab", p, settings=settings(projectId=p))
    out = runs.run_collector(spark, [root], "rnaseq", os.path.join(tmpdir_path, "wh"), "2024-03-06")
    assert out["found"] == 3 and out["projects_recorded"] == 3 and not out["failed"]
