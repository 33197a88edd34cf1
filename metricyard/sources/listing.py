"""Folder trees as a Python data source.

``spark.read.format("folder_tree")`` lists everything below some roots on the executors. Names are taken
literally: brackets, blanks and leading dots or underscores are names like any other, and symbolic links to
folders are not followed (as ``find`` does). Nothing of the listing passes through the driver. It only counts
folder names, level by level, until a level has enough of them to deal out, and passes that depth on. Who lists a
folder is a function of its path (the hash of its part down to that depth), so tasks need no shared list, and a
retried task lists the same folders.

A share that holds more than ``BUDGET`` entries (one huge project) hands the folders it has not opened yet back as
open rows; ``list_tree`` deals these out anew, folder by folder, until none is left. So no folder subtree is bound
to one task. Folders that cannot be read, or vanish meanwhile, are left out; bytes of a name that are not UTF-8 are
replaced. The paths must be reachable as files
from the executors (a shared file system), as for the readers of bodies.
"""

from __future__ import annotations

import fnmatch
import json
import os
import time
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

BUDGET = 200_000          # entries that a share lists before it hands folders back
PER_SHARE = 8             # folders to deal out for each share, if the tree has as many
DEEPEST = 4               # levels that may be looked through for that
TREE = "root string, path string, is_dir boolean, closed boolean, length long, modificationTime timestamp"
_ARROW = pa.schema([("root", pa.string()), ("path", pa.string()), ("is_dir", pa.bool_()), ("closed", pa.bool_()),
                    ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC"))])


def local(path: str) -> str:
    """A path that ``open`` takes; other schemes than file: are an error."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        return "/" + rest.lstrip("/")
    if colon and rest.startswith("//"):
        raise ValueError(f"not a path of a shared file system: {path}")
    return path


def entries(folder: str) -> Iterator[os.DirEntry]:
    try:
        with os.scandir(folder) as found:
            yield from found
    except OSError:
        return


def subfolders(folder: str) -> Iterator[str]:
    return (e.path for e in entries(folder) if e.is_dir(follow_symlinks=False))


def dealing_depth(roots: Sequence[str], wanted: int) -> int:
    """The first level below the roots with ``wanted`` folders, else the deepest one looked at. Only folders of
    the levels above are opened, fewer than ``wanted`` each."""
    level, depth = list(roots), 0
    while depth < DEEPEST:
        below = []
        for folder in level:
            for sub in subfolders(folder):
                below.append(sub)
                if len(below) >= wanted:
                    return depth + 1
        if not below:
            return max(depth, 1)
        level, depth = below, depth + 1
    return depth


def share_of(root: str, path: str, depth: int, shares: int) -> int:
    """The share that opens a folder, from its path down to ``depth`` levels below the root."""
    parts = path[len(root):].strip("/").split("/")[:depth]
    return zlib.crc32("/".join([root, *parts]).encode("utf-8", "surrogateescape")) % shares


class Rows:
    """Collects rows into Arrow batches."""

    def __init__(self, size: int = 10_000):
        self.size, self.rows = size, []

    def add(self, root, path, is_dir, closed=True, stat=None) -> Iterator[pa.RecordBatch]:
        clean = path.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        self.rows.append((root, clean, is_dir, closed, stat.st_size if stat else None, int(stat.st_mtime * 1e6) if stat else None))
        if len(self.rows) >= self.size:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def walk(stack: list[tuple[str, str]], budget: int, mine=lambda root, path: (True, False)) -> Iterator[pa.RecordBatch]:
    """Rows of all entries below the (root, folder) pairs. ``mine`` tells of a folder whether it is listed here with
    the files in it, and whether it is shared: opened by everyone who walks this tree, for the folders below.
    Beyond the budget, folders not opened yet come out as open rows, but for shared ones."""
    rows, seen = Rows(), 0
    while stack:
        root, folder = stack.pop()
        own, shared = mine(root, folder)
        if seen > budget and not shared:
            yield from rows.add(root, folder, True, closed=False)
            continue
        for e in entries(folder):
            try:
                is_dir = e.is_dir(follow_symlinks=False)
                if not is_dir and own and e.is_file():        # follows links to files, as tests of files do
                    seen += 1
                    yield from rows.add(root, e.path, False, stat=e.stat())
            except OSError:
                continue
            if is_dir:
                below_own, below_shared = mine(root, e.path)
                if below_own:
                    seen += 1
                    yield from rows.add(root, e.path, True)
                if below_own or below_shared:
                    stack.append((root, e.path))
    yield rows.batch()


class Share(InputPartition):
    def __init__(self, number: int, shares: int, depth: int):
        self.number, self.shares, self.depth = number, shares, depth


class FolderReader(DataSourceReader):
    def __init__(self, options):
        self.roots = json.loads(options["roots"])
        self.shares = int(options.get("shares", "1"))
        self.budget = int(options.get("budget", str(BUDGET)))

    def partitions(self):
        for root in self.roots:
            with os.scandir(root):                     # a missing root is an error
                pass
        depth = dealing_depth(self.roots, PER_SHARE * self.shares)
        return [Share(i, self.shares, depth) for i in range(self.shares)]

    def read(self, share):
        def mine(root, path):
            level = path[len(root):].strip("/").count("/") + 1 if path != root else 0
            return share_of(root, path, share.depth, share.shares) == share.number, level < share.depth

        yield from walk([(r, r) for r in self.roots], self.budget, mine)


class Interval(Share):
    """A share of a tree, and the modification times (microseconds, the first excluded) that it reports."""

    def __init__(self, share: Share, after: int, until: int):
        super().__init__(share.number, share.shares, share.depth)
        self.after, self.until = after, until


class ChangedFiles(DataSourceStreamReader, FolderReader):
    """Files whose modification time lies in the interval of a micro-batch, so an edited file comes again. The offset
    is a time, ``settle`` seconds behind the clock; the driver lists nothing, and the tasks walk the tree once for each
    micro-batch. A repeated batch has the same interval: a file edited meanwhile moves to a later one, none is lost.
    Files moved in with an older time are left to the batch collector."""

    def __init__(self, options):
        FolderReader.__init__(self, {**options, "budget": str(1 << 62)})
        self.pattern = options.get("pattern", "*")
        self.settle = float(options.get("settle", "2"))

    def initialOffset(self):
        return {"until": 0}

    def latestOffset(self):
        return {"until": int((time.time() - self.settle) * 1e6)}

    def partitions(self, start, end):
        return [Interval(s, start["until"], end["until"]) for s in FolderReader.partitions(self)]

    def read(self, interval):
        from pyarrow import compute as pc
        for batch in FolderReader.read(self, interval):
            names = [not d and fnmatch.fnmatchcase(os.path.basename(p), self.pattern)
                     for p, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            at = pc.cast(batch.column(5), pa.int64())
            inside = pc.and_(pc.greater(at, interval.after), pc.less_equal(at, interval.until))
            yield batch.filter(pc.and_(pa.array(names, pa.bool_()), inside))

    def commit(self, end):
        pass


class FolderTree(DataSource):
    """Options: ``roots`` (JSON list), ``shares`` (tasks), ``budget`` (entries of a share before it hands back); for a
    stream of changed files also ``pattern`` (of file names) and ``settle`` (seconds)."""

    @classmethod
    def name(cls):
        return "folder_tree"

    def schema(self):
        return TREE

    def reader(self, schema):
        return FolderReader(self.options)

    def streamReader(self, schema):
        return ChangedFiles(self.options)


def list_tree(spark: SparkSession, roots: Sequence[str], shares: int | None = None, budget: int = BUDGET) -> DataFrame:
    """``(root, path, is_dir, length, modificationTime)`` of everything below the roots, the roots themselves left out."""
    from ..session import cut_lineage

    shares = shares or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.dataSource.register(FolderTree)
    where = sorted({local(r).rstrip("/") or "/" for r in roots})
    rows = cut_lineage(spark.read.format("folder_tree").option("roots", json.dumps(where)).option("shares", str(shares))
                       .option("budget", str(budget)).load())
    done, left = rows.filter("closed"), rows.filter("NOT closed")
    while not left.isEmpty():
        more = cut_lineage(_walked(left, shares, budget))
        done, left = done.unionByName(more.filter("closed")), more.filter("NOT closed")
    return done.drop("closed")


def list_below(folders: DataFrame, folder_col: str = "project_dir") -> DataFrame:
    """The tree below the given folders, listed by tasks that are dealt folder by folder."""
    shares = int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = folders.select(F.col(folder_col).alias("root"), F.col(folder_col).alias("path")).distinct()
    return _walked(each, shares, 1 << 62).drop("closed")


def _walked(folders: DataFrame, shares: int, budget: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            yield from walk(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), budget)

    return folders.select("root", "path").repartition(shares, "path").mapInArrow(work, TREE)


def changed_files(spark: SparkSession, roots: Sequence[str], pattern: str, settle: float = 2.0) -> DataFrame:
    """A stream of ``(root, path, is_dir, closed, length, modificationTime)`` of new and edited files."""
    spark.dataSource.register(FolderTree)
    shares = spark.conf.get("spark.sql.shuffle.partitions")
    where = sorted({local(r).rstrip("/") or "/" for r in roots})
    return (spark.readStream.format("folder_tree").option("roots", json.dumps(where)).option("shares", str(shares))
                 .option("pattern", pattern).option("settle", str(settle)).load())
