"""Helpers shared by the training-data operators: stored intermediate tables and connected components."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"\x20\x09-\x0D"          # the white space of every word rule below
WORD = rf"[^{WHITE}]+"


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session (tests) may leave it unset; it then gets a private folder. On a cluster an
    unset key is an error, because each machine would write to a disk of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="metricyard-llm-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/llm"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back: lineage ends there, the
    rows are computed once, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text) -> F.Column:
    """Number of maximal runs of non-white characters; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{WHITE}]++")), F.lit(0)).cast("long")


FOREST_EDGES = 500_000        # edges that a task holds to contract them


def _forest(edges: DataFrame) -> DataFrame:
    """Edges of the same components with fewer of them: each task joins up the edges it reads, by pieces of
    bounded size, and sends on one edge from every node to the least node of its part."""
    def contract(batches):
        def emit():
            ends = {n: find(n) for n in list(root)}
            pairs = [(r, n) for n, r in ends.items() if r != n]
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in pairs], pa.int64()),
                                               pa.array([n for _, n in pairs], pa.int64())], ["a", "b"])

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        root, held = {}, 0
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root.setdefault(a, a)
                root.setdefault(b, b)
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
            held += batch.num_rows
            if held > FOREST_EDGES:
                yield emit()
                root.clear()
                held = 0
        yield emit()

    return edges.select("a", "b").mapInArrow(contract, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Connected components of the undirected graph with edges ``links(a long, b long)``.

    Returns ``(node, root)`` for every node on an edge to another; ``root`` is one node of its component.
    In each round the tasks contract pieces of at most ``FOREST_EDGES`` edges to stars, then every node
    moves to the neighbour (or itself) that comes first, and the edges are rewritten to the new nodes.
    First is the least node in even rounds, and the least by a random rank of the round in odd ones, so
    that long chains shrink by a constant share. Once all edges that are left fit one piece, its stars are
    the components. Work is joins and min-aggregations over edges; nothing is collected.
    """
    edges, nodes, step = links.select("a", "b"), None, 0
    while True:
        edges = stored(edges.where("a <> b").distinct(), "edges")
        pieces = -(-edges.count() // FOREST_EDGES)
        stars = stored(_forest(edges.coalesce(max(1, pieces))), "stars")
        if pieces <= 1:
            to = stars.select(F.col("b").alias("u"), F.col("a").alias("to"))
            if nodes is None:
                return to.select(F.col("u").alias("node"), F.col("to").alias("root")).unionAll(
                    to.select(F.col("to").alias("node"), F.col("to").alias("root")).distinct())
            return _moved(nodes, to)
        place = (lambda c: F.struct(F.xxhash64(c, F.lit(step)), c.alias("v"))) if step % 2 else (
            lambda c: F.struct(F.lit(0).alias("z"), c.alias("v")))
        ends = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            stars.select(F.col("b").alias("u"), F.col("a").alias("v")))
        best = ends.groupBy("u").agg(F.min(place(F.col("v"))).alias("r"))
        to = stored(best.select("u", F.least("r", place(F.col("u")))["v"].alias("to")), "moves")
        edges = (stars.join(to.select(F.col("u").alias("a"), F.col("to").alias("ta")), "a")
                 .join(to.select(F.col("u").alias("b"), F.col("to").alias("tb")), "b")
                 .select(F.col("ta").alias("a"), F.col("tb").alias("b")))
        nodes = stored(to.select(F.col("u").alias("node"), F.col("to").alias("root")) if nodes is None else _moved(nodes, to), "nodes")
        step += 1


def _moved(nodes: DataFrame, to: DataFrame) -> DataFrame:
    return nodes.join(to.select(F.col("u").alias("root"), "to"), "root", "left").select(
        "node", F.coalesce("to", "root").alias("root"))
