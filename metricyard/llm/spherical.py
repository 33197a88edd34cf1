"""Operator 5, embedding near-dedup with spherical-cap filters.

Directions are structured random product codes: the (randomly rotated) space is cut into blocks, each with
its own small random codebook, and a direction joins one codeword per block. A vector is list-decoded to
its best directions, block by block, and every vector gets equally many: ``LISTS``, or more where pairs drawn
at exactly the wanted cosine would share none with a probability above ``MISS``, as measured for the
dimension and the number of directions in use. Vectors that share a filter are joined and verified by their
cosine in double precision. The number of directions grows with the largest label, so filters keep about
``LISTS * 16`` vectors. Filters with one word in the first block are one group, or several where labels are large, and a
vector travels once for each of its groups, in its own type. A group that holds more than ``GROUP_ROWS`` vectors is dealt into
blocks of bounded size and every pair of
blocks is one task, so no member of a filter and no pair in one is left out. Where more than ``MOST_LISTS``
filters a vector would be needed, fewer directions are used. A link at the cosine itself is thus missed with
a probability of about ``MISS`` over the random directions, and closer ones less.

Equal vectors of one label form a class, compared once. A pair is counted in its first shared filter only;
tasks emit sums of link counts and a spanning forest of links, never all pairs.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component, and rows with a
null label, link with nothing (0 links, own component, kept). Vectors of different lengths never link.
Repeated rows are vectors of one class and link with each other. Ids that are null: such rows link as others
do, but never name a component unless all ids in it are null. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import components, stored

COSINE, LISTS, GROUP_ROWS, SEED = 0.93, 16, 32_768, 20
MISS, MOST_LISTS, DRAWN = 0.001, 64, 4000
LARGE_BYTES = 8 << 20            # names of groups to split are broadcast up to this size; beyond it they are joined by shuffling


class Directions:
    """``2**bits`` random product directions of dimension ``dim`` and the list decoder."""

    def __init__(self, dim: int, bits: int, lists: int = LISTS, seed: int = SEED):
        rng = np.random.default_rng([seed, dim, bits])
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        blocks = min(dim, max(2, math.ceil(bits / 12)))
        widths = [len(x) for x in np.array_split(np.arange(dim), blocks)]
        sizes = [2 ** len(x) for x in np.array_split(np.arange(bits), blocks)]
        self.books = []
        for w, b in zip(widths, sizes):
            c = rng.standard_normal((b, w))
            c = np.unique(c / np.linalg.norm(c, axis=1, keepdims=True), axis=0)     # of width 1, only -1 and 1
            self.books.append(c * math.sqrt(w / dim))
        self.cuts = np.cumsum([0, *widths])
        self.bits, self.lists = bits, lists

    def decode(self, unit: np.ndarray) -> np.ndarray:
        """For each unit vector the numbers of its ``lists`` best directions (all, if there are fewer), best first."""
        x = unit @ self.rotation
        score, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for a, b, c in zip(self.cuts, self.cuts[1:], self.books):
            # the best sums hold only the best words of each block
            s, word = _best(x[:, a:b] @ c.T, self.lists)
            total = (score[:, :, None] + s[:, None, :]).reshape(len(x), -1)
            codes = (code[:, :, None] * len(c) + word[:, None, :]).reshape(len(x), -1)
            score, at = _best(total, self.lists)
            code = np.take_along_axis(codes, at, 1)
        return np.take_along_axis(code, np.argsort(-score, axis=1, kind="stable"), 1)

    def needed(self, cosine: float, miss: float = MISS) -> int:
        """How many of ``lists`` filters a vector needs, so that drawn pairs at ``cosine`` share one but for a
        share ``miss``; more than ``lists``, if these do not do."""
        rng, dim = np.random.default_rng([SEED, len(self.rotation)]), len(self.rotation)
        first = []
        for _ in range(0, DRAWN, 250):
            u, w = rng.standard_normal((2, 250, dim))
            u /= np.linalg.norm(u, axis=1, keepdims=True)
            w -= (w * u).sum(axis=1, keepdims=True) * u
            w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)
            cu, cv = self.decode(u), self.decode(cosine * u + math.sqrt(max(0.0, 1 - cosine ** 2)) * w)
            rank = np.arange(1, cu.shape[1] + 1)
            last = np.maximum(rank[:, None], rank[None, :])
            first += [last[a[:, None] == b[None, :]].min(initial=self.lists + 1) for a, b in zip(cu, cv)]
        return int(np.sort(first)[math.ceil(len(first) * (1 - miss)) - 1])


def _best(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best scores of each row (all, if there are fewer) and their places."""
    if k >= score.shape[1]:
        return score, np.broadcast_to(np.arange(score.shape[1]), score.shape)
    at = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return np.take_along_axis(score, at, 1), at


def directions(dim: int, bits: int, lists: int = LISTS, cosine: float = COSINE) -> Directions:
    """Directions with at least ``lists`` filters a vector and as many as ``cosine`` needs; where that is more
    than ``MOST_LISTS``, fewer directions."""
    while True:
        made = Directions(dim, bits, max(lists, MOST_LISTS))
        need = made.needed(cosine)
        if need <= made.lists or bits == 0:
            made.lists = max(lists, need)
            return made
        bits -= 1


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str):
    """Rows that cannot link (vec_id), rows with their class, and the classes (label, v, cid, copies, least)."""
    given = vectors.schema[vector_col].dataType
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)      # floats travel as floats
    v = F.col(vector_col) if single else F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", usable)
    classes = stored(rows.where("ok").groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
                     .withColumn("cid", F.monotonically_increasing_id()), "classes")
    ids = rows.where("ok").select("vec_id", "label", "v").join(classes.select("label", "v", "cid", "copies", "least"), ["label", "v"])
    alone = rows.where(~F.col("ok")).select("vec_id")
    return alone, ids.select("vec_id", "cid", "copies", "least"), classes


def _tuned(classes: DataFrame, bits: int, lists: int, cosine: float) -> DataFrame:
    """(dim, bits, lists): for every length of vectors how many directions, and how many filters a vector; searched once."""
    def search(batches):
        for batch in batches:
            found = [(d, directions(d, bits, lists, cosine)) for d in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int32()), pa.array([m.bits for _, m in found], pa.int32()),
                                              pa.array([m.lists for _, m in found], pa.int32())], ["dim", "bits", "lists"])

    return stored(classes.select("dim").distinct().mapInArrow(search, "dim int, bits int, lists int"), "directions")


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; the largest component goes out first, so that no square overflows."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _filters(classes: DataFrame, bits: int, lists: int, cosine: float = COSINE, parts: int = 1) -> DataFrame:
    """(key, cid, copies, v, own, before): one row for each group of filters that a class is in. A group holds the filters
    with one word in the first block (dealt into ``parts``); ``own`` are the class's filters there, ``before`` its filters of
    other groups that come before the last of them. So a vector travels once for a group instead of once for a filter."""
    classes = classes.withColumn("dim", F.size("v"))
    rows = classes.select("label", "cid", "copies", "v", "dim").join(_tuned(classes, bits, lists, cosine), "dim").select(
        F.concat_ws("|", "dim", "label").alias("label"), "cid", "copies", "v", "dim", "bits", "lists")
    code_type = "int" if bits <= 30 else "long"

    def decode(batches):
        made = {}
        for batch in batches:
            label, cid, copies = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            starts, flat = batch.column(3).offsets.to_numpy(), batch.column(3).values.to_numpy(zero_copy_only=False)
            dims, bits_, lists_ = (batch.column(k).to_numpy() for k in (4, 5, 6))
            for dim in np.unique(dims).tolist():
                which = np.flatnonzero(dims == dim)
                if dim not in made:
                    made[dim] = Directions(dim, int(bits_[which[0]]), int(lists_[which[0]]))
                rest = math.prod(len(c) for c in made[dim].books[1:])
                for part in np.array_split(which, -(-len(which) // 1000)):
                    x = np.stack([flat[starts[i]: starts[i + 1]] for i in part])
                    codes = np.sort(made[dim].decode(_unit(x)), axis=1)
                    group = codes // rest * parts + codes % parts
                    n, width = codes.shape
                    row, g, c = np.repeat(np.arange(n), width), group.ravel(), codes.ravel()
                    order = np.lexsort((c, g, row))
                    row, g, c = row[order], g[order], c[order]
                    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (g[1:] != g[:-1])])
                    last = np.r_[first[1:], len(c)]
                    row, g = row[first], g[first]
                    earlier = (codes[row] < c[last - 1][:, None]) & (group[row] != g[:, None])
                    code_of = pa.int32() if code_type == "int" else pa.int64()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{label[part[r]]}|{k}" for r, k in zip(row, g)]), pa.array(cid[part][row]), pa.array(copies[part][row]),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * dim, pa.int32()), pa.array(x[row].ravel())),
                        pa.ListArray.from_arrays(pa.array(np.r_[first, len(c)], pa.int32()), pa.array(c, code_of)),
                        pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(earlier.sum(axis=1))], pa.int32()),
                                                 pa.array(codes[row][earlier], code_of))],
                        ["key", "cid", "copies", "v", "own", "before"])

    number = classes.schema["v"].dataType.elementType.simpleString()
    return rows.mapInArrow(decode, f"key string, cid long, copies long, v array<{number}>, own array<{code_type}>, before array<{code_type}>")


def group_links(v, table, code, copies, block, cross: bool, cosine: float):
    """Links of one filter (or block pair): (degree sums by row, forest of links), counting only pairs whose
    first shared filter is this one. ``table`` holds the filters of each row up to this one, filled up with -1."""
    m = len(v)
    degree, forest, root = np.zeros(m, np.int64), [], np.arange(m)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(0, m, 256):
        near = v[a: a + 256] @ v.T >= cosine
        i, j = np.nonzero(near)
        i += a
        ok = i < j
        if cross:
            ok &= block[i] != block[j]
        i, j = i[ok], j[ok]
        for s in range(0, len(i), 20_000):
            x, y = i[s: s + 20_000], j[s: s + 20_000]
            tx, ty = table[x], table[y]
            earlier = ((tx[:, :, None] == ty[:, None, :]) & (tx >= 0)[:, :, None] & (tx < code)[:, :, None]).any(axis=(1, 2))
            x, y = x[~earlier], y[~earlier]
            degree += np.bincount(x, weights=copies[y], minlength=m).astype(np.int64)
            degree += np.bincount(y, weights=copies[x], minlength=m).astype(np.int64)
            for p, q in zip(x.tolist(), y.tolist()):
                p, q = find(p), find(q)
                if p != q:
                    root[q] = p
                    forest.append((p, q))
    return degree, forest


def _group(pieces, cross: bool, cosine: float):
    """(degree sums by row, links) of one group of filters (or a pair of its blocks), filter by filter."""
    cid, copies, block, v = (np.concatenate(x) for x in list(zip(*pieces))[:4])
    own, before = ([np.asarray(c) for p in pieces for c in p[k]] for k in (4, 5))
    sizes = np.array([len(c) for c in own])
    table = np.full((len(cid), max(len(a) + len(b) for a, b in zip(own, before))), -1, np.int64)
    for i, (a, b) in enumerate(zip(own, before)):
        table[i, : len(a)], table[i, len(a): len(a) + len(b)] = a, b
    code, row = np.concatenate(own), np.repeat(np.arange(len(cid)), sizes)
    order = np.lexsort((row, code))
    code, row = code[order], row[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    degree, links, cross = np.zeros(len(cid), np.int64), [], cross and len(np.unique(block)) > 1
    for start, members in zip(starts, np.split(row, starts[1:])):
        if len(members) > 1:
            more, forest = group_links(_unit(v[members]), table[members], code[start], copies[members], block[members], cross, cosine)
            degree[members] += more
            links += [(int(cid[members[p]]), int(cid[members[q]])) for p, q in forest]
    return cid, degree, links


def _join_filters(rows: DataFrame, cosine: float, group_rows: int) -> DataFrame:
    """(kind, a, b): kind 0 adds b links to class a, kind 1 is a link between classes a and b."""
    rows = stored(rows, "filters")
    large = stored(rows.groupBy("key").count().where(F.col("count") > group_rows).withColumn(
        "blocks", F.ceil(F.col("count") * 2 / group_rows)).select("key", "blocks"), "large")
    size = large.agg(F.sum(F.octet_length("key") + 32)).first()[0] or 0
    rows = rows.join(F.broadcast(large) if size <= LARGE_BYTES else large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    rows = rows.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.concat_ws("/", "key", F.least("block", "other"), F.greatest("block", "other"))
    rows = rows.withColumn("task", F.when(F.col("blocks") > 1, pair).otherwise(F.col("key")))
    rows = rows.select("task", "cid", "copies", F.when(F.col("blocks") > 1, F.col("block")).alias("block"), "v", "own", "before")
    rows = rows.repartition("task").sortWithinPartitions("task", "cid")

    def verify(batches):
        def finish():
            kind, a, b = [], [], []
            if sum(len(p[0]) for p in held) > 1:
                cid, degree, links = _group(held, cross, cosine)
                some = np.flatnonzero(degree)
                kind = [0] * len(some) + [1] * len(links)
                a, b = cid[some].tolist() + [p for p, _ in links], degree[some].tolist() + [q for _, q in links]
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                              ["kind", "a", "b"])

        name, held, cross = None, [], False
        for batch in batches:
            tasks, cols = batch.column(0).to_pylist(), batch.columns
            ends = [i for i in range(1, len(tasks)) if tasks[i] != tasks[i - 1]] + [len(tasks)] * bool(tasks)
            start = 0
            for end in ends:
                if tasks[start] != name:
                    yield finish()
                    name, held, cross = tasks[start], [], cols[3][start].is_valid
                piece = [c.slice(start, end - start) for c in cols]
                values = piece[4].flatten().to_numpy(zero_copy_only=False)
                held.append((piece[1].to_numpy(), piece[2].to_numpy(), piece[3].fill_null(0).to_numpy(),
                             values.reshape(end - start, -1), piece[5].to_pylist(), piece[6].to_pylist()))
                start = end
        yield finish()

    return stored(rows.mapInArrow(verify, "kind int, a long, b long"), "links")


def spherical_dedup(vectors: DataFrame, cosine: float = COSINE, lists: int = LISTS, group_rows: int = GROUP_ROWS,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    single, ids, classes = _classes(vectors, id_col, vector_col, label_col)
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits = max(8, math.ceil(math.log2(max(most, 1) / 16)))
    words = 2 ** math.ceil(bits / max(2, math.ceil(bits / 12)))                  # of the first block
    parts = math.ceil(max(1, most * lists / words / (group_rows / 2)))
    found = _join_filters(_filters(classes, bits, lists, cosine, parts), cosine, group_rows)
    degree = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("more"))
    roots = components(found.where("kind = 1").select("a", "b"))
    rows = classes.select("cid", "copies", "least").join(degree, "cid", "left").join(
        roots.withColumnRenamed("node", "cid"), "cid", "left")
    rows = stored(rows.select("cid", "least", (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                              F.coalesce("root", "cid").alias("root")), "degrees")
    comp = rows.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rows.join(comp, "root").select("cid", "n_links", "component_id")
    out = ids.select("vec_id", "cid").join(named, "cid").select("vec_id", "n_links", "component_id")
    alone = single.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_spherical_dedup(spark, sf_dir):
    return spherical_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
