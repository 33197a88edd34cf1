"""Operator 12, hard-negative mining with angular triangle filtering.

Vectors become integers, ``floor(256 * x)``. Every row stores the angles between its integer vector and a few
reference directions. For a row x, an anchor a and a direction r the triangle inequality on the sphere gives::

    |angle(a, r) - angle(x, r)| <= angle(a, x) <= min(angle(a, r) + angle(x, r), 2 pi - angle(a, r) - angle(x, r))

so the angles give an interval for the cosine, and with the norms one for the integer score, widened by more than
all rounding (``ANGLE_SLACK``, ``COSINE_SLACK``, one unit). Only rows whose interval meets a window in which the anchor
still wants scores get an integer inner product; that product alone decides. The windows are: at or above the
anchor's fifth best score so far for positives; ``30 * p <= 100 * s <= 90 * p``, not below the tenth best so far, for
the negatives of a positive with score p.

Plan: rows, sorted by dimension, label, nearest direction and angle, are packed into blocks of at most
``BLOCK_ROWS`` with the least and greatest angle and norm, and blocks into lanes. Anchors are packed the same way.
An anchor block goes to the lanes whose summary meets its windows, and a task streams anchor blocks past one lane,
dropping whole blocks, then rows, by their intervals. Each anchor's best rows of the lanes meet in a ranked window.
The anchors are a stated query set against all rows, in blocks; lanes and blocks have bounded size, so a label
that holds a third of all rows is many blocks. Directions come from a sample of at most ``SAMPLE`` rows, those of least
hashed id; they decide how much is skipped, never the result.

Defined results: rows with a null id, label or vector, or a null or non-finite component (also after times 256) take
no part. Rows of another dimension than the anchor's are not compared. Every row counts by itself: a repeated
row of an anchor is another row of the same label. Score ties go to the smaller id; tied rows of one id are alike.
Zero and empty vectors score 0. Scores are exact integers, clipped to the range of long where they leave it. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
DIRECTIONS, SAMPLE = 16, 4096
BLOCK_ROWS, LANE_ROWS, ANCHOR_ROWS = 4096, 131_072, 256
ANGLE_SLACK, COSINE_SLACK = 1e-5, 4e-6
EXACT = 2.0 ** 53 / 100
LONG = -(1 << 63), (1 << 63) - 1

PREPARED = "uid long, vec_id long, label int, dim int, wide boolean, comps binary, norm double, angles binary, cell int, near double"
BLOCKS = ("dim int, label int, n int, uids binary, ids binary, wide boolean, comps binary, norms binary, angles binary, lo array<double>, "
          "hi array<double>, least_norm double, most_norm double, wants array<array<long>>")


# ---------------------------------------------------------------- vectors, directions, angles
def matrices(batch: pa.RecordBatch):
    """Groups of rows by dimension: (row numbers, integer components as doubles)."""
    vectors = batch.column("embedding")
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    ends = vectors.offsets.to_numpy()
    with np.errstate(over="ignore"):
        fine = np.concatenate([[0], np.cumsum(~np.isfinite(values * SCALE))])
    ok = np.ones(batch.num_rows, bool)
    for c in batch.columns:
        ok &= c.is_valid().to_numpy(zero_copy_only=False)
    start, size = ends[:-1], np.diff(ends)
    ok &= fine[ends[1:]] == fine[start]
    for dim in np.unique(size[ok]).tolist():
        rows = np.flatnonzero(ok & (size == dim))
        yield rows, np.floor(values[start[rows][:, None] + np.arange(dim)] * SCALE)


def norms_of(comps: np.ndarray) -> np.ndarray:
    most = np.abs(comps).max(axis=1, initial=0)
    return most * np.sqrt(((comps / np.maximum(most, 1)[:, None]) ** 2).sum(axis=1))


def unit(comps: np.ndarray) -> np.ndarray:
    scaled = comps / np.maximum(np.abs(comps).max(axis=1, initial=0), 1)[:, None]
    return scaled / np.maximum(np.sqrt((scaled ** 2).sum(axis=1)), 1e-300)[:, None]


def choose_directions(sample: list[list[float]], most: int = DIRECTIONS) -> dict[int, np.ndarray]:
    """Dimension -> unit directions: the first vector, then always the one farthest from those chosen."""
    by_dim: dict[int, list] = {}
    for v in sample:
        if v is not None and all(x is not None and math.isfinite(x * SCALE) for x in v):
            c = np.floor(np.array(v, dtype=np.float64) * SCALE)
            if c.any():
                by_dim.setdefault(len(v), []).append(c)
    out = {}
    for dim, rows in by_dim.items():
        points, chosen = unit(np.stack(rows)), [0]
        closest = points @ points[0]
        while len(chosen) < min(most, len(points)) and closest.min() < 1 - 1e-9:
            chosen.append(int(closest.argmin()))
            closest = np.maximum(closest, points @ points[chosen[-1]])
        out[dim] = points[chosen]
    return out


def prepared(vectors: DataFrame, directions: dict[int, np.ndarray]) -> DataFrame:
    """(PREPARED) from (vec_id, label, embedding, uid)."""
    def work(batches):
        for batch in batches:
            cols = {k: batch.column(k) for k in ("uid", "vec_id", "label")}
            for rows, comps in matrices(batch):
                refs = directions.get(comps.shape[1], np.zeros((0, comps.shape[1])))
                angles = np.arccos(np.clip(unit(comps) @ refs.T, -1, 1)).astype(np.float32)
                wide = np.abs(comps).max(axis=1, initial=0) > 32_000
                cell = angles.argmin(axis=1) if len(refs) else np.zeros(len(rows), int)
                near = angles.min(axis=1, initial=4)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*(cols[k].take(at) for k in cols), pa.array(np.full(len(rows), comps.shape[1], np.int32)), pa.array(wide),
                     pa.array([c.tobytes() if w else c.astype(np.int16).tobytes() for c, w in zip(comps, wide)], pa.binary()),
                     pa.array(norms_of(comps)), pa.array([a.tobytes() for a in angles], pa.binary()),
                     pa.array(cell.astype(np.int32)), pa.array(near.astype(np.float64))],
                    ["uid", "vec_id", "label", "dim", "wide", "comps", "norm", "angles", "cell", "near"])

    return vectors.mapInArrow(work, PREPARED)


# ---------------------------------------------------------------- blocks
def packed(rows: DataFrame, most: int, parts: int) -> DataFrame:
    """Blocks (BLOCKS) of neighbouring rows of one dimension and label; ``rows`` are PREPARED with an optional ``wants``."""
    if "wants" not in rows.columns:
        rows = rows.withColumn("wants", F.lit(None).cast("array<long>"))
    order = ["dim", "label", "wide", "cell", "near", "uid"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = rows.sparkSession.createDataFrame([], BLOCKS).schema

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        held, key = [], None
        target = to_arrow_schema(schema)

        def block():
            angles = np.stack([np.frombuffer(r["angles"], np.float32) for r in held]).astype(np.float64)
            norms = np.array([r["norm"] for r in held])
            row = {"dim": key[0], "label": key[1], "wide": key[2], "n": len(held), "norms": norms.tobytes(),
                   "uids": np.array([r["uid"] for r in held]).tobytes(), "ids": np.array([r["vec_id"] for r in held]).tobytes(),
                   "comps": b"".join(r["comps"] for r in held), "angles": b"".join(r["angles"] for r in held),
                   "lo": angles.min(axis=0).tolist(), "hi": angles.max(axis=0).tolist(), "least_norm": float(norms.min()),
                   "most_norm": float(norms.max()), "wants": [r["wants"] or [] for r in held]}
            return pa.RecordBatch.from_pylist([row], schema=target)

        for batch in batches:
            for r in batch.to_pylist():
                at = (r["dim"], r["label"], r["wide"])
                if held and (at != key or len(held) == most):
                    yield block()
                    held = []
                key = at
                held.append(r)
        if held:
            yield block()

    return rows.mapInArrow(work, BLOCKS)


class Block:
    def __init__(self, row: dict):
        self.dim, self.label, self.n = row["dim"], row["label"], row["n"]
        self.ids, self.uids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["uids"], np.int64)
        self.norms = np.frombuffer(row["norms"])
        self.angles = np.frombuffer(row["angles"], np.float32).reshape(self.n, -1)
        self.raw, self.wide = row["comps"], row["wide"]
        self.lo, self.hi = np.array(row["lo"]), np.array(row["hi"])
        self.least_norm, self.most_norm, self.wants = row["least_norm"], row["most_norm"], row["wants"]
        self._comps = None

    @property
    def comps(self):
        if self._comps is None:
            self._comps = np.frombuffer(self.raw, np.float64 if self.wide else np.int16).reshape(self.n, self.dim).astype(np.float64)
        return self._comps


def score_bounds(a_norms, cos_lo, cos_hi, least, most):
    """Safe bounds of integer scores from cosine bounds and norms (all broadcast against each other)."""
    cos_lo, cos_hi = cos_lo - COSINE_SLACK, cos_hi + COSINE_SLACK
    with np.errstate(over="ignore"):
        lo = a_norms * np.where(cos_lo < 0, cos_lo * most, cos_lo * least)
        hi = a_norms * np.where(cos_hi < 0, cos_hi * least, cos_hi * most)
    return lo * (1 - 1e-12 * np.sign(lo)) - 1, hi * (1 + 1e-12 * np.sign(hi)) + 1


def block_interval(a: Block, rows, x: Block):
    """Score bounds of some anchors against a whole block, from its least and greatest angles."""
    t = a.angles[rows].astype(np.float64)
    near = np.maximum(t - x.hi, x.lo - t).max(axis=1, initial=0)
    far = np.minimum(t + x.hi, 2 * np.pi - t - x.lo).min(axis=1, initial=np.pi)
    return score_bounds(a.norms[rows], np.cos(np.clip(far + ANGLE_SLACK, 0, np.pi)), np.cos(np.clip(near - ANGLE_SLACK, 0, np.pi)),
                        x.least_norm, x.most_norm)


def row_intervals(a: Block, rows, x: Block):
    """Score bounds of some anchors against every row of a block."""
    near = np.zeros((len(rows), x.n), np.float32)
    far = np.full((len(rows), x.n), np.pi, np.float32)
    for r in range(a.angles.shape[1]):
        t, u = a.angles[rows, r][:, None], x.angles[:, r][None, :]
        np.maximum(near, np.abs(t - u), out=near)
        s = t + u
        np.minimum(far, np.minimum(s, np.float32(2 * np.pi) - s), out=far)
    return score_bounds(a.norms[rows][:, None], np.cos(np.clip(far + ANGLE_SLACK, 0, np.pi)),
                        np.cos(np.clip(near - ANGLE_SLACK, 0, np.pi)), x.norms, x.norms)


def exact_scores(a: Block, rows, x: Block, cols) -> np.ndarray:
    """Integer inner products as longs: by doubles where those are exact, else by Python integers."""
    left, right = a.comps[rows], x.comps[cols]
    if float(a.norms[rows].max(initial=0)) * float(x.norms[cols].max(initial=0)) < EXACT:
        return np.rint(left @ right.T).astype(np.int64)
    whole = lambda m: np.array([[int(c) for c in row] for row in m.tolist()], dtype=object).reshape(m.shape)
    return np.clip(whole(left) @ whole(right).T, *LONG).astype(np.int64)


class Best:
    """The ``most`` best (score, id) of one window [lo, hi]; None is no limit."""

    def __init__(self, most: int, lo=None, hi=None):
        self.most, self.lo, self.hi, self.rows = most, lo, hi, []

    def floor(self):
        """No score below this can still enter."""
        return self.rows[-1][0] if len(self.rows) == self.most else self.lo

    def add(self, scores, ids, uids):
        ok = np.ones(len(scores), bool)
        lo = self.floor()
        if lo is not None:
            ok &= scores >= lo
        if self.hi is not None:
            ok &= scores <= self.hi
        at = np.flatnonzero(ok)
        if len(at) > 4 * self.most:
            cut = np.partition(scores[at], len(at) - self.most)[len(at) - self.most]
            at = at[scores[at] >= cut]
        new = zip((int(s) for s in scores[at]), ids[at].tolist(), uids[at].tolist())
        self.rows = sorted([*self.rows, *new], key=lambda r: (-r[0], r[1], r[2]))[: self.most]


def windows_of(a: Block, i: int, low=LOW, high=HIGH, negatives=NEGATIVES, positives=POSITIVES) -> list[Best]:
    """What an anchor looks for: its best positives, or for each positive its negatives."""
    if not a.wants[i]:
        return [Best(positives)]
    return [Best(negatives, -((-low * p) // 100), (high * p) // 100) for p in a.wants[i]]


def search(a: Block, blocks: list[Block], same_label: bool, wanted: list[list[Best]]) -> int:
    """Fills the windows of the anchors of a block from the blocks of a lane; the number of integer scores."""
    scored, inf = 0, math.inf
    for x in blocks:
        if x.dim != a.dim or (x.label == a.label) != same_label:
            continue
        floors = lambda i: min((-inf if f is None else f for f in (w.floor() for w in wanted[i])), default=inf)
        tops = np.array([max((inf if w.hi is None else w.hi for w in ws), default=-inf) for ws in wanted], dtype=float)
        needs = np.array([floors(i) for i in range(a.n)], dtype=float)
        needs[needs <= LONG[0]] = -inf                  # clipped scores tie
        lo, hi = block_interval(a, np.arange(a.n), x)
        rows = np.flatnonzero((hi >= needs) & (lo <= tops))
        if not len(rows):
            continue
        lo, hi = row_intervals(a, rows, x)
        meets = (hi >= needs[rows][:, None]) & (lo <= tops[rows][:, None])
        cols = np.flatnonzero(meets.any(axis=0))
        scores = exact_scores(a, rows, x, cols)
        meets = meets[:, cols]
        if same_label:
            meets &= a.uids[rows][:, None] != x.uids[cols][None, :]
        scored += int(meets.sum())
        for k, i in enumerate(rows.tolist()):
            at = cols[meets[k]]
            own = scores[k][meets[k]]
            for w in wanted[i]:
                w.add(own, x.ids[at], x.uids[at])
    return scored


# ---------------------------------------------------------------- lanes
def mined(blocks: DataFrame, anchors: DataFrame, lanes: DataFrame, count: int, same_label: bool) -> DataFrame:
    """(a_uid, a_id, slot, id, uid, score): the best rows of each lane for every window of the anchors."""
    near = F.greatest(F.lit(0.0), F.array_max(F.zip_with(
        F.zip_with("a_lo", "l_hi", lambda p, q: p - q), F.zip_with("l_lo", "a_hi", lambda p, q: p - q), lambda p, q: F.greatest(p, q))) - ANGLE_SLACK)
    most = F.cos(F.least(F.lit(math.pi), F.coalesce(near, F.lit(0.0)))) + COSINE_SLACK
    highest = F.when(most >= 0, most * F.col("a_most") * F.col("l_most")).otherwise(most * F.col("a_least") * F.col("l_least"))
    wanted = F.array_min(F.flatten("wants"))                         # the least positive score of the block
    low = F.when(wanted.isNull(), F.lit(-math.inf)).otherwise(wanted * (LOW / 100) - 1)
    sides = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("lane")).join(lanes, ["lane", "dim"])
    labels = (F.col("label").between(F.col("l_first"), F.col("l_last")) if same_label
              else (F.col("l_first") != F.col("l_last")) | (F.col("label") != F.col("l_first")))
    sides = sides.withColumnsRenamed({"lo": "a_lo", "hi": "a_hi", "least_norm": "a_least", "most_norm": "a_most"}).where(
        labels & (highest * (1 + 1e-9) + 1 >= low)).withColumnsRenamed(
        {"a_lo": "lo", "a_hi": "hi", "a_least": "least_norm", "a_most": "most_norm"})
    columns = [c.split()[0] for c in BLOCKS.replace("array<array<long>>", "x").replace("array<double>", "x").split(", ")]
    both = blocks.select("lane", F.lit(0).alias("side"), *columns).unionByName(sides.select("lane", F.lit(1).alias("side"), *columns))
    both = both.repartition("lane").sortWithinPartitions("lane", "side")

    def work(batches):
        lane, held, out = None, [], []

        def rows():
            cols = list(zip(*out)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(cols)],
                                              ["a_uid", "a_id", "slot", "id", "uid", "score"])

        for batch in batches:
            for r in (row for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
                if r["lane"] != lane:
                    lane, held = r["lane"], []
                block = Block(r)
                if r["side"] == 0:
                    held.append(block)
                    continue
                wanted = [windows_of(block, i) for i in range(block.n)]
                search(block, held, same_label, wanted)
                out.extend((int(block.uids[i]), int(block.ids[i]), slot, rid, uid, s)
                           for i, ws in enumerate(wanted) for slot, w in enumerate(ws) for s, rid, uid in w.rows)
                if len(out) > 20_000:
                    yield rows()
                    out = []
        yield rows()

    return both.mapInArrow(work, "a_uid long, a_id long, slot int, id long, uid long, score long")


def best_of(found: DataFrame, most: int) -> DataFrame:
    w = Window.partitionBy("a_uid", "slot").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def mine_negatives(vectors: DataFrame, anchor: F.Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", lane_rows: int = LANE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor``, a
    condition on ``vec_id``, holds."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("int").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("embedding")).withColumn("uid", F.monotonically_increasing_id())
    sample = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    directions = choose_directions([r[0] for r in sample.select("embedding").collect()])
    rows = stored(prepared(rows, directions), "vectors")
    total = rows.count()
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lane_rows = min(lane_rows, max(BLOCK_ROWS, total // tasks))       # small tables still use all tasks
    # a range of rows is a partition of blocks, and so a lane; two ranges never share a block
    blocks = stored(packed(rows, BLOCK_ROWS, max(1, -(-total // lane_rows))).withColumn("lane", F.spark_partition_id()), "blocks")
    spans = blocks.select("lane", "dim", "label", "least_norm", "most_norm", F.posexplode_outer(F.arrays_zip("lo", "hi")).alias("r", "z"))
    spans = spans.groupBy("lane", "dim", "r").agg(
        F.min("label").alias("l_first"), F.max("label").alias("l_last"), F.min("least_norm").alias("l_least"),
        F.max("most_norm").alias("l_most"), F.min("z.lo").alias("lo"), F.max("z.hi").alias("hi"))
    per_direction = F.array_sort(F.collect_list(F.struct("r", "lo", "hi")))
    lanes = spans.groupBy("lane", "dim").agg(
        F.min("l_first").alias("l_first"), F.max("l_last").alias("l_last"), F.min("l_least").alias("l_least"),
        F.max("l_most").alias("l_most"), F.filter(per_direction, lambda s: s["r"].isNotNull()).alias("s"))
    lanes = stored(lanes.select("lane", "dim", "l_first", "l_last", "l_least", "l_most", F.col("s.lo").alias("l_lo"),
                                F.col("s.hi").alias("l_hi")), "lanes")
    count = 1 + (lanes.agg(F.max("lane")).first()[0] or 0)
    queries = rows.where(anchor)
    parts = max(1, min(tasks, queries.count() // (4 * ANCHOR_ROWS)))
    first = mined(blocks, packed(queries, ANCHOR_ROWS, parts), lanes, count, True)
    positives = stored(best_of(first, POSITIVES).select("a_uid", "a_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                                                        (F.col("rank") - 1).alias("slot")), "positives")
    wants = positives.groupBy("a_uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))),
                                                       lambda s: s["positive_score"]).alias("wants"))
    asking = queries.join(wants, queries["uid"] == wants["a_uid"]).drop("a_uid")
    second = mined(blocks, packed(asking, ANCHOR_ROWS, parts), lanes, count, False)
    negatives = best_of(second, NEGATIVES).select("a_uid", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(negatives, ["a_uid", "slot"]).select(
        F.col("a_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_angular_negatives(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.uid AS a_uid, a.vec_id AS a_id, x.uid, x.vec_id, a.label = x.label AS same,
             CASE WHEN len(a.c) = 0 THEN 0 ELSE list_inner_product(a.c, x.c)::BIGINT END AS score
      FROM v a JOIN v x ON a.vec_id % 100 = 0 AND a.uid <> x.uid AND len(a.c) = len(x.c)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a_uid ORDER BY score DESC, vec_id, uid) AS slot FROM s WHERE same)
      WHERE slot <= 5),
n AS (SELECT p.a_uid, p.slot, p.a_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id,
             s.score AS negative_score, row_number() OVER (PARTITION BY p.a_uid, p.slot ORDER BY s.score DESC, s.vec_id, s.uid) AS rank
      FROM p JOIN s ON p.a_uid = s.a_uid AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT a_id AS anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
