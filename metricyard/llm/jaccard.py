"""Operator 9, exact n-gram Jaccard join as a metric-space join.

Distance is ``1 - Jaccard`` of shingle sets, a metric. Documents with one set form a class; only one
representative of a class is compared. Two sets within the threshold must share one of their rarest
shingles (their prefix in one fixed order of all shingles), so representatives that share too few
with others are finished. Each shared prefix shingle elects a pivot, and the documents that hold it fall into
that pivot's region; every linking pair meets in at least one region.

Inside a region documents are ordered by their distance to the pivot. By the triangle inequality a pair
can link only if the two distances differ by at most ``eps = 1 - threshold``, so each block is compared
with its window alone, and documents within ``eps`` of the pivot are already connected through it. A
region too large for one task is split by Spark: rings of width ``eps`` around a new pivot, each ring
with the documents of the next ring as its boundary copies, recursively; what the metric cannot split any
more (all documents nearly equally far) is dealt into blocks, and every pair of blocks is one task. All
links between different sets count; a region emits only a spanning forest of its links.

Defined results: null text is empty; without words a document has no shingles, links with nothing and is
its own component; with fewer words than the shingle length the whole sequence is one shingle. Repeated
rows are members of one class and each get a result row. The component of rows whose ids are all null is
null. An empty table gives an empty result. Shingles are compared by 64-bit hashes, and equal
sets are recognised by 64-bit digests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, stored

WORDS, PERCENT = 4, 85
MAX_MEMBERS, MAX_SHINGLES = 1024, 1 << 22      # of one region in one task
DEPTH = 2                                      # ring splits before blocks
HOT_ENTRIES, HOT_SHARE, HOT_LEAST = 1 << 16, 16, 3
SMALL_ROWS = 1_000_000                         # tables of up to so many short rows are broadcast
SPARE = 3                                      # prefixes are longer by this percentage of the set


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of n that its prefix holds: enough that linking sets share ``1 + SPARE percent``."""
    return n - (n * percent + 99) // 100 + 1 + n * SPARE // 100 if n else 0

_A, _B, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPAN = 1 << 20                                 # bytes hashed at once


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= _B
    h ^= h >> np.uint64(29)
    return h


class Shingler:
    """Sorted distinct shingle hashes of a text; words are split on ASCII white space, A-Z lower-cased.

    A word's hash is a polynomial of random 64-bit values of its bytes, read off running sums of the text."""

    def __init__(self, k: int):
        self.k = k
        self.value = np.random.default_rng(4).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.value[65:91] = self.value[97:123]
        self.white = np.zeros(256, bool)
        self.white[[9, 10, 11, 12, 13, 32]] = True
        self._grow(1 << 12)

    def _grow(self, n: int):
        self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, x))])
                              for x in (_A, _BACK))

    def words(self, data: bytes) -> np.ndarray:
        """Hashes of the words in order, by pieces of about ``SPAN`` bytes that end at white space."""
        if len(data) <= SPAN:
            return self._piece(data)
        white = np.flatnonzero(self.white[np.frombuffer(data, np.uint8)])
        found, at = [], 0
        while at < len(data):
            i = np.searchsorted(white, at + SPAN)
            end = int(white[i]) if i < len(white) else len(data)
            found.append(self._piece(data[at:end]))
            at = max(end, at + 1)
        return np.concatenate(found)

    def _piece(self, data: bytes) -> np.ndarray:
        b = np.frombuffer(data, np.uint8)
        white = self.white[b]
        if len(b) >= len(self.up):
            self._grow(2 * len(b))
        edge = np.flatnonzero(np.diff(white, prepend=True, append=True))
        start, end = edge[::2], edge[1::2]
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.value[b] * self.up[: len(b)], out=sums[1:])
        return _mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        return self.with_places(text)[0]

    def with_places(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct shingles, the first word of each, hashes of all words)."""
        h = self.words((text or "").encode("utf-8", "surrogatepass"))
        if not len(h):
            return h, h, h
        k = min(self.k, len(h))
        out = h[: len(h) - k + 1] + np.uint64(k)
        for i in range(1, k):
            out = out * _A + h[i: len(h) - k + 1 + i]
        return *np.unique(_mix(out), return_index=True), h


def _as_shingle(words: np.ndarray) -> np.ndarray:
    """The one-word shingles of word hashes, as the tables of common words hold them."""
    return _mix(words + np.uint64(1)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int64)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))).cast(pa.list_(pa.int64()))


def common_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles (``k`` words) of a sample of documents, at most ``HOT_ENTRIES``, with their counts.

    They only set the order in which prefixes are taken (rare first). Any order gives the same links;
    this one keeps shared passages, and with ``k = 1`` shingles of common words, out of the prefixes."""
    def shingles(batches):
        make = Shingler(k)
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(make(text.as_py()).view(np.int64))], ["h"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(HOT_SHARE)) == 0).select("text")
    top = (sample.mapInArrow(shingles, "h long").groupBy("h").count().where(F.col("count") >= HOT_LEAST)
           .orderBy(F.col("count").desc(), "h").limit(HOT_ENTRIES).toPandas().sort_values("h"))
    return top["h"].to_numpy(np.int64), top["count"].to_numpy(np.int64)


def counts_of(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Count of each key in a (sorted keys, counts) table, 0 for the others."""
    known, count = table
    if not len(known) or not len(keys):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, count[at], 0)


def document_prefixes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, th, n, uid (64-bit digest of the set, the name of its class), prefix array<long>.

    Of equal sets in one batch, only the first carries its prefix."""
    hot = common_shingles(docs, k)
    # a word's weight is the logarithm of its count; a shingle's is the sum over its words
    words, seen_in = common_shingles(docs, 1)
    weights = words, np.round(16 * np.log2(seen_in + 1)).astype(np.int64)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")

    def features(batches):
        make = Shingler(k)
        for batch in batches:
            n, uid, prefixes, seen = [], [], [], set()
            for text in batch.column(2):
                s, first, h = make.with_places(text.as_py())
                n.append(len(s))
                uid.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                order = s.view(np.int64)[:0]
                if len(s) and uid[-1] not in seen:
                    heavy = np.concatenate([[0], np.cumsum(counts_of(_as_shingle(h), weights))])
                    most = np.minimum(first.astype(np.int64) + k, len(h))
                    weight = heavy[most] - heavy[first.astype(np.int64)]
                    order = s.view(np.int64)
                    order = order[np.lexsort((order, weight, counts_of(order, hot)))]
                seen.add(uid[-1])
                prefixes.append(order[: prefix_length(len(order), percent)].view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(uid, pa.int64()), _lists(prefixes)],
                ["doc_id", "th", "n", "uid", "prefix"])

    return stored(rows.mapInArrow(features, "doc_id long, th long, n long, uid long, prefix array<long>"), "prefixes")


def _need(percent: int) -> F.Column:
    least = F.ceil(F.col("n") * percent / 100).cast("long")
    return 1 + F.floor(least * SPARE / 100).cast("long")


def _with_partners(tokens: DataFrame, percent: int) -> DataFrame:
    """Tokens (uid, n, h) of sets that may link: a set keeps tokens that another set holds too, and it
    stays if it has at least ``need`` of them.

    The prefixes of two linking sets share ``1 + SPARE percent`` of the smaller set. The smaller has
    ``percent`` of the larger one's size or more, so a set that links shares at least ``need = 1 + SPARE
    percent of (percent of n)`` tokens with its partner."""
    of_token = Window.partitionBy("h")
    shared = tokens.withColumn("lo", F.min("uid").over(of_token)).withColumn("hi", F.max("uid").over(of_token))
    shared = shared.where("lo <> hi").select("uid", "n", "h").distinct()
    enough = shared.groupBy("uid").agg(F.count("*").alias("held"), F.first("n").alias("n")).where(
        F.col("held") >= _need(percent)).select("uid")
    return stored(shared.join(enough, "uid", "left_semi"), "tokens")


def _pivot_regions(prefixes: DataFrame, percent: int, max_members: int) -> DataFrame:
    """(region, uid): the region of a pivot holds the sets that share with it a prefix shingle that
    elected it. The set whose shingles are shared most wins, so that a cluster has few pivots.

    A set leaves the regions that fewest of its shingles elect, as long as these are fewer than half of
    the shingles it needs; of the shingles that two linking sets share, one at least is then left to
    both. Regions that hang together and are small enough in all become one, so their sets travel once."""
    held = prefixes.select("uid", "n", F.explode("prefix").alias("h"))
    tokens = _with_partners(_with_partners(held, percent), percent)
    groups = tokens.groupBy("h").agg(F.count("*").alias("c"))
    fame = tokens.join(groups, "h").groupBy("uid").agg(F.sum("c").alias("fame"))
    elect = tokens.join(fame, "uid").groupBy("h").agg(
        F.max(F.struct("fame", F.col("uid").alias("pivot")))["pivot"].alias("region"))
    votes = tokens.join(elect, "h").groupBy("region", "uid").agg(F.count("*").alias("votes"), F.first("n").alias("n"))
    upto = Window.partitionBy("uid").orderBy("votes", "region").rowsBetween(Window.unboundedPreceding, 0)
    regions = votes.withColumn("lost", F.sum("votes").over(upto)).where(
        F.col("lost") > F.floor((_need(percent) - 1) / 2)).select("region", "uid")
    regions = stored(regions, "regions")
    whole = components(regions.select(F.col("region").alias("a"), F.col("uid").alias("b")))
    small = whole.groupBy("root").agg(F.count("*").alias("m")).where(F.col("m") <= max_members)
    small = stored(whole.join(small, "root").select(F.col("root").alias("region"), F.col("node").alias("uid")), "whole")
    return stored(regions.join(small.select("uid"), "uid", "left_anti").select("region", "uid").unionByName(small), "regions")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """uid -> (n, s) for the representatives that share a region: their texts are read once more."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    w = wanted.select("uid", F.col("doc_id").alias("w_id"), F.col("th").alias("w_th"))
    n_wanted = w.count()
    w = F.broadcast(w) if n_wanted <= SMALL_ROWS else w       # else the texts are shuffled to their names
    texts = rows.join(w, (rows["th"] == w["w_th"]) & rows["doc_id"].eqNullSafe(w["w_id"])).select("uid", "text")

    def shingles(batches):
        make = Shingler(k)
        for batch in batches:
            arrays = [make(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(a) for a in arrays], pa.int64()), _lists(arrays)], ["uid", "n", "s"])

    sets = stored(texts.mapInArrow(shingles, "uid long, n long, s array<long>"), "sets")
    return sets if sets.count() == n_wanted else stored(sets.dropDuplicates(["uid"]), "sets")      # repeated rows


def _distances(members: DataFrame, sets: DataFrame, pivots: DataFrame) -> DataFrame:
    """Adds n, common, pivot and d, the distance to the region's pivot."""
    p = pivots.join(sets.select(F.col("uid").alias("pivot"), F.col("n").alias("pn"), F.col("s").alias("ps")), "pivot")
    both = members.join(sets, "uid").join(p, "region")
    common = F.size(F.array_intersect("s", "ps")).cast("long")
    return both.select("region", "uid", "pivot", "n", common.alias("common"), (F.col("n") + F.col("pn") - common).alias("all")) \
        .withColumn("d", 1 - F.col("common") / F.col("all"))


def _split_large(regions: DataFrame, sets: DataFrame, percent: int, max_members: int, max_shingles: int,
                 depth: int) -> tuple[DataFrame, list[DataFrame]]:
    """Regions as (region string, uid, pivot) that all fit one task, and links found on the way."""
    eps = (100 - percent) / 100
    sizes = sets.select("uid", "n")
    todo = regions.select(F.col("region").cast("string").alias("region"), "uid", F.col("region").alias("pivot"))
    done, links = [], []
    for level in range(depth + 1):
        weight = todo.join(sizes, "uid").groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
        weight = stored(weight.where("m > 1").withColumn("blocks", F.ceil(F.greatest(
            F.col("m") * 2 / max_members, F.col("w") * 2 / max_shingles))), "weights")
        small = weight.where(f"m <= {max_members} and w <= {max_shingles}").select("region")
        large = weight.where(f"m > {max_members} or w > {max_shingles}")
        done.append(todo.join(small, "region", "left_semi"))
        if large.isEmpty():
            break
        big = todo.join(large.select("region", "blocks"), "region")
        if level == depth:      # the metric splits no further: pairs of blocks
            b = big.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(5)), F.col("blocks")))
            other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
            b = b.select("region", "uid", "block", other)
            done.append(b.select(F.concat_ws(":", "region", F.least("block", "other"), F.greatest("block", "other")).alias("region"),
                                 "uid", F.lit(None).cast("long").alias("pivot")))
            break
        if level:               # another pivot than the parent's
            pivots = big.groupBy("region").agg(F.min(F.struct(F.xxhash64("uid", F.lit(level)), "uid"))["uid"].alias("pivot"))
        else:
            pivots = big.select("region", "pivot").distinct()
        near = stored(_distances(big.select("region", "uid"), sets, pivots), "rings")
        links.append(near.where(f"100 * common >= {percent} * `all` and uid <> pivot").select(
            F.col("uid").alias("a"), F.col("pivot").alias("b")))
        ring = F.floor(F.col("d") / F.lit(eps + 1e-9)).cast("long")
        homes = F.explode(F.when(ring > 0, F.array(ring, ring - 1)).otherwise(F.array(ring)))
        todo = stored(near.select("region", "uid", "pivot", homes.alias("ring")).select(
            F.concat_ws("/", "region", "ring").alias("region"), "uid", "pivot"), "todo")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out, links


def region_links(ids, sets, pivot, percent: int):
    """Links (i, j) of one region as a spanning forest: blocks in order of distance to the pivot, each
    against its triangle-inequality window."""
    m = len(ids)
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), n)
    _, token, df = np.unique(flat, return_inverse=True, return_counts=True)
    keep = df[token] > 1
    token, owner = token[keep], owner[keep]
    if not len(token):
        return []
    _, token = np.unique(token, return_inverse=True)
    width = int(token.max()) + 1
    centre = int(np.flatnonzero(ids == pivot)[0]) if pivot is not None and (ids == pivot).any() else 0
    mine = np.zeros(width, bool)
    mine[token[owner == centre]] = True
    common = np.bincount(owner[mine[token]], minlength=m)
    d = 1 - common / (n + n[centre] - common)
    eps = (100 - percent) / 100 + 1e-9
    order = np.argsort(d, kind="stable")
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    ds, ns = d[order], n[order]
    root = np.arange(m)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []

    def link(i, j):
        a, b = find(i), find(j)
        if a != b:
            root[b] = a
            out.append((int(ids[order[i]]), int(ids[order[j]])))

    c = int(place[centre])
    linked = np.flatnonzero(100 * common[order] >= percent * (ns + n[centre] - common[order]))
    for i in linked:
        link(c, int(i))
    # documents within eps of the pivot come first and need no comparison with each other
    core = len(linked) if (linked == np.arange(len(linked))).all() else 0
    rows = place[owner]
    by = np.argsort(rows, kind="stable")
    rows, token = rows[by], token[by]
    start = np.searchsorted(rows, np.arange(m + 1))
    step = max(1, min(256, m))
    for a in range(0, m, step):
        b = min(a + step, m)
        lo = max(a, core) if b <= core else a
        hi = int(np.searchsorted(ds, ds[b - 1] + eps, "right"))
        if hi <= lo or hi - a < 2:
            continue
        both = np.zeros((b - a, hi - lo), np.float32)
        local, inv = np.unique(token[start[a]: start[b]], return_inverse=True)
        for t in range(0, len(local), 4096):
            part = local[t: t + 4096]
            left = np.zeros((b - a, len(part)), np.float32)
            sel = (inv >= t) & (inv < t + len(part))
            left[rows[start[a]: start[b]][sel] - a, inv[sel] - t] = 1
            tk, rw = token[start[lo]: start[hi]], rows[start[lo]: start[hi]]
            pos = np.minimum(np.searchsorted(part, tk), len(part) - 1)
            hit = part[pos] == tk
            right = np.zeros((hi - lo, len(part)), np.float32)
            right[rw[hit] - lo, pos[hit]] = 1
            both += left @ right.T
        size = ns[a:b, None] + ns[None, lo:hi] - both
        i, j = np.nonzero(100 * both >= percent * size)
        i, j = i + a, j + lo
        for x, y in zip(i[i < j], j[i < j]):
            link(int(x), int(y))
    return out


def _compare(regions: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    regions = stored(regions.select("region", "uid", "pivot"), "parts")
    regions = F.broadcast(regions) if regions.count() <= SMALL_ROWS else regions
    full = sets.select("uid", "s").join(regions, "uid").select("region", "uid", "pivot", "s")
    full = full.repartition("region").sortWithinPartitions("region")

    def links(batches):
        name, ids, arrays, centre = None, [], [], None

        def finish():
            found = []
            if len(ids) > 1:
                order = np.argsort(np.array(ids, np.int64))
                kept = [i for k, i in enumerate(order) if not k or ids[i] != ids[order[k - 1]]]
                found = region_links(np.array(ids, np.int64)[kept], [arrays[i] for i in kept], centre, percent)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                               pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            lists = batch.column(3)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            uid, names, centres = batch.column(1).to_numpy(), batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, r in enumerate(names):
                if r != name:
                    yield finish()
                    name, ids, arrays, centre = r, [], [], centres[i]
                ids.append(int(uid[i]))
                arrays.append(np.array(flat[ends[i]: ends[i + 1]]))
        yield finish()

    return full.mapInArrow(links, "a long, b long")


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, max_members: int = MAX_MEMBERS,
                 max_shingles: int = MAX_SHINGLES, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, th (hash of its text), n_shingles, component_id, kept.

    Two documents link when ``100 * intersection >= percent * union`` of their distinct ``words``-word
    shingles. ``kept`` marks the row of least (doc_id, th) in each component."""
    prefixes = document_prefixes(docs, words, percent)
    filled = prefixes.where("n > 0")
    regions = _pivot_regions(filled.select("uid", "n", "prefix"), percent, max_members)
    wanted = stored(filled.select("uid", "doc_id", "th").join(regions.select("uid").distinct(), "uid", "left_semi").groupBy("uid").agg(
        F.min(F.struct("th", "doc_id")).alias("x")).select("uid", "x.*"), "wanted")
    sets = _sets(docs, wanted, words)
    parts, links = _split_large(regions, sets, percent, max_members, max_shingles, depth)
    edges = _compare(parts, sets, percent)
    for more in links:
        edges = edges.unionByName(more)
    roots = components(edges).withColumnRenamed("node", "uid")
    rows = stored(filled.select("doc_id", "th", "n", "uid").join(roots, "uid", "left").select(
        "doc_id", "th", "n", F.coalesce("root", "uid").alias("g")), "members")
    best = rows.groupBy("g").agg(F.min("doc_id").alias("component_id"), F.min(F.when(
        F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("w"), F.min("th").alias("least"))
    rows = rows.join(best, "g")
    kept = F.when(F.col("w").isNull(), F.col("th") == F.col("least")).otherwise(
        (F.col("doc_id") == F.col("w.doc_id")) & (F.col("th") == F.col("w.th")))
    rows = rows.select("doc_id", "th", F.col("n").alias("n_shingles"), "component_id", F.coalesce(kept, F.lit(False)).alias("kept"))
    alone = prefixes.where("n = 0").select("doc_id", "th", F.col("n").alias("n_shingles"),
                                           F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return rows.unionByName(alone)


def op9_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_join(docs).select("doc_id", "n_shingles", "component_id")


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies (five words, similarity 0.8 or more)."""
    kept = jaccard_join(docs, words=5, percent=80).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__h")).distinct()
    rows = docs.withColumn("__th", F.xxhash64("text"))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["__id"]) & (rows["__th"] == kept["__h"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "__th"]).select(*docs.columns)
