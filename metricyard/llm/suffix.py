"""Operator 7, removal of repeated byte strings by sharded external induced sorting.

A byte goes if a ``window``-byte string that covers it starts earlier, in a document of smaller id or earlier in
the same document. The order of all suffixes of the corpus is not needed for this, only which windows are equal,
so suffixes are sorted in shards that equal windows are sure to share:

1. Equal texts are merged first (all but the first of them go whole). Texts are stored once, compressed, bucketed
   by key, so that later joins move only positions.
2. Each window has an anchor: its leftmost ``gram`` of least hash. Equal windows have equal anchors. Anchors whose
   gram occurs once in the corpus end the matter for their windows; that is most of them.
3. For each repeated anchor, the windows that have it form one short piece of text. Equal pieces merge, first in
   the task that makes them, then in the shard that the gram's hash names; all but the first are repeated whole.
   A gram whose pieces exceed a shard is split: its windows are dealt by the anchor's offset in them, ``STEPS``
   offsets at a time, and by the bytes that all windows of such offsets hold, which equal windows share. The last
   step deals single windows, which only merge; so what a task holds and sorts is bounded, however common a gram.
4. Where one anchor has different pieces, their suffixes are sorted by external induced sorting (``induced.py``).
   Neighbours with a common prefix of ``window`` bytes are equal windows; all but the first are repeated.
5. Repeated spans go back to their texts, are united and cut out.

Defined results: null text is empty. Texts shorter than the window lose nothing. Rows with the same id and text
count as one document and get the same result. Rows with a null id come after all others in order. Among different
texts with one id, the order is that of their digests. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_dir, stored
from .induced import DEPTH, sort_suffixes

WINDOW, GRAM = DEPTH, 32
LAST = (1 << 63) - 1
BUCKET_BYTES, SHARD_BYTES = 16 << 20, 3 << 20
FEW_NAMES = 1_000_000           # grams of 8 bytes that are broadcast
STEPS, HELD_SPANS = (9, 1), 200_000
_UP = 0x9E3779B97F4A7C15


class Anchors:
    """Anchor (leftmost gram of least hash) of every window of a text."""

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, gram
        self.value = np.random.default_rng(8).integers(0, 1 << 64, 256, dtype=np.uint64)
        self._grow(1 << 12)

    def _grow(self, n: int):
        self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, x, np.uint64))])
                              for x in (_UP, pow(_UP, -1, 1 << 64)))

    def grams(self, data: bytes) -> np.ndarray:
        b = np.frombuffer(data, np.uint8)
        if len(b) >= len(self.up):
            self._grow(2 * len(b))
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.value[b] * self.up[: len(b)], out=sums[1:])
        h = (sums[self.gram:] - sums[: -self.gram]) * self.down[: len(b) - self.gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(gram hashes, anchor of each window start)."""
        h = self.grams(data)
        low = (h >> np.uint64(32)).astype(np.uint32)
        span, width = self.window - self.gram + 1, 1
        best, at = low, np.arange(len(low), dtype=np.int32)
        while width < span:
            step = min(width, span - width)
            left, right = best[:-step], best[step:]
            take = left <= right
            best, at = np.where(take, left, right), np.where(take, at[:-step], at[step:])
            width += step
        return h, at


def anchor_runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of the runs of windows with one anchor."""
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.concatenate([first[1:], [len(at)]]) - 1


def unite(spans: np.ndarray) -> np.ndarray:
    """Union of the (start, end) rows as sorted disjoint spans that do not touch."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], np.append(reach[:-1][new[1:]], reach[-1])], axis=1)


def _unique_texts(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """(k, o, blob): one row per distinct text of at least ``window`` bytes; o is its least document order.

    Stored in ``buckets`` buckets of k, so that joins on k leave the texts where they are."""
    rows = docs.where(F.octet_length("text") >= window).select(F.coalesce("doc_id", F.lit(LAST)).alias("o"), "text")

    def squeeze(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            least: dict[str, int] = {}
            for o, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                least[t] = min(o, least.get(t, LAST))
            data = [t.encode("utf-8", "surrogatepass") for t in least]
            k = [int.from_bytes(hashlib.sha256(d).digest()[:8], "big", signed=True) for d in data]
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(list(least.values()), pa.int64()),
                                              pa.array([press.compress(d) for d in data], pa.binary())], ["k", "o", "blob"])

    texts = (rows.mapInArrow(squeeze, "k long, o long, blob binary").repartition(buckets, "k")
             .groupBy("k", "blob").agg(F.min("o").alias("o")))
    name = f"llm_texts_{uuid.uuid4().hex}"
    texts.select("k", "o", "blob").write.bucketBy(buckets, "k").option(
        "path", f"{scratch_dir(docs.sparkSession)}/{name}").saveAsTable(name)
    table = docs.sparkSession.table(name)                 # holds the files and their buckets from here on
    docs.sparkSession.sql(f"DROP TABLE {name}")           # an external table: only its name goes
    return table


def _repeated_anchors(texts: DataFrame, window: int, gram: int, groups: int) -> DataFrame:
    """(k, pos): for each text, anchors (binary int32) whose gram occurs elsewhere in the corpus too.

    Grams are dealt to ``groups`` groups by hash. A task first settles the grams that it meets more than once
    and sends only one of them on, so a very common gram reaches its group once per task."""
    def collect(batches):
        anchors = Anchors(window, gram)
        press, unpress = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            hs, ps, ds = [], [], []
            for i, blob in enumerate(batch.column(1)):
                h, at = anchors.of(unpress.decompress(blob.as_py()))
                p = anchor_runs(at)[0]
                hs.append(h[p])
                ps.append(p)
                ds.append(np.full(len(p), i, np.int32))
            if not hs:
                continue
            h, p, d = np.concatenate(hs), np.concatenate(ps), np.concatenate(ds)
            order = np.argsort(h, kind="stable")
            s = h[order]
            same = s[1:] == s[:-1]
            first = np.concatenate([[True], ~same])
            known = np.zeros(len(h), bool)                  # met more than once here
            known[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            send = np.zeros(len(h), bool)
            send[order] = first
            group = (h % np.uint64(groups)).astype(np.int64)
            out = [[], [], []]

            def row(name, mask_or_index, settled):
                doc, count = np.unique(d[mask_or_index], return_counts=True)
                parts = [np.array([len(doc), settled], np.int64), keys[doc].astype(np.int64), count.astype(np.int64),
                         p[mask_or_index].astype(np.int32)]
                if not settled:
                    parts.append(h[mask_or_index])
                out[0].append(name)
                out[1].append(press.compress(b"".join(x.tobytes() for x in parts)))

            for part in np.array_split(np.flatnonzero(known), -(-int(known.sum()) // 100_000) or 1):
                if len(part):
                    row(int(d[part[0]]) % groups, np.sort(part), 1)
            index = np.flatnonzero(send)
            index = index[np.argsort(group[index], kind="stable")]
            edge = np.searchsorted(group[index], np.arange(groups + 1))
            for g in np.unique(group[index]):
                row(int(g), index[edge[g]: edge[g + 1]], 0)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], ["g", "blob"])

    def match(batches):
        unpress = zstandard.ZstdDecompressor()
        name, held = None, []

        def rows(keys, count, p, keep):
            doc = np.repeat(np.arange(len(keys)), count)[keep]
            edge = np.searchsorted(doc, np.arange(len(keys) + 1))
            p = p[keep]
            some = np.flatnonzero(np.diff(edge))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[some]), pa.array([p[edge[i]: edge[i + 1]].tobytes() for i in some], pa.binary())], ["k", "pos"])

        def finish():
            if len(held):
                h = np.concatenate([x[3] for x in held])
                order = np.argsort(h, kind="stable")
                s = h[order]
                same = s[1:] == s[:-1]
                repeated = np.zeros(len(h), bool)
                repeated[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
                at = 0
                for keys, count, p, hh in held:
                    yield rows(keys, count, p, repeated[at: at + len(hh)])
                    at += len(hh)

        for batch in batches:
            for g, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = unpress.decompress(blob.as_py())
                n, settled = np.frombuffer(raw, np.int64, 2)
                keys, count = np.frombuffer(raw, np.int64, n, 16), np.frombuffer(raw, np.int64, n, 16 + 8 * n)
                total = int(count.sum())
                p = np.frombuffer(raw, np.int32, total, 16 + 16 * n)
                if settled:
                    yield rows(keys, count, p, np.ones(total, bool))
                    continue
                if g != name:
                    yield from finish()
                    name, held = g, []
                held.append((keys, count, p, np.frombuffer(raw, np.uint64, total, 16 + 16 * n + 4 * total)))
        yield from finish()

    sent = texts.select("k", "blob").mapInArrow(collect, "g long, blob binary")
    found = sent.repartition(groups, "g").sortWithinPartitions("g").mapInArrow(match, "k long, pos binary")
    return found.groupBy("k").agg(F.collect_list("pos").alias("pos"))


def _pieces(texts: DataFrame, anchors: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows of two kinds: pieces (h, piece, k, o, start, anchor), the last being the anchor's offset in the piece,
    and repeated spans (k, o, spans as binary int64 pairs).

    Of equal pieces in one batch of texts, only the first in document order is sent; the others are spans."""
    rows = texts.join(anchors, "k").select("o", "k", "blob", "pos")

    def cut(batches):
        finder, unpress = Anchors(window, gram), zstandard.ZstdDecompressor()
        for batch in batches:
            o, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            seen, made, spans = set(), [], []
            for i in np.lexsort((k, o)):
                data = unpress.decompress(batch.column(2)[i].as_py())
                wanted = np.concatenate([np.frombuffer(x, np.int32) for x in batch.column(3)[i].as_py()])
                h, at = finder.of(data)
                a, first, last = anchor_runs(at)
                use = np.isin(a, wanted)
                gone = []
                for p, s, e in zip(a[use].tolist(), first[use].tolist(), last[use].tolist()):
                    piece = data[s: e + window]
                    if piece in seen:
                        gone.append((s, e + window))
                    else:
                        seen.add(piece)
                        made.append((int(h[p].view(np.int64)), piece, int(k[i]), int(o[i]), s, p - s))
                if gone:
                    spans.append((int(k[i]), int(o[i]), unite(np.array(gone, np.int64)).tobytes()))
            yield _piece_rows(made, spans)

    return stored(rows.mapInArrow(cut, PIECES), "pieces")


def _split(pieces: DataFrame, step: int, window: int, gram: int) -> DataFrame:
    """The rows of ``pieces`` dealt on: windows whose anchor has one of ``step`` neighbouring offsets, by the bytes
    that such windows share. Of equal pieces in one batch only the first is sent, as above."""
    def cut(batches):
        for batch in batches:
            h, piece, k, o, start, anchor = (batch.column(i).to_pylist() for i in range(6))
            seen, made, spans = set(), [], {}
            for i in sorted(range(len(h)), key=lambda i: (o[i], k[i], start[i])):
                p, last = anchor[i], len(piece[i]) - window
                for low in range((p - min(p, last)) // step * step, p + 1, step):       # offsets low to low + step - 1
                    high = min(low + step, window - gram + 1) - 1
                    a, b = max(0, p - high), min(last, p - low)
                    if a > b:
                        continue
                    part = piece[i][a: b + window]
                    shared = piece[i][p - low: p - high + window]
                    name = hashlib.blake2b(b"%d %d " % (h[i], low) + shared, digest_size=8).digest()
                    if (name, part) in seen:
                        spans.setdefault((k[i], o[i]), []).append((start[i] + a, start[i] + b + window))
                    else:
                        seen.add((name, part))
                        made.append((int.from_bytes(name, "big", signed=True), part, k[i], o[i], start[i] + a, p - a))
            yield _piece_rows(made, [(*where, unite(np.array(v, np.int64)).tobytes()) for where, v in spans.items()])

    return pieces.select("h", "piece", "k", "o", "start", "anchor").mapInArrow(cut, PIECES)


PIECES = "h long, piece binary, k long, o long, start long, anchor int, spans binary"


def _piece_rows(made: list[tuple], spans: list[tuple]) -> pa.RecordBatch:
    """Pieces (h, piece, k, o, start, anchor) and spans (k, o, spans) as rows of ``PIECES``."""
    n, m = len(made), len(spans)
    none = lambda c: [None] * c
    return pa.RecordBatch.from_arrays([
        pa.array([x[0] for x in made] + none(m), pa.int64()), pa.array([x[1] for x in made] + none(m), pa.binary()),
        pa.array([x[2] for x in made] + [x[0] for x in spans], pa.int64()),
        pa.array([x[3] for x in made] + [x[1] for x in spans], pa.int64()),
        pa.array([x[4] for x in made] + none(m), pa.int64()), pa.array([x[5] for x in made] + none(m), pa.int32()),
        pa.array(none(n) + [x[2] for x in spans], pa.binary())], ["h", "piece", "k", "o", "start", "anchor", "spans"])


def _bounded(pieces: DataFrame, window: int, gram: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """``pieces`` with the large grams split, and the bytes of all pieces. At most one gram a shard is large; up to
    ``FEW_NAMES`` of them are broadcast, more are joined by a shuffle."""
    done = None
    for step in (*STEPS, None):
        sizes = pieces.where("piece is not null").groupBy("h").agg(F.sum(F.octet_length("piece")).alias("size"))
        total, large = sizes.agg(F.sum("size"), F.max("size")).first()
        if step is None or (large or 0) <= shard_bytes:
            break
        names = stored(sizes.where(F.col("size") > shard_bytes).select("h"), "large_grams")
        names = F.broadcast(names) if names.count() <= FEW_NAMES else names
        rest = pieces.join(names, "h", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        pieces = stored(_split(pieces.join(names, "h", "left_semi"), step, window, gram), "parts")
    if done is None:
        return pieces, total or 0
    pieces = done.unionByName(pieces)
    return pieces, pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0


def repeated_windows(pieces: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each piece, in document order, the offsets of its windows that an earlier one equals."""
    text = np.zeros(1 + sum(map(len, pieces)) + len(pieces), np.uint16)
    owner = np.zeros(len(text), np.int32)
    offset = np.zeros(len(text), np.int32)
    at = 1
    for i, p in enumerate(pieces):
        text[at: at + len(p)] = np.frombuffer(p, np.uint8).astype(np.uint16) + 1
        owner[at: at + len(p) + 1] = i
        offset[at: at + len(p) + 1] = np.arange(len(p) + 1)
        at += len(p) + 1
    sizes = np.array([len(p) for p in pieces])
    position, common = sort_suffixes(text)
    group = np.cumsum(common < window)
    full = (offset[position] + window <= sizes[owner[position]]) & (text[position] > 0)
    position, group = position[full], group[full]
    rank = owner[position].astype(np.int64) * (int(sizes.max()) + 1) + offset[position]
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.minimum.reduceat(rank, start)
    late = rank > np.repeat(least, np.diff(np.append(start, len(rank))))
    who, where = owner[position[late]], offset[position[late]]
    order = np.lexsort((where, who))
    who, where = who[order], where[order]
    edge = np.searchsorted(who, np.arange(len(pieces) + 1))
    return [where[edge[i]: edge[i + 1]] for i in range(len(pieces))]


def _shard_spans(pieces: DataFrame, total: int, window: int, shard_bytes: int) -> DataFrame:
    """(k, o, spans) found by sorting the shards."""
    rows = pieces.where("piece is not null").select("h", "piece", "k", "o", "start")
    rows = rows.repartition(max(1, -(-total // shard_bytes)), "h").sortWithinPartitions("h")

    def sort(batches):
        gone: dict[tuple[int, int], list] = {}
        different: list[tuple] = []

        first: dict[bytes, tuple] = {}                    # the pieces of one gram; equal ones merge

        def settle():
            """If several pieces of the gram differ, they go to the sorter."""
            if len(first) > 1:
                different.extend((*where, piece) for piece, where in first.items())
            first.clear()

        def flush():
            if different:
                different.sort(key=lambda x: x[:3])
                for (o, k, start, _), late in zip(different, repeated_windows([x[3] for x in different], window)):
                    if len(late):
                        found = unite(np.stack([late, late + window], axis=1).astype(np.int64)) + start
                        gone.setdefault((k, o), []).extend(map(tuple, found.tolist()))
                different.clear()
            return spans()

        def spans():
            out = [(k, o, unite(np.array(v, np.int64)).tobytes()) for (k, o), v in gone.items()]
            gone.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate(
                (pa.int64(), pa.int64(), pa.binary()))], ["k", "o", "spans"])

        name, size, merged = None, 0, 0
        for batch in batches:
            for h, piece, k, o, start in zip(*(c.to_pylist() for c in batch.columns)):
                if h != name:
                    settle()
                    if size > 2 * shard_bytes or merged > HELD_SPANS:     # a shard may be cut between grams
                        yield flush()
                        size = merged = 0
                    name = h
                old, new = first.get(piece), (o, k, start)
                if old is None:
                    size += len(piece)
                else:
                    o, k, start = old if new < old else new
                    gone.setdefault((k, o), []).append((start, start + len(piece)))
                    merged += 1
                    if merged > HELD_SPANS:               # spans may go at any time
                        yield spans()
                        merged = 0
                if old is None or new < old:
                    first[piece] = new
        settle()
        yield flush()

    return rows.mapInArrow(sort, "k long, o long, spans binary")


def _cut_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(sha, n_removed, n_spans, kept_sha256) of the texts that lose something."""
    lists = spans.groupBy("k", "o").agg(F.collect_list("spans").alias("spans")).withColumnsRenamed({"k": "sk", "o": "so"})
    rows = texts.join(lists, (F.col("k") == F.col("sk")) & (F.col("o") == F.col("so"))).select("blob", "spans")

    def cut(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            sha, removed, count, kept = [], [], [], []
            for blob, parts in zip(batch.column(0), batch.column(1)):
                data = unpress.decompress(blob.as_py())
                spans = unite(np.concatenate([np.frombuffer(x, np.int64) for x in parts.as_py()]).reshape(-1, 2))
                left, at = hashlib.sha256(), 0
                for s, e in spans.tolist():
                    left.update(data[at:s])
                    at = e
                left.update(data[at:])
                sha.append(hashlib.sha256(data).digest())
                removed.append(int((spans[:, 1] - spans[:, 0]).sum()))
                count.append(len(spans))
                kept.append(left.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(sha, pa.binary()), pa.array(removed, pa.int64()),
                                              pa.array(count, pa.int64()), pa.array(kept)],
                                             ["sha", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(cut, "sha binary, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = stored(docs.select("doc_id", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("sha"),
                              F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    total = base.agg(F.sum("n_bytes")).first()[0] or 0
    # one bucket for ``bucket_bytes``, as long as Spark allows that many; beyond, buckets grow with the input
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    parts = min(most, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes)))
    texts = _unique_texts(docs, window, parts)
    pieces = _pieces(texts, _repeated_anchors(texts, window, gram, parts), window, gram)
    pieces, size = _bounded(pieces, window, gram, shard_bytes)
    spans = _shard_spans(pieces, size, window, shard_bytes).unionByName(pieces.where("spans is not null").select("k", "o", "spans"))
    changed = _cut_texts(texts, spans)
    firsts = base.groupBy("sha").agg(F.min(F.coalesce("doc_id", F.lit(LAST))).alias("first"))
    rows = base.join(firsts, "sha").join(changed, "sha", "left")
    long_ = F.col("n_bytes") >= window
    copy = long_ & (F.coalesce("doc_id", F.lit(LAST)) != F.col("first"))
    pick = lambda late, mine, else_: F.when(copy, late).otherwise(F.coalesce(mine, else_))
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("n_removed"), zero).alias("n_removed"),
                       pick(F.lit(1).cast("long"), F.col("n_spans"), zero).alias("n_spans"),
                       pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("kept_sha256"), F.lower(F.hex("sha"))).alias("kept_sha256"))


def op7_suffix_dedup(spark, sf_dir):
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
