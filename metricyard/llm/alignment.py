"""Operator 13, alignment of two tokenizers with inverted pair bitmaps.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file), B a sentencepiece model that adds a space in front. Both
encode each whole text, A with a space put before it, so that both cover the same bytes. An A and a B token that
share bytes are linked; byte offsets where both end cut the text into groups.

Links without pairing tokens: the ends of both, merged, cut the bytes into intervals, and every interval lies in
exactly one A and one B token, so intervals and links are the same thing. Neither tokenizer has a token that runs
from a character into a space behind it, so texts are cut into pieces before such spaces, and a task encodes and
aligns every distinct piece once while it remembers it (``REMEMBER``; ``load_tokenizers`` refuses a B without this
property).

The corpus-wide part is an inverted index of id pairs:

1. Tasks write their documents in runs of at most ``RUN_DOCS`` documents and about ``RUN_LINKS`` entries. Of each
   run and id pair they write the bitmap of the documents that hold the pair (plane -1) and the bit planes of
   ``multiplicity - 1`` (plane k holds the documents whose number has bit k). A bitmap is compressed: 16-bit
   positions if few documents hold the pair, packed bits if many do.
2. Bitmaps of one pair are OR-ed inside a run while they are built; different runs hold different documents, so
   from there on the OR is a list and popcounts add up: ``n_docs`` is the sum over plane -1, ``n_links`` adds
   2**k times the popcount of plane k. Only counts are shuffled for this, added up in tasks first.
3. ``best`` marks pairs whose count is the highest of their A id. The highest counts have one row per id of A,
   at most the vocabulary, and are broadcast.
4. Runs ask for the counts of their pairs, by keys alone; there, bitmaps and planes turn into scores by document.

Defined results: a null or empty text, and one whose joined tokens differ from it (as with U+2581), has no tokens:
zeros and an empty ``groups_sha256``. Repeated rows and rows with a null id are documents of their own. Ties for the
highest count are all best. Very long texts are one document of a run. An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_dir, stored

TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
RUN_DOCS, RUN_LINKS = 1 << 13, 3_000_000
STEP_CHARS = 2_000_000          # characters of texts that are cut and looked up at once
REMEMBER = 400_000              # distinct pieces that a task remembers
LONG_PIECE = 200                # longer pieces are not remembered beyond their step
PAIR = 20                       # bits of an id in a pair

# From a text with a space in front: pieces end before a space that follows another character; white space at the
# end of the text stays with the last piece.
PIECE = re.compile(r"\s*\S+(?:[^\S ]\s*\S*)*(?:\s+\Z)?|\s+")

DOC = pa.schema([("kind", pa.int8()), ("run", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                 ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                 ("pair", pa.int64()), ("plane", pa.int8()), ("dense", pa.bool_()), ("bits", pa.binary())])
DOC_DDL = ("kind byte, run long, pos int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, pair long, plane byte, dense boolean, bits binary")


def byte_level() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest counts up from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_tokenizers(file_a: bytes, file_b: bytes):
    """(encode lists of A ids, encode lists of B ids, bytes of the tokens of A, of B); B's texts come without the space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(file_a.decode())
    a.encode_special_tokens = True
    table = byte_level()
    bytes_a = [bytes(table.get(c, 63) for c in a.id_to_token(i) or "") for i in range(a.get_vocab_size())]
    b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
    bytes_b = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if re.search("[^▁]▁", piece):
            raise ValueError("tokens of B run over the start of words")
        bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    batch = getattr(a, "encode_batch_fast", a.encode_batch)
    return (lambda texts: [e.ids for e in batch(texts, add_special_tokens=False)],
            lambda texts: b.encode(texts, num_threads=1), bytes_a, bytes_b)


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind=np.int64):
        self.all, self.n = np.zeros(1024, kind), 0

    def add(self, values):
        if self.n + len(values) > len(self.all):
            self.all = np.resize(self.all, 2 * (self.n + len(values)))
        self.all[self.n: self.n + len(values)] = values
        self.n += len(values)


class Pieces:
    """Distinct pieces of texts with their tokens, links and groups."""

    def __init__(self, tokenizers):
        self.encode_a, self.encode_b, self.bytes_a, self.bytes_b = tokenizers
        self.len_a, self.len_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.clear()

    def clear(self):
        self.index, self.groups, self.long = {}, [], []
        self.n_a, self.n_b, self.n_groups, self.n_links, self.at, self.pairs = (Growing() for _ in range(6))
        self.good = Growing(bool)

    def look_up(self, pieces: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(p for p in pieces if p not in self.index))
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.add(new)
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))

    def add(self, new: list[str]):
        raw = [p.encode() for p in new]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ids_b = self.encode_b([p[1:] for p in new])
        n_b = np.fromiter(map(len, ids_b), np.int64, len(ids_b))
        b = np.fromiter(chain.from_iterable(ids_b), np.int64, n_b.sum())
        a, n_a = self.joined_a(new, lens)
        good = np.ones(len(new), bool)
        if any(b"".join(map(table.__getitem__, ids.tolist())) != b"".join(raw) for ids, table in ((a, self.bytes_a), (b, self.bytes_b))):
            ids_a = self.encode_a(new)
            n_a = np.fromiter(map(len, ids_a), np.int64, len(ids_a))
            a = np.fromiter(chain.from_iterable(ids_a), np.int64, n_a.sum())
            for i, (x, p, q) in enumerate(zip(raw, ids_a, ids_b)):
                good[i] = b"".join(map(self.bytes_a.__getitem__, p)) == x == b"".join(map(self.bytes_b.__getitem__, q))
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b, lens = n_a * good, n_b * good, lens * good
        ends = np.cumsum(lens)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        cuts = np.union1d(end_a, end_b)                   # one interval, so one link, ends at each
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        links = np.diff(np.searchsorted(cuts, ends, "right"), prepend=0)
        groups = np.diff(np.searchsorted(both, ends, "right"), prepend=0)
        pairs = (a[np.searchsorted(end_a, cuts)] << PAIR) | b[np.searchsorted(end_b, cuts)]
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        i = j = 0
        named = []
        for p, q in zip(np.searchsorted(end_a, both, "right").tolist(), np.searchsorted(end_b, both, "right").tolist()):
            named.append(f"{','.join(text_a[i:p])}|{','.join(text_b[j:q])}")
            i, j = p, q
        k = 0
        for n in groups.tolist():
            self.groups.append(named[k] if n == 1 else ";".join(named[k: k + n]))
            k += n
        self.at.add(self.pairs.n + np.cumsum(links) - links)
        for own, values in ((self.n_a, n_a), (self.n_b, n_b), (self.n_groups, groups), (self.n_links, links),
                            (self.pairs, pairs), (self.good, good)):
            own.add(values)
        self.long += [p for p in new if len(p) > LONG_PIECE]

    def joined_a(self, new: list[str], lens: np.ndarray):
        """A's ids of all pieces, and how many each has. Pieces that end in no white space are encoded as one text of
        many: the next one starts with a space there, which no token of A runs into."""
        texts, held = [], []
        for p in new:
            held.append(p)
            if p[-1].isspace() or len(held) == 500:
                texts.append("".join(held))
                held = []
        ids = self.encode_a([*texts, "".join(held)])
        a = np.fromiter(chain.from_iterable(ids), np.int64)
        return a, np.diff(np.searchsorted(np.cumsum(self.len_a[a]), np.cumsum(lens), "right"), prepend=0)

    def forget(self):
        """Keeps what a task remembers within bounds."""
        if len(self.index) > REMEMBER or self.long:
            self.clear()


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[0], starts[0] + 1, ... of all ranges, one after another."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)


def step_of(texts: list[str | None], known: Pieces):
    """Counts, group hashes and (pair, document, multiplicity) entries of some texts."""
    cut = [PIECE.findall(" " + t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    ids = known.look_up(list(chain.from_iterable(cut)))
    doc = np.repeat(np.arange(len(cut)), sizes)
    bad = np.zeros(len(cut), bool)
    bad[doc[~known.good.all[ids]]] = True
    if bad.any():
        keep = ~bad[doc]
        ids, doc, sizes = ids[keep], doc[keep], np.where(bad, 0, sizes)
    counts = []
    for per_piece in (known.n_a, known.n_b, known.n_groups, known.n_links):
        total = np.concatenate([[0], np.cumsum(per_piece.all[ids])])
        ends = np.cumsum(sizes)
        counts.append(total[ends] - total[ends - sizes])
    hashes, at, listed = [], 0, ids.tolist()
    for n in sizes.tolist():
        hashes.append(hashlib.sha256(";".join([known.groups[i] for i in listed[at: at + n]]).encode()).hexdigest() if n else "")
        at += n
    both, times = np.unique((doc << 40) | ids, return_counts=True)
    ids, doc = both & ((1 << 40) - 1), both >> 40
    n = known.n_links.all[ids]
    pairs = known.pairs.all[spread(known.at.all[ids], n)]
    return counts, hashes, (pairs, np.repeat(doc, n), np.repeat(times, n))


def postings(pair, doc, times):
    """Compressed bitmaps and multiplicity planes of a run: (pair, plane, dense, bits) arrays, by pair."""
    order = np.lexsort((doc, pair))
    pair, doc, times = pair[order], doc[order], times[order]
    first = np.ones(len(pair), bool)
    first[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    pair, doc, times = pair[at], doc[at].astype(np.uint16), np.add.reduceat(times, at, dtype=np.int64) if len(at) else times
    parts = [(-1, pair, doc)]
    k, more = 0, times - 1
    while (more >> k).any():
        has = (more >> k) & 1 == 1
        parts.append((k, pair[has], doc[has]))
        k += 1
    out = []
    for plane, pair, doc in parts:
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        at = np.flatnonzero(new)
        size = np.diff(at, append=len(pair))
        dense = size > RUN_DOCS // 16
        few = ~np.repeat(dense, size)
        bounds = np.concatenate([[0], np.cumsum(2 * size[~dense])]).astype(np.int32)
        short = pa.Array.from_buffers(pa.binary(), int((~dense).sum()), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(doc[few].tobytes())])
        long = []
        for i, n in zip(at[dense].tolist(), size[dense].tolist()):
            bits = np.zeros(RUN_DOCS, bool)
            bits[doc[i: i + n]] = True
            long.append(np.packbits(bits, bitorder="little").tobytes())
        for which, blobs in ((~dense, short), (dense, pa.array(long, pa.binary()))):
            keys = pair[at[which]]
            out.append((pa.array(keys, pa.int64()), pa.array(np.full(len(keys), plane, np.int8)),
                        pa.array(np.full(len(keys), which is dense)), blobs))
    return [pa.concat_arrays(x) for x in zip(*out)]


def aligned(docs: DataFrame, file_a: bytes, file_b: bytes) -> DataFrame:
    """One row per document (kind 0) and per run, pair and plane (kind 1), from (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((file_a, file_b))

    def work(batches):
        known = Pieces(load_tokenizers(*shared.value))
        task, run, here = TaskContext.get().partitionId(), 0, 0
        entries = []

        def rows(kind, **columns):
            n = len(next(iter(columns.values())))
            whole = {"kind": pa.array(np.full(n, kind, np.int8)), "run": pa.array(np.full(n, (task << 32) | run)), **columns}
            return pa.RecordBatch.from_arrays([whole[f.name].cast(f.type) if f.name in whole else pa.nulls(n, f.type) for f in DOC], schema=DOC)

        def flush():
            nonlocal entries, run, here
            if entries:
                columns = postings(*map(np.concatenate, zip(*entries)))
                for i in range(0, len(columns[0]), 50_000):
                    yield rows(1, **dict(zip(("pair", "plane", "dense", "bits"), (c.slice(i, 50_000) for c in columns))))
            entries, run, here = [], run + 1, 0

        for ids, texts in steps(batches):
            if here + len(ids) > RUN_DOCS or sum(len(e[0]) for e in entries) > RUN_LINKS:
                yield from flush()
            counts, hashes, (pair, doc, times) = step_of(texts, known)
            entries.append((pair, (doc + here).astype(np.uint16), times.astype(np.int32)))
            yield rows(0, pos=pa.array(np.arange(here, here + len(ids))), doc_id=ids, groups_sha256=pa.array(hashes, pa.string()),
                       **{k: pa.array(v) for k, v in zip(("n_a", "n_b", "n_groups", "n_links"), counts)})
            here += len(ids)
            known.forget()
        yield from flush()

    def steps(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and end - at < RUN_DOCS and (end == at or chars < STEP_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                yield batch.column(0).slice(at, end - at), texts[at:end]
                at = end

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, DOC_DDL)


def align_tokens(docs: DataFrame, file_a: str = f"{TOKENIZERS}/{FILE_A}", file_b: str = f"{TOKENIZERS}/{FILE_B}"):
    """(documents, pairs): documents has one row per row of ``docs`` (doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256); pairs has one row per linked id pair (a, b, n_docs, n_links, best)."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark)}/aligned-{uuid.uuid4().hex}"
    rows = aligned(docs, open(file_a, "rb").read(), open(file_b, "rb").read())
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    of = lambda kind: spark.read.schema(rows.schema).parquet(path).where(F.col("kind") == kind)
    lists = of(1).select("run", "pair", "plane", "dense", "bits")
    popcount = F.when(F.col("dense"), F.bitmap_count("bits")).otherwise(F.octet_length("bits") / 2).cast("long")
    pairs = stored(lists.select("pair", "plane", popcount.alias("n")).groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == -1, F.col("n")).otherwise(F.lit(0))).alias("n_docs"),
        F.sum(F.when(F.col("plane") == -1, F.col("n")).otherwise(F.expr("n << CAST(plane AS INT)"))).alias("n_links"))
        .select(F.shiftright("pair", PAIR).alias("a"), "pair", "n_docs", "n_links"), "pairs")
    most = pairs.groupBy("a").agg(F.max("n_docs").alias("most"))           # a row per id of A that occurs
    pairs = pairs.join(F.broadcast(most), "a").select(
        "pair", "a", (F.col("pair").bitwiseAND(F.lit((1 << PAIR) - 1))).alias("b"), "n_docs", "n_links",
        (F.col("n_docs") == F.col("most")).alias("best"))
    # each run asks for the counts of its pairs; bitmaps travel once, to their run
    asked = of(1).where("plane = -1").select("run", "pair")
    told = asked.join(pairs.select("pair", "n_docs", "best").hint("merge"), "pair")
    about = ["pos", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    both = of(0).select("run", *about).unionByName(told, allowMissingColumns=True)
    out = lists.groupBy("run").cogroup(both.groupBy("run")).applyInArrow(
        scores, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out, pairs.drop("pair")


def scores(lists: pa.Table, both: pa.Table) -> pa.Table:
    """Turns the postings of a run back into sums by document; ``both`` has its documents and the counts of its pairs."""
    docs, told = both.filter(both.column("pos").is_valid()), both.filter(both.column("pair").is_valid()).sort_by("pair")
    known, n_docs, is_best = (told.column(c).to_numpy() for c in ("pair", "n_docs", "best"))
    total, best = np.zeros(RUN_DOCS, np.int64), np.zeros(RUN_DOCS, np.int64)
    for part in lists.to_batches():
        plane, dense, pair = (part.column(c).to_numpy(zero_copy_only=False) for c in ("plane", "dense", "pair"))
        bits, at = part.column("bits"), np.searchsorted(known, pair)
        few = np.flatnonzero(~dense)
        short = bits.take(pa.array(few)).to_pylist()
        size = np.fromiter(map(len, short), np.int64, len(short)) // 2
        spots = [np.frombuffer(b"".join(short), np.uint16).astype(np.int64)]
        owner = [np.repeat(few, size)]
        for i in np.flatnonzero(dense).tolist():
            spots.append(np.flatnonzero(np.unpackbits(np.frombuffer(bits[i].as_buffer(), np.uint8), bitorder="little")))
            owner.append(np.full(len(spots[-1]), i))
        spots, owner = np.concatenate(spots), np.concatenate(owner)
        weight = np.left_shift(1, np.maximum(plane, 0).astype(np.int64))
        np.add.at(total, spots, (weight * n_docs[at])[owner])
        np.add.at(best, spots, (weight * is_best[at])[owner])
    pos = docs.column("pos").to_numpy()
    sums = {"n_best": pa.array(best[pos]), "count_sum": pa.array(total[pos])}
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.table({k: sums[k] if k in sums else docs.column(k) for k in names})


def op13_pair_bitmaps(spark, sf_dir, tokenizers: str = TOKENIZERS):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokens(docs, f"{tokenizers}/{FILE_A}", f"{tokenizers}/{FILE_B}")[0]
