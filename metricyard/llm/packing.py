"""Operator 4, packing into optimal length buckets.

Documents are cut into segments of at most ``max_len`` tokens (none is dropped or shortened). The global
histogram of segment lengths has at most ``max_len + 1`` entries whatever the input, so it may go to the
driver, where dynamic programming finds the ``buckets`` boundaries of least total padding. Inside a bucket
of length L a batch has ``token_budget // L`` rows (at least one). Batch numbers are dense: segments are
dealt to chunks by hash, numbered inside their chunk, and shifted by the sizes of the chunks before it, so
no bucket, however large, is numbered in one task, and only the last batch of a bucket can be short.

Defined results: a null or empty text is one segment of 0 tokens; it takes a row of the smallest bucket.
Repeated rows are packed each. Ties in the padding go to the smaller boundary. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

MAX_LEN, TOKEN_BUDGET, BUCKETS, CHUNK_ROWS = 4096, 65_536, 16, 20_000


def optimal_buckets(lengths, counts, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` ranges of the sorted ``lengths`` with the least total padding
    when every item is padded to the bound of its range."""
    x, c = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    m = len(x)
    if not m:
        return []
    n_upto = np.concatenate([[0], np.cumsum(c)])
    s_upto = np.concatenate([[0], np.cumsum(c * x)])
    cost = x * n_upto[1:] - s_upto[1:]                       # one range up to each length
    cuts = []
    for _ in range(1, min(buckets, m)):
        best, cut = cost.copy(), np.zeros(m, np.int64)       # cut 0: no range before
        for j in range(1, m):
            with_cut = cost[:j] + x[j] * (n_upto[j + 1] - n_upto[1: j + 1]) - (s_upto[j + 1] - s_upto[1: j + 1])
            i = int(with_cut.argmin())
            if with_cut[i] < best[j]:
                best[j], cut[j] = with_cut[i], i + 1
        cuts.append(cut)
        cost = best
    bounds, j = [int(x[-1])], m - 1
    for cut in reversed(cuts):
        if not cut[j]:
            continue
        j = int(cut[j]) - 1
        bounds.append(int(x[j]))
    return bounds[::-1]


def segments(docs: DataFrame, max_len: int, tokens=None) -> DataFrame:
    """doc_id, th, seg_no, start, n_tokens; ``tokens`` is a column of token counts, else words count."""
    n = F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0)) if tokens is not None else word_count(F.col("text"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), n.alias("n"))
    last = F.greatest(F.ceil(F.col("n") / max_len) - 1, F.lit(0)).cast("long")
    rows = rows.select("doc_id", "th", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("seg_no"))
    start = F.col("seg_no") * max_len
    return rows.select("doc_id", "th", "seg_no", start.alias("start"),
                       F.least(F.col("n") - start, F.lit(max_len)).alias("n_tokens"))


def pack(docs: DataFrame, max_len: int = MAX_LEN, token_budget: int = TOKEN_BUDGET, buckets: int = BUCKETS,
         tokens=None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """doc_id, seg_no, start, n_tokens, bucket_len, batch_no (dense inside a bucket), row_no (in the batch)."""
    parts = stored(segments(docs, max_len, tokens), "segments")
    histogram = sorted((r["n_tokens"], r["count"]) for r in parts.groupBy("n_tokens").count().collect())
    bounds = optimal_buckets([x for x, _ in histogram], [c for _, c in histogram], buckets) or [max_len]
    chunks = max(1, -(-sum(c for _, c in histogram) // chunk_rows))
    bucket = F.lit(bounds[-1])
    for b in reversed(bounds[:-1]):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bucket)
    h = F.xxhash64("doc_id", "th", "seg_no")
    parts = parts.withColumn("bucket_len", bucket.cast("long")).withColumn("h", h).withColumn(
        "chunk", F.pmod(F.col("h"), F.lit(chunks)))
    before = Window.partitionBy("bucket_len").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.groupBy("bucket_len", "chunk").agg(F.count("*").alias("c")).withColumn(
        "shift", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    inside = Window.partitionBy("bucket_len", "chunk").orderBy("h", "doc_id", "seg_no")
    rows = F.greatest(F.floor(F.lit(token_budget) / F.greatest("bucket_len", F.lit(1))).cast("long"), F.lit(1).cast("long"))
    numbered = parts.withColumn("rn", F.row_number().over(inside) - 1).join(shift, ["bucket_len", "chunk"])
    at = F.col("rn") + F.col("shift")
    return numbered.select("doc_id", "seg_no", "start", "n_tokens", "bucket_len",
                           F.floor(at / rows).cast("long").alias("batch_no"), (at % rows).alias("row_no"))


def op4_length_buckets(spark, sf_dir):
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def pack_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last): the packed segments of the documents."""
    return pack(docs)
