"""Append, merge and update operators.

All of them are joins/aggregations planned by Catalyst; nothing is collected.
The driver only looks at column-name lists (schema evolution, common columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from .joins import fits_broadcast, null_safe_on, prefixed


def dedupe(df: DataFrame, key: Sequence[str] | None = None, order_col: str | None = None) -> DataFrame:
    """M5: drop duplicate rows (or duplicate keys). With ``order_col`` the first row in that
    order is kept; the choice is a partial aggregation (``min_by``) so hot keys are combined
    map-side before the shuffle."""
    if key is None:
        return df.dropDuplicates()
    key = list(key)
    if order_col is None:
        return df.dropDuplicates(key)
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(order_col)).alias("_first"))
    return picked.select(*key, "_first.*").select(*df.columns)


def scope_to_partitions(target: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Restrict the target to the partitions the batch touches (left-semi -> dynamic partition pruning)."""
    if not partition_cols:
        return target
    return target.join(batch.select(*partition_cols).distinct(), list(partition_cols), "left_semi")


def new_rows_if_absent(target: DataFrame, batch: DataFrame, key: Sequence[str],
                       partition_cols: Sequence[str] = (), order_col: str | None = None,
                       batch_stored: bool = False) -> DataFrame:
    """M1 rows to write: batch rows whose key (null-safe) is not stored yet; batch duplicates collapse.

    With ``batch_stored`` the batch is a stored table, cheap to read twice, and the bytes of its
    keys are measured. When they fit the broadcast threshold, the stored keys that collide with
    the batch are found by a left-semi join of the *target* against the broadcast keys, so the
    target is only scanned (and partition-pruned), never shuffled, and the batch is anti-joined
    with that small collision set. A larger stored batch sends a Bloom filter of its keys to the target
    instead, and one grouped pass over the batch and the few target rows that pass it decides. A batch that is
    not stored meets the whole target in that pass. All ways keep the batch row that comes first in ``order_col``.
    """
    key = list(key)
    b = dedupe(batch, key, order_col)
    scoped = scope_to_partitions(target, b, partition_cols)
    t = prefixed(scoped.select(*key), "_t_")
    tk = [f"_t_{c}" for c in key]
    bk = prefixed(b.select(*key), "_b_")
    if batch_stored and fits_broadcast(bk):
        hits = t.join(F.broadcast(bk), null_safe_on(t, bk, tk, [f"_b_{c}" for c in key]), "left_semi")
        return b.join(hits, null_safe_on(b, hits, key, tk), "left_anti").select(*batch.columns)
    return _new_rows_by_aggregate(likely_in(scoped, batch, key) if batch_stored else scoped, batch, key, order_col)


BLOOM_BITS = 1 << 26          # at most; as words of 64 bits, a broadcast of at most 2 ** 20 rows of two longs


def likely_in(target: DataFrame, batch: DataFrame, key: Sequence[str], most_bits: int = BLOOM_BITS) -> DataFrame:
    """Rows of ``target`` whose key may be in ``batch``: all that are, and of the others about one in sixteen, or
    more once the batch has more than ``most_bits`` / 16 keys. The filter sets one bit for each key hash (NULLs hash alike) and
    is broadcast as (word, bits); its size is bounded by ``most_bits``, whatever the batch. The target is scanned where it lies."""
    n = batch.count()
    bits = 1 << max(10, min(most_bits.bit_length() - 1, (16 * max(n, 1) - 1).bit_length()))

    def place(df):
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(bits).cast("long"))

    words = (batch.select(place(batch).alias("p")).select(F.shiftright("p", 6).alias("_w"), (F.col("p") % 64).cast("int").alias("b"))
                  .groupBy("_w").agg(F.bit_or(F.expr("1L << b")).alias("_bits")))
    t = target.withColumn("_p", place(target)).withColumn("_w", F.shiftright("_p", 6))
    kept = t.join(F.broadcast(words), "_w").filter(F.expr("(_bits >> CAST(_p % 64 AS INT)) & 1L = 1L"))
    return kept.select(*target.columns)


def _new_rows_by_aggregate(target: DataFrame, batch: DataFrame, key: Sequence[str], order_col: str | None) -> DataFrame:
    """M1 when the batch is too large to broadcast: one shuffle instead of de-dup + join.

    Stored keys (tag 0) and batch rows (tag 1) are unioned and grouped on the key -- grouping
    treats NULLs as equal, which is the null-safe key match. A key whose smallest tag is 1 is
    new; its non-key columns come from the batch row first in ``order_col`` order. Partial
    aggregation collapses duplicates map-side, so a hot key costs one row per task.
    """
    key = list(key)
    rest = [c for c in batch.columns if c not in key and c != order_col]
    kcols = [F.col(f"`{c}`") for c in key]
    carried = []                       # what a new key takes from its first batch row
    if order_col:
        carried.append(F.col(order_col).alias("_ord"))
    if rest:
        carried.append(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"))
    b = batch.select(*kcols, F.lit(1).alias("_src"), *carried)
    t = target.select(*kcols, F.lit(0).alias("_src"),
                      *[F.lit(None).cast(b.schema[n].dataType).alias(n) for n in ("_ord", "_rest")
                        if n in b.columns])
    aggs = [F.min("_src").alias("_src")]
    if order_col:
        aggs.append(F.min("_ord").alias("_ord"))
    if rest:
        aggs.append((F.min_by("_rest", F.col("_ord")) if order_col else F.first("_rest", ignorenulls=True))
                    .alias("_rest"))
    new = t.unionByName(b).groupBy(*key).agg(*aggs).filter(F.col("_src") == 1)
    cols = {c: F.col(f"`{c}`") for c in key}
    cols.update({c: F.col("_rest")[c].alias(c) for c in rest})
    if order_col:
        cols[order_col] = F.col("_ord").alias(order_col)
    return new.select(*[cols[c] for c in batch.columns])


def append_if_absent(target: DataFrame, batch: DataFrame, key: Sequence[str],
                     partition_cols: Sequence[str] = (), order_col: str | None = None,
                     batch_stored: bool = False) -> DataFrame:
    """M1: table state after the append (existing rows never change; first writer wins)."""
    new = new_rows_if_absent(target, batch, key, partition_cols, order_col, batch_stored)
    return target.unionByName(new.select(*target.columns))


def common_columns(target_cols: Sequence[str], batch_cols: Sequence[str], last: Sequence[str] = ("name", "value")) -> list[str]:
    """INTERSECT over column names, with ``last`` kept at the end when present."""
    common = [c for c in target_cols if c in set(batch_cols) and c not in last]
    return common + [c for c in last if c in target_cols and c in batch_cols]


def new_rows_except(target: DataFrame, batch: DataFrame, partition_cols: Sequence[str] = (),
                    batch_stored: bool = False) -> DataFrame:
    """M2 rows to write: ``batch EXCEPT target`` over the common columns (NULLs equal, batch
    duplicates collapse). Planned like M1 with every common column as the key."""
    common = common_columns(target.columns, batch.columns)
    return new_rows_if_absent(target.select(*common), batch.select(*common), common, partition_cols,
                              batch_stored=batch_stored)


def append_except(target: DataFrame, batch: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """M2: table state after ``INSERT (common) SELECT common FROM batch EXCEPT SELECT common FROM target``."""
    return target.unionByName(new_rows_except(target, batch, partition_cols), allowMissingColumns=True)


def append_distinct_all(existing: DataFrame, new: DataFrame) -> DataFrame:
    """M3: concat by name (schema union) and drop full duplicates."""
    return existing.unionByName(new, allowMissingColumns=True).dropDuplicates()


def evolve_schema(target: DataFrame, batch: DataFrame, fixed_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """M4: rename batch columns with C2 (ledger L-20: rename first), then add the batch's
    new columns to the target as NULL text. Column names only are inspected on the driver."""
    renamed = {c: (c if c in fixed_cols else clean.clean_column_name_py(c)) for c in batch.columns}
    b = batch.select(*[F.col(f"`{c}`").alias(renamed[c]) for c in batch.columns])
    t = target
    for c in b.columns:
        if c not in t.columns:
            t = t.withColumn(c, F.lit(None).cast("string"))
    return t, b


def evolve_append(target: DataFrame, batch: DataFrame, fixed_cols: Sequence[str] = ()) -> DataFrame:
    """M4 + M2: widen the target, then append the set difference."""
    t, b = evolve_schema(target, batch, fixed_cols)
    return append_except(t, b)


def probe_rows(batch: DataFrame, group_cols: Sequence[str], order_col: str | Sequence[str], n: int = 2) -> DataFrame:
    """The n-th row per group in ``order_col`` order. ``row_number() = n`` lets Spark put a
    per-partition group limit before the shuffle, so a hot group does not move all its rows."""
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    w = Window.partitionBy(*group_cols).orderBy(*[F.col(c) for c in order])
    return batch.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n).drop("_rn")


def batch_seen_by_probe(batch: DataFrame, target: DataFrame, group_cols: Sequence[str], order_col: str | Sequence[str],
                        key: Sequence[str], n: int = 2) -> DataFrame:
    """M6: skip whole groups whose n-th row is already in the target (optional, ledger L-5)."""
    probes = probe_rows(batch, group_cols, order_col, n)
    t = prefixed(target.select(*key), "_t_")
    seen = (probes.join(t, null_safe_on(probes, t, key, [f"_t_{c}" for c in key]), "left_semi")
                  .select(*group_cols).distinct())
    return batch.join(seen, list(group_cols), "left_anti").select(*batch.columns)


def changed_since(content_hash: DataFrame, last_run: DataFrame, key: str = "path") -> DataFrame:
    """M7: files whose content hash differs from (or is absent in) the last run log."""
    return content_hash.join(last_run, [key, "sha256"], "left_anti")


def set_status(df: DataFrame, match: Column, status_col: str = "ProjStatus",
               from_status: str = "Delivered", to_status: str = "Undelivered") -> DataFrame:
    """Rows matching ``match`` and having ``from_status`` get ``to_status``; other rows unchanged."""
    cond = match & (F.col(status_col) == F.lit(from_status))
    return df.withColumn(status_col, F.when(cond, F.lit(to_status)).otherwise(F.col(status_col)))


def status_scope(df: DataFrame, run_type_col: str, run_type: str, samples: DataFrame | None = None,
                 sample_col: str = "Sample_Name") -> DataFrame:
    """Rows of one run type (and optional sample list), whatever their status."""
    scoped = df.filter(F.col(run_type_col) == F.lit(run_type))
    if samples is not None:
        scoped = scoped.join(samples.select(F.col(samples.columns[0]).alias(sample_col)).distinct(), sample_col, "left_semi")
    return scoped


def update_status(df: DataFrame, run_type_col: str, run_type: str, samples: DataFrame | None = None,
                  sample_col: str = "Sample_Name", status_col: str = "ProjStatus",
                  from_status: str = "Delivered", to_status: str = "Undelivered") -> DataFrame:
    """U1 expressed as a join: scope rows are flagged through a left-semi-equivalent left join
    on the sample list, so the list never becomes SQL text (ledger L-26)."""
    flagged = df.withColumn("_in_run", F.col(run_type_col) == F.lit(run_type))
    if samples is not None:
        s = samples.select(F.col(samples.columns[0]).alias("_s")).distinct().withColumn("_hit", F.lit(True))
        flagged = flagged.join(s, flagged[sample_col] == s["_s"], "left").drop("_s")
        match = F.col("_in_run") & F.coalesce(F.col("_hit"), F.lit(False))
        out = set_status(flagged, match, status_col, from_status, to_status).drop("_hit")
    else:
        out = set_status(flagged, F.col("_in_run"), status_col, from_status, to_status)
    return out.drop("_in_run")
