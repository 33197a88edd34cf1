"""Join helpers: checked broadcast, null-safe key joins, salted joins for hot keys.

* ``fits_broadcast`` measures a side's real bytes against the session's broadcast
  threshold; beyond the bound callers use a plan that broadcasts nothing.
* ``salted_left_join`` spreads one hot key over ``salt`` tasks: the big side
  gets a salt derived from a hash of its row, the small per-key side is
  replicated ``salt`` times. Used where one project/group may hold a third of
  all rows (lanes x samples, per-project enrichment).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def broadcast_threshold(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    raw = str(conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).lower()
    m = re.fullmatch(r"(-?\d+)([kmg]?)b?", raw)
    return int(m[1]) * {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}[m[2]] if m else 10 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, summed over the real lengths of their values (one small aggregate)."""
    row = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16) for c in df.columns), F.lit(16))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Size check before a broadcast: the measured bytes must stay under the broadcast threshold."""
    limit = broadcast_threshold(df) if max_bytes is None else max_bytes
    return limit > 0 and measured_bytes(df) <= limit


def prefixed(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in cols])


def null_safe_on(left: DataFrame, right: DataFrame, lcols: Sequence[str], rcols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{a}`"].eqNullSafe(right[f"`{b}`"]) for a, b in zip(lcols, rcols)])


def salt_column(cols: Sequence[str], salt) -> Column:
    """Deterministic salt in [0, salt) from a hash of the given columns (re-running a task
    after an executor loss gives the same salt). ``salt`` may be a column (per-row bound)."""
    n = salt if isinstance(salt, Column) else F.lit(salt)
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), n.cast("long")).cast("int")


def hot_keys(big: DataFrame, on: Sequence[str], share: float) -> DataFrame:
    """Keys holding more than ``share`` of all rows of ``big``. At most ``1 / share`` keys can
    qualify, so the result has a proven size bound and may be broadcast."""
    counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    total = big.select(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("_rows") > total * F.lit(share)).select(*on)


def salted_left_join(big: DataFrame, small: DataFrame, on: Sequence[str], salt: int | None = None,
                     salt_from: Sequence[str] | None = None, hot_share: float = 0.01) -> DataFrame:
    """Left join on ``on`` where a hot key of ``big`` is split ``salt`` ways.

    Hot keys (more than ``hot_share`` of the rows, so at most ``1 / hot_share`` of them) are
    found by one aggregation and broadcast; only their rows get a salt in ``[0, salt)`` and only
    their ``small`` rows are replicated ``salt`` times. Other keys join unsalted, so the small
    side does not grow with the number of keys. ``small`` must hold few rows per key.
    ``salt`` defaults to the session's shuffle partition count.
    """
    on = list(on)
    n = salt or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    if n <= 1:
        return big.join(small, on, "left")
    hot = F.broadcast(hot_keys(big, on, hot_share).withColumn("_hot", F.lit(True)))
    src = list(salt_from or big.columns)
    b = (big.join(hot, on, "left")
            .withColumn("_salt", F.when(F.col("_hot"), salt_column(src, n)).otherwise(F.lit(0)))
            .drop("_hot"))
    s = (small.join(hot, on, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col("_hot"), F.lit(n - 1))
                                                                   .otherwise(F.lit(0)))))
              .drop("_hot"))
    return b.join(s, on + ["_salt"], "left").drop("_salt")
