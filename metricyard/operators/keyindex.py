"""Index of stored keys, for appends that neither scan nor shuffle the table.

Beside a table lies a folder ``<table>.keys/buckets=<n>/bucket=<b>/`` with one 128-bit digest for each stored row. A
digest is taken over the names and values of the columns that are not NULL, in the order of their names. So NULLs
match NULLs, a column that was added later changes no older digest (schema union), and column order plays no part.

A batch reads only the buckets that its own digests fall into (``bucket`` is a partition column, and the list of
buckets on the driver has at most ``n`` numbers), and of those only digests. If the batch's digests fit a broadcast
(measured), the index is filtered where it lies; otherwise both are shuffled by digest. The table itself is not read.

Rows are written before their digests. A writer that dies in between leaves fewer digests than rows; ``ensure``, called
when a writer starts, sees that from the two counts (Parquet footers) and rebuilds the index from the table, as
it does for a table that never had one. Two writers of one table must not run at the same time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import glob_paths
from .joins import fits_broadcast

BUCKETS = 64
DIGESTS = "digest binary, bucket int"


def _text(col: Column, kind: T.DataType) -> Column:
    """A text that is equal exactly for equal values."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(col.alias("v")))
    if isinstance(kind, T.BinaryType):
        return F.hex(col)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(col == 0, F.lit("0.0")).otherwise(col.cast("double").cast("string"))       # -0.0 equals 0.0
    return col.cast("string")


def row_digest(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """128 bits of SHA-256 over the names and values of the columns that are not NULL."""
    pieces = []
    for name in sorted(cols or df.columns):
        text = _text(F.col(f"`{name}`"), df.schema[name].dataType)
        pieces.append(F.when(text.isNotNull(), F.concat(F.lit(f"{len(name)}:{name}="), F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.substring(F.unhex(F.sha2(F.concat_ws("", *pieces), 256)), 1, 16)


def bucket_of(digest: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(buckets).cast("long")).cast("int")


class KeyIndex:
    """The digests of a Parquet table's keys (``key`` None: of whole rows)."""

    def __init__(self, spark: SparkSession, table_path: str, key: Sequence[str] | None = None, buckets: int = BUCKETS):
        self.spark, self.table_path, self.key = spark, table_path.rstrip("/"), key and list(key)
        known = glob_paths(spark, f"{self.table_path}.keys/buckets=*")
        self.buckets = int(known[0].rsplit("=", 1)[1]) if known else buckets        # fixed when the index is made
        self.path = f"{self.table_path}.keys/buckets={self.buckets}"

    def _stored_rows(self) -> DataFrame | None:
        from pyspark.errors import AnalysisException
        try:
            return self.spark.read.option("mergeSchema", self.key is None).parquet(self.table_path)
        except AnalysisException:
            return None

    def digests(self, buckets: Sequence[int] | None = None) -> DataFrame:
        if not glob_paths(self.spark, f"{self.path}/bucket=*"):
            return self.spark.createDataFrame([], DIGESTS)
        out = self.spark.read.schema(DIGESTS).parquet(self.path)
        return out if buckets is None else out.filter(F.col("bucket").isin(list(buckets)))

    def with_digest(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_digest", row_digest(df, self.key)).withColumn("_bucket", bucket_of("_digest", self.buckets))

    def ensure(self) -> "KeyIndex":
        """Makes the index agree with the table; returns itself."""
        rows = self._stored_rows()
        stored = 0 if rows is None else rows.count()
        if stored != self.digests().count():
            self._write(self.with_digest(rows) if rows is not None else self.spark.createDataFrame([], "_digest binary, _bucket int"),
                        "overwrite")
        return self

    def _write(self, rows: DataFrame, mode: str) -> None:
        out = rows.select(F.col("_digest").alias("digest"), F.col("_bucket").alias("bucket"))
        out.repartition("bucket").write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self.path)

    def absent(self, batch: DataFrame, order_col: str | None = None) -> DataFrame:
        """The rows of a stored batch whose key is not in the table, one for each key (the first by ``order_col``), with
        ``_digest`` and ``_bucket``."""
        rows = self.with_digest(batch)
        if order_col is None:
            rows = rows.dropDuplicates(["_digest"])
        else:
            rest = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "_digest"])
            rows = rows.groupBy("_digest").agg(F.min_by(rest, F.col(order_col)).alias("_r")).select("_digest", "_r.*")
        own = rows.select("_digest", "_bucket")
        touched = [r[0] for r in own.select("_bucket").distinct().collect()]                 # at most self.buckets numbers
        stored = self.digests(touched).select(F.col("digest").alias("_stored"))
        if fits_broadcast(own.select("_digest")):
            stored = stored.join(F.broadcast(own.select("_digest")), F.col("_stored") == F.col("_digest"), "left_semi")
        return rows.join(stored, rows["_digest"] == F.col("_stored"), "left_anti")

    def append(self, batch: DataFrame, order_col: str | None = None, write=None) -> int:
        """Appends the absent rows of a stored batch and their digests; returns how many. ``write`` may lay out the
        rows in its own way; by default they are plain Parquet files."""
        from ..session import cut_lineage
        new = cut_lineage(self.absent(batch, order_col))
        added = new.count()
        if added:
            rows = new.drop("_digest", "_bucket")
            write(rows, self.table_path) if write else rows.write.mode("append").parquet(self.table_path)
            self._write(new, "append")
        return added
