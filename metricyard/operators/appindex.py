"""A1 kept up by increments: exact distinct sample counts from bitmaps that merge.

Every sample of a source gets a dense number once (``samples``). Each batch of rows adds, for the (Application,
Investigator_Folder) groups it touches, bitmaps of the numbers it saw (``bitmap_construct_agg``, 32,768 numbers each).
The index ORs the bitmaps of a group (``bitmap_or_agg``) and adds up their ``bitmap_count``. An OR takes the same rows
twice without harm, so a batch that is tried again, or a whole table handed over to catch up, gives the same counts.
``noted`` keeps the number of table rows that the bitmaps stand for; where it differs from the table, a run died in
between (or the table is older than the state), and ``catch_up`` hands the table over.

Only the applications of a batch are read and written: both tables are partitioned by ``Application``, of which there
are as many as the routing rules name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.tables import read_version, table_or_empty, write_version
from .numbering import numbered

SAMPLES = "source string, sample string, n bigint, Application string"
BITMAPS = "source string, Investigator_Folder string, bucket bigint, bits binary, Application string"
NOTED = "source string, rows bigint"


class AppIndex:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        return table_or_empty(self.spark, f"{self.root}/{name}", schema)

    def noted(self, source: str) -> int | None:
        row = read_version(self.spark, f"{self.root}/noted", NOTED).filter(F.col("source") == source).first()
        return None if row is None else row["rows"]

    def note(self, source: str, rows: int) -> None:
        others = read_version(self.spark, f"{self.root}/noted", NOTED).filter(F.col("source") != source)
        write_version(others.unionByName(self.spark.createDataFrame([(source, rows)], NOTED)), f"{self.root}/noted")

    def add(self, source: str, rows: DataFrame, sample_col: str) -> None:
        """Takes the groups and samples of some rows into the state."""
        seen = cut_lineage(rows.filter("Application IS NOT NULL AND Investigator_Folder IS NOT NULL").select(
            "Application", "Investigator_Folder", F.col(sample_col).cast("string").alias("sample")).distinct())
        touched = [r[0] for r in seen.select("Application").distinct().collect()]
        if not touched:
            return
        known = self._table("samples", SAMPLES).filter(F.col("Application").isin(touched) & (F.col("source") == source))
        new = seen.filter("sample IS NOT NULL").select("Application", "sample").distinct().join(
            known, ["Application", "sample"], "left_anti")
        last = self._table("samples", SAMPLES).agg(F.max("n")).first()[0] or 0
        fresh = numbered(new, ["Application", "sample"], last + 1, "n").withColumn("source", F.lit(source))
        fresh.select("source", "sample", "n", "Application").write.mode("append").partitionBy("Application").parquet(f"{self.root}/samples")
        known = self._table("samples", SAMPLES).filter(F.col("Application").isin(touched) & (F.col("source") == source))
        bits = seen.join(known.drop("source"), ["Application", "sample"], "left").groupBy(
            "Application", "Investigator_Folder", F.bitmap_bucket_number("n").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))
        bits.select(F.lit(source).alias("source"), "Investigator_Folder", "bucket", "bits", "Application").write.mode(
            "append").partitionBy("Application").parquet(f"{self.root}/bitmaps")

    def catch_up(self, source: str, table: DataFrame, sample_col: str) -> bool:
        """Hands the whole table over if the state does not stand for all of its rows; true if it had to."""
        rows = table.count()
        if self.noted(source) == rows:
            return False
        self.add(source, table, sample_col)
        self.note(source, rows)
        return True

    def index(self) -> DataFrame:
        """(Application, Investigator_Folder, Sample_Count) by source; a group without any sample counts 0."""
        group = ["source", "Application", "Investigator_Folder"]
        whole = self._table("bitmaps", BITMAPS).groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        count = F.sum(F.when(F.col("bucket").isNull(), F.lit(0)).otherwise(F.bitmap_count("bits")))
        return whole.groupBy(*group).agg(count.cast("bigint").alias("Sample_Count")).drop("source")
