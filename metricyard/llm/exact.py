"""Operator 3, exact dedup by skew-safe combining. DataFrame operations only.

Equal texts are found by grouping on the digest *and* the full text, in three steps: Spark's
map-side aggregation removes copies inside each task, the exchange that follows groups by
(digest, text, salt), and a second one combines the salt winners by (digest, text). A group that
holds a third of all rows thus reaches any task as at most one row per input task and salt.

Defined results: a null text counts as the empty text, so null and empty rows are copies of each
other. Rows are never merged: repeated rows each get a result row. Rows with a null id take part;
they never stay while their group has an id, and a group without any id keeps ``keep_id`` null and
``kept`` true. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SALTS = 16


def sha_digest(body) -> F.Column:
    return F.unhex(F.sha2(F.encode(body, "UTF-8"), 256))


def _bodies(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body")).withColumn(
        "digest", digest(F.col("body")))


def text_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, body) groups with the id that stays and the number of rows, by salted combining."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    local = salted.groupBy("digest", "body", "salt").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    return local.groupBy("digest", "body").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest=sha_digest) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    Documents find their group by digest alone while only one text has that digest. Should different
    texts share a digest, their rows are matched on the full text as well (``digest`` is a parameter
    so that tests can force this).
    """
    rows = _bodies(docs, id_col, text_col, digest)
    by_digest = stored(
        text_groups(rows, salts).groupBy("digest").agg(
            F.count("*").alias("n_texts"), F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size")), "digests")
    result = rows.select("doc_id", "digest").join(by_digest.where("n_texts = 1").drop("n_texts"), "digest")
    shared = by_digest.where("n_texts > 1").select("digest")
    if not shared.isEmpty():
        clash = rows.join(shared, "digest", "left_semi")
        result = result.unionByName(
            clash.join(text_groups(clash, salts), ["digest", "body"]).select(
                "digest", "doc_id", "keep_id", "group_size"))
    return result.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         "digest")


def op3_exact_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept",
                                    F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def keep_one_copy(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the row that stays of each group of equal texts, with the columns of ``docs``.

    Fully repeated rows (same id and text) leave one row."""
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"))
    rows = docs.withColumn("__digest", sha_digest(F.coalesce("text", F.lit(""))))
    rows = rows.join(kept.distinct(), F.col("doc_id").eqNullSafe(F.col("__id"))
                     & (rows["__digest"] == kept["__digest"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "__digest"]).select(*docs.columns)
