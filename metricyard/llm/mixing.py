"""Operator 10, mixing sources to target weights by Pareto order sampling. DataFrame operations only.

Every document of a source with target T and size S is expected ``e`` times: T / S on the average of its words, in
proportion to ``size ** -tilt`` or a weight column inside the source, and no document above ``cap``. ``floor(e)`` whole copies are certain; the rest
``p = e - floor(e)`` is its inclusion probability for one copy more. Pareto order sampling ranks the
documents by ``(u / (1 - u)) / (p / (1 - p))`` with ``u`` drawn from a hash of the id, and takes them
in that order until the source's word target is reached. The sample's size is thus fixed, in words.
The document that would cross the target is passed over, and ``FILL`` short rounds fill the rest with
the next documents in rank that still fit.

The cut in a source is found without ordering the source in one task: the ranks fall into ``SLOTS``
slots, words are summed by (source, slot), and only the slot in which the target falls is ordered by row.

Defined results: a null text has size 0; a null source is a source of its own, last in order. A source
of size 0 has target 0 and takes nothing, as do all documents of size 0. Repeated rows are sampled each;
they share a rank and are interchangeable. A null id is an id like any other. Reruns agree, because
ranks depend on ids and the seed only. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .common import stored, word_count

SOURCE_WEIGHTS = (5, 2, 1)
CAP = 3.0
SLOTS = 4096
FILL = 3
TILT = 0.5                   # in the registered query, expected copies go as a document's size to the power of minus this
FEW_SOURCES = 100_000        # up to so many, tables of one short row per source are broadcast


def source_targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """source -> (source_size, target), from sums alone: no task orders or holds the sources.

    Reshared excess ends where no target is above its cap: target = min(cap size, weight x level) for one level. The
    level rises from an equal share: sources at their cap give it up, the others share what is left, until no more
    source reaches its cap. Each step is one sum over the sources."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = numbered(per, [F.col("source").asc_nulls_last()], col="k")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("k") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(cap))
    goal, free = per.agg(F.sum("source_size") * F.lit(share), F.sum("w")).first()
    level, at_cap = (goal or 0.0) / (free or 1.0), -1
    while True:
        full = F.col("most") <= F.col("w") * F.lit(level)
        n, taken, free = per.agg(F.count_if(full), F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                                 F.sum(F.when(~full, F.col("w")).otherwise(0.0))).first()
        if n == at_cap or not free:
            return per.select("source", "source_size", F.when(full, F.col("most")).otherwise(F.col("w") * F.lit(level)).alias("target"))
        level, at_cap = max(level, (goal - taken) / free), n


def _expected(rows: DataFrame, cap: float, few: bool) -> DataFrame:
    """Adds ``e``: expected copies, in proportion to ``w`` within a source, none above ``cap``; what a cap
    cuts off is spread over the documents below it, round by round until none is above."""
    rows = rows.withColumn("e", F.lit(None).cast("double"))
    while True:
        open_ = F.col("e").isNull()
        left = rows.groupBy("source").agg(
            F.sum(F.when(~open_, F.col("e") * F.col("size")).otherwise(0.0)).alias("given"),
            F.sum(F.when(open_, F.col("w") * F.col("size")).otherwise(0.0)).alias("mass"))
        rows = stored(_with_source(rows.drop("given", "mass"), left, few).withColumn(
            "try", F.when(open_, F.when(F.col("mass") > 0, (F.col("target") - F.col("given")) * F.col("w") / F.col("mass"))
                          .otherwise(0.0)))
            .withColumn("over", F.coalesce(F.col("try") > cap, F.lit(False))), "expected")
        if rows.where("over").isEmpty():
            return rows.withColumn("e", F.coalesce("e", "try")).drop("try", "over", "given", "mass")
        rows = rows.withColumn("e", F.when(F.col("over"), F.lit(cap)).otherwise(F.col("e"))).drop("try", "over")


def _with_source(rows: DataFrame, per_source: DataFrame, few: bool) -> DataFrame:
    """Null-safe join on source. With few sources the rows stay where they are, so a source with a third
    of all rows is no hot key; with many, the join shuffles, and Spark splits skewed partitions."""
    per = per_source.withColumnRenamed("source", "__s")
    per = F.broadcast(per) if few else per
    return rows.join(per, rows["source"].eqNullSafe(per["__s"]), "left").drop("__s")


def _prefix(rows: DataFrame, room: DataFrame, few: bool) -> DataFrame:
    """Of the rows that may be taken (``open``), those first in rank whose words add up to at most the
    source's ``room``: the same rows with ``hit``."""
    rows = _with_source(rows, room, few)
    open_ = F.col("open") & (F.col("size") <= F.col("room"))
    rows = rows.withColumn("slot", F.when(open_, F.floor(F.col("t") * SLOTS).cast("int")))
    slots = rows.where("slot is not null").groupBy("source", "slot").agg(
        F.sum("size").alias("words"), F.first("room").alias("room"))
    upto = Window.partitionBy("source").orderBy("slot")
    slots = slots.withColumn("cum", F.sum("words").over(upto))
    cut = slots.where("cum > room").groupBy("source").agg(
        F.min(F.struct("slot", (F.col("cum") - F.col("words")).alias("base"))).alias("cut"))
    rows = _with_source(rows, cut, few)
    here = F.col("slot") == F.col("cut.slot")
    inside = rows.where(F.coalesce(here, F.lit(False)))
    in_order = Window.partitionBy("source").orderBy("t", "size", "doc_id", "th").rowsBetween(
        Window.unboundedPreceding, 0)
    inside = inside.withColumn("hit", F.col("cut.base") + F.sum("size").over(in_order) <= F.col("room"))
    rest = rows.where(~F.coalesce(here, F.lit(False))).withColumn(
        "hit", F.col("slot").isNotNull() & (F.col("cut").isNull() | (F.col("slot") < F.col("cut.slot"))))
    return rest.unionByName(inside).drop("slot", "cut", "room")


def mix_sources(docs: DataFrame, weights=SOURCE_WEIGHTS, share: float = 1.0, cap: float = CAP, seed: int = 42,
                weight_col: str | None = None, tilt: float = 0.0, fill: int = FILL) -> DataFrame:
    """One row per document: doc_id, source, size, th, source_size, target, copies, taken.

    Inside a source the expected copies are in proportion to ``weight_col`` (positive numbers; null counts as 1), else
    to ``size ** -tilt``: with a tilt, a long document has lower odds to come once more than a short one."""
    size = word_count(F.col("text"))
    w = (F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)) if weight_col
         else F.when(size > 0, F.pow(size, F.lit(-float(tilt)))).otherwise(F.lit(0.0)))
    sizes = stored(docs.select(F.col("doc_id"), F.col("source"), size.alias("size"),
                               F.xxhash64("text").alias("th"), w.alias("w")), "sizes")
    targets = stored(source_targets(sizes, weights, share, cap), "targets")
    few = targets.count() <= FEW_SOURCES
    rows = _with_source(sizes, targets, few)
    if weight_col or tilt:
        rows = _expected(rows, cap, few)
    else:
        rows = rows.withColumn("e", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                               .otherwise(0.0))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    p = F.col("e") - F.floor("e")
    q = (u / (1 - u)) / (p / (1 - p))
    rows = (rows.withColumn("copies", F.floor("e").cast("long"))
            .withColumn("open", (p > 0) & (F.col("size") > 0))
            .withColumn("t", F.when(F.col("open"), q / (1 + q))).drop("w", "e"))
    for _ in range(1 + fill):
        room = rows.groupBy("source").agg(
            (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("room"))
        rows = stored(_prefix(rows, room, few).withColumn("copies", F.col("copies") + F.col("hit").cast("long"))
                      .withColumn("open", F.col("open") & ~F.col("hit")).drop("hit"), "mix")
    return rows.select("doc_id", "source", "size", "th", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))


def op10_mix_sources(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs, tilt=TILT).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it (not at all, once, or repeated).

    Rows alike in id, source and text are interchangeable, so their copies are summed."""
    key = ["__id", "__source", "__size", "__th"]
    copies = mix_sources(docs).where("copies > 0").groupBy("doc_id", "source", "size", "th").agg(
        F.sum("copies").alias("copies"))
    keyed = (docs.withColumn("__id", F.col("doc_id")).withColumn("__source", F.col("source"))
             .withColumn("__size", word_count(F.col("text"))).withColumn("__th", F.xxhash64("text")))
    once = keyed.dropDuplicates(key)
    joined = once.join(copies.toDF(*[f"{c}_" for c in key], "__copies"),
                       [once[c].eqNullSafe(F.col(f"{c}_")) for c in key])
    return joined.withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(
        *[once[c] for c in docs.columns])
