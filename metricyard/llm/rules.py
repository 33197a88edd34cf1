"""Operator 6, quality classifier as a sparse ensemble of rules.

Text statistics are Spark columns over the whole text. Shallow random trees are grown on a bounded sample
of labelled rows; every path from a root to a node is a conjunctive rule (``words > 20 AND punct <= 0.1``).
A lasso logistic regression on the 0/1 values of the rules leaves a few with a weight, and these are compiled
into one Spark column expression, so scoring is a plain projection that needs no Python and no join.

Training reads at most ``SAMPLE`` labelled rows outside the held-out fold (crc32 of the id modulo 5 is 0),
those of least hashed id, in a fixed order in one partition, so that reruns agree. Labels, language, source
and id are never inputs.

Defined results: a null text counts as empty and gets the score of an empty text. Repeated rows are scored
each. A null id is not held out of scoring; its rows are never trained on. Without labels, or with labels of
one kind only, every score is the label share (0.5 without any). An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, TREES, TREE_DEPTH, L1, CUT = 20_000, 12, 3, 0.003, 0.3
FOLDS = 5


def statistics(text: str = "text") -> dict[str, F.Column]:
    """name -> column over the whole text; every statistic is 0 for an empty text."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1))
    removed = lambda pattern: (chars - F.length(F.regexp_replace(t, pattern, ""))) / chars
    return {
        "log_words": F.log1p(F.size(words).cast("double")),
        "word_len": F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]++", "")) / n_words,
        "distinct": F.size(F.array_distinct(words)) / n_words,
        "upper": removed(r"\p{Lu}++"),
        "digits": removed(r"[0-9]++"),
        "stops": removed(r"[.,;:?]++"),
        "marks": removed(r"[^\p{L}\p{N}\s.,;:?'\"()-]++"),
        "lines": removed(r"\n++"),
        "again": removed(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++(?=\1(?![^\x20\x09-\x0D]))"),
    }


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % FOLDS == 0, F.lit(False))


def tree_rules(model) -> list[tuple[tuple[int, str, float], ...]]:
    """Distinct conjunctions (feature, '<=' or '>', threshold) of all paths of a fitted forest."""
    rules = {}
    for tree in model.trees:
        path: list[tuple[int, str, float]] = []
        for line in tree.toDebugString.splitlines():
            m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)", line)
            if not m:
                continue
            depth = len(m[1]) - 2 if len(m[1]) >= 2 else 0
            path = path[:depth] + [(int(m[2]), m[3], float(m[4]))]
            rules.setdefault(tuple(sorted(set(path))))
    return list(rules)                               # at most TREES * (2 ** (TREE_DEPTH + 1) - 2)


def compile_rule(rule, names: list[str]) -> F.Column:
    cond = F.lit(True)
    for feature, sign, at in rule:
        c = F.col(names[feature])
        cond = cond & ((c <= F.lit(at)) if sign == "<=" else (c > F.lit(at)))
    return cond


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """At most ``limit`` labelled documents outside the held-out fold, with their statistics."""
    known = labels.where("quality is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(
        F.max("quality").cast("double").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")      # at most ``limit`` short rows
    stats = statistics()
    return texts.select("doc_id", "label", *[c.cast("double").alias(k) for k, c in stats.items()])


def fit_rules(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> dict:
    """{"bias": b, "rules": [(rule, weight)], "names": [...]}"""
    from .common import stored

    names = list(statistics())
    train = stored(training_rows(docs, labels, limit).repartition(1).sortWithinPartitions("doc_id", *names), "training")
    share = train.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        odds = 0.0 if share is None else (30.0 if share else -30.0)
        return {"bias": odds, "rules": [], "names": names}
    train = train.coalesce(1)
    vec = VectorAssembler(inputCols=names, outputCol="x").transform(train).select("x", "label", *names)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=TREE_DEPTH,
                                    subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=7).fit(vec)
    rules = tree_rules(forest)
    if not rules:
        return {"bias": math.log(share / (1 - share)), "rules": [], "names": names}
    hits = train.select("label", *[compile_rule(r, names).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    table = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(hits).select("x", "label")
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=L1, maxIter=60).fit(table.cache())
    table.unpersist()
    return {"bias": float(lasso.intercept), "names": names,
            "rules": [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if abs(w) > 1e-9]}


def score_column(model: dict) -> F.Column:
    """The ensemble as one column expression over the statistics' columns."""
    z = F.lit(model["bias"])
    for rule, weight in model["rules"]:
        z = z + F.when(compile_rule(rule, model["names"]), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (names of its own columns may clash: they stay as they are)."""
    stats = statistics()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
                       *[c.cast("double").alias(k) for k, c in stats.items()])
    return rows.select("__doc", score_column(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))


def op6_rule_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select(
        F.col("__doc.doc_id").alias("doc_id"), held_out("__doc.doc_id").alias("held_out"), "score", "predicted")


def drop_low_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    model = fit_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).where("predicted = 1").select("__doc.*")
