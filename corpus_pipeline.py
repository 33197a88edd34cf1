"""Corpus pipeline: quality filter, exact and near-duplicate removal, source mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet into the shared
scratch folder and read again as the next stage's documents. All stages but the last return the columns of
``documents``; the last returns the packed segments (doc_id, seg_no, start, n_tokens, bucket_len, batch_no, row_no).
The quality stage reads ``labels`` to learn from; an empty table of documents gives an empty result at every stage.

Nulls: a null text is an empty text (and of low quality, as a rule); null ids, sources and languages are kept as they are.
Ties: of equal texts the row with the largest doc_id stays, of near copies the one with the smallest. Fully repeated rows
leave one at the exact stage; the mix may repeat a row, and packing takes each. Texts are read whole at every stage.
Extra columns travel with their rows up to the mix; packing returns its own columns only. Lengths are words.
"""

from __future__ import annotations

from metricyard.llm.common import stored
from metricyard.llm.exact import keep_one_copy
from metricyard.llm.jaccard import drop_near_copies
from metricyard.llm.mixing import mix_documents
from metricyard.llm.packing import pack_documents
from metricyard.llm.rules import drop_low_quality

STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", keep_one_copy),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_documents),
    ("packing", pack_documents),
]

# No SQL twin: the classifier is trained, and hashes order the sample.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
