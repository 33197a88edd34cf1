"""The corpus pipeline and the registered queries on the smallest given tables."""
import math
import os
import random
import re
import tempfile

import pytest

import __spark_entry__ as E
import corpus_pipeline
from metricyard.llm import packing, rules

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF).cache()
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if name != "mixing sources to target weights" and i < 4:
            assert docs.count() <= before
        before = docs.count()
        assert before > 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_every_operator_is_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_queries_cover_their_tables(spark):
    rows = {"op3_exact_dedup": "documents", "op5_spherical_dedup": "embeddings", "op2_html_text": "pages", "op8_token_counts": "documents"}
    for name, table in rows.items():
        assert E.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def prose(seed, words):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(5000)}" for _ in range(words))


def statistics_by_brute_force(text):
    """The statistics of ``rules`` for a text of ASCII characters."""
    n, words = max(len(text), 1), text.split()
    m = max(len(words), 1)
    share = lambda pattern: (n - len(re.sub(pattern, "", text))) / n
    return {"log_words": math.log1p(len(words)), "word_len": sum(map(len, words)) / m, "distinct": len(set(words)) / m,
            "upper": share("[A-Z]"), "digits": share("[0-9]"), "stops": share("[.,;:?]"),
            "marks": share(r"[^A-Za-z0-9\s.,;:?'\"()-]"), "lines": share("\n"),
            "again": sum(len(a) + 1 for a, b in zip(words, words[1:]) if a == b) / n}


def score_by_brute_force(model, text):
    stats, z = statistics_by_brute_force(text), model["bias"]
    for rule, weight in model["rules"]:
        if all(stats[model["names"][f]] <= at if sign == "<=" else stats[model["names"][f]] > at for f, sign, at in rule):
            z += weight
    return 1 / (1 + math.exp(-z))


def near_copies_left(rows):
    """The rows of least id of the components of similarity 0.8 in five-word shingles."""
    sets = []
    for _, text, _ in rows:
        w = text.lower().split()
        sets.append({tuple(w[i: i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                root = [root[i] if r == root[j] else r for r in root]
    least = {}
    for (i, _, _), r in zip(rows, root):
        least[r] = min(i, least.get(r, i))
    return [row for row, r in zip(rows, root) if row[0] == least[r]]


def test_run_against_plain_python(spark):
    # after cleaning, the words of the sources are 5 to 2, as the mix wants them: it takes each document once
    good = [(i, prose(i, 60), "a" if i < 50 else "b") for i in range(70)] + [(70, prose(70, 5000), "a"), (71, prose(71, 2000), "b")]
    bad = [(1000 + i, " ".join(f"WORD{i}!!" for _ in range(30 + i)), "ab"[i % 2]) for i in range(60)]
    copies = [(2000 + i, good[i][1], good[i][2]) for i in range(0, 71, 9)]
    near = [(3000 + i, good[i][1] + " end", good[i][2]) for i in range(1, 71, 6)]
    rows = good + bad + copies + near
    folder = tempfile.mkdtemp(prefix="metricyard-test-")
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _, _ in good + bad], "doc_id long, quality int, toxic int")
    docs.repartition(5).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = rules.fit_rules(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    passed = [r for r in rows if score_by_brute_force(model, r[1]) >= rules.CUT]
    assert model["rules"] and {r[0] for r in passed} == {r[0] for r in rows} - {r[0] for r in bad}
    last = {}
    for i, text, _ in passed:
        last[text] = max(i, last.get(text, i))
    single = [r for r in passed if last[r[1]] == r[0]]
    left = near_copies_left(single)
    words = {s: sum(len(t.split()) for _, t, x in left if x == s) for s in "ab"}
    assert len(single) == len(passed) - len(copies) and len(left) == len(good) and 2 * words["a"] == 5 * words["b"]
    for (name, stage), want in zip(corpus_pipeline.STAGES, (passed, single, left, left)):
        docs = stage(spark, docs, folder).cache()
        assert sorted(map(tuple, docs.collect())) == sorted((i, t, "en", s, len(t)) for i, t, s in want), name

    parts = []
    for i, text, _ in left:
        n = len(text.split())
        parts += [(i, k, at, min(n - at, packing.MAX_LEN)) for k, at in enumerate(range(0, max(n, 1), packing.MAX_LEN))]
    bounds = sorted({p[3] for p in parts})                      # fewer lengths than buckets: no padding at all
    assert len(bounds) <= packing.BUCKETS
    out = [tuple(r) for r in corpus_pipeline.run(spark, folder).select(
        "doc_id", "seg_no", "start", "n_tokens", "bucket_len", "batch_no", "row_no").collect()]
    assert sorted(r[:5] for r in out) == sorted((*p, p[3]) for p in parts)
    for b in bounds:
        most = packing.TOKEN_BUDGET // b
        places = sorted(r[5:] for r in out if r[4] == b)
        assert places == [divmod(k, most) for k in range(len(places))]
