"""Operator 11 against a plain-Python version, and its policies and ablations against direct counts."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from metricyard.llm import ledger
from test_operators import EDGE, docs_frame, prose


def measured(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i: i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
            "n_upper": len(re.findall("[A-Z]", t)), "n_digits": len(re.findall("[0-9]", t)), "n_shouts": len(re.findall("[!?]", t))}


TEXTS = EDGE + [(100, "a b c a b c"), (101, "a a a a"), (102, "a b c d a b c"), (103, "x\nx\r\nx\n\n \nx"), (104, "a\x0bb\x0cc\x1cd e"),
                (105, "| # <b> & $ 100% *"), (106, "STOP! NOW? " * 60), (107, prose(1, 3000, 12)), (108, prose(2, 500)),
                (109, "one two three " * 2 + "one two"), (110, "4 5 6 " * 70), (111, "a\x00b \U0001F600 é")]


def test_measurements_against_plain_python(spark):
    out = ledger.rule_ledger(docs_frame(spark, TEXTS)).collect()
    want = sorted((str(i), sorted(measured(t).items())) for i, t in TEXTS)
    assert sorted((str(r["row"]["doc_id"]), sorted((k, r[k]) for k in ledger.MEASURES)) for r in out) == want
    assert all(set(r["row"].asDict()) == {"doc_id", "lang", "source", "n_chars", "score", "h", "th", "size"} for r in out)
    for r in out:
        m = {k: r[k] for k in ledger.MEASURES}
        bits = sum(1 << i for i, (_, cond) in enumerate(ledger.RULES) if eval(cond.replace("OR", "or"), {}, m))
        assert bits == r["fail_bits"]
    assert ledger.rule_ledger(docs_frame(spark, TEXTS).limit(0)).count() == 0


@pytest.mark.parametrize("forgiven", [0, 1])
def test_policies_and_ablations_against_direct_counts(spark, forgiven):
    """Bits come from a stored ledger; policies and ablations never read a text."""
    policies = (ledger.BASE, ledger.Policy("own", 3, ("upper_case", "shouting", "digits", "few_words"), forgiven))
    held = [(i, b) for i, b in enumerate([0, 1, 2, 3, 1 << 4, 1 << 5, (1 << 4) | (1 << 5), 1, 255, 0])]
    frame = spark.createDataFrame(held, "doc_id long, fail_bits long")
    kept = {p: lambda b, p=p, drop=0: bin(b & p.mask() & ~drop).count("1") <= p.forgiven for p in policies}
    for r in ledger.apply_policies(frame, policies).collect():
        assert [(v["policy"], v["version"], v["kept"]) for v in r["verdicts"]] == [(p.name, p.version, kept[p](r["fail_bits"])) for p in policies]
    got = {(r["policy"], r["rule"]): r for r in ledger.ablations(frame, policies).collect()}
    assert len(got) == sum(len(p.rules) for p in policies)
    for p in policies:
        for rule in p.rules:
            r, bit = got[p.name, rule], 1 << ledger.BIT[rule]
            assert r["version"] == p.version and r["n_docs"] == len(held)
            assert r["n_kept"] == sum(kept[p](b) for _, b in held) and r["n_failed"] == sum(bool(b & bit) for _, b in held)
            assert r["n_alone"] == sum(not kept[p](b) and b & p.mask() == bit for _, b in held)
            assert r["n_kept_without"] == sum(kept[p](b, drop=bit) for _, b in held)
    assert ledger.ablations(frame.limit(0), policies).count() == 0


def test_ledger_plan_reads_texts_once(spark):
    plan = ledger.rule_ledger(docs_frame(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    clean = "Every rule leaves an ordinary paragraph of plain words alone, and this one is as plain as they come. "
    rows = [(1, " ".join(f"{w}{chr(97 + i)}" for i in range(5) for w in clean.split()))]
    assert ledger.rule_ledger(docs_frame(spark, rows)).select(F.bit_count("fail_bits")).first()[0] == 0
