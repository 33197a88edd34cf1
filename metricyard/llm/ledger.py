"""Operator 11, quality rules as a ledger of bits. DataFrame operations only.

Every rule is evaluated once, in one pass over the texts without a shuffle: ``rule_ledger`` measures each document
and sets bit N of ``fail_bits`` where rule N fails. The ledger (ids, measurements, bits) can be stored; a policy is a
version of a set of rules with a number of failures that it forgives, and works on the bits alone, so a new version
needs no text. ``ablations`` tells, for every rule of every policy, how many documents it fails, how many it alone
drops and how many would stay without it, from the counts by bit pattern: a partial aggregation to at most
2 ** rules patterns, bit tests and ``bit_count``.

Words are maximal runs of characters other than white space (\\x20 and \\x09-\\x0D). Measurements:

- ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters of ``[#*$%&|<>]``)
- ``n_lines`` (lines, split at \\n, that hold a word), ``n_dup_lines`` (those equal to an earlier line)
- ``n_repeat_words``: words in three-word windows that the text holds twice or more, the first included. The
  windows are sorted as structs of their words, so equal ones are neighbours; texts whose windows all have different
  hashes have no equal windows and skip the sort. No hash decides more than that.
- ``n_upper`` (A-Z), ``n_digits`` (0-9), ``n_shouts`` (characters of ``[!?]``)

Defined results: a null text is an empty text, with all measurements 0. Texts are read whole; a text is one row, so
one task holds its words. Repeated rows and null ids are measured each. Rows do not compete, so there are no ties, and their
order does not matter. Extra columns, of any name, are carried in the struct ``row``. An empty table gives an empty
ledger, and no ablations.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE

SYMBOLS = r"[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits",
            "n_shouts"]

# Bit number -> (name, SQL condition over the measurements that makes the rule fail). A stored ledger keeps its bits,
# so a rule keeps its number for ever; new rules are added at the end.
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("upper_case", "100 * n_upper > 30 * word_chars"),
    ("shouting", "100 * n_shouts > 20 * n_words"),
    ("short_or_long_words", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    ("digits", "100 * n_digits > 30 * word_chars"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]
    forgiven: int = 0           # so many failed rules still pass

    def mask(self) -> int:
        return sum(1 << BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
WEB_1 = Policy("web", 1, ("few_words", "repeated_windows", "symbols", "duplicate_lines"))
WEB_2 = Policy("web", 2, tuple(BIT))
POLICIES = (BASE, WEB_1, WEB_2)


def let(value, body):
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it many times."""
    return F.transform(F.array(value), body)[0]


def repeated_window_words(words) -> F.Column:
    """Number of words in windows of three that occur twice or more in the array ``words``."""
    n = F.size(words)
    windows = F.slice(F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), n).alias("b"),
                                   F.slice(words, F.lit(3), n).alias("c"), F.sequence(F.lit(0), n - 1).alias("at")),
                      F.lit(1), n - 2)

    def covered(s):
        pairs = F.filter(F.arrays_zip(s.alias("x"), F.slice(s, F.lit(2), F.size(s)).alias("y")),
                         lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]))
        at = F.array_sort(F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(p["x"]["at"], p["y"]["at"])))))
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                           lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")))["n"]

    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    some = F.when(n > 3, let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))).otherwise(F.lit(False))
    return F.when(some, let(F.sort_array(windows), covered)).otherwise(F.lit(0))


def measurements(text) -> F.Column:
    """Struct of the ``MEASURES`` of a text column."""
    t = F.coalesce(text, F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    words = F.filter(F.split(t, f"[{WHITE}]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{WHITE}]"))
    by_words = let(words, lambda w: F.struct(
        F.size(w).alias("n_words"), F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x)).alias("word_chars"),
        repeated_window_words(w).alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"),
                                             (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return F.struct(by_words.alias("w"), by_lines.alias("l"), count(SYMBOLS).alias("n_symbols"),
                    count("[A-Z]").alias("n_upper"),
                    count("[0-9]").alias("n_digits"), count("[!?]").alias("n_shouts"))


def fail_bits(rules=RULES) -> F.Column:
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, cond) in enumerate(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long"))


def rule_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row: struct of all columns but the text, the measurements as longs, fail_bits)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    m = docs.select(F.struct(*rest).alias("row"), measurements(F.col(f"`{text}`")).alias("m"))
    at = {"n_words": "m.w", "word_chars": "m.w", "n_repeat_words": "m.w", "n_lines": "m.l", "n_dup_lines": "m.l"}
    flat = m.select("row", *[F.col(f"{at.get(k, 'm')}.{k}").cast("long").alias(k) for k in MEASURES])
    return flat.withColumn("fail_bits", fail_bits())


def passes(policy: Policy, bits="fail_bits") -> F.Column:
    failed = F.col(bits).bitwiseAND(F.lit(policy.mask()).cast("long"))
    return F.bit_count(failed) <= F.lit(policy.forgiven)


def apply_policies(ledger: DataFrame, policies=POLICIES) -> DataFrame:
    """The ledger with ``verdicts``: an array of (policy, version, kept), in the order of ``policies``."""
    return ledger.withColumn("verdicts", F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), passes(p).alias("kept")) for p in policies]))


def ablations(ledger: DataFrame, policies=POLICIES) -> DataFrame:
    """One row per policy and rule: (policy, version, rule, n_docs, n_kept, n_failed: documents that fail the rule,
    n_alone: dropped documents that fail no other rule of the policy, n_kept_without: kept if the rule goes)."""
    patterns = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    terms = F.array(*[F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                               F.lit(p.mask()).cast("long").alias("mask"), F.lit(1 << BIT[r]).cast("long").alias("bit"),
                               F.lit(p.forgiven).alias("forgiven")) for p in policies for r in p.rules])
    t = patterns.select("fail_bits", "n", F.explode(terms).alias("t")).select("fail_bits", "n", "t.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    failed = hit.bitwiseAND(F.col("bit")) != 0
    kept = F.bit_count(hit) <= F.col("forgiven")
    without = F.bit_count(hit.bitwiseAND(F.bitwise_not("bit"))) <= F.col("forgiven")
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))
    return t.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("n_docs"), total(kept).alias("n_kept"), total(failed).alias("n_failed"),
        total(failed & ~kept & (hit == F.col("bit"))).alias("n_alone"), total(without).alias("n_kept_without"))


def op11_rule_ledger(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base_failed = ~passes(BASE)
    return rule_ledger(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & passes(WEB_2)).alias("kept"), "fail_bits")


_COUNTED = [("n_symbols", SYMBOLS), ("n_upper", "[A-Z]"), ("n_digits", "[0-9]"), ("n_shouts", "[!?]")]
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM s WHERE len(ws) > 2),
c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS k FROM g),
r AS (SELECT rid, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM c WHERE k > 1) GROUP BY rid),
m AS (SELECT s.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0)::BIGINT AS word_chars,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             {", ".join(f"len(regexp_extract_all(t, '{p}'))::BIGINT AS {k}" for k, p in _COUNTED)}
      FROM s LEFT JOIN r USING (rid)),
b AS (SELECT *, ({" + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, (_, cond) in enumerate(RULES))})::BIGINT AS fail_bits
      FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b
"""
