"""Operator 13 against whole texts encoded by the two libraries and all pairs of tokens."""
import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from metricyard.llm import alignment as al
from test_operators import EDGE, docs_frame, prose

A, B = f"{al.TOKENIZERS}/{al.FILE_A}", f"{al.TOKENIZERS}/{al.FILE_B}"


def whole(text, a, b, table):
    """(A ids, B ids, byte ranges of A, of B) of a whole text, or None where the bytes differ."""
    if not text:
        return None
    raw, out = (" " + text).encode(), []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    for ids, of in ((ids_a, lambda i: bytes(table[c] for c in a.id_to_token(i))),
                    (ids_b, lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())):
        spans, at = [], 0
        for x in map(of, ids):
            if raw[at: at + len(x)] != x:
                return None
            spans.append((at, at + len(x)))
            at += len(x)
        if at != len(raw):
            return None
        out.append((ids, spans))
    return out


def brute(rows):
    a, b, table = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), al.byte_level()
    a.encode_special_tokens = True
    docs, held = [], defaultdict(int)
    for i, text in rows:
        found = whole(text, a, b, table)
        links, groups = [], []
        if found:
            (ids_a, sa), (ids_b, sb) = found
            links = [(x, y) for x, (s, e) in zip(ids_a, sa) for y, (t, f) in zip(ids_b, sb) if s < f and t < e] if len(ids_a) < 400 else []
            if not links:                                      # long texts: two pointers
                p = q = 0
                while p < len(sa) and q < len(sb):
                    links.append((ids_a[p], ids_b[q]))
                    end_a, end_b = sa[p][1], sb[q][1]
                    p, q = p + (end_a <= end_b), q + (end_b <= end_a)
            cuts = sorted({e for _, e in sa} & {e for _, e in sb})
            groups = [(",".join(str(x) for x, (_, e) in zip(ids_a, sa) if lo < e <= hi), ",".join(str(x) for x, (_, e) in zip(ids_b, sb) if lo < e <= hi))
                      for lo, hi in zip([0] + cuts, cuts)] if len(cuts) < 400 else None
        docs.append((i, found, links, groups))
        for pair in set(links):
            held[pair] += 1
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for i, found, links, groups in docs:
        sha = None if groups is None else hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if found else ""
        ends = len({e for _, e in found[0][1]} & {e for _, e in found[1][1]}) if found else 0
        out.append((i, len(found[0][0]) if found else 0, len(found[1][0]) if found else 0, ends, len(links),
                    sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha))
    times = Counter(p for d in docs for p in d[2])
    return out, {p: (n, times[p], n == top[p[0]]) for p, n in held.items()}


TEXTS = EDGE + [(20, "a  b "), (21, "  x"), (22, "▁x"), (23, "a \n  b\n\n c\t d"), (24, "<|endoftext|> <s> <0x41> </s>"), (25, " "), (26, "   "),
                (27, "don't   stop now 　 x"), (28, "\x00\x1c y\x85z"), (29, "é ﬁ ½ \U0001F469‍\U0001F4BB"), (30, "a\n b"),
                (31, "x ▁ y"), (32, "the the the the the of of the"), (33, "\r\n\r\n"), (34, "123 4567 89,0 $5.00!!")]
TEXTS += [(100 + i, prose(i, 40, 60)) for i in range(30)]


@pytest.mark.parametrize("docs, links, memory", [(1 << 13, 3_000_000, 400_000), (5, 3_000_000, 10), (64, 100, 0)])
def test_alignment_against_all_pairs(spark, monkeypatch, docs, links, memory):
    for name, value in (("RUN_LINKS", links), ("REMEMBER", memory), ("STEP_CHARS", 300 if docs < 100 else al.STEP_CHARS)):
        monkeypatch.setattr(al, name, value)
    if docs == 64:
        monkeypatch.setattr(al, "RUN_DOCS", 64)             # four documents make a bitmap of packed bits
    want, want_pairs = brute(TEXTS)
    out, pairs = al.align_tokens(docs_frame(spark, TEXTS).repartition(3, "n_chars"))
    got = sorted(map(tuple, out.collect()), key=str)
    assert [(*g[:7], "-" if w[7] is None else g[7]) for g, w in zip(got, sorted(want, key=str))] == \
        [(*w[:7], "-" if w[7] is None else w[7]) for w in sorted(want, key=str)] and len(got) == len(TEXTS)
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"], r["best"]) for r in pairs.collect()} == want_pairs


def test_empty_table(spark):
    out, pairs = al.align_tokens(docs_frame(spark, TEXTS).limit(0))
    assert out.count() == 0 and pairs.count() == 0
    none, _ = al.align_tokens(docs_frame(spark, [(1, None), (2, "")]))
    assert sorted(map(tuple, none.collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
