"""Operator 8, token counts of a unigram tokenizer by dynamic programming shared along a trie.

A document's pre-tokens are its words, each with the mark of a preceding space. For the distinct pre-tokens
of a batch, in sorted order, which is the depth-first order of their trie, the forward pass keeps the best
score and token count of every prefix of the current word; the next word starts at the first character in
which it differs. So each trie node is scored once, and a word's count is stored where it ends. Counts of
words seen before come from a bounded store. Documents are mapped independently: no shuffle, no collect.

The vocabulary is a public tokenizer's piece list, read on the driver (a fixed file of some 30,000 pieces,
passed by path) and sent to the tasks. Piece r of the list scores ``-log(r + 2.7)``, Zipf's law for its
rank; a character that is no piece costs its UTF-8 bytes at ``BYTE_SCORE`` each.

Defined results: null and empty texts have 0 pre-tokens and 0 tokens. White space other than one space per
word is not counted. Equal scores go to fewer tokens. Repeated rows are counted each; other columns are
ignored; an empty table gives an empty result. Words of any length are scored whole.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BYTE_SCORE = -20.0
STORE = 500_000          # words whose counts a task keeps


def load_pieces(path: str = TOKENIZER) -> dict[str, float]:
    """piece -> score, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {p: -math.log(r + 2.7) for r, p in enumerate(pieces)}


class TrieCounter:
    """Token counts of words, scoring each shared prefix of a sorted run of words once."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.nodes = 0

    def count(self, words: list[str]) -> list[int]:
        """``words`` sorted; the result is in their order."""
        get, longest = self.scores.get, self.longest
        best, used, last, out = [0.0], [0], "", []
        for word in words:
            same, most = 0, min(len(word), len(last))
            while same < most and word[same] == last[same]:
                same += 1
            del best[same + 1:], used[same + 1:]
            for d in range(same + 1, len(word) + 1):
                top, tokens = None, 0
                for start in range(max(0, d - longest), d):
                    s = get(word[start:d])
                    if s is not None:
                        s += best[start]
                        if top is None or s > top or s == top and used[start] + 1 < tokens:
                            top, tokens = s, used[start] + 1
                if get(word[d - 1]) is None:
                    n = len(word[d - 1].encode("utf-8", "surrogatepass"))
                    s = best[d - 1] + n * BYTE_SCORE
                    if top is None or s > top or s == top and used[d - 1] + n < tokens:
                        top, tokens = s, used[d - 1] + n
                best.append(top)
                used.append(tokens)
                self.nodes += 1
            last = word
            out.append(used[len(word)])
        return out


def token_counts(docs: DataFrame, scores: dict[str, float] | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pretokens, n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(scores if scores is not None else load_pieces())

    def counts(batches):
        trie, store = TrieCounter(shared.value), {}
        for batch in batches:
            split = [(t.as_py() or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1)]
            if len(store) > STORE:
                store.clear()
            new = sorted((w.decode("utf-8", "surrogatepass"), w) for w in set().union(*split) - store.keys())
            store.update(zip((w for _, w in new), trie.count([SPACE + s for s, _ in new])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in split], pa.int64()),
                 pa.array([sum(map(store.__getitem__, x)) for x in split], pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(counts, "doc_id long, n_pretokens long, n_tokens long")


def op8_token_counts(spark, sf_dir):
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
