"""Registered queries of the training-data operators and their DuckDB twins, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from .alignment import op13_pair_bitmaps
from .chat import OP1_SQL, op1_chat_format
from .exact import OP3_SQL, op3_exact_dedup
from .html_text import op2_html_text
from .jaccard import op9_jaccard_join
from .ledger import OP11_SQL, op11_rule_ledger
from .mixing import op10_mix_sources
from .negatives import OP12_SQL, op12_angular_negatives
from .packing import op4_length_buckets
from .rules import op6_rule_quality
from .spherical import op5_spherical_dedup
from .suffix import op7_suffix_dedup
from .unigram import op8_token_counts

QUERIES = {f.__name__: f for f in (op1_chat_format, op2_html_text, op3_exact_dedup, op4_length_buckets,
                                   op5_spherical_dedup, op6_rule_quality, op7_suffix_dedup, op8_token_counts,
                                   op9_jaccard_join, op10_mix_sources, op11_rule_ledger,
                                   op12_angular_negatives, op13_pair_bitmaps)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE = {"op1_chat_format": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op11_rule_ledger": OP11_SQL,
          "op12_angular_negatives": OP12_SQL}
