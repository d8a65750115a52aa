"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from terrace.llm.bitplane import op10_bitplanes
from terrace.llm.collocations import OP12_SQL, op12_collocations
from terrace.llm.decontaminate import OP11_SQL, op11_decontaminate
from terrace.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from terrace.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from terrace.llm.html_text import op8_html_text
from terrace.llm.mixing import OP3_SQL, op3_mixing
from terrace.llm.ngram_join import op2_ngram_join
from terrace.llm.pieces import op1_pieces
from terrace.llm.pii import op7_pii
from terrace.llm.secrets import op6_secrets
from terrace.llm.toxicity import op4_toxicity
from terrace.llm.topk import OP9_SQL, op9_topk

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_pieces": op1_pieces,
    "op2_ngram_join": op2_ngram_join,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_secrets": op6_secrets,
    "op7_pii": op7_pii,
    "op8_html_text": op8_html_text,
    "op9_topk": op9_topk,
    "op10_bitplanes": op10_bitplanes,
    "op11_decontaminate": op11_decontaminate,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {
    "op3_mixing": OP3_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op9_topk": OP9_SQL,
    "op11_decontaminate": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
