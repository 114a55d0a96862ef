"""Operators for preparing training text: one module per operator, each with
the query ``opN_<name>`` that applies it to its whole table."""

from fathom.llm.registry import ORACLES, QUERIES
from fathom.llm import (arc_warc, byte_bpe, chat_format, decontaminate, exact_dedup, hpylm, near_dedup, ordinal_toxicity, passages, periodic_runs, quality_nbsvm, sentence_piece, whitening)  # noqa: F401
