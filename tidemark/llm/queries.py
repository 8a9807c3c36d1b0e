"""The subpackage's registered queries and their DuckDB equivalents, by name."""

from __future__ import annotations

from tidemark.llm.conversations import OP11_SQL, op11_conversation_repair
from tidemark.llm.copies import OP13_SQL, op13_exact_dedup
from tidemark.llm.decontaminate import op5_decontaminate
from tidemark.llm.lines import op4_line_dedup
from tidemark.llm.lm import op3_lm_scores
from tidemark.llm.manifest import OP12_SQL, op12_merkle_manifest
from tidemark.llm.oracles import ORACLE as EARLIER
from tidemark.llm.pieces import op8_sentencepiece
from tidemark.llm.pii import op7_pii
from tidemark.llm.quality import op9_quality_classifier
from tidemark.llm.rules import op6_quality_rules
from tidemark.llm.secrets import op1_secret_scan
from tidemark.llm.simhash import op2_simhash
from tidemark.llm.substrings import op10_substring_dedup

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash": op2_simhash,
    "op3_lm_scores": op3_lm_scores,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality_rules": op6_quality_rules,
    "op7_pii": op7_pii,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE = EARLIER | {"op11_conversation_repair": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_exact_dedup": OP13_SQL}

__all__ = ["ORACLE", "QUERIES"]
