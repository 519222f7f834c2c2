"""Registered queries of the document operators and the SQL of those that SQL can state."""

from __future__ import annotations

from riskframe.llm import decontam, divergence, hard_negatives, lines, ngram_join
from riskframe.llm.bpe import op4_byte_bpe
from riskframe.llm.chunk_dedup import op3_chunk_dedup
from riskframe.llm.decontam import op7_decontamination
from riskframe.llm.divergence import op11_source_divergence
from riskframe.llm.hard_negatives import op12_hard_negatives
from riskframe.llm.licenses import op8_license_scan
from riskframe.llm.lines import op9_line_dedup
from riskframe.llm.ngram_join import op1_ngram_join
from riskframe.llm.pii import op6_pii_pseudonyms
from riskframe.llm.quality import op10_quality_rules
from riskframe.llm.secrets import op5_secret_scan
from riskframe.llm.substring_dedup import op2_suffix_dedup
from riskframe.llm.word_bpe import op13_word_bpe

QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_suffix_dedup, op3_chunk_dedup, op4_byte_bpe, op5_secret_scan, op6_pii_pseudonyms, op7_decontamination, op8_license_scan,
    op9_line_dedup, op10_quality_rules, op11_source_divergence, op12_hard_negatives, op13_word_bpe,
)}

ORACLES = {"op1_ngram_join": ngram_join.ORACLE, "op7_decontamination": decontam.ORACLE, "op9_line_dedup": lines.ORACLE,
           "op11_source_divergence": divergence.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE}
