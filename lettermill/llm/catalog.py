"""The queries of the operators, and the SQL that must give the same rows."""

from __future__ import annotations

from lettermill.llm.bpe_codec import op3_bpe_codec
from lettermill.llm.conversations import op12_conversation_repair
from lettermill.llm.importance import OP11_SQL, op11_importance
from lettermill.llm.line_dedup import OP1_SQL, op1_line_dedup
from lettermill.llm.lm_scoring import op5_lm_scoring
from lettermill.llm.mixing import OP2_SQL, op2_mixing
from lettermill.llm.near_dedup import op10_near_dedup
from lettermill.llm.neighbours import op6_neighbours
from lettermill.llm.passage_dedup import op4_passage_dedup
from lettermill.llm.personal_data import op13_personal_data
from lettermill.llm.quality_rules import op8_quality_rules
from lettermill.llm.secret_scan import op9_secret_scan
from lettermill.llm.token_counts import op7_token_counts

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mixing": op2_mixing,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_passage_dedup": op4_passage_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_neighbours": op6_neighbours,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_near_dedup": op10_near_dedup,
    "op11_importance": op11_importance,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_personal_data": op13_personal_data,
}

SQL = {
    "op1_line_dedup": OP1_SQL,
    "op2_mixing": OP2_SQL,
    "op11_importance": OP11_SQL,
}
