"""The named queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from marginflow.llm.chat_format import OP11_SQL, op11_chat_format
from marginflow.llm.decontaminate import OP7_SQL, op7_decontaminate
from marginflow.llm.jaccard_join import OP2_SQL, op2_jaccard_join
from marginflow.llm.langid import op5_language_id
from marginflow.llm.line_dedup import OP9_SQL, op9_line_dedup
from marginflow.llm.nn_descent import op6_nn_descent
from marginflow.llm.pieces import op3_pieces
from marginflow.llm.pii import op1_pii
from marginflow.llm.quality_mil import op4_quality
from marginflow.llm.runs import OP12_SQL, op12_periodic_runs
from marginflow.llm.suffix_dedup import OP10_SQL, op10_suffix_dedup
from marginflow.llm.url_filter import op8_url_filter
from marginflow.llm.vector_codes import OP13_SQL, op13_vector_codes

QUERIES = {
    "op1_pii": op1_pii,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_pieces": op3_pieces,
    "op4_quality": op4_quality,
    "op5_language_id": op5_language_id,
    "op6_nn_descent": op6_nn_descent,
    "op7_decontaminate": op7_decontaminate,
    "op8_url_filter": op8_url_filter,
    "op9_line_dedup": op9_line_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}

STATEMENTS: dict[str, str] = {
    "op2_jaccard_join": OP2_SQL,
    "op7_decontaminate": OP7_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_suffix_dedup": OP10_SQL,
    "op11_chat_format": OP11_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
