"""The queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from .decontamination import OP3_SQL, op3_decontamination
from .exact_dedup import OP2_SQL, op2_exact_dedup
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .language_id import op6_language_id
from .line_dedup import OP9_SQL, op9_line_dedup
from .near_dedup import OP8_SQL, op8_near_dedup
from .quality import op7_quality
from .sentencepiece_bpe import op1_sentencepiece
from .suffix_dedup import OP4_SQL, op4_suffix_dedup
from .token_alignment import op13_token_alignment
from .topk_search import OP12_SQL, op12_topk_search
from .url_filter import op5_url_filter
from .warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_language_id": op6_language_id,
    "op7_quality": op7_quality,
    "op8_near_dedup": op8_near_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_topk_search": op12_topk_search,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op2_exact_dedup": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op4_suffix_dedup": OP4_SQL,
    "op8_near_dedup": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_warc": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_topk_search": OP12_SQL,
}
