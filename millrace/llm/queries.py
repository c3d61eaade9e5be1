"""Registered queries of the dealt operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import ball_tree, bond, jaccard_join, substring_dedup
from .ball_tree import op8_ball_tree
from .bond import op13_hard_negatives
from .byte_pairs import op10_byte_pairs
from .html_text import op3_html_text
from .jaccard_join import op6_jaccard_join
from .katz import op11_katz_backoff
from .language import op4_language_id
from .licenses import op9_license_scan
from .packing import op1_best_fit_packing
from .quality import op2_quality_rules
from .substring_dedup import op7_substring_dedup
from .url_filter import op5_url_filter
from .whitening import op12_whitening

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_rules": op2_quality_rules,
    "op10_byte_pairs": op10_byte_pairs,
    "op3_html_text": op3_html_text,
    "op5_url_filter": op5_url_filter,
    "op4_language_id": op4_language_id,
    "op8_ball_tree": op8_ball_tree,
    "op9_license_scan": op9_license_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_substring_dedup": op7_substring_dedup,
    "op11_katz_backoff": op11_katz_backoff,
    "op12_whitening": op12_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op6_jaccard_join": jaccard_join.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op8_ball_tree": ball_tree.ORACLE,
    "op13_hard_negatives": bond.ORACLE,
}
