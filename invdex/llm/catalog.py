"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import (chat, decontaminate, fingerprints, html_text, lm_score, mixing, periodic_runs, pii, quality, ranked_search, simhash,
               toxicity, warc)

QUERIES = {
    "op1_decontaminate": decontaminate.q_op1_decontaminate,
    "op2_simhash": simhash.q_op2_simhash,
    "op3_mixing": mixing.q_op3_mixing,
    "op4_chat": chat.q_op4_chat,
    "op5_toxicity": toxicity.q_op5_toxicity,
    "op6_lm_score": lm_score.q_op6_lm_score,
    "op7_html": html_text.q_op7_html,
    "op8_pii": pii.q_op8_pii,
    "op9_warc": warc.q_op9_warc,
    "op10_quality": quality.q_op10_quality,
    "op11_ranked_search": ranked_search.q_op11_ranked_search,
    "op12_fingerprints": fingerprints.q_op12_fingerprints,
    "op13_periodic_runs": periodic_runs.q_op13_periodic_runs,
}

# Queries without an entry are tested against brute force in tests/llm.
ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op4_chat": chat.ORACLE,
    "op9_warc": warc.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
}
