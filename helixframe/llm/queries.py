"""Registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from . import alignment, chat, fingerprints, leaks, lines, pieces, pii, quality, rules, secrets, simhash, spelling, urls

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_lines": lines.op2_lines,
    "op3_leaks": leaks.op3_leaks,
    "op4_quality": quality.op4_quality,
    "op5_rules": rules.op5_rules,
    "op6_chat": chat.op6_chat,
    "op7_simhash": simhash.op7_simhash,
    "op8_pii": pii.op8_pii,
    "op9_urls": urls.op9_urls,
    "op10_secrets": secrets.op10_secrets,
    "op11_alignment": alignment.op11_alignment,
    "op12_spelling": spelling.op12_spelling,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}
ORACLE = {"op2_lines": lines.OP2_SQL, "op5_rules": rules.OP5_SQL, "op6_chat": chat.OP6_SQL, "op9_urls": urls.OP9_SQL, "op12_spelling": spelling.OP12_SQL}
