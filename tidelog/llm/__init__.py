"""Training-data operators. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from tidelog.llm import decontaminate, html, jaccard, language, pieces, pii, quality, secrets, substrings, warc

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_secrets": secrets.op2_secrets,
    "op3_warc": warc.op3_warc,
    "op4_quality": quality.op4_quality,
    "op5_html": html.op5_html,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_language": language.op7_language,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_pii": pii.op9_pii,
    "op10_jaccard_join": jaccard.op10_jaccard_join,
}
ORACLES: dict[str, str] = {"op3_warc": warc.OP3_SQL, "op8_substring_dedup": substrings.OP8_SQL, "op10_jaccard_join": jaccard.OP10_SQL}
