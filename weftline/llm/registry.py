"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from weftline.llm.backoff import op6_backoff
from weftline.llm.divergence import OP11_SQL, op11_divergence
from weftline.llm.fuzzyhash import op3_fingerprints
from weftline.llm.language import op8_language_id
from weftline.llm.media import op10_media
from weftline.llm.mergedrop import op7_merge_dropout
from weftline.llm.minhash import op9_minhash
from weftline.llm.packing import op2_packing
from weftline.llm.pagegraph import op13_html
from weftline.llm.substrings import op4_suffix_dedup
from weftline.llm.templates import op5_line_templates
from weftline.llm.toxicity import op1_toxicity
from weftline.llm.variants import op12_variants


def queries() -> dict:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_packing": op2_packing,
        "op3_fingerprints": op3_fingerprints,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_line_templates": op5_line_templates,
        "op6_backoff": op6_backoff,
        "op7_merge_dropout": op7_merge_dropout,
        "op8_language_id": op8_language_id,
        "op9_minhash": op9_minhash,
        "op10_media": op10_media,
        "op11_divergence": op11_divergence,
        "op12_variants": op12_variants,
        "op13_html": op13_html,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_divergence": OP11_SQL}
