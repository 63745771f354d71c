"""The registered queries of this subpackage and the SQL twins of those that have one."""

from __future__ import annotations

import corpus_pipeline
from rimline.llm import conversations, fingerprints, licenses, lines, mixing, near, packing, pii, quality, toxicity, twins, urls, warc, whitening

QUERIES = {
    "op1_soft_membership_mixing": mixing.op1_soft_membership_mixing,
    "op2_winnowed_lines": lines.op2_winnowed_lines,
    "op3_phrase_fingerprints": fingerprints.op3_phrase_fingerprints,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_personal_data": pii.op5_personal_data,
    "op6_learned_decision_list": quality.op6_learned_decision_list,
    "op7_warc_derivatives": warc.op7_warc_derivatives,
    "op8_ordinal_toxicity": toxicity.op8_ordinal_toxicity,
    "op9_hierarchical_packing": packing.op9_hierarchical_packing,
    "op10_ngram_jaccard_join": near.op10_ngram_jaccard_join,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_url_filter": urls.op13_url_filter,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = dict(twins.ORACLE)
