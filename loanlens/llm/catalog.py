"""Registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from loanlens.llm import (bsi_topk, decontaminate, imatch, license_scan, maxscore, mixing, near_join, quality_crf, suffix_dedup, toxicity,
                          url_filter, warc, whitening)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_mixing_weights": mixing.op4_mixing_weights,
    "op5_imatch_fingerprints": imatch.op5_imatch_fingerprints,
    "op6_quality_crf": quality_crf.op6_quality_crf,
    "op7_warc_normaliser": warc.op7_warc_normaliser,
    "op8_ngram_jaccard_join": near_join.op8_ngram_jaccard_join,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_ranked_search": maxscore.op11_ranked_search,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_bsi_topk": bsi_topk.op13_bsi_topk,
}

SQL: dict[str, str] = {
    "op4_mixing_weights": mixing.OP4_SQL,
    "op7_warc_normaliser": warc.OP7_SQL,
    "op11_ranked_search": maxscore.OP11_SQL,
    "op13_bsi_topk": bsi_topk.OP13_SQL,
}
