"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from reelrank.llm import (alignment, bpe, decontaminate, langid, licenses, lm, mixing, neardup, pii,
                          runs, topk, toxicity, urlfilter)

QUERIES = {f.__name__: f for f in (
    topk.op1_topk_search,
    toxicity.op2_toxicity,
    langid.op3_language_id,
    urlfilter.op4_url_filter,
    licenses.op5_license_scan,
    neardup.op6_near_dedup,
    lm.op7_lm_scoring,
    decontaminate.op8_benchmark_decontamination,
    pii.op9_pii_surrogates,
    bpe.op10_byte_bpe,
    runs.op11_periodic_runs,
    mixing.op12_source_mixing,
    alignment.op13_tokenizer_alignment,
)}

SQL = {
    "op1_topk_search": topk.SQL,
    "op4_url_filter": urlfilter.SQL,
    "op5_license_scan": licenses.SQL,
    "op8_benchmark_decontamination": decontaminate.SQL,
}
