"""The queries of this folder, by name, with SQL where SQL can express them."""

from __future__ import annotations

from sheaftext.llm import bpe, collocations, decontaminate, fingerprints, hmm, jaccard_join, line_dedup, quality, topk_search, toxicity, url_filter, warc, whitening

QUERIES = {
    "op1_line_dedup": (line_dedup.op1_line_dedup, line_dedup.SQL),
    "op2_hidden_markov": (hmm.op2_hidden_markov, None),
    "op3_fingerprints": (fingerprints.op3_fingerprints, None),
    "op4_url_filters": (url_filter.op4_url_filters, url_filter.SQL),
    "op5_bpe": (bpe.op5_bpe, None),
    "op6_warc": (warc.op6_warc, warc.SQL),
    "op7_jaccard_join": (jaccard_join.op7_jaccard_join, None),
    "op8_decontaminate": (decontaminate.op8_decontaminate, None),
    "op9_toxicity": (toxicity.op9_toxicity, None),
    "op10_quality": (quality.op10_quality, None),
    "op11_topk_search": (topk_search.op11_topk_search, topk_search.SQL),
    "op12_whitening": (whitening.op12_whitening, None),
    "op13_collocations": (collocations.op13_collocations, collocations.SQL),
}
