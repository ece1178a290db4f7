"""The queries of the training-data operators, and their SQL."""

from __future__ import annotations

from . import divergence, exact_dedup, langid, licences, mixing, packing, pieces, resampling, secrets_scan, simhash, topk, toxicity, warc

QUERIES = {
    "op1_simhash": simhash.query,
    "op2_packing": packing.query,
    "op3_mixing": mixing.query,
    "op4_warc": warc.query,
    "op5_toxicity": toxicity.query,
    "op6_exact_dedup": exact_dedup.query,
    "op7_licences": licences.query,
    "op8_topk": topk.query,
    "op9_secrets": secrets_scan.query,
    "op10_langid": langid.query,
    "op11_divergence": divergence.query,
    "op12_pieces": pieces.query,
    "op13_resampling": resampling.query,
}

SQL = {
    "op4_warc": warc.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op7_licences": licences.SQL,
    "op8_topk": topk.SQL,
    "op9_secrets": secrets_scan.SQL,
    "op11_divergence": divergence.SQL,
}
