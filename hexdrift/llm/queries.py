"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontamination, exact_dedup, hilbert_shards, licenses, line_dedup, packing, simhash, tokens, toxicity, warc

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_token_files": tokens.op3_token_files,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_warc": warc.op6_warc,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_simhash": simhash.op8_simhash,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_hilbert_shards": hilbert_shards.op10_hilbert_shards,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op6_warc": warc.OP6_SQL,
}
