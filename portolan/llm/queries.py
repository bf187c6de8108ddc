"""The registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from portolan.llm import (bpe, decontamination, exact_dedup, fill_middle, line_dedup, mixing, quality, simhash, suffix_tree, token_counts,
                          urls, warc, whitening)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_quality_scores": quality.op2_quality_scores,
    "op3_suffix_tree": suffix_tree.op3_suffix_tree,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_simhash": simhash.op5_simhash,
    "op6_url_filter": urls.op6_url_filter,
    "op7_warc": warc.op7_warc,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_fill_in_middle": fill_middle.op11_fill_in_middle,
    "op12_whitening": whitening.op12_whitening,
    "op13_byte_bpe": bpe.op13_byte_bpe,
}
ORACLES = {
    "op1_mix_sources": mixing.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op7_warc": warc.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op11_fill_in_middle": fill_middle.ORACLE,
}
