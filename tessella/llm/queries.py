"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import elias_fano, jaccard_join, line_dedup, matroska, mixing, packing, secret_scan, separator_scan, spotsigs, toxicity

QUERIES = {
    f.__name__: f
    for f in (
        separator_scan.op1_token_counts,
        toxicity.op2_toxicity,
        matroska.op3_media_columns,
        jaccard_join.op4_ngram_join,
        line_dedup.op5_line_dedup,
        mixing.op6_mixing,
        elias_fano.op7_token_files,
        packing.op8_packing,
        spotsigs.op9_fingerprints,
        secret_scan.op10_secret_scan,
    )
}
ORACLE: dict[str, str] = {"op5_line_dedup": line_dedup.OP5_SQL}
