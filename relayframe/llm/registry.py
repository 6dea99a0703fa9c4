"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from relayframe.llm import (
    collocations, decontaminate, fingerprints, html, langid, lines, mixing, near, ranked, surrogates, token_files, urls, vertical)

QUERIES = {
    "op1_url_filter": urls.op1_url_filter,
    "op2_multiset_hash": fingerprints.op2_multiset_hash,
    "op3_language": langid.op3_language,
    "op4_surrogates": surrogates.op4_surrogates,
    "op5_line_runs": lines.op5_line_runs,
    "op6_layout_text": html.op6_layout_text,
    "op7_similarity_sketch": near.op7_similarity_sketch,
    "op8_string_tiling": decontaminate.op8_string_tiling,
    "op9_temperature_mix": mixing.op9_temperature_mix,
    "op10_huffman_files": token_files.op10_huffman_files,
    "op11_stratified_search": ranked.op11_stratified_search,
    "op12_vertical_join": vertical.op12_vertical_join,
    "op13_quotient_phrases": collocations.op13_quotient_phrases,
}

SQL: dict[str, str] = {
    "op1_url_filter": urls.SQL_OP1,
    "op5_line_runs": lines.SQL_OP5,
    "op11_stratified_search": ranked.SQL_OP11,
    "op12_vertical_join": vertical.SQL_OP12,
    "op13_quotient_phrases": collocations.SQL_OP13,
}
