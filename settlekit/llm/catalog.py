"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import (crosstok, licences, linededup, mixing, neardup, packing, phrases, pieces, pii, quality, search, sharding,
               sql, urls)

QUERIES = {
    "op1_exact_search": search.op1_exact_search,
    "op2_url_filter": urls.op2_url_filter,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_mixing": mixing.op4_mixing,
    "op5_sharding": sharding.op5_sharding,
    "op6_personal_data": pii.op6_personal_data,
    "op7_licence_scan": licences.op7_licence_scan,
    "op8_line_dedup": linededup.op8_line_dedup,
    "op9_near_dedup": neardup.op9_near_dedup,
    "op10_packing": packing.op10_packing,
    "op11_collocations": phrases.op11_collocations,
    "op12_sentencepiece": pieces.op12_sentencepiece,
    "op13_alignment": crosstok.op13_alignment,
}
SQL = sql.SQL
