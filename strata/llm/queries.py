"""The queries of this package: opN_<name> over the given tables, and their SQL where there is one."""

from __future__ import annotations

from .alignment import op11_token_alignment
from .decontaminate import OP8_SQL, op8_decontamination
from .exact import OP13_SQL, op13_digest_index
from .lines import op4_fuzzy_lines
from .merkle import OP12_SQL, op12_merkle_manifest
from .neardup import op3_minhash
from .packing import op5_packing
from .pii import op10_semi_crf_pii
from .quality import op6_mil_quality
from .rules import op9_rule_ledger
from .sharding import op1_kd_shards
from .toxicity import op2_pu_toxicity
from .urls import OP7_SQL, op7_url_filter

QUERIES = {
    "op1_kd_shards": op1_kd_shards,
    "op2_pu_toxicity": op2_pu_toxicity,
    "op3_minhash": op3_minhash,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_packing": op5_packing,
    "op6_mil_quality": op6_mil_quality,
    "op7_url_filter": op7_url_filter,
    "op8_decontamination": op8_decontamination,
    "op9_rule_ledger": op9_rule_ledger,
    "op10_semi_crf_pii": op10_semi_crf_pii,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_digest_index": op13_digest_index,
}

ORACLE_SQL = {
    "op7_url_filter": OP7_SQL,
    "op8_decontamination": OP8_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_digest_index": OP13_SQL,
}
