"""Queries of this subpackage by key, and their SQL."""

from __future__ import annotations

from .op01_token_ids import op1_token_ids
from .op02_byte_bpe import op2_byte_bpe
from .op03_suffix_dedup import op3_suffix_dedup
from .op04_simhash import op4_simhash
from .op05_licenses import op5_licenses
from .op06_quality_classifier import op6_quality_classifier
from .op07_secrets import op7_secrets
from .op08_quality_rules import OP8_SQL, op8_quality_rules
from .op09_decontamination import op9_decontamination
from .op10_pii import op10_pii
from .op11_periodic_runs import op11_periodic_runs
from .op12_lexical_search import OP12_SQL, op12_lexical_search
from .op13_url_filter import OP13_SQL, op13_url_filter

QUERIES = {
    "op1_token_ids": op1_token_ids,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_simhash": op4_simhash,
    "op5_licenses": op5_licenses,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_secrets": op7_secrets,
    "op8_quality_rules": op8_quality_rules,
    "op9_decontamination": op9_decontamination,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_lexical_search": op12_lexical_search,
    "op13_url_filter": op13_url_filter,
}

ORACLES: dict[str, str] = {
    "op8_quality_rules": OP8_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_url_filter": OP13_SQL,
}
