"""Queries of the training-data operators, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from .bpe import op3_bpe
from .crf import op13_secrets
from .langid import op6_langid
from .lines import op4_lines
from .packing import op9_pack
from .pii import op1_pii
from .quality import op7_quality
from .resample import OP12_SQL, op12_resample
from .simhash import op2_simhash
from .spotsigs import op8_spotsigs
from .suffixes import op10_repeats
from .urls import op5_urls
from .vectors import OP11_SQL, op11_codes

QUERIES = {
    "op1_pii": op1_pii,
    "op2_simhash": op2_simhash,
    "op3_bpe": op3_bpe,
    "op4_lines": op4_lines,
    "op5_urls": op5_urls,
    "op6_langid": op6_langid,
    "op7_quality": op7_quality,
    "op8_spotsigs": op8_spotsigs,
    "op9_pack": op9_pack,
    "op10_repeats": op10_repeats,
    "op11_codes": op11_codes,
    "op12_resample": op12_resample,
    "op13_secrets": op13_secrets,
}

ORACLES: dict[str, str] = {"op11_codes": OP11_SQL, "op12_resample": OP12_SQL}
