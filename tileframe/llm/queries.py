"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from .bpe import op5_bpe
from .language import op9_language
from .licenses import OP8_SQL, op8_licenses
from .line_dedup import OP2_SQL, op2_line_dedup
from .mixing import op6_mixing
from .quality import op3_quality
from .sharding import op1_sharding
from .simhash import op7_simhash
from .syncmers import op4_syncmers
from .topk import OP10_SQL, op10_topk

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_syncmers": op4_syncmers,
    "op5_bpe": op5_bpe,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_licenses": op8_licenses,
    "op9_language": op9_language,
    "op10_topk": op10_topk,
}

ORACLE_SQL = {"op2_line_dedup": OP2_SQL, "op8_licenses": OP8_SQL, "op10_topk": OP10_SQL}
