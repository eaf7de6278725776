"""The queries of this subpackage and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

from .bpe import op10_byte_bpe
from .jaccard import op5_jaccard_join
from .language import op6_language
from .licenses import op7_license_scan
from .media import op9_media
from .mixing import OP4_SQL, op4_mix_sources
from .neighbours import op8_near_vectors
from .pii import op1_pii
from .quality import op2_quality
from .toxicity import op3_toxicity

QUERIES = {
    "op1_pii": op1_pii,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_mix_sources": op4_mix_sources,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_language": op6_language,
    "op7_license_scan": op7_license_scan,
    "op8_near_vectors": op8_near_vectors,
    "op9_media": op9_media,
    "op10_byte_bpe": op10_byte_bpe,
}
ORACLES: dict[str, str] = {"op4_mix_sources": OP4_SQL}
