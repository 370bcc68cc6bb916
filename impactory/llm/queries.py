"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chunk_recipes
from .chroma import op1_chroma
from .chunk_bpe import op7_chunk_bpe
from .chunk_recipes import op13_exact_dedup
from .language_id import op8_language_id
from .line_quality import op6_quality
from .packing import op2_packing
from .pitman_yor import op3_pitman_yor
from .secret_scan import op10_secret_scan
from .simhash import op5_simhash
from .spot_signatures import op9_spot_signatures
from .token_alignment import op12_token_alignment
from .toxicity import op4_toxicity
from .turn_repair import op11_turn_repair

QUERIES = {f.__name__: f for f in (op1_chroma, op2_packing, op3_pitman_yor, op4_toxicity, op5_simhash, op6_quality, op7_chunk_bpe, op8_language_id, op9_spot_signatures, op10_secret_scan, op11_turn_repair, op12_token_alignment, op13_exact_dedup)}
ORACLES: dict[str, str] = {"op13_exact_dedup": chunk_recipes.ORACLE}
