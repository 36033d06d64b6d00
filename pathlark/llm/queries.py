"""The registered queries of the text operators, and their SQL twins."""

from __future__ import annotations

from pathlark.llm.bpe import op9_byte_bpe
from pathlark.llm.decontaminate import op3_decontamination
from pathlark.llm.language import op7_language
from pathlark.llm.lines import op2_near_lines
from pathlark.llm.merkle import ORACLE as MERKLE_SQL
from pathlark.llm.merkle import op12_merkle_manifest
from pathlark.llm.neardup import op4_near_duplicates
from pathlark.llm.passages import op10_repeated_passages
from pathlark.llm.quality import ORACLE as QUALITY_SQL
from pathlark.llm.quality import op6_quality
from pathlark.llm.resample import ORACLE as RESAMPLE_SQL
from pathlark.llm.resample import op13_importance_resampling
from pathlark.llm.secrets import ORACLE as SECRETS_SQL
from pathlark.llm.secrets import op8_secrets
from pathlark.llm.sentence_pieces import op11_sentence_pieces
from pathlark.llm.substrings import op1_repeated_substrings
from pathlark.llm.wavelet import op5_token_shards

QUERIES = {f.__name__: f for f in (
    op1_repeated_substrings, op2_near_lines, op3_decontamination, op4_near_duplicates, op5_token_shards, op6_quality, op7_language, op8_secrets, op9_byte_bpe,
    op10_repeated_passages, op11_sentence_pieces, op12_merkle_manifest, op13_importance_resampling,
)}
ORACLE: dict[str, str] = {
    "op6_quality": QUALITY_SQL, "op8_secrets": SECRETS_SQL, "op12_merkle_manifest": MERKLE_SQL, "op13_importance_resampling": RESAMPLE_SQL,
}
