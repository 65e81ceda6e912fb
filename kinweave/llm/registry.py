"""The queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from .decontaminate import op4_decontamination
from .language_id import op10_language_id
from .license_scan import op8_license_scan
from .minhash import OP13_SQL, op13_minhash
from .mixing import op6_mixing
from .ranking import OP11_SQL, op11_grouped_ranking
from .simhash import op2_simhash
from .substring_dedup import op1_substring_dedup
from .token_store import op3_token_output
from .topk import OP5_SQL, op5_top_k
from .toxicity import op7_toxicity
from .warc import OP9_SQL, op9_warc_archive
from .whitening import op12_whitening

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash": op2_simhash,
    "op3_token_output": op3_token_output,
    "op4_decontamination": op4_decontamination,
    "op5_top_k": op5_top_k,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_license_scan": op8_license_scan,
    "op9_warc_archive": op9_warc_archive,
    "op10_language_id": op10_language_id,
    "op11_grouped_ranking": op11_grouped_ranking,
    "op12_whitening": op12_whitening,
    "op13_minhash": op13_minhash,
}

SQL: dict[str, str] = {"op5_top_k": OP5_SQL, "op9_warc_archive": OP9_SQL, "op11_grouped_ranking": OP11_SQL, "op13_minhash": OP13_SQL}
