"""The queries of this folder, one for each operator, and their SQL where there is any."""

from __future__ import annotations

from .chat_tree import OP7_SQL, op7_chat_tree
from .collocations import OP11_SQL, op11_collocations
from .decontaminate import op9_decontamination
from .language import op4_language
from .minhash import op13_minhash
from .packing import op1_packing
from .periodic_runs import op12_periodic_runs
from .quality import op8_quality
from .quality_rules import op3_quality_rules
from .simhash import op2_simhash
from .token_counts import op5_token_counts
from .token_files import op6_token_files
from .url_filter import OP10_SQL, op10_url_filter

QUERIES = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_language": op4_language,
    "op5_token_counts": op5_token_counts,
    "op6_token_files": op6_token_files,
    "op7_chat_tree": op7_chat_tree,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_url_filter": op10_url_filter,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_minhash": op13_minhash,
}
ORACLE_SQL = {"op7_chat_tree": OP7_SQL, "op10_url_filter": OP10_SQL, "op11_collocations": OP11_SQL}
