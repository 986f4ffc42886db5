"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .bpe import op10_bpe
from .conversations import op12_conversation_repair
from .conversations_sql import SQL as CONVERSATIONS_SQL
from .filter_audit import SQL as FILTER_SQL
from .filter_audit import op13_filter_audit
from .html_text import SQL as HTML_SQL
from .html_text import op7_html_text
from .language_id import op9_language_id
from .mixing import op5_mixing
from .quality_cnn import op6_quality_cnn
from .quartile_digest import SQL as DIGEST_SQL
from .quartile_digest import op8_quartile_digest
from .repetition import SQL as REPETITION_SQL
from .repetition import op1_repetition
from .sharding import op4_sharding
from .sharding import sql as sharding_sql
from .simhash_dedup import op3_simhash_dedup
from .simhash_sql import SQL as SIMHASH_SQL
from .token_counts import op11_token_counts
from .toxicity import op2_toxicity

QUERIES = {f.__name__: f for f in (op1_repetition, op2_toxicity, op3_simhash_dedup, op4_sharding, op5_mixing, op6_quality_cnn, op7_html_text, op8_quartile_digest, op9_language_id, op10_bpe, op11_token_counts, op12_conversation_repair, op13_filter_audit)}

#: Training, automata and iterations can't be expressed in SQL; tests/llm holds brute-force versions.
ORACLE_SQL: dict[str, str] = {"op1_repetition": REPETITION_SQL, "op3_simhash_dedup": SIMHASH_SQL, "op4_sharding": sharding_sql(), "op7_html_text": HTML_SQL, "op8_quartile_digest": DIGEST_SQL, "op12_conversation_repair": CONVERSATIONS_SQL, "op13_filter_audit": FILTER_SQL}
