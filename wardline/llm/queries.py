"""The operators' queries by name, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.llm.bm25 import op3_bm25_search
from wardline.llm.chat import OP7_SQL, op7_chat_format
from wardline.llm.decontaminate import OP4_SQL, op4_decontaminate
from wardline.llm.huffman import op10_huffman_files
from wardline.llm.hyperminhash import OP13_SQL, op13_hyperminhash
from wardline.llm.importance import OP11_SQL, op11_importance_resample
from wardline.llm.kneser_ney import op9_lm_score
from wardline.llm.language_id import op6_language_id
from wardline.llm.packing import op1_pack
from wardline.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from wardline.llm.secrets import op2_secret_scan
from wardline.llm.simhash import op8_simhash_near_dedup
from wardline.llm.substring_dedup import OP5_SQL, op5_substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pack,
        op2_secret_scan,
        op3_bm25_search,
        op4_decontaminate,
        op5_substring_dedup,
        op6_language_id,
        op7_chat_format,
        op8_simhash_near_dedup,
        op9_lm_score,
        op10_huffman_files,
        op11_importance_resample,
        op12_prefix_trie,
        op13_hyperminhash,
    )
}

#: The others need a tokenizer, a hash or a search that SQL does not have; the tests hold them against plain Python.
SQL: dict[str, str] = {
    "op4_decontaminate": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op7_chat_format": OP7_SQL,
    "op11_importance_resample": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_hyperminhash": OP13_SQL,
}
