"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from monthwise.llm import prefix_trie, quality, substring_dedup, vector_codes
from monthwise.llm.embedding_dedup import op9_embedding_dedup
from monthwise.llm.html_extract import op5_html_text
from monthwise.llm.near_dedup import op1_near_dedup
from monthwise.llm.packing import op8_packing
from monthwise.llm.pii import op3_pii
from monthwise.llm.prefix_trie import op13_prefix_trie
from monthwise.llm.quality import op2_quality_rules
from monthwise.llm.sentencepieces import op6_sentencepiece
from monthwise.llm.sharding import op7_sharding
from monthwise.llm.substring_dedup import op12_substring_dedup
from monthwise.llm.toxicity import op4_toxicity
from monthwise.llm.vector_codes import op11_vector_codes
from monthwise.llm.warc import op10_warc


def registry() -> dict:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_quality_rules": op2_quality_rules,
        "op3_pii": op3_pii,
        "op4_toxicity": op4_toxicity,
        "op5_html_text": op5_html_text,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_sharding": op7_sharding,
        "op8_packing": op8_packing,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_warc": op10_warc,
        "op11_vector_codes": op11_vector_codes,
        "op12_substring_dedup": op12_substring_dedup,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": quality.ORACLE,
        "op11_vector_codes": vector_codes.ORACLE,
        "op12_substring_dedup": substring_dedup.ORACLE,
        "op13_prefix_trie": prefix_trie.ORACLE,
    }
