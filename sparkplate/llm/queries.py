"""The registered queries of this subpackage and their SQL twins."""

from sparkplate.llm import (binary, bpe, chat, exact, langid, lines, negatives, ngrams, packing, quality, search, sharding,
                            substrings)

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_packing": packing.op4_packing,
    "op5_exact_dedup": exact.op5_exact_dedup,
    "op6_ngram_join": ngrams.op6_ngram_join,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_language_id": langid.op8_language_id,
    "op9_suffix_dedup": substrings.op9_suffix_dedup,
    "op10_token_files": binary.op10_token_files,
    "op11_sharding": sharding.op11_sharding,
    "op12_lexical_search": search.op12_lexical_search,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}
ORACLE = {
    "op1_quality_rules": quality.ORACLE_SQL,
    "op2_line_dedup": lines.ORACLE_SQL,
    "op3_chat_formatting": chat.ORACLE_SQL,
    "op5_exact_dedup": exact.ORACLE_SQL,
    "op12_lexical_search": search.ORACLE_SQL,
    "op13_hard_negatives": negatives.ORACLE_SQL,
}
