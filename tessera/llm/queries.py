"""The queries of this subpackage, and their DuckDB SQL where SQL expresses them."""

from . import bpe, conversation_repair, fingerprints, line_dedup, media, ngram_join, packing, quality_rules, sharding, spelling, substring_dedup, suffix_dedup, toxicity

QUERIES = {
    "op1_media_columns": media.query,
    "op2_byte_bpe": bpe.query,
    "op3_best_fit_packing": packing.query,
    "op4_toxicity": toxicity.query,
    "op5_line_dedup": line_dedup.query,
    "op6_ngram_jaccard_join": ngram_join.query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_extendible_sharding": sharding.query,
    "op9_suffix_array_dedup": suffix_dedup.query,
    "op10_quality_rules": quality_rules.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_spelling_variants": spelling.query,
    "op13_document_fingerprints": fingerprints.query,
}
SQL = {
    "op5_line_dedup": line_dedup.SQL,
    "op6_ngram_jaccard_join": ngram_join.SQL,
    "op7_substring_dedup": substring_dedup.SQL,
    "op8_extendible_sharding": sharding.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_document_fingerprints": fingerprints.SQL,
}
