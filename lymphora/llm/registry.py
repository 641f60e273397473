"""The operators' queries and their SQL."""

from . import bpe, chat, embed, html, jaccard, langid, mixing, quality, search, suffixes

QUERIES = {
    "op1_ngram_jaccard_join": jaccard.query,
    "op2_html_extraction": html.query,
    "op3_source_mixing": mixing.query,
    "op4_suffix_array_dedup": suffixes.query,
    "op5_chat_formatting": chat.query,
    "op6_exact_top_k_search": search.query,
    "op7_embedding_near_dedup": embed.query,
    "op8_byte_level_bpe": bpe.query,
    "op9_quality_classifier": quality.query,
    "op10_language_id": langid.query,
}
ORACLES = {"op1_ngram_jaccard_join": jaccard.SQL, "op4_suffix_array_dedup": suffixes.SQL, "op5_chat_formatting": chat.SQL, "op6_exact_top_k_search": search.SQL, "op7_embedding_near_dedup": embed.SQL}
