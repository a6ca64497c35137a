"""The registered queries of this package and the SQL that checks them, where SQL can express them."""

from __future__ import annotations

from . import (chat, decontaminate, hilbert, host_rules, jaccard, manifest, mixing, pages, spelling, suffix_dedup, token_store, toxicity,
               vector_search)

QUERIES = {
    "op1_token_store": token_store.query,
    "op2_jaccard_join": jaccard.query,
    "op3_host_rules": host_rules.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_hilbert_shards": hilbert.query,
    "op6_chat_format": chat.query,
    "op7_page_text": pages.query,
    "op8_decontaminate": decontaminate.query,
    "op9_mix_sources": mixing.query,
    "op10_toxicity": toxicity.query,
    "op11_vector_search": vector_search.query,
    "op12_spelling_variants": spelling.query,
    "op13_merkle_manifest": manifest.query,
}

SQL = {
    "op2_jaccard_join": jaccard.SQL,
    "op3_host_rules": host_rules.SQL,
    "op6_chat_format": chat.SQL,
    "op11_vector_search": vector_search.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_merkle_manifest": manifest.SQL,
}
