"""The registered queries of this folder, and SQL where SQL can express them."""

from __future__ import annotations

from rollcall.llm import (
    bpe,
    conversation_trie,
    embedding_dedup,
    exact_dedup,
    langid,
    ngram_join,
    packing,
    phrases,
    pii,
    quality,
    secret_scan,
    token_store,
    warc,
)

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_warc": warc.op2_warc,
    "op3_pii": pii.op3_pii,
    "op4_packing": packing.op4_packing,
    "op5_secrets": secret_scan.op5_secrets,
    "op6_quality": quality.op6_quality,
    "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_language_id": langid.op9_language_id,
    "op10_bpe": bpe.op10_bpe,
    "op11_token_store": token_store.op11_token_store,
    "op12_prefix_trie": conversation_trie.op12_prefix_trie,
    "op13_collocations": phrases.op13_collocations,
}

SQL = {
    "op8_exact_dedup": exact_dedup.SQL,
    "op12_prefix_trie": conversation_trie.SQL,
    "op13_collocations": phrases.SQL,
}
