"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from hirescope.llm import (ann, chat_quotes, filter_audit, hmm_lm, html_extract, mixing, ngram_join, prefix_trie, quality,
                           sp_codec, toxicity, url_filter, warc)

QUERIES = {f.__name__: f for f in (
    mixing.op1_source_mixing, html_extract.op2_html_extraction, url_filter.op3_url_filter,
    sp_codec.op4_sentencepiece, chat_quotes.op5_quote_linking, ngram_join.op6_ngram_jaccard,
    hmm_lm.op7_hmm_scoring, warc.op8_warc_index, ann.op9_inverted_multi_index, quality.op10_quality_rules,
    prefix_trie.op11_prefix_trie, toxicity.op12_toxicity, filter_audit.op13_filter_audit)}

ORACLE = {
    "op1_source_mixing": mixing.ORACLE_SQL,
    "op6_ngram_jaccard": ngram_join.ORACLE_SQL,
    "op8_warc_index": warc.ORACLE_SQL,
    "op10_quality_rules": quality.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
