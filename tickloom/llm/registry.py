"""Queries of the training-data operators, and the SQL that some of them can be held against."""

from __future__ import annotations

from tickloom.llm import exact_dedup, language, line_dedup, mixing, packing, prefix_trie, private_terms, quality, resampling, simhash, tokens, transport_stream, warc


def queries() -> dict:
    return {
        "op1_private_terms": private_terms.op1_private_terms,
        "op2_warc_writer": warc.op2_warc_writer,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_source_mixing": mixing.op4_source_mixing,
        "op5_simhash_covering": simhash.op5_simhash_covering,
        "op6_language_centroids": language.op6_language_centroids,
        "op7_mixture_packing": packing.op7_mixture_packing,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op9_transport_stream": transport_stream.op9_transport_stream,
        "op10_quality_classifier": quality.op10_quality_classifier,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_token_counts": tokens.op12_token_counts,
        "op13_importance_resampling": resampling.op13_importance_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc_writer": warc.ORACLE,
        "op3_exact_dedup": exact_dedup.ORACLE,
        "op11_prefix_trie": prefix_trie.ORACLE,
        "op13_importance_resampling": resampling.ORACLE,
    }
