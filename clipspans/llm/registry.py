"""The registered queries of this folder, with their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipspans.llm import byte_bpe, collocations, decontaminate, exact_dedup, prefix_trie, quality, sentencepiece_unigram, sharding, simhash, token_files, toxicity, url_rules, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": sentencepiece_unigram.op1_sentencepiece,
        "op2_quality": quality.op2_quality,
        "op3_warc_audit": warc.op3_warc_audit,
        "op4_simhash": simhash.op4_simhash,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_hash_tree_shards": sharding.op6_hash_tree_shards,
        "op7_exact_dedup": exact_dedup.op7_exact_dedup,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_url_rules": url_rules.op9_url_rules,
        "op10_token_files": token_files.op10_token_files,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_byte_bpe": byte_bpe.op12_byte_bpe,
        "op13_collocations": collocations.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_audit": warc.SQL, "op5_decontaminate": decontaminate.SQL, "op7_exact_dedup": exact_dedup.SQL, "op9_url_rules": url_rules.SQL, "op11_prefix_trie": prefix_trie.SQL, "op13_collocations": collocations.SQL}
