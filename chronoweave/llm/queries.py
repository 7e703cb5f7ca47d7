"""Registered queries of the thirteen operators and their SQL."""

from __future__ import annotations

from ..session import ship_package
from . import chat_format, decontaminate, langid, license_scan, mixture, ngram_join, pitman_yor, prefix_trie, quality, spelling, substring_dedup, toxicity, url_rules



def shipped(query):
    """The query, with the package sent to the executors first."""

    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_benchmark_decontamination": decontaminate.op1,
    "op2_url_filters": url_rules.op2,
    "op3_source_mixing": mixture.op3,
    "op4_ngram_jaccard_join": ngram_join.op4,
    "op5_toxicity": toxicity.op5,
    "op6_language_id": langid.op6,
    "op7_license_scans": license_scan.op7,
    "op8_quality_rules": quality.op8,
    "op9_substring_dedup": substring_dedup.op9,
    "op10_chat_formatting": chat_format.op10,
    "op11_lm_scoring": pitman_yor.op11,
    "op12_spelling_variants": spelling.op12,
    "op13_conversation_trie": prefix_trie.op13,
}
QUERIES = {name: shipped(query) for name, query in QUERIES.items()}
SQL = {
    "op2_url_filters": url_rules.ORACLE,
    "op8_quality_rules": quality.ORACLE,
    "op10_chat_formatting": chat_format.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
    "op13_conversation_trie": prefix_trie.ORACLE,
}
