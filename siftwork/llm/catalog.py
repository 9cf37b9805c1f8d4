"""The queries of this subpackage, by name, and their oracle SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, collocations, decontamination, jaccard_join, language_id, main_text, mixing, ngram_model, prefix_trie, quality_rules, secret_scan, sharding, site_quality
from .common import table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": lambda spark, d: sharding.digest(table(spark, d, "documents")),
    "op2_benchmark_decontamination": lambda spark, d: decontamination.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op3_quality_classifier": lambda spark, d: site_quality.site_quality(table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_bpe_encoding": lambda spark, d: bpe.digests(table(spark, d, "documents"), tokenizer_path()),
    "op5_language_id": lambda spark, d: language_id.predict(table(spark, d, "documents")),
    "op6_jaccard_join": lambda spark, d: jaccard_join.jaccard_join(table(spark, d, "documents")),
    "op7_secret_scans": lambda spark, d: secret_scan.scan(table(spark, d, "documents")),
    "op8_html_extraction": lambda spark, d: main_text.main_text(table(spark, d, "pages")),
    "op9_lm_scoring": lambda spark, d: ngram_model.score(table(spark, d, "documents")),
    "op10_quality_rules": lambda spark, d: quality_rules.quality_rules(table(spark, d, "documents")),
    "op11_prefix_trie": lambda spark, d: prefix_trie.digest(table(spark, d, "conversations")),
    "op12_collocations": lambda spark, d: collocations.collocations(table(spark, d, "documents")),
    "op13_source_mixing": lambda spark, d: mixing.digest(table(spark, d, "documents")),
}
ORACLES: dict[str, str] = {}
