"""The registered queries of this subpackage, over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import centroids, decontaminate, extraction, jaccard, langid, licenses, linededup, packing, quality, rules, sharding, toxicity, turns
from voxloom.llm.common import documents
from voxloom.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": lambda spark, folder: quality.query(documents(spark, folder), table(spark, folder, "labels")),
    "op2_license_scan": lambda spark, folder: licenses.query(documents(spark, folder)),
    "op3_language_id": lambda spark, folder: langid.query(documents(spark, folder)),
    "op4_line_dedup": lambda spark, folder: linededup.query(documents(spark, folder)),
    "op4_passage_dedup": lambda spark, folder: linededup.passage_query(documents(spark, folder)),
    "op5_toxicity": lambda spark, folder: toxicity.query(documents(spark, folder), table(spark, folder, "labels")),
    "op6_decontamination": lambda spark, folder: decontaminate.query(
        documents(spark, folder), table(spark, folder, "benchmark")
    ),
    "op7_sharding": lambda spark, folder: sharding.query(documents(spark, folder)),
    "op8_packing": lambda spark, folder: packing.query(documents(spark, folder)),
    "op9_quality_rules": lambda spark, folder: rules.query(documents(spark, folder)),
    "op10_jaccard_join": lambda spark, folder: jaccard.query(documents(spark, folder)),
    "op11_html_extraction": lambda spark, folder: extraction.query(table(spark, folder, "pages")),
    "op12_centroid_clustering": lambda spark, folder: centroids.query(table(spark, folder, "embeddings")),
    "op13_conversation_repair": lambda spark, folder: turns.query(table(spark, folder, "conversations")),
}
ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.sql(),
    "op4_line_dedup": linededup.sql(),
    "op4_passage_dedup": linededup.passage_sql(),
    "op6_decontamination": decontaminate.sql(),
    "op9_quality_rules": rules.sql(),
    "op12_centroid_clustering": centroids.sql(),
    "op13_conversation_repair": turns.sql(),
}
