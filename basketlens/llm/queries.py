"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import new_path
from basketlens.llm import anchors, audit, codes, graph, language, licences, mixing, packing, quality, runindex, shards, simhash, toxicity
from basketlens.llm.tokens import default_tokenizer
from basketlens.llm.workers import find_package


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, folder), default_tokenizer(), capacity=2048, end_id=0)


def token_shards(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "shards")
    shards.write_shards(_documents(spark, folder), path, default_tokenizer(), end_id=2)
    return shards.read_documents(shards.open_shards(spark, path))


def repetition_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.repetition_quality(_documents(spark, folder))


def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, folder), bits=3, shingle=3)


def anchor_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return anchors.deduplicated(_documents(spark, folder), window=50)


def repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return runindex.without_repeats(_documents(spark, folder), window=400)


def calibrated_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(_documents(spark, folder))


def graph_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    find_package(spark)
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return graph.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def _held_out(parts: int, part: int):
    """Whether crc32 of the id as text leaves ``part``; ids without are learned from by nobody."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


def language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = _documents(spark, folder), _held_out(4, 2)
    found = language.predict(docs, language.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def toxicity_by_compression(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = _documents(spark, folder), _held_out(3, 1)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    found = toxicity.score(docs, toxicity.fit(docs.filter(~held_out), labels), threshold=0.7)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    find_package(spark)
    return codes.compressed(spark.read.parquet(f"{folder}/embeddings.parquet"))


def licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(_documents(spark, folder))


def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": best_fit_packing,
        "op2_calibrated_mixture": calibrated_mixture,
        "op3_token_shards": token_shards,
        "op4_graph_neighbours": graph_neighbours,
        "op5_repeated_bytes": repeated_bytes,
        "op6_language_profiles": language_profiles,
        "op7_toxicity_by_compression": toxicity_by_compression,
        "op8_anchor_dedup": anchor_dedup,
        "op9_repetition_quality": repetition_quality,
        "op10_simhash_groups": simhash_groups,
        "op11_vector_codes": vector_codes,
        "op12_licence_scan": licence_scan,
        "op13_filter_audit": filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_vector_codes": codes.compressed_sql(), "op12_licence_scan": licences.scan_sql(), "op13_filter_audit": audit.AUDIT_SQL}
