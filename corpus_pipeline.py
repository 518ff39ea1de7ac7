"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.functions.shared_tables import delete_written_tables, written_so_far, written_table
from basketlens.llm import anchors, mixing, packing, quality, similar
from basketlens.llm.tokens import default_tokenizer
from basketlens.llm.workers import find_package

#: Chunks of text whose ids a worker remembers, some 200 bytes each.
REMEMBERED_CHUNKS = 100_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the repetition rules go, and so do null and empty
    texts, which have no word.  Repeated rows are judged alike; null ids do
    not matter; an empty table stays empty."""
    find_package(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more between their sets
    of 5-word shingles the one with the smallest doc_id stays.  Pairs are
    found by 25 fingerprints, 7 or fewer differing bits in one of them (a
    fingerprint alone finds about a quarter of the pairs with 0.8), and verified.

    Rows without doc_id stay, as nothing tells them apart; all rows of a
    doc_id stay or go together.  Texts without a word are alike.  An empty
    table stays empty."""
    find_package(spark)
    before = written_so_far()
    found = similar.similar_groups(docs, similarity=0.8, shingle=5, bits=7, words=similar.FINGERPRINTS)
    others = written_table(found.filter("doc_id <> component_id").select("doc_id"), "near-duplicates")
    delete_written_tables(spark, before, keep=1)  # the search is over
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the document with the smallest
    doc_id only; documents of which nothing is left go.  Null and empty texts
    stay, as empty ones.  Rows without doc_id count as the smallest; rows of one doc_id
    take nothing from each other.  An empty table stays empty."""
    find_package(spark)
    return anchors.without_repeats(docs, window=50)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw that evens out sources, languages and topics.  Null sources and
    languages are values of their own; repeated rows of a doc_id are drawn
    together.  An empty table stays empty."""
    find_package(spark)
    return mixing.chosen_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens.
    Workers stay for the other stages of a next run, so they remember less."""
    find_package(spark)
    return packing.pack_documents(docs, default_tokenizer(), capacity=2048, end_id=0, remembered=REMEMBERED_CHUNKS)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("source mix", source_mix),
    ("best-fit packing", packed),
]

#: The stages cannot be expressed in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on its way is removed
    when its result is there."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), written_so_far()
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        delete_written_tables(spark, before, keep=1)
    return docs
