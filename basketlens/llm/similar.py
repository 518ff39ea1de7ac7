"""Near-duplicates by word shingles, found by SimHash and then verified.

Fingerprints in vantage-point trees (``simhash``) propose pairs; a pair is a
link if the sets of its shingles are similar enough, which is computed
exactly.  Not all proposed pairs are made.  First each text is compared with
the first one near to it in each shard, which joins most groups at once.
Where proposals hang together and links do not, the texts of such a group
are searched again for all pairs that cross what links have joined; a pair
that bitmaps of both sets rule out is dropped where it is found, so a family
of texts that are near but not similar gives few rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.joins import lookup
from basketlens.functions.shared_tables import written_table
from basketlens.llm import simhash
from basketlens.llm.components import components
from basketlens.llm.rolling import slices

#: Fingerprints of a text: at 7 bits, together they miss about one in 500 of
#: the pairs with similarity 0.8 (binomial model), and fewer above.
FINGERPRINTS = 25
#: Fingerprints of a shard that one task of the second search asks for.
ASKED_AT_ONCE = 131_072
#: Numbers of 64 bits in the bitmap of a set of shingles.
BITMAP_WORDS = 16
#: Pairs of bitmaps that are compared at once, some 128 bytes each.
PAIRS_AT_ONCE = 16_384
#: Bits that stand for the doc_ids of which the texts are read again.
ASKED_BITS = 1 << 23
#: Texts in at least this part of the pairs have their pairs spread.
HOT_LIMIT = 200


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    return np.unique(simhash.shingle_hashes(text, shingle))


def bitmap_of(hashes: np.ndarray) -> np.ndarray:
    """``BITMAP_WORDS`` numbers with the bits that some hash falls on."""
    bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
    bits[(hashes % np.uint64(len(bits))).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def may_be_similar(bitmaps: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the sets at the places ``a`` and ``b`` can have the similarity.

    A bit that one set has and the other lacks is a hash that they do not
    share, so bits bound what they share from above: no pair is lost."""
    found = np.empty(len(a), bool)
    for at in range(0, len(a), PAIRS_AT_ONCE):
        x, y = a[at : at + PAIRS_AT_ONCE], b[at : at + PAIRS_AT_ONCE]
        one, other = bitmaps[x], bitmaps[y]
        shared = np.minimum(
            sizes[x] - np.bitwise_count(one & ~other).sum(axis=1, dtype=np.int64),
            sizes[y] - np.bitwise_count(other & ~one).sum(axis=1, dtype=np.int64),
        )
        found[at : at + PAIRS_AT_ONCE] = shared >= similarity * (sizes[x] + sizes[y] - shared) - 1e-6
    return found


def _described(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """(doc_id, key, size, fp, bitmap): digest and size of the set of
    shingles, ``words`` fingerprints of it and its bitmap."""

    def describe(batches):
        from xxhash import xxh3_128_digest

        for batch in slices(batches):
            sets = [shingle_set(t, shingle) for t in batch.column(1).to_pylist()]
            fps = simhash.fingerprints_of_hashes(sets, words).view(np.int64)
            keys = pa.array([xxh3_128_digest(s.astype("<u8").tobytes()) for s in sets], pa.binary())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            bitmaps = [bitmap_of(s).view(np.int64) for s in sets]
            columns = [batch.column(0), keys, sizes, pa.array(fps.tolist(), pa.list_(pa.int64())), pa.array(bitmaps, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "size", "fp", "bitmap"])

    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(describe, "doc_id long, key binary, size long, fp array<long>, bitmap array<long>")


def _pairs(found: DataFrame) -> DataFrame:
    return found.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _asked_texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, text) of the ``asked`` doc_ids, which are distinct.  A bitmap
    of them, of bounded size, is broadcast first, so that few other texts are
    moved.  (A semi-join would be pushed below it.)"""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(ASKED_BITS))
    word, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    set_bits = written_table(asked.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")), "asked")
    texts = docs.select(F.col("doc_id").cast("long"), "text").withColumn("word", word)
    texts = texts.join(F.broadcast(set_bits), "word").filter(F.col("bits").bitwiseAND(bit) != 0)
    return texts.select("doc_id", "text").join(asked, "doc_id")


def similar_pairs(pairs: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The ``pairs`` a - b of doc_ids of which texts have at least this
    similarity: common shingles to all shingles of both."""

    def sets(batches):
        for batch in slices(batches):
            found = [shingle_set(t, shingle).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "hashes"])

    asked = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = _asked_texts(docs, asked)
    held = written_table(texts.mapInArrow(sets, "node long, hashes array<long>"), "shingle-sets")
    both = lookup(pairs, held.toDF("a", "of_a"), "a", "inner", HOT_LIMIT)
    both = lookup(both, held.toDF("b", "of_b"), "b", "inner", HOT_LIMIT, counted=pairs)
    common = F.size(F.array_intersect("of_a", "of_b"))
    every = F.size("of_a") + F.size("of_b") - common
    alike = F.when(every == 0, 1.0).otherwise(common / every)  # a doc_id may have an empty text among others
    return both.filter(alike >= similarity).select("a", "b").distinct()


def crossing_pairs(texts: DataFrame, bits: int, words: int, similarity: float) -> DataFrame:
    """All pairs a - b of ``texts`` (node, fp, size, bitmap, label, main) that
    lie close by any fingerprint, have unlike labels, are not both ``main``
    and whose sizes and bitmaps allow the similarity."""
    parts = simhash.parts_for(bits)
    bitmap = [f"bitmap{k}" for k in range(BITMAP_WORDS)]
    held = [F.col("bitmap")[k].alias(c) for k, c in enumerate(bitmap)]
    each = texts.select("node", "label", "size", F.col("main").cast("long").alias("main"), *held, F.posexplode("fp").alias("word", "fp"))
    found = simhash.placed(written_table(each, "crossing"), bits, simhash.SHARD_SIZE_OF_WORDS, words)
    places = written_table(found.withColumn("live", F.col("home") & (F.col("main") == 0)), "places")
    pieces = written_table(places.groupBy("shard").agg(F.ceil(F.count("*") / ASKED_AT_ONCE).alias("pieces")), "pieces")
    own = F.pmod(F.xxhash64("node"), "pieces")
    there = F.when(F.col("live"), F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).otherwise(F.array(own))
    cut = lookup(places, pieces, "shard").withColumn("own", own).withColumn("piece", F.explode(there))

    def cross(key: tuple, table: pa.Table) -> pa.Table:
        fps, node, label, size = (table[c].to_numpy() for c in ("fp", "node", "label", "size"))
        live = np.flatnonzero(table["live"].to_numpy())
        ask = np.flatnonzero(table["own"].to_numpy() == table["piece"].to_numpy())
        bitmaps = np.stack([table[c].to_numpy().view(np.uint64) for c in bitmap], axis=1)
        found = [pa.table({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})]
        for a, b in simhash.close_pairs(fps.view(np.uint64), live, ask, key[0].as_py() // words % parts, bits):
            fits = (label[a] != label[b]) & (np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]) - 1e-6)
            a, b = a[fits], b[fits]
            fits = may_be_similar(bitmaps, size, a, b, similarity)
            found.append(pa.table({"a": node[a[fits]], "b": node[b[fits]]}))
        return pa.concat_tables(found)

    shards = cut.select("shard", "piece", "own", "live", "fp", "node", "label", "size", *bitmap).groupBy("shard", "piece")
    return _pairs(shards.applyInArrow(cross, "a long, b long"))


def similar_groups(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, bits: int = 7, words: int = FINGERPRINTS) -> DataFrame:
    """(doc_id, component_id) for each doc_id: the smallest doc_id that links
    reach.  Texts link if the sets of their ``shingle``-word runs (A-Z in
    lower case; shorter texts are one run) have at least ``similarity`` in
    common and one of ``words`` fingerprints differs in at most ``bits`` bits.

    Texts without a word (null ones too) are alike.  Rows without doc_id are
    left out; repeated rows give one; a doc_id with several texts links
    them.  Only ``doc_id`` and ``text`` are read; an empty table gives an
    empty result.
    """
    described = written_table(_described(docs, shingle, words), "described")
    texts = described.groupBy("key").agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ("fp", "size", "bitmap")))
    texts = written_table(texts, "distinct")
    shared = written_table(lookup(described.select("doc_id", "key"), texts.select("key", "node"), "key"), "shared")
    several = shared.groupBy("doc_id").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most")
    several = shared.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))

    proposed = written_table(simhash.links_of_words(texts, bits, words), "proposed")
    tried = written_table(_pairs(proposed.select("a", F.col("near").alias("b"))), "tried")
    first = components(similar_pairs(tried, docs, shingle, similarity).unionByName(several))
    first = written_table(first, "joined")

    hang_together = components(proposed.select("a", "b").unionByName(several)).withColumnRenamed("component", "group")
    label = F.coalesce("component", "node").alias("label")
    labels = written_table(hang_together.join(first, "node", "left").select("node", "group", label), "labels")
    # The label most nodes of a group have: none of its own nodes cross.
    sizes = labels.groupBy("group", "label").agg(F.count("*").alias("n")).groupBy("group")
    apart = sizes.agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.count("*").alias("labels")).filter("labels > 1")
    again = lookup(labels, apart.select("group", "most"), "group", "inner").withColumn("main", F.col("label") == F.col("most"))
    again = texts.join(again.select("node", "label", "main"), "node")
    crossing = crossing_pairs(again, bits, words, similarity).join(tried, ["a", "b"], "left_anti")
    second = similar_pairs(written_table(crossing, "crossing-pairs"), docs, shingle, similarity)

    links = second.unionByName(first.select(F.col("node").alias("a"), F.col("component").alias("b")))
    linked = written_table(components(links), "similar")
    return lookup(shared, linked, "node").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
