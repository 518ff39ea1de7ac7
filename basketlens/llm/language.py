"""Language identification by rank-order profiles.

A profile lists a language's most frequent letter n-grams by rank.  A
document's own list is compared to each: every n-gram costs the difference
of its ranks, one that the profile lacks the most there is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Documents that a language is learned from, at most.
LEARNED_DOCUMENTS = 2_000
PROFILE_SIZE = 300
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one to three letters, edges of words included, each as
    three code points in one integer, and how often they occur."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points = np.where(_letters()[points], points, 0)
    points = np.concatenate([[0], points, [0]])
    points = points[(points > 0) | np.append(True, points[:-1] > 0)]  # one edge between words
    one, two = points[:-1], points[1:]
    pairs = one << 21 | two
    triples = pairs[:-1] << 21 | points[2:]
    return np.unique(np.concatenate([one[one > 0], pairs, triples[two[:-1] > 0]]), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, ties by their number."""
    return grams[np.lexsort((grams, -counts))[:size]]


@dataclass
class LanguageModel:
    languages: list[str]
    profiles: list[np.ndarray]
    size: int

    def __post_init__(self):
        self.orders = [np.argsort(p) for p in self.profiles]

    def distances(self, own: np.ndarray) -> np.ndarray:
        """The mean cost of an n-gram for each language, between 0 and 1."""
        result = np.ones(len(self.profiles))
        for i, (profile, order) in enumerate(zip(self.profiles, self.orders)):
            if len(profile):
                at = order[np.minimum(np.searchsorted(profile, own, sorter=order), len(profile) - 1)]
                cost = np.where(profile[at] == own, np.abs(at - np.arange(len(own))), self.size)
                result[i] = np.minimum(cost, self.size).mean() / self.size
        return result

    def predict(self, text: str | None) -> tuple[str, float]:
        grams, counts = ngrams(text)
        if len(grams) < 2 or not self.languages:  # no letter: nothing but an edge
            return UNKNOWN, 0.0
        found = self.distances(ranked(grams, counts, self.size))
        order = np.argsort(found, kind="stable")
        best = float(found[order[0]])
        second = float(found[order[1]]) if len(order) > 1 else 1.0
        return self.languages[order[0]], 1 - best / (best + second) if best + second else 0.5


def fit(docs: DataFrame, learned: int = LEARNED_DOCUMENTS, size: int = PROFILE_SIZE) -> LanguageModel:
    """Profiles from at most ``learned`` documents of each language, those
    whose id has the smallest hashes.  Rows without language are left out."""
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang")
    # Of a large language only ids with small hashes, twice as many as wanted
    # by their number, meet in a task; a row per language is broadcast.
    sizes = sample.groupBy("lang").agg(F.count("*").alias("_size"))
    place = F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5
    sample = sample.join(F.broadcast(sizes), "lang").filter(place * F.col("_size") < 2 * learned + 100).drop("_size")
    sample = sample.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= learned).select("doc_id", "lang").distinct()

    def count(batches):
        for batch in batches:
            rows: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.setdefault(lang, []).append(ngrams(text))
            for lang, each in rows.items():
                grams, place = np.unique(np.concatenate([g for g, _ in each]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([n for _, n in each]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

    # At most ``learned`` ids a language.
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(sample), ["doc_id", "lang"]).select("lang", "text")
    counts = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size).collect()
    profiles: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return LanguageModel(list(profiles), [np.array(p, np.int64) for p in profiles.values()], size)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; ``und`` with score 0
    for null texts and those without a letter, or if no language is known.
    The score is the share of the two smallest distances that the second
    has.  Ties go to the first language by name; repeated rows get equal
    results; an empty table gives an empty result; only ``doc_id`` and
    ``text`` are read."""

    def apply(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(apply, "doc_id long, lang_pred string, score double")
