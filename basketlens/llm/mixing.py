"""Mixing sources, languages and topics to target weights.

Token counts per cell (source, language, topic) are raked by iterative
proportional fitting until each marginal meets its target, with no cell
above what it has.  A document is drawn with its cell's probability.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.shared_tables import written_table

#: The columns of a cell, and what targets call them.
CELL = {"source": "source", "lang": "lang", "__topic": "topic"}
#: Share of the tokens that is kept, and the power that evens out shares
#: where no targets are given (1: as they are, 0: all equal).
KEPT_SHARE, EVENNESS = 0.7, 0.7
TOPICS, TOPIC_WORD_CHARS = 8, 5
#: Cells are metadata; more than this is a wrong column.
MOST_CELLS = 1_000_000


def topic_of(words: list[str], topics: int = TOPICS) -> int:
    """Documents with the same dominant longer word share a topic; -1
    without such a word.  Ties go to the first word by code point."""
    counts = Counter(w for w in words if len(w) >= TOPIC_WORD_CHARS)
    if not counts:
        return -1
    most = max(counts.values())
    return zlib.crc32(min(w for w, n in counts.items() if n == most).encode()) % topics


def rake(tokens: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray], budget: float, rounds: int = 500, close: float = 1e-9) -> np.ndarray:
    """Weights, at most ``tokens``, of which each dimension's categories
    (``places``: a category for each cell) hold their ``targets`` (shares)
    of ``budget`` as nearly as what is there allows."""
    weights = tokens * min(1.0, budget / max(tokens.sum(), 1e-300))
    for _ in range(rounds):
        before = weights
        for place, share in zip(places, targets):
            now = np.bincount(place, weights, len(share)).astype(float)
            factors = np.divide(share * budget, now, out=np.ones_like(now), where=now > 0)
            weights = np.minimum(weights * factors[place], tokens)
        if np.abs(weights - before).max(initial=0.0) <= close * max(budget, 1.0):
            break
    return weights


def _described(docs: DataFrame, topics: int) -> DataFrame:
    """The documents with ``__tokens`` (words) and ``__topic``."""

    def describe(batches):
        for batch in batches:
            rows = [(len(words), topic_of(words, topics)) for words in ((t or "").split() for t in batch.column("text").to_pylist())]
            added = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "__tokens", "__topic"])

    return docs.mapInArrow(describe, T.StructType([*docs.schema.fields, T.StructField("__tokens", T.LongType()), T.StructField("__topic", T.IntegerType())]))


def _probabilities(described: DataFrame, targets: dict[str, dict], kept_share: float, evenness: float) -> DataFrame:
    """The probability of each cell."""
    cells = described.groupBy(*CELL).agg(F.sum("__tokens").alias("tokens"))
    rows = cells.limit(MOST_CELLS + 1).collect()
    if len(rows) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells of source, language and topic")
    tokens = np.array([r["tokens"] for r in rows], float)
    places, shares = [], []
    for column, name in CELL.items():
        values = {v: i for i, v in enumerate(dict.fromkeys(r[column] for r in rows))}
        place = np.array([values[r[column]] for r in rows], np.int64)
        if name in targets:
            share = np.array([float(targets[name].get(v, 0.0)) for v in values])
        else:
            share = np.bincount(place, tokens, len(values)) ** evenness
        places.append(place)
        shares.append(share / max(share.sum(), 1e-300))
    weights = rake(tokens, places, shares, kept_share * tokens.sum())
    chances = np.where(tokens > 0, weights / np.maximum(tokens, 1), 1.0)
    schema = T.StructType([*(cells.schema[c] for c in CELL), T.StructField("__probability", T.DoubleType())])
    return cells.sparkSession.createDataFrame([(*(r[c] for c in CELL), float(p)) for r, p in zip(rows, chances)], schema)


def _drawn(described: DataFrame, chances: DataFrame, seed: int) -> DataFrame:
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in CELL]
    uniform = F.shiftrightunsigned(F.xxhash64("d.doc_id", F.lit(seed)), 11) / float(1 << 53)
    joined = described.alias("d").join(F.broadcast(chances).alias("p"), same)  # at most MOST_CELLS rows
    return joined.select("d.*", "p.__probability", (uniform < F.col("p.__probability")).alias("__chosen"))


def mixture(docs: DataFrame, targets: dict[str, dict] | None = None, kept_share: float = KEPT_SHARE, evenness: float = EVENNESS, topics: int = TOPICS, seed: int = 7) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability, chosen) of every
    document.  ``targets`` gives shares by value for any of ``source``,
    ``lang`` and ``topic``.

    Null sources and languages are values of their own.  A text without
    words (null, empty) weighs nothing and is always chosen.  The draw is by
    hash of doc_id, so repeated rows share their fate and reruns agree.  An
    empty table gives an empty result; other columns are not read.
    """
    narrow = _described(docs.select("doc_id", "source", "lang", "text"), topics).drop("text")
    described = written_table(narrow, "described")
    drawn = _drawn(described, _probabilities(described, targets or {}, kept_share, evenness), seed)
    new = {"__topic": "topic", "__tokens": "n_tokens", "__probability": "probability", "__chosen": "chosen"}
    return drawn.select("doc_id", "source", "lang", *(F.col(a).alias(b) for a, b in new.items()))


def chosen_rows(docs: DataFrame, targets: dict[str, dict] | None = None, kept_share: float = KEPT_SHARE, evenness: float = EVENNESS, topics: int = TOPICS, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that the same draw chooses, with their columns."""
    chances = _probabilities(_described(docs.select("source", "lang", "text"), topics), targets or {}, kept_share, evenness)
    return _drawn(_described(docs, topics), chances, seed).filter("__chosen").select(*docs.columns)
