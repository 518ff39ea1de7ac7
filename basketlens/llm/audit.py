"""How five document filters interact, whatever order they run in.

One pass over the bytes of a text, driven by two tables, gives all that the
filters ask about it.  What is left of a document is a set of failed filters
in five bits, so the 120 orders are worked out from 32 counts per part.
"""

from __future__ import annotations

import itertools
import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.joins import lookup
from basketlens.functions.shared_tables import written_table
from basketlens.llm.rolling import grouped, slices

LETTERS = "ABCDE"
#: What a byte is: of a word, a capital, the first of a code point, a symbol.
WORD, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8
#: What a step of the transducer says besides: a word starts here, or ended before.
START, END = 16, 32


@dataclass(frozen=True)
class Limits:
    """A: fewer words than ``least_words``; B: less than ``distinct_percent``
    of the words are distinct; C: more than ``capital_percent`` of the code
    points are A-Z; D: any of ``symbols`` (ASCII); E: a copy."""

    least_words: int = 100
    distinct_percent: int = 80
    capital_percent: int = 10
    symbols: str = "#$%&*|"


def byte_classes(symbols: str) -> np.ndarray:
    classes = np.full(256, WORD | POINT, np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] ^= WORD
    classes[0x80:0xC0] ^= POINT
    classes[ord("A") : ord("Z") + 1] |= CAPITAL
    classes[list(symbols.encode())] |= SYMBOL
    return classes


#: Output by state (whether the byte before was of a word) and byte class;
#: the next state is the WORD bit of the class.
STEPS = np.array([[c | (START if c & ~state & WORD else 0) | (END if state & ~c & WORD else 0) for c in range(16)] for state in (0, 1)], np.uint8)


def transduced(data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The outputs for all bytes; the first byte follows a gap."""
    kinds = classes[data]
    states = np.zeros(len(data), np.uint8)
    states[1:] = kinds[:-1] & WORD
    return STEPS.ravel()[states << 4 | kinds]


class SpanTable:
    """A hash table of byte spans with open addressing.  All spans are put in
    at once, in rounds; a span is taken for the one in its slot only if all
    of their bytes and their owners agree."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray):
        """``data`` ends in eight bytes that no span reaches."""
        self.eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        self.starts, self.lengths, self.owners = starts, ends - starts, owners
        self.heads = self._chunk(np.arange(len(starts)), 0)

    def _chunk(self, spans: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 7 of spans longer than 8k, as a number."""
        unused = np.maximum(0, 8 * (k + 1) - self.lengths[spans]).astype(np.uint64) * np.uint64(8)
        return self.eights[self.starts[spans] + 8 * k] << unused

    def hashes(self) -> np.ndarray:
        found = (self.heads ^ (self.owners.astype(np.uint64) << np.uint64(8)) + self.lengths.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        more, k = np.flatnonzero(self.lengths > 8), 1
        while len(more):
            found[more] = (found[more] ^ found[more] >> np.uint64(29) ^ self._chunk(more, k)) * np.uint64(0xBF58476D1CE4E5B9)
            k += 1
            more = more[self.lengths[more] > 8 * k]
        return (found ^ found >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        alike = (a == b) | (self.heads[a] == self.heads[b]) & (self.lengths[a] == self.lengths[b]) & (self.owners[a] == self.owners[b])
        open_, k = np.flatnonzero(alike & (a != b) & (self.lengths[a] > 8)), 1
        while len(open_):
            differ = self._chunk(a[open_], k) != self._chunk(b[open_], k)
            alike[open_[differ]] = False
            k += 1
            open_ = open_[~differ & (self.lengths[a[open_]] > 8 * k)]
        return alike

    def firsts(self) -> np.ndarray:
        """One span of each kind: which of the spans got a slot."""
        n = len(self.starts)
        bits = max(4, (2 * n).bit_length())
        place = (self.hashes() >> np.uint64(64 - bits)).astype(np.int64)
        table, kept, pending = np.full(1 << bits, -1, np.int64), np.zeros(n, bool), np.arange(n)
        while len(pending):
            at = place[pending]
            free = table[at] < 0
            table[at[free]] = pending[free]
            holder = table[at]
            kept[holder[free]] = True
            pending = pending[~self.same(pending, holder)]
            place[pending] = (place[pending] + 1) & ((1 << bits) - 1)
        return kept


def measured(texts: list[bytes], classes: np.ndarray) -> list[np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text."""
    n = len(texts)
    data = np.frombuffer(b"\n".join(texts) + b"\n" * 9, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    out = transduced(data, classes)
    owner = lambda places: np.searchsorted(ends, places, side="right")
    starts, stops = np.flatnonzero(out & START), np.flatnonzero(out & END)
    owners = owner(starts)
    firsts = SpanTable(data, starts, stops, owners).firsts()
    per_text = lambda owners: np.bincount(owners, minlength=n)[:n]
    inner = np.flatnonzero(out & POINT == 0)
    capitals, symbols = np.flatnonzero(out & CAPITAL), np.flatnonzero(out & SYMBOL)
    return [per_text(owners), per_text(owners[firsts]), per_text(owner(capitals)), sizes - per_text(owner(inner)), per_text(owner(symbols))]


VERDICT = "doc_id long, part string, text_key binary, n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long, mask int"


def verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """What filters A to D find in each document: its counts, and in ``mask``
    a bit for each filter it fails (A is 1).  ``text_key`` is the SHA-256 of
    the text, ``part`` its lang.

    A null text is an empty one, a null lang the part ''.  Rows are judged
    one by one, repeated ones alike; other columns are not read.
    """
    import hashlib

    classes = byte_classes(limits.symbols)

    def judge(batches):
        for batch in slices(batches):
            at = 0
            for texts in grouped(batch.column(2).to_pylist()):
                words, distinct, capitals, points, symbols = found = measured(texts, classes)
                fails = [words < limits.least_words, 100 * distinct < limits.distinct_percent * words]
                fails += [100 * capitals > limits.capital_percent * points, symbols > 0]
                mask = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
                keys = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
                own = [batch.column(k).slice(at, len(texts)) for k in (0, 1)]
                columns = [*own, keys, *(pa.array(c.astype(np.int64)) for c in found), pa.array(mask.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in VERDICT.split(", ")])
                at += len(texts)

    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), part.alias("part"), "text").mapInArrow(judge, VERDICT)


def _outcomes(docs: DataFrame, labels: DataFrame, limits: Limits) -> DataFrame:
    """(part, mask, good, toxic, n): documents by all five filters."""
    # Rows of one document and text are one; so a text with very many copies
    # is spread by doc_id here and reduced in each task below.
    each = verdicts(docs, limits).groupBy("doc_id", "part", "text_key", "mask").agg(F.count("*").alias("n"))
    each = written_table(each, "verdicts")
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))))
    tagged = lookup(each, known, "doc_id").fillna(False, ["good", "toxic"])
    kinds = tagged.groupBy("text_key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnumbered"),
    )
    # Now a text has a row per part and label only.
    first = F.col("least") == F.min("least").over(Window.partitionBy("text_key"))
    kinds = kinds.withColumn("own", F.when(first, F.col("at_least")).otherwise(0) + F.col("unnumbered"))
    own = F.col("own")
    either = F.array(
        F.struct(F.col("mask"), own.alias("n")), F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - own).alias("n"))
    )
    split = kinds.select("part", "good", "toxic", F.explode(either).alias("e")).select("part", "good", "toxic", "e.mask", "e.n")
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def _orders() -> Column:
    """All orders, step by step, as an array column: the filter's bit and
    those of the filters before it."""
    steps = []
    for order in itertools.permutations(range(5)):
        before = 0
        for step, letter in enumerate(order, 1):
            steps.append({"filter_order": "".join(LETTERS[k] for k in order), "step": step, "bit": 1 << letter, "before": before})
            before |= 1 << letter
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """For each part (lang), order of the filters and step: the documents
    kept after it, removed by it, failing its filter but removed before,
    failing its filter only, and of the removed those that ``labels`` call
    good (quality = 1) or toxic (toxic = 1); ``shapley`` is what the filter
    removes in all 120 orders together.

    Filter E fails a document whose text a smaller doc_id has anywhere in
    the table; rows without doc_id come after all others and neither fail it
    nor make others fail.  Null texts are empty, null langs are the part '';
    repeated rows count each; a document with several label rows is good
    (toxic) if one of them says so.  An empty table gives an empty result;
    other columns are not read.
    """
    counts = _outcomes(docs, labels, limits)

    def by_mask(keep: Column | None) -> Column:
        n = F.col("n") if keep is None else F.when(keep, F.col("n")).otherwise(0)
        return F.array(*(F.sum(F.when(F.col("mask") == m, n).otherwise(0)) for m in range(32)))

    arrays = counts.groupBy("part").agg(by_mask(None).alias("every"), by_mask(F.col("good")).alias("good"), by_mask(F.col("toxic")).alias("toxic"))
    steps = arrays.select("*", F.explode(_orders()).alias("o")).select("part", "every", "good", "toxic", "o.*")
    bit, before = F.col("bit"), F.col("before")
    masks = F.array(*map(F.lit, range(32)))

    def total(counts: str, test, share=lambda m: F.lit(1)) -> Column:
        """Documents with a mask of which ``test`` holds, times ``share``."""
        one = lambda m, n: F.when(test(m), n * share(m)).otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.zip_with(masks, counts, one), F.lit(0).cast("long"), lambda a, x: a + x)

    fails = lambda m: m.bitwiseAND(bit) != 0
    gone = lambda m: m.bitwiseAND(before) != 0
    removed = lambda m: fails(m) & ~gone(m)
    # Each failed filter comes first in an equal share of the orders.
    first_in = lambda m: F.floor(F.lit(math.factorial(5)) / F.bit_count(m))
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("every", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("every", removed).alias("removed"),
        total("every", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("every", lambda m: m == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("every", fails, first_in).alias("shapley"),
    )


#: The same in SQL.
AUDIT_SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(ws) < 100 AS INTEGER) + 2 * CAST(100 * len(list_distinct(ws)) < 80 * len(ws) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS mask
    FROM w LEFT JOIN l USING (doc_id)),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, step, letter, bit,
    CAST(coalesce((SELECT sum(x.bit) FROM letters x WHERE strpos(filter_order, x.letter) < step), 0) AS INTEGER) AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS step), letters WHERE letter = filter_order[step]),
r AS (SELECT part, filter_order, step, letter,
    sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM h, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
