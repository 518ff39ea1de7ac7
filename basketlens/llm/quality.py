"""Quality rules on repetition: how much of a text its own repeats cover."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.rolling import Rolling, Words, covered, grouped, mixed, repeated, slices

#: Largest share of a text's word characters inside repeated runs of n words
#: (published rules for large web corpora, fixed values), and inside lines
#: that occurred before.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARS_LIMIT = 0.20
LEAST_WORDS = 10
REPEAT_WORDS_PERCENT = 20

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_share double, worst_ngram_share double"
)


def measure(texts: list[bytes], ngram_limits: dict[int, float] | None = None) -> list[np.ndarray]:
    """The columns behind ``doc_id``, a value for each text."""
    limits = NGRAM_LIMITS if ngram_limits is None else ngram_limits
    words, n = Words(texts), len(texts)
    per_text = lambda flags: np.add.reduceat(np.append(flags, 0), words.text_starts)
    chars = (words.data & 0xC0 != 0x80) & ~words.space
    char_sums = np.concatenate([[0], np.cumsum(chars)])
    word_chars, symbols = per_text(chars), per_text(_SYMBOLS[words.data])
    of_text = lambda weights: np.bincount(words.text_of, weights, n).astype(np.int64)

    # A line before it: same bytes, same text, earlier.
    line_ends = np.flatnonzero(words.data == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1])
    raw = Rolling(np.arange(256, dtype=np.uint64)[words.data] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    line_text = np.searchsorted(words.text_ends, line_starts, side="right")
    line_chars = char_sums[line_ends] - char_sums[line_starts]
    wordy = line_chars > 0
    keys = mixed(raw.of(line_starts, line_ends) + line_text.astype(np.uint64))[wordy]
    later = repeated(keys)[1]
    dup_lines = np.bincount(line_text[wordy], later, n).astype(np.int64)
    dup_line_chars = np.bincount(line_text[wordy], later * line_chars[wordy], n)

    each_word = char_sums[words.ends] - char_sums[words.starts]
    rolling = Rolling(words.hashes())
    salt = mixed(words.text_of.astype(np.uint64))
    repeat_words = np.zeros(n, np.int64)
    worst = np.zeros(n)
    bad = dup_line_chars > LINE_CHARS_LIMIT * word_chars
    for size, limit in sorted({5: 1.0, **limits}.items()):
        inside = np.flatnonzero(words.whole(size))
        found, later = repeated(mixed(rolling.windows(size)[inside] + salt[inside]))
        if size == 5:
            repeat_words = of_text(covered(inside[found], 5, len(each_word)))
        share = of_text(covered(inside[later], size, len(each_word)) * each_word) / np.maximum(word_chars, 1)
        bad |= share > limit
        worst = np.maximum(worst, share)
    failed = (words.counts < LEAST_WORDS) | (100 * repeat_words > REPEAT_WORDS_PERCENT * words.counts)
    return [words.counts, word_chars, symbols, dup_lines, repeat_words, failed, ~failed & ~bad, dup_line_chars / np.maximum(word_chars, 1), worst]


def repetition_quality(docs: DataFrame, ngram_limits: dict[int, float] | None = None) -> DataFrame:
    """Word, symbol and repetition counts of each document and whether it is
    kept: not failed by the base rules, and no more of its word characters
    than the limits in repeated runs of words or lines.  Of a repeated run
    all but the first count for the limits.

    Null and empty texts have no word and fail.  Each row is judged alone,
    so repeated rows get equal results; only ``doc_id`` and ``text`` are
    read.  An empty table gives an empty result.
    """
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in COLUMNS.split(", "))])

    def judge(batches):
        for batch in slices(batches):
            at = 0
            for texts in grouped(batch.column(1).to_pylist()):
                found = measure(texts, ngram_limits)
                columns = [batch.column(0).slice(at, len(texts)), *(pa.array(c, f.type) for c, f in zip(found, list(schema)[1:]))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(judge, COLUMNS)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows whose text passes, with all their columns as they are."""

    text = [c.lower() for c in docs.columns].index("text")

    def filtered(batches):
        for batch in slices(batches):
            masks = [measure(group)[6] for group in grouped(batch.column(text).to_pylist())]
            yield batch.filter(pa.array(np.concatenate(masks)))

    return docs.mapInArrow(filtered, docs.schema)
