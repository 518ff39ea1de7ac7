"""Substring deduplication by difference-cover anchors.

A difference cover of a period holds, for any two positions, a common shift
below the period that takes both onto it.  So two equal windows of words,
wherever they start, have equal shorter hashes at some pair of cover
positions inside: the anchors.  Anchors that occur once rule out nearly all
unrepeated text; only windows around the others are hashed in full, and the
smallest document of each decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.blocks import Block, per_block, with_findings, written_blocks
from basketlens.llm.rolling import Rolling, Words, covered

#: A perfect difference set: every remainder is a difference of two of these.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)

KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class _Anchored:
    """The words of a block and their anchors of ``size`` words."""

    def __init__(self, block: Block, window: int):
        self.words = Words(block.texts)
        self.values = [self.words.hashes(k) for k in range(2)]
        self.rolling = [Rolling(v, k) for k, v in enumerate(self.values)]
        self.window, self.size = window, window - PERIOD + 1
        place = np.arange(len(self.words.starts)) - self.words.firsts[self.words.text_of]
        on_cover = np.isin(place % PERIOD, COVER)[: max(0, len(place) - self.size + 1)]
        self.at = np.flatnonzero(on_cover & self.words.whole(self.size))
        self.hashes = self.rolling[0].windows(self.size)[self.at]

    def windows_around(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the anchors."""
        whole = self.words.whole(self.window)
        near = covered(np.maximum(anchors - PERIOD + 1, 0), anchors - np.maximum(anchors - PERIOD + 1, 0) + 1, len(self.words.starts))
        return np.flatnonzero(whole & near[: len(whole)])

    def window_hashes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = starts + self.window
        return tuple(r.of(starts, ends) for r in self.rolling)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of equal keys."""
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return firsts, np.append(firsts[1:], len(keys))[: len(firsts)] - 1


def _repeats(blocks: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The ``blocks``, and per block the hashes of its windows that also start
    in a smaller document, with that document."""
    if window < PERIOD + 8:
        raise ValueError(f"a window needs {PERIOD + 8} words at least")

    def list_anchors(block: Block):
        found = _Anchored(block, window)
        owner = block.doc_ids[found.words.text_of[found.at]]
        order = np.lexsort((owner, found.hashes))
        keys, owner = found.hashes[order], owner[order]
        firsts, lasts = _runs(keys)
        columns = [_signed(keys[firsts]), pa.array(np.full(len(firsts), block.number)), pa.array(owner[firsts] != owner[lasts])]
        yield pa.RecordBatch.from_arrays(columns, names=["hash", "block", "several"])

    # One row per block and anchor; ``several`` documents of the block have it.
    listed = per_block(blocks, list_anchors, "hash long, block long, several boolean")
    same = Window.partitionBy("hash")
    counted = listed.withColumn("n", F.count("*").over(same)).withColumn("any", F.max("several").over(same))
    shared = counted.filter("n > 1 OR any").select("block", "hash")

    def list_windows(block: Block, findings: pa.Table) -> pa.Table:
        found = _Anchored(block, window)
        hits = found.at[np.isin(found.hashes, findings["hash"].to_numpy().view(np.uint64))]
        starts = found.windows_around(hits)
        first, second = found.window_hashes(starts)
        owner = block.doc_ids[found.words.text_of[starts]]
        order = np.lexsort((owner, first))
        first, second, owner = first[order], second[order], owner[order]
        firsts, lasts = _runs(first)
        return pa.table(
            {
                "first": _signed(first[firsts]),
                "second": (second[firsts] >> np.uint64(32)).astype(np.uint32).view(np.int32),
                "block": np.full(len(firsts), block.number),
                "owner": owner[firsts],
                "several": owner[firsts] != owner[lasts],
            }
        )

    listed = with_findings(blocks, shared, list_windows, "first long, second int, block long, owner long, several boolean")
    same = Window.partitionBy("first", "second")
    least = listed.withColumn("least", F.min("owner").over(same))
    return blocks, least.filter("owner > least OR several").select("block", "first", "least")


def _removed(block: Block, findings: pa.Table, window: int) -> tuple[Words, np.ndarray]:
    """Which words of a block go."""
    words = Words(block.texts)
    if not findings.num_rows:
        return words, np.zeros(len(words.starts), bool)
    first = findings["first"].to_numpy().view(np.uint64)
    order = np.argsort(first)
    first, least = first[order], findings["least"].to_numpy()[order]
    starts = np.flatnonzero(words.whole(window))
    mine = Rolling(words.hashes()).of(starts, starts + window)
    at = np.minimum(np.searchsorted(first, mine), len(first) - 1)
    gone = (first[at] == mine) & (block.doc_ids[words.text_of[starts]] > least[at])
    return words, covered(starts[gone], window, len(words.starts))


def _kept_texts(block: Block, words: Words, gone: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Words removed per text, and the rest joined by single spaces."""
    removed = np.bincount(words.text_of, gone, len(block.texts)).astype(np.int64)
    texts, data = [], words.data.tobytes()
    for i, text in enumerate(block.texts):
        if not removed[i]:
            texts.append(b" ".join(text.split()))
            continue
        own = slice(words.firsts[i], words.firsts[i] + words.counts[i])
        here = np.flatnonzero(~gone[own]) + own.start
        texts.append(b" ".join(data[a:b] for a, b in zip(words.starts[here].tolist(), words.ends[here].tolist())))
    return removed, texts


def deduplicated(docs: DataFrame, window: int = 50) -> DataFrame:
    """Per document: its words, how many of them go, and the hash of the rest.

    A word goes if a window of ``window`` words that covers it, in the same
    word sequence, also starts in a document with a smaller doc_id.  Windows
    are found by 96 bits of hash, and their words by 64 of these.  Null and
    empty texts have no words.
    Rows with the same doc_id do not remove each other's words, and a null
    doc_id is smaller than all others.  Only ``doc_id`` and ``text`` are
    read; an empty table gives an empty result.
    """
    blocks, repeats = _repeats(written_blocks(docs), window)

    def digest(block: Block, findings: pa.Table) -> pa.Table:
        words, gone = _removed(block, findings, window)
        removed, texts = _kept_texts(block, words, gone)
        hashes = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
        return pa.table({"doc_id": block.ids_column(), "n_words": words.counts, "n_removed": removed, "kept_sha256": hashes})

    return with_findings(blocks, repeats, digest, KEPT)


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """The documents with what ``deduplicated`` keeps: a text that loses
    words is the rest joined by single spaces, and ``n_chars``, if there,
    its length; one that loses all goes.  Other texts and columns stay as
    they are."""
    carried = tuple(c for c in docs.columns)
    blocks, repeats = _repeats(written_blocks(docs, carried=tuple(c for c in carried if c != "text")), window)

    def rebuild(block: Block, findings: pa.Table) -> pa.Table:
        words, gone = _removed(block, findings, window)
        removed, kept = _kept_texts(block, words, gone)
        texts = [(k if r else t).decode() for r, k, t in zip(removed, kept, block.texts)]
        rows = block.carried()
        rows = rows.append_column("text", pa.array(texts, pa.string()))
        if "n_chars" in rows.column_names:
            lengths = pa.array([len(t) if r else None for r, t in zip(removed, texts)], pa.int64())
            merged = pc.coalesce(lengths, rows["n_chars"].cast(pa.int64())).cast(rows.schema.field("n_chars").type)
            rows = rows.set_column(rows.column_names.index("n_chars"), "n_chars", merged)
        return rows.select(carried).filter(pa.array((removed == 0) | np.array([bool(t) for t in texts], bool)))

    return with_findings(blocks, repeats, rebuild, docs.schema)
