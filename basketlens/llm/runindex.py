"""Repeated byte strings by run-length indexes.

A run-compressed Burrows-Wheeler transform of some segments, with the text
positions at the ends of its runs, is enough to find every long match among
them: between two run heads, the match length at text position i + 1 is the
one at i less one.  So the lengths at run heads, streamed along the text,
are the matching statistics of the segments against all others.

To keep indexes small and matches together, segments meet by content.  Each
window holds an anchor, a byte n-gram with the least hash of some window,
and a core around it that all windows of the same half share.  Cores that
occur once rule out unrepeated text; segments of equal content are repeated
as a whole and are indexed once.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import written_table
from basketlens.llm.blocks import Block, per_block, with_findings, written_blocks
from basketlens.llm.rolling import Rolling, byte_values, covered, mixed

GRAM = 32
#: Bytes of segments in one index, about, and segments with one core at most.
INDEX_BYTES = 1 << 20
MOST_SEGMENTS = 2_048

KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SEGMENT = "core long, block long, start long, stop long, shift int, low int, high int, text binary"


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (a ufunc) of each stretch of ``width`` values."""
    n, rows = len(x), -(-len(x) // width)
    padded = np.concatenate([x, np.full(rows * width - n, x[-1], x.dtype)]).reshape(rows, width)
    ahead = best.accumulate(padded, axis=1).ravel()
    behind = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


class _Anchored:
    """The halves of windows around each anchor of a block: ``core`` and
    ``hull`` are hashes; ``start`` and ``stop`` bound the bytes of the
    half's windows, ``shift`` is how many of its first windows are missing
    because the document starts later."""

    def __init__(self, block: Block, window: int):
        self.data = np.frombuffer(b"".join(block.texts), np.uint8)
        self.ends = np.cumsum(block.sizes)
        self.starts = self.ends - block.sizes
        half = (window - GRAM) // 2
        rolling = Rolling(byte_values(self.data))
        at, text = self._anchors(rolling, window)
        begin, end = self.starts[text], self.ends[text]
        parts = []
        for low, high, core in (
            (at + GRAM - window, at - half, (at - half, at + GRAM)),
            (at - half + 1, at, (at, at - half + 1 + window)),
        ):
            first, last = np.maximum(low, begin), np.minimum(high, end - window)
            some = first <= last
            cores = rolling.of(core[0][some], core[1][some]) ^ np.uint64(len(parts))
            hulls = rolling.of(first[some], last[some] + window)
            parts.append((cores, hulls, first[some], last[some] + window, (first - low)[some], (high - low)[some]))
        self.core, self.hull, self.start, self.stop, self.shift, self.high = (np.concatenate(c) for c in zip(*parts))

    def _anchors(self, rolling: Rolling, window: int) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(self.data), window - GRAM + 1
        if n < window:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        grams = rolling.windows(GRAM)
        text = np.repeat(np.arange(len(self.ends)), self.ends - self.starts)
        whole = self.ends[text[: n - window + 1]] - np.arange(n - window + 1) >= window
        least = np.where(whole, _sliding(grams, width, np.minimum), np.uint64(0))
        around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        at = np.flatnonzero(_sliding(around, width, np.maximum) == grams)
        return at, text[at]


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes in order, by doubling of compared prefixes; suffixes must
    differ within ``depth`` symbols."""
    n = len(symbols)
    width = int(symbols.max() + 1).bit_length()
    step = max(1, 62 // width)
    packed = np.zeros(n, np.int64)
    for k in range(step):
        packed <<= width
        packed[: n - k] |= symbols[k:].astype(np.int64) + 1
    order = np.argsort(packed, kind="stable")
    heads = np.concatenate([[True], packed[order][1:] != packed[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    bits = n.bit_length()
    while step < depth:
        # Only suffixes that share their rank are compared further.
        tied = ~(heads & np.append(heads[1:], True))
        places = np.flatnonzero(tied)
        if not len(places):
            break
        who = order[places]
        ahead = np.where(who + step < n, rank[np.minimum(who + step, n - 1)] + 1, 0)
        key = rank[who] << bits | ahead
        if 3 * bits <= 64:
            low = np.sort(key.astype(np.uint64) << np.uint64(bits) | who.astype(np.uint64))
            key, who = low >> np.uint64(bits), (low & np.uint64((1 << bits) - 1)).astype(np.int64)
        else:
            by = np.argsort(key, kind="stable")
            key, who = key[by], who[by]
        order[places] = who
        heads[places] = np.concatenate([[True], key[1:] != key[:-1]])
        rank[who] = np.maximum.accumulate(np.where(heads[places], places, 0))
        step *= 2
    return order


class RunIndex:
    """A run-length index of segments: the run-compressed transform and, at
    the two ends where runs meet, the text positions."""

    def __init__(self, segments: list[bytes]):
        n = len(segments)
        sizes = np.fromiter(map(len, segments), np.int64, n)
        self.ends = np.cumsum(sizes + 1) - 1  # where the separators are
        self.starts = self.ends - sizes
        data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
        symbols = data.astype(np.int32) + n
        symbols[self.ends] = np.arange(n)  # a separator of its own for each
        order = suffix_order(symbols, int(sizes.max(initial=0)) + 1)
        before = symbols[order - 1]
        self.heads = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.run_symbols = before[np.concatenate([[0], self.heads])]
        #: Text positions on either side of each border between runs.
        self.samples = order[self.heads - 1], order[self.heads]
        self.rolling = Rolling(byte_values(data))
        self.size = len(data)

    def _match_lengths(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The borders whose sides agree over ``least`` bytes or more: both
        positions and how long they agree, within their segments."""
        a, b = self.samples
        left = [self.ends[np.searchsorted(self.ends, x)] - x for x in (a, b)]
        room = np.minimum(*left)
        a, b, room = (x[room >= least] for x in (a, b, room))
        same = self.rolling.of(a, a + least) == self.rolling.of(b, b + least)
        a, b, high = a[same], b[same], room[same]
        low = np.full(len(a), least)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.rolling.of(a, a + middle) == self.rolling.of(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return a, b, low

    def repeated(self, least: int) -> np.ndarray:
        """Which bytes a string of ``least`` bytes covers that also starts
        elsewhere: the streamed matching statistics reach beyond them."""
        a, b, length = self._match_lengths(least)
        reach = np.zeros(self.size, np.int64)
        for side in (a, b):
            np.maximum.at(reach, side, side + length)
        return np.maximum.accumulate(reach) > np.arange(self.size)


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def _halved(segments: DataFrame, window: int) -> DataFrame:
    """Segments cut into two by the place of their windows around the
    anchor, each half with a larger core of its own."""

    def cut(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                middle = (row["low"] + row["high"] + 1) // 2
                raw = np.frombuffer(row["text"], np.uint8)
                rolling = Rolling(byte_values(raw))
                for low, high in ((row["low"], middle - 1), (middle, row["high"])):
                    first = max(low, row["shift"])
                    last = min(high, row["shift"] + len(raw) - window)
                    if first > last:
                        continue
                    a, b = first - row["shift"], last - row["shift"] + window
                    core = rolling.of(np.array([high - row["shift"]]), np.array([low - row["shift"] + window]))
                    core = mixed(core ^ mixed(np.array([row["core"]]).view(np.uint64) + np.uint64(high)))
                    rows.append((int(core.view(np.int64)[0]), row["block"], row["start"] + a, row["start"] + b, first, low, high, row["text"][a:b]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[f.split()[0] for f in SEGMENT.split(", ")]).cast(_SEGMENT_SCHEMA)

    return segments.mapInArrow(cut, SEGMENT)


def _joined(segments: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Segments of one index, with those that share bytes of a document put
    together, so that each place of the corpus is there once."""
    rows = sorted(zip(*(segments[n].to_pylist() for n in ("block", "start", "text"))), key=lambda r: r[:2])
    parts: list[list] = []
    for block, start, text in rows:
        if parts and parts[-1][0] == block and start < (end := parts[-1][1] + len(parts[-1][2])):
            parts[-1][2] += text[end - start :]
        else:
            parts.append([block, start, bytearray(text)])
    blocks, starts, texts = zip(*parts)
    return np.array(blocks, np.int64), np.array(starts, np.int64), [bytes(t) for t in texts]


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_SEGMENT_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in SEGMENT.split(", "))])


def _bounded(segments: DataFrame, window: int, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Segments with at most ``most`` different ones to a core, and the spans
    found on the way.  Cores with more are halved until they have fewer; a
    half that is a single window has one content only.  A round goes over
    the halves of the last one alone."""
    done, found = [], []
    while True:
        hot = segments.groupBy("core").agg(F.count("*").alias("n")).filter(F.col("n") > most)
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, [*done, segments]), found
        hot = written_table(hot.select("core"), "hot")
        done.append(segments.join(hot, "core", "left_anti"))
        halves = _halved(segments.join(hot, "core", "left_semi"), window).dropDuplicates(["core", "block", "start", "stop"])
        halves = written_table(halves, "halves").withColumn("hull", F.sha2("text", 256))
        classes = halves.groupBy("core", "hull").agg(F.count("*").alias("n"), F.min(F.struct("block", "start")).alias("one"))
        marked = halves.join(classes, ["core", "hull"])
        found.append(marked.filter("n > 1").select("block", "start", "stop"))
        ones = marked.filter("one.block = block AND one.start = start")
        segments = written_table(ones.select(*segments.columns), "segments")


def repeated_spans(docs: DataFrame, window: int, index_bytes: int = INDEX_BYTES, most: int = MOST_SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """The blocks of ``docs``, and (block, start, stop): byte spans, by place
    in the block, that repeated strings of ``window`` bytes cover."""
    if window < 2 * GRAM:
        raise ValueError(f"a window needs {2 * GRAM} bytes at least")
    blocks = written_blocks(docs)

    def list_halves(block: Block):
        found = _Anchored(block, window)
        order = np.lexsort((found.start, found.hull, found.core))
        core, hull, start = found.core[order], found.hull[order], found.start[order]
        firsts = np.flatnonzero(np.concatenate([[True], (core[1:] != core[:-1]) | (hull[1:] != hull[:-1])])) if len(core) else order
        lasts = np.append(firsts[1:], len(core)) - 1
        several = start[firsts] != start[lasts]
        columns = [core[firsts].view(np.int64), hull[firsts].view(np.int64), np.full(len(firsts), block.number), several]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["core", "hull", "block", "several"])

    listed = per_block(blocks, list_halves, "core long, hull long, block long, several boolean")
    core, hull = Window.partitionBy("core"), Window.partitionBy("core", "hull")
    shared = (
        listed.withColumn("n", F.count("*").over(core))
        .withColumn("any", F.max("several").over(core))
        .filter("n > 1 OR any")
        .withColumn("kinds", F.min("hull").over(core) != F.max("hull").over(core))
        .withColumn("whole", F.max("several").over(hull) | (F.count("*").over(hull) > 1))
        .withColumn("sent", F.col("kinds") & (F.min("block").over(hull) == F.col("block")))
        .select("block", "core", "hull", "whole", "sent")
    )

    def cut(block: Block, findings: pa.Table) -> pa.Table:
        if not findings.num_rows:
            return _SEGMENT_SCHEMA.empty_table()
        found = _Anchored(block, window)
        wanted = {(c, h): (w, s) for c, h, w, s in zip(*(findings[n].to_pylist() for n in ("core", "hull", "whole", "sent")))}
        cores, hulls = found.core.view(np.int64), found.hull.view(np.int64)
        rows, spans = [], []
        for i in np.flatnonzero(np.isin(cores, findings["core"].to_numpy())).tolist():
            whole, sent = wanted.get((int(cores[i]), int(hulls[i])), (False, False))
            start, stop = int(found.start[i]), int(found.stop[i])
            if whole:
                spans.append((start, stop))
            if sent:
                wanted[int(cores[i]), int(hulls[i])] = (whole, False)
                rows.append((int(cores[i]), block.number, start, stop, int(found.shift[i]), 0, int(found.high[i]), found.data[start:stop].tobytes()))
        if spans:
            at = np.array(spans)
            for a, b in zip(*_spans(covered(at[:, 0], at[:, 1] - at[:, 0], len(found.data)))):
                rows.append((None, block.number, int(a), int(b), None, None, None, None))
        return pa.table([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * 8, _SEGMENT_SCHEMA)], schema=_SEGMENT_SCHEMA)

    cuts = written_table(with_findings(blocks, shared, cut, SEGMENT), "segments")
    segments, found = _bounded(cuts.filter("text IS NOT NULL"), window, most)
    segments = written_table(segments, "segments") if found else segments
    total = segments.agg(F.sum(F.length("text"))).first()[0] or 0
    indexes = max(1, -(-total // index_bytes))

    def mark(table: pa.Table) -> pa.Table:
        blocks_of, begins, texts = _joined(table)
        index = RunIndex(texts)
        starts, stops = _spans(index.repeated(window))
        owner = np.searchsorted(index.ends, starts)
        shift = begins[owner] - index.starts[owner]
        return pa.table({"block": blocks_of[owner], "start": starts + shift, "stop": stops + shift})

    dealt = segments.select(F.pmod(F.xxhash64("core"), F.lit(indexes)).alias("index"), "block", "start", "text")
    found.append(dealt.groupBy("index").applyInArrow(mark, "block long, start long, stop long"))
    found.append(cuts.filter("text IS NULL").select("block", "start", "stop"))
    return blocks, reduce(DataFrame.unionByName, found)


def without_repeats(docs: DataFrame, window: int = 400, **limits: int) -> DataFrame:
    """Per document: its bytes, how many go and in how many runs, and the
    hash of the rest.

    A byte goes if a string of ``window`` bytes that covers it also starts
    anywhere else, in the same document too; matches lie within documents.
    Equal segments are told by 128 bits of hash, match lengths by 64.  Null
    and empty texts have no bytes; repeated rows count as documents of their
    own.  Only ``doc_id`` and ``text`` are read; an empty table gives an
    empty result.
    """
    blocks, spans = repeated_spans(docs, window, **limits)

    def keep(block: Block, findings: pa.Table) -> pa.Table:
        data = b"".join(block.texts)
        starts, stops = findings["start"].to_numpy(), findings["stop"].to_numpy()
        gone = covered(starts, stops - starts, len(data))
        ends = np.cumsum(block.sizes)
        removed, runs, hashes = [], [], []
        raw = np.frombuffer(data, np.uint8)
        for a, b in zip((ends - block.sizes).tolist(), ends.tolist()):
            own = gone[a:b]
            removed.append(int(own.sum()))
            runs.append(len(_spans(own)[0]) if removed[-1] else 0)
            hashes.append(hashlib.sha256(raw[a:b][~own] if removed[-1] else data[a:b]).hexdigest())
        return pa.table({"doc_id": block.ids_column(), "n_bytes": block.sizes, "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(runs, pa.int64()), "kept_sha256": pa.array(hashes, pa.string())})

    return with_findings(blocks, spans, keep, KEPT)
