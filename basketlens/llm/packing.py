"""Best-fit packing of token pieces by minimum bin slack.

Documents are cut into pieces of at most ``capacity`` tokens.  How many
pieces have each length - at most ``capacity`` numbers, at any corpus size -
is all that the packing plan depends on: per bin the longest piece left
opens it, and a bitset subset-sum over the lengths left finds the fullest
set beside it.  The same set would win again while its lengths last, so it
is taken as often as they do, and each set uses up at least one length.
Pieces then find their place from their rank among those of their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import written_table
from basketlens.llm.tokens import REMEMBERED_CHUNKS

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def fullest_set(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose sum comes
    closest to ``room`` from below; of equal sums the one with longer ones."""
    mask = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        layers.append((length, reach))
        for _ in range(min(counts[length], room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            reach = wider
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(layers):
        while not before >> total & 1:
            total -= length
            chosen[length] = chosen.get(length, 0) + 1
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, pieces of each length in one bin) until all are used."""
    left, plan = {k: n for k, n in counts.items() if n}, []
    while left:
        longest = max(left)
        rest = {k: n - (k == longest) for k, n in left.items() if n > (k == longest)}
        chosen = fullest_set(rest, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        plan.append((times, chosen))
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _places(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces per bin, offset), sorted."""
    used: dict[int, int] = {}
    rows, first_bin = [], 0
    for times, chosen in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            each = chosen[length]
            rows.append((length, used.get(length, 0), first_bin, each, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        first_bin += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, remembered: int = REMEMBERED_CHUNKS) -> DataFrame:
    """One row per piece: where it starts in its document, its length, the
    checksum of its ids, and its number among the task's pieces of its length."""

    def cut(batches):
        from pyspark import TaskContext

        from basketlens.llm.tokens import encoder

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        texts_to_ids = encoder(tokenizer, end_id, remembered).encode
        for batch in batches:
            doc_ids, at = batch.column(0).to_pylist(), 0
            for ids, sizes in texts_to_ids(batch.column(1)):
                raw = memoryview(ids.astype("<u4")).cast("B")
                rows, begin = [], 0
                for size in sizes.tolist():
                    start, length = 0, size % capacity or capacity
                    for piece in range(-(-size // capacity)):
                        crc = zlib.crc32(raw[4 * (begin + start) : 4 * (begin + start + length)])
                        rows.append((doc_ids[at], piece, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                        start, length = start + length, capacity
                    begin, at = begin + size, at + 1
                yield _batch(rows, PIECES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, remembered: int = REMEMBERED_CHUNKS) -> DataFrame:
    """Place every piece of every document in a sequence.  Workers remember
    the ids of ``remembered`` chunks of text: fewer take less memory and more
    time.

    Null and empty texts hold the end id alone.  Of a document longer than
    ``capacity`` the first piece takes the remainder.  Repeated rows are
    packed one by one, ties within a length go by place in the input, an
    empty table gives an empty result, and only ``doc_id`` and ``text`` are
    read, whatever else there is.
    """
    pieces = written_table(token_pieces(docs, tokenizer, capacity, end_id, remembered), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    places = _places(plan_bins({r["length"]: r["n"] for r in histogram}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(batches):
        keys = places[:, 0] << 48 | places[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = places[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[f.split()[0] for f in PLACED.split(", ")])

    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("base"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, PLACED)
