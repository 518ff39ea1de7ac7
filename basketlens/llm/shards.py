"""Token ids in shard files with a minimal perfect hash index.

A shard is one row of a Parquet table: the raw little-endian ids of its
documents in ascending ``doc_id`` order, where each document starts, and an
index from key to document.  The index is a cascade of bit sets: a key that
alone hits a position of a level owns it, the others go to the next level.
The rank of the bit is the key's slot, so n keys have n slots; a slot holds
a fingerprint, which tells strangers, and the first document with that key.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Positions per key of a level; more positions, fewer levels.
SPREAD = 1.5

SHARD = (
    "part int, shard int, start long, n_docs int, n_tokens long, width int, first_key long, last_key long, "
    "keys binary, offsets binary, levels binary, bits binary, fingerprints binary, firsts binary, payload binary"
)
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in SHARD.split(", "))])
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
NO_KEY = -(1 << 63)


def scrambled(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key (the finalizer of a split-mix generator)."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1D8E4E27C47D124F) % 2**64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class PerfectHash:
    """Slots 0..n-1 for n distinct integer keys."""

    def __init__(self, levels: np.ndarray, bits: np.ndarray, fingerprints: np.ndarray):
        self.levels, self.bits, self.fingerprints = levels, bits, fingerprints
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        left, levels, words = keys, [], []
        while len(left):
            size = -(-int(len(left) * SPREAD) // 64) * 64 + 64
            at = (scrambled(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            level = np.zeros(size, np.uint8)
            level[at[alone]] = 1
            levels.append(size)
            words.append(np.packbits(level, bitorder="little").view("<u8"))
            left = left[~alone]
        made = cls(np.array(levels, "<i8"), np.concatenate(words) if words else np.empty(0, "<u8"), np.empty(0, "<u2"))
        made.fingerprints = np.zeros(len(keys), "<u2")
        made.fingerprints[made._slots(keys)] = cls._prints(keys)
        return made

    @staticmethod
    def _prints(keys: np.ndarray) -> np.ndarray:
        return (scrambled(keys, -1) >> np.uint64(48)).astype("<u2")

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.levels.tolist()):
            at = (scrambled(keys[open_], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slots[open_[hit]] = (self.ranks[at >> 6] + below)[hit]
            open_, base = open_[~hit], base + size
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that are not in the index, but
        for one in 65,536 of them, which get some slot."""
        slots = self._slots(keys)
        slots[slots >= 0] = np.where(self.fingerprints[slots[slots >= 0]] == self._prints(keys[slots >= 0]), slots[slots >= 0], -1)
        return slots


class Shard:
    """A shard row, read."""

    def __init__(self, row: dict):
        view = lambda name, kind: np.frombuffer(row[name] or b"", kind)
        self.start, self.keys, self.offsets = row["start"], view("keys", "<i8"), view("offsets", "<i8")
        self.index = PerfectHash(view("levels", "<i8"), view("bits", "<u8"), view("fingerprints", "<u2"))
        self.firsts = view("firsts", "<i4")
        self.payload = view("payload", f"<u{row['width']}")

    def documents_of(self, keys: np.ndarray) -> np.ndarray:
        """The first document with each key, by the index alone; -1 for none."""
        slots = self.index.slots(keys)
        found = np.full(len(keys), -1, np.int64)
        found[slots >= 0] = self.firsts[slots[slots >= 0]]
        return found

    def ids(self, document: int) -> np.ndarray:
        return self.payload[self.offsets[document] : self.offsets[document + 1]].astype("<u4")


def _shard_row(part: int, shard: int, start: int, keys: list, sizes: list[int], ids: list[np.ndarray]) -> tuple:
    stored = np.array([NO_KEY if k is None else k for k in keys], "<i8")
    known = np.array([k is not None for k in keys], bool)
    distinct, firsts = np.unique(stored[known], return_index=True)
    index = PerfectHash.of(distinct)
    by_slot = np.zeros(len(distinct), "<i4")
    by_slot[index.slots(distinct)] = np.flatnonzero(known)[firsts]
    payload = np.concatenate(ids)
    width = 2 if not len(payload) or payload.max() < 1 << 16 else 4
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    raw = [a.tobytes() for a in (stored, offsets, index.levels, index.bits, index.fingerprints, by_slot, payload.astype(f"<u{width}"))]
    return (part, shard, start, len(keys), int(offsets[-1]), width, keys[0], keys[-1], *raw)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_tokens: int = 1 << 19) -> None:
    """Encode every document, in ascending ``doc_id`` order over all shards,
    and write the shards to ``path``.

    Null and empty texts hold the end id alone.  Null keys come first and
    have no index entry.  Rows with the same key, or none, stay next to each
    other, in the order of the input, over as many shards and tasks as they
    need; the index of a shard names the first of them in it.  A shard is
    closed at ``shard_tokens``; a longer document has one of its own.  Only
    ``doc_id`` and ``text`` are read; an empty table gives no shards.
    """

    def encode(batches):
        from pyspark import TaskContext

        from basketlens.llm.tokens import encoder

        part, shard, start = TaskContext.get().partitionId(), 0, 0
        keys, sizes, ids, held = [], [], [], 0
        for batch in batches:
            batch_keys, at = batch.column(0).to_pylist(), 0
            for flat, counts in encoder(tokenizer, end_id).encode(batch.column(1)):
                begin = 0
                for size in counts.tolist():
                    key = batch_keys[at]
                    if keys and held + size > shard_tokens:
                        yield _record(_shard_row(part, shard, start, keys, sizes, ids))
                        start, shard = start + held, shard + 1
                        keys, sizes, ids, held = [], [], [], 0
                    keys.append(key)
                    sizes.append(size)
                    ids.append(flat[begin : begin + size])
                    held, begin, at = held + size, begin + size, at + 1
        if keys:
            yield _record(_shard_row(part, shard, start, keys, sizes, ids))

    # The place in the input cuts what has one key; it costs no look at the text.
    numbered = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("nth"))
    ordered = numbered.repartitionByRange("doc_id", "nth").sortWithinPartitions("doc_id", "nth")
    ordered.select("doc_id", "text").mapInArrow(encode, SHARD).write.option("compression", "zstd").parquet(path)


def _record(row: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SCHEMA)], schema=_SCHEMA)


def open_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``, the ids before each over all shards."""
    shards = spark.read.schema(SHARD).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task that wrote
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return shards.join(F.broadcast(bases), "part").withColumn("base", F.col("base") + F.col("start"))


def read_documents(shards: DataFrame) -> DataFrame:
    """Every document of the shards, found through the index and checked
    against its place in the key order."""

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                shard = Shard(row)
                found = np.where(shard.keys == NO_KEY, -1, shard.documents_of(shard.keys))
                behind = np.arange(len(found)) - found
                if ((found >= 0) & ((behind < 0) | (shard.keys[found] != shard.keys))).any() or ((found < 0) & (shard.keys != NO_KEY)).any():
                    raise ValueError(f"index of shard {row['part']}/{row['shard']} does not match its keys")
                place = np.where(found >= 0, found + behind, np.arange(len(found)))
                crcs = [zlib.crc32(shard.ids(d)) for d in place.tolist()]
                keys = pa.array(shard.keys, mask=shard.keys == NO_KEY)
                columns = [keys, pa.array(row["base"] + shard.offsets[place]), pa.array(shard.offsets[place + 1] - shard.offsets[place]), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in READ.split(", ")])

    return shards.mapInArrow(read, READ)


def fetch(shards: DataFrame, keys: list[int], most: int = 1000) -> DataFrame:
    """Ids of the documents with the given keys (at most ``most`` keys a
    call), by constant-time access to the shards whose key range has them."""
    if len(keys) > most:
        raise ValueError(f"{len(keys)} keys in one call; the limit is {most}")
    wanted = np.unique(np.array(keys, np.int64))

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({n: batch.column(n)[i].as_py() for n in batch.schema.names})
                found = shard.documents_of(wanted)
                for key, document in zip(wanted.tolist(), found.tolist()):
                    while 0 <= document < len(shard.keys) and shard.keys[document] == key:
                        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([shard.ids(document).tolist()], pa.list_(pa.int64()))], names=["doc_id", "ids"])
                        document += 1

    inside = F.lit(False)
    for key in wanted.tolist():
        inside = inside | F.lit(key).between(F.coalesce("first_key", F.lit(NO_KEY)), F.col("last_key"))
    return shards.filter(inside).mapInArrow(read, "doc_id long, ids array<long>")
