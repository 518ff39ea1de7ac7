"""Documents in compressed blocks.

A block is one row with some megabytes of whole texts.  Passes over the
corpus that need its texts again shuffle blocks, a third the size of the
texts, and what one pass finds is sent per block, not per occurrence.
Blocks are written once, so their numbers stay the same for later passes.
Parquet does not compress them again: its codec would hold whole pages of
large rows in memory outside the heap, for nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketlens.functions.shared_tables import written_table

BLOCK_BYTES = 2 << 20
BLOCK = "block long, doc_ids binary, sizes binary, texts binary, rest binary"
COLUMNS = [f.split()[0] for f in BLOCK.split(", ")]
NO_ID = -(1 << 63)


def written_blocks(docs: DataFrame, limit: int = BLOCK_BYTES, carried: tuple[str, ...] = ()) -> DataFrame:
    """The texts of ``docs`` in blocks of about ``limit`` bytes; a longer
    text has a block of its own.  Null texts are empty.  Null ids are kept
    as ``NO_ID``, the smallest integer.  Columns named in ``carried`` come
    along as they are."""

    def pack(batches):
        import zstandard
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        compressor = zstandard.ZstdCompressor(level=3)
        ids, texts, rest, held = [], [], [], 0

        def block():
            numbers = np.array([NO_ID if i is None else i for i in ids], "<i8")
            sizes = np.array([len(t) for t in texts], "<i8")
            raw = [numbers.tobytes(), sizes.tobytes(), compressor.compress(b"".join(texts))]
            raw.append(compressor.compress(_stream(pa.Table.from_batches(rest).combine_chunks())) if carried else None)
            columns = [pa.array([part << 32 | number]), *(pa.array([b], pa.binary()) for b in raw)]
            return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "sizes", "texts", "rest"])

        for batch in batches:
            others, begin = batch.select(range(2, batch.num_columns)), 0
            for at, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), 1):
                ids.append(doc_id)
                texts.append((text or "").encode())
                held += len(texts[-1])
                if held >= limit:
                    rest.append(others.slice(begin, at - begin))
                    yield block()
                    ids, texts, rest, held, number, begin = [], [], [], 0, number + 1, at
            rest.append(others.slice(begin))
        if ids:
            yield block()

    columns = [F.col("doc_id").cast("long").alias("__id"), F.col("text").alias("__text"), *carried]
    return written_table(docs.select(*columns).mapInArrow(pack, BLOCK), "blocks", compression="uncompressed")


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class Block:
    """A block row, read."""

    def __init__(self, number: int, doc_ids: bytes, sizes: bytes, texts: bytes, rest: bytes | None):
        import zstandard

        self._rest = rest

        self.number, self.doc_ids = number, np.frombuffer(doc_ids, "<i8")
        self.sizes = np.frombuffer(sizes, "<i8")
        data = zstandard.ZstdDecompressor().decompress(texts)
        ends = np.cumsum(self.sizes).tolist()
        self.texts = [data[a:b] for a, b in zip([0, *ends], ends)]

    def carried(self) -> pa.Table:
        """The carried columns, a row for each text."""
        import zstandard

        stream = zstandard.ZstdDecompressor().decompressobj().decompress(self._rest)
        return pa.ipc.open_stream(stream).read_all()

    def ids_column(self) -> pa.Array:
        return pa.array(self.doc_ids, mask=self.doc_ids == NO_ID)


def per_block(blocks: DataFrame, function: Callable[[Block], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``function`` to each block, without moving any."""

    def apply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from function(Block(*(batch.column(k)[i].as_py() for k in range(5))))

    return blocks.select(*COLUMNS).mapInArrow(apply, schema)


def with_findings(blocks: DataFrame, findings: DataFrame, function: Callable[[Block, pa.Table], pa.Table], schema: str | T.StructType) -> DataFrame:
    """Apply ``function`` to each block and the rows of ``findings`` with its
    number; blocks without findings get an empty table."""

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return empty
        return function(Block(*(left.column(k)[0].as_py() for k in range(5))), right)

    kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    empty = to_arrow_schema(kinds).empty_table()
    texts = blocks.select(*COLUMNS)
    return texts.groupBy("block").cogroup(findings.groupBy("block")).applyInArrow(apply, schema)
