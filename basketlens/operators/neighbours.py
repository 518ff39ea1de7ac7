"""Exact nearest neighbours among the rows of a group, by blocks of points.

Equal points are one point with its smallest keys, so copies are no crowd.
The points of a group are divided, along the widest column at the median
of a bounded sample, into blocks; every block has a box around what it
really holds.  A point finds its nearest in its own block first and then
asks those other blocks only whose boxes are nearer than what it has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketlens.functions.joins import lookup
from basketlens.functions.ordering import top_per_group
from basketlens.functions.scalars import quoted
from basketlens.functions.shared_tables import written_table

#: Points of a block, while there are at most MOST_BLOCKS of them.
BLOCK_POINTS, MOST_BLOCKS = 1_024, 20_000
#: Points, all groups together, from which the cuts between blocks are learned.
SAMPLE = 50_000
#: Points that ask a block in one task.
ASKED_AT_ONCE = 4_096
#: A box counts as nearer by this share, for rounding.
SLACK = 1e-12


def finite_point(columns: Sequence[str]) -> tuple[Column, Column]:
    """The columns as an array of doubles, and whether all are finite."""
    point = F.array(*[quoted(c).cast("double") + F.lit(0.0) for c in columns])
    return point, F.forall(point, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


class Cuts:
    """Binary cuts of space: node i sends points with x[column] <= value to
    left[i], others to right[i]; negative numbers are blocks -1 - b."""

    def __init__(self, sample: np.ndarray, blocks: int, first_block: int):
        self.column, self.value, self.left, self.right = [], [], [], []
        self.blocks = 0
        self.first = first_block
        self.root = self._cut(sample, blocks)

    def _cut(self, sample: np.ndarray, blocks: int) -> int:
        width = sample.max(0) - sample.min(0) if len(sample) else np.zeros(1)
        if blocks <= 1 or not width.max() > 0:
            self.blocks += 1
            return -(self.first + self.blocks)
        column = int(width.argmax())
        # the middle value, or the largest below it if nothing would go right
        values = np.sort(sample[:, column])
        value = values[(len(values) - 1) // 2]
        if value == values[-1]:
            value = values[values < value][-1]
        low = sample[:, column] <= value
        node = len(self.column)
        for each, what in ((self.column, column), (self.value, value), (self.left, 0), (self.right, 0)):
            each.append(what)
        self.left[node] = self._cut(sample[low], -(-blocks // 2))
        self.right[node] = self._cut(sample[~low], blocks // 2)
        return node

    def blocks_of(self, points: np.ndarray) -> np.ndarray:
        at = np.full(len(points), self.root)
        column, value, left, right = map(np.array, (self.column, self.value, self.left, self.right))
        while len(inner := np.flatnonzero(at >= 0)):
            node = at[inner]
            low = points[inner, column[node]] <= value[node]
            at[inner] = np.where(low, left[node], right[node])
        return -1 - at


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks]) if len(column) else np.empty(0)
    return flat.reshape(len(column), -1)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All pairs, column by column in order, so that every engine that adds
    in this order gets the same last bit."""
    total = np.zeros((len(a), len(b)))
    for c in range(a.shape[1]):
        gap = a[:, c, None] - b[None, :, c]
        total += gap * gap
    return total


def _best_of_block(asked: np.ndarray, bounds: np.ndarray, points: np.ndarray, keys: list[np.ndarray], order: dict, k: int) -> Iterator[tuple]:
    """(asker, point, key, squared distance) arrays: for each asker the ``k``
    nearest (distance, key) pairs of the block that are within its bound."""
    many = np.array([len(x) for x in keys])
    step = max(1, (1 << 20) // max(1, len(points)))
    for start in range(0, len(asked), step):
        gaps = squared_distances(asked[start : start + step], points)
        limit = bounds[start : start + step, None]
        if len(points) > k:
            limit = np.minimum(limit, np.partition(gaps, k - 1, axis=1)[:, k - 1 : k])
        row, point = np.nonzero(gaps <= limit)
        gap = gaps[row, point]
        times = many[point]
        row, gap, point = (np.repeat(x, times) for x in (row, gap, point))
        place = np.arange(len(point)) - np.repeat(np.cumsum(times) - times, times)
        names = np.array([order[keys[p][j]] for p, j in zip(point.tolist(), place.tolist())], np.int64)
        best = np.lexsort((names, gap, row))
        row, gap, point, place = row[best], gap[best], point[best], place[best]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        yield row[keep] + start, point[keep], place[keep], gap[keep]


def nearest_in_group(df: DataFrame, key: str, group: str, columns: Sequence[str], k: int = 5) -> DataFrame:
    """(group, key, point, neighbours) of every row: ``neighbours`` lists the
    ``k`` nearest other rows of its group (fewer if there are fewer) as
    (distance, key, point) structs, nearest first, ties to the smaller key.
    ``distance`` is Euclidean over ``columns``.

    Rows without key or group, or with a null or non-finite column, are
    nobody's neighbours and not in the result.  Keys should be unique; rows
    that repeat a key are one neighbour.  A few classes as groups are meant:
    one row per group and block reaches the driver.
    """
    point, finite = finite_point(columns)
    rows = df.select(quoted(group).alias("group"), quoted(key).alias("key"), point.alias("x"))
    rows = rows.filter(finite & F.col("group").isNotNull() & F.col("key").isNotNull())
    held = top_per_group(rows.distinct(), ["group", "x"], [F.col("key")], k + 1)
    points = held.groupBy("group", "x").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    points = written_table(points, "points")
    sizes = {r["group"]: r["n"] for r in points.groupBy("group").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    size = max(BLOCK_POINTS, -(-total // MOST_BLOCKS))

    by_hash = F.pmod(F.xxhash64("x", F.lit("sample")), F.lit(1 << 40)) < F.lit(int(min(1.0, SAMPLE / max(1, total)) * (1 << 40)))
    learned: dict = {g: [] for g in sizes}
    for r in points.filter(by_hash).select("group", "x").toLocalIterator():  # about SAMPLE rows
        learned[r["group"]].append(r["x"])
    cuts, first = {}, 0
    for g, n in sorted(sizes.items(), key=lambda e: str(e[0])):
        sample = np.array(learned[g]) if learned[g] else np.zeros((0, len(columns)))
        cuts[g] = Cuts(sample, -(-n // size), first)
        first += cuts[g].blocks

    types = {"group": rows.schema["group"].dataType, "key": rows.schema["key"].dataType}
    placed_schema = T.StructType([T.StructField("block", T.LongType()), *points.schema.fields])

    def place(batches):
        for batch in batches:
            names = batch.column("group").to_pylist()
            x, block = _matrix(batch.column("x")), np.zeros(batch.num_rows, np.int64)
            for g in set(names):
                own = np.flatnonzero(np.array([n == g for n in names]))
                block[own] = cuts[g].blocks_of(x[own])
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns], names=["block", *batch.schema.names])

    placed = written_table(points.mapInArrow(place, placed_schema), "placed-points")
    ends = [f(F.get("x", F.lit(j))).alias(f"{n}{j}") for n, f in (("low", F.min), ("high", F.max)) for j in range(len(columns))]
    boxes = placed.groupBy("group", "block").agg(*ends).collect()  # at most MOST_BLOCKS rows, and one per group
    lows, highs = (np.array([[r[f"{n}{j}"] for j in range(len(columns))] for r in boxes]) for n in ("low", "high"))
    box_blocks, box_groups = np.array([r["block"] for r in boxes], np.int64), [r["group"] for r in boxes]
    of_group = {g: np.flatnonzero([b == g for b in box_groups]) for g in sizes}

    found = T.ArrayType(T.StructType([T.StructField("gap", T.DoubleType()), T.StructField("key", types["key"]), T.StructField("x", T.ArrayType(T.DoubleType()))]))
    own_schema = T.StructType(
        [T.StructField("group", types["group"]), T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("found", found), T.StructField("bound", T.DoubleType()), T.StructField("blocks", T.ArrayType(T.LongType()))]
    )

    def lists(count: int, pieces: Iterator[tuple], keys: list, x: np.ndarray) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in range(count)]
        for row, point, place_, gap in pieces:
            for r, p, j, g in zip(row.tolist(), point.tolist(), place_.tolist(), gap.tolist()):
                out[r].append({"gap": g, "key": keys[p][j], "x": x[p].tolist()})
        return out

    def ranks(keys: list) -> dict:
        return {name: i for i, name in enumerate(sorted({n for each in keys for n in each}))}

    def own_block(table: pa.Table) -> pa.Table:
        x, keys, g = _matrix(table["x"]), table["keys"].to_pylist(), table["group"][0].as_py()
        near = lists(len(x), _best_of_block(x, np.full(len(x), np.inf), x, keys, ranks(keys), k + 1), keys, x)
        bound = np.array([n[k]["gap"] if len(n) > k else np.inf for n in near])
        others = of_group[g][box_blocks[of_group[g]] != table["block"][0].as_py()]
        blocks = []
        for start in range(0, len(x), 256):
            part = x[start : start + 256, None, :]
            gap = np.square(np.maximum(0.0, np.maximum(lows[others] - part, part - highs[others]))).sum(-1)
            near_box = gap * (1 - SLACK) <= bound[start : start + 256, None]
            blocks += [box_blocks[others[flags]].tolist() for flags in near_box]
        data = {"group": table["group"], "x": table["x"], "found": near, "bound": bound, "blocks": blocks}
        return pa.table([pa.array(v, f.type) if not isinstance(v, pa.ChunkedArray) else v for v, f in zip(data.values(), to_arrow_schema(own_schema))], names=list(data))

    own = written_table(placed.groupBy("block").applyInArrow(own_block, own_schema), "own-neighbours")

    # Askers of a block are cut into pieces, and the block is repeated for each.
    asks = own.select("group", "x", "bound", F.explode("blocks").alias("block"))
    wanted = asks.groupBy("block").agg(F.ceil(F.count("*") / ASKED_AT_ONCE).alias("pieces"))
    wanted = written_table(wanted, "askers")  # at most a row per block
    asks = lookup(asks, wanted, "block").withColumn("piece", F.pmod(F.xxhash64("group", "x"), F.col("pieces")))
    repeated = lookup(placed, wanted, "block", "inner")
    repeated = repeated.select("block", "x", "keys", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    more_schema = T.StructType(own_schema.fields[:3])

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        x, keys = _matrix(right["x"]), right["keys"].to_pylist()
        near = lists(left.num_rows, _best_of_block(_matrix(left["x"]), left["bound"].to_numpy(), x, keys, ranks(keys), k + 1), keys, x)
        found_type = to_arrow_schema(more_schema).field("found").type
        return pa.table([left["group"], left["x"], pa.array(near, found_type)], names=["group", "x", "found"])

    answers = asks.select("block", "piece", "group", "x", "bound").groupBy("block", "piece").cogroup(repeated.groupBy("block", "piece")).applyInArrow(
        lambda left, right: ask(left, right) if left.num_rows else to_arrow_schema(more_schema).empty_table(), more_schema
    )
    every = own.select("group", "x", F.explode("found").alias("f")).unionByName(answers.select("group", "x", F.explode("found").alias("f")))
    best = top_per_group(every, ["group", "x"], [F.col("f.gap"), F.col("f.key")], k + 1)
    near = best.groupBy("group", "x").agg(F.array_sort(F.collect_list("f")).alias("near"))
    joined = lookup(rows.distinct(), written_table(near, "neighbours"), ["group", "x"], "inner")
    others = F.slice(F.filter("near", lambda f: f["key"] != F.col("key")), 1, k)
    named = F.transform(others, lambda f: F.struct(F.sqrt(f["gap"]).alias("distance"), f["key"].alias("key"), f["x"].alias("point")))
    return joined.select(F.col("group").alias(group), F.col("key").alias(key), F.col("x").alias("point"), named.alias("neighbours"))
