"""Nearest neighbours by hierarchical navigable small-world graphs.

Distinct vectors, with the smallest vec_ids that have them, are dealt over
shards by hash.  Each shard has a graph in flat
arrays: nodes are ordered by level, so a level is a prefix of them and its
links one array.  Queries go through every shard in blocks; what the shards
find is scored exactly and merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.shared_tables import written_table

SHARD_VECTORS = 8_192
QUERY_BLOCK = 512
#: Links of a node on upper levels (twice as many on the lowest), candidates
#: kept while building, and while searching.
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 64, 128
#: Nodes expanded at once, and inserted at once.
EXPANDED, BATCH = 4, 256

INDEX = "shard long, ids binary, repeats binary, members binary, vectors binary, levels binary, links binary"
FOUND = "query_id long, vec_id long, score double"


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of a[i] to b[i, j]."""
    return np.square(b - a[:, None, :]).sum(-1)


class Graph:
    """A graph over ``vectors`` (rows), searched by squared distance."""

    def __init__(self, vectors: np.ndarray, sizes: list[int], links: list[np.ndarray]):
        self.vectors, self.sizes, self.links = vectors, sizes, links

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH) -> "Graph":
        """Insert the rows in order; each level holds the first
        1 / ``links`` of the level below."""
        n, sizes = len(vectors), [len(vectors)]
        while sizes[-1] > 4 * links:
            sizes.append(-(-sizes[-1] // links))
        made = cls(vectors, sizes, [np.full((s, links * (2 if i == 0 else 1)), -1, np.int32) for i, s in enumerate(sizes)])
        done = 0
        while done < n:
            batch = np.arange(done, min(n, done + max(1, min(BATCH, done // 2 + 1))))
            made._insert(batch, width)
            done = int(batch[-1]) + 1
        return made

    def _insert(self, batch: np.ndarray, width: int) -> None:
        done = int(batch[0])
        entry = np.zeros((len(batch), 1), np.int64)
        among = _squared(self.vectors[batch], np.broadcast_to(self.vectors[batch], (len(batch), *self.vectors[batch].shape)))
        for level in range(len(self.sizes) - 1, -1, -1):
            here = batch[batch < self.sizes[level]]
            if done:
                ids, gaps = self._beam(self.vectors[batch], level, entry, width if len(here) else 8, min(done, self.sizes[level]))
                entry = ids
            if not len(here):
                continue
            q = len(here)
            # Members of the batch are candidates of each other too.
            mates = np.argsort(among[:q, :q] + np.diag(np.full(q, np.inf)), axis=1)[:, : min(q - 1, 16)]
            near = np.take_along_axis(among[:q, :q], mates, 1)
            candidates, distances = here[mates] if q > 1 else np.full((q, 0), -1), near
            if done:
                candidates, distances = np.concatenate([ids[:q], candidates], 1), np.concatenate([gaps[:q], distances], 1)
            self._link(level, here, candidates, distances)

    def _choose(self, owners: np.ndarray, ids: np.ndarray, gaps: np.ndarray, most: int) -> np.ndarray:
        """At most ``most`` links for each owner: candidates closer to it
        than to those already taken, then the nearest others."""
        order = np.argsort(gaps, axis=1, kind="stable")[:, : 3 * most]
        ids, gaps = np.take_along_axis(ids, order, 1), np.take_along_axis(gaps, order, 1)
        n, c = ids.shape
        points = self.vectors[np.maximum(ids, 0)]
        square = np.square(points).sum(-1)
        between = square[:, :, None] + square[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        taken, closest, valid = np.zeros((n, c), bool), np.full((n, c), np.inf), (ids >= 0) & np.isfinite(gaps)
        for j in range(c):
            take = valid[:, j] & (gaps[:, j] < closest[:, j]) & (taken.sum(1) < most)
            taken[:, j] = take
            closest = np.where(take[:, None], np.minimum(closest, between[:, j]), closest)
        rank = np.where(taken, 0, np.where(valid, 1, 2)) * c + np.arange(c)
        first = np.argsort(rank, axis=1)[:, :most]
        chosen = np.where(np.take_along_axis(valid, first, 1), np.take_along_axis(ids, first, 1), -1)
        return np.pad(chosen, ((0, 0), (0, most - chosen.shape[1])), constant_values=-1)

    def _link(self, level: int, owners: np.ndarray, ids: np.ndarray, gaps: np.ndarray) -> None:
        links = self.links[level]
        if not ids.shape[1]:
            return
        links[owners] = self._choose(owners, ids, gaps, links.shape[1])
        source, target = np.repeat(owners, links.shape[1]), links[owners].ravel().astype(np.int64)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, firsts, counts = np.unique(target, return_index=True, return_counts=True)
        most = min(int(counts.max(initial=0)), links.shape[1])
        place = np.arange(len(target)) - np.repeat(firsts, counts)
        new = np.full((len(nodes), most), -1, np.int64)
        within = place < most
        new[np.repeat(np.arange(len(nodes)), counts)[within], place[within]] = source[within]
        both = np.concatenate([links[nodes], new], 1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        reach = np.where(both >= 0, _squared(self.vectors[nodes], self.vectors[np.maximum(both, 0)]), np.inf)
        links[nodes] = self._choose(nodes, both, reach, links.shape[1])

    def _beam(self, queries: np.ndarray, level: int, entry: np.ndarray, width: int, inserted: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes met, nearest first, -1 where fewer."""
        q, links = len(queries), self.links[level]
        seen = np.zeros((q, inserted + 1), bool)  # the last column stands for no node
        seen[:, inserted] = True
        rows = np.arange(q)[:, None]

        def fresh(ids: np.ndarray) -> np.ndarray:
            ids = np.sort(np.where((ids < 0) | (ids >= inserted), inserted, ids), axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = inserted
            ids = np.where(seen[rows, ids], inserted, ids)
            seen[rows, ids] = True
            return ids

        def gaps_of(ids: np.ndarray) -> np.ndarray:
            return np.where(ids < inserted, _squared(queries, self.vectors[np.minimum(ids, inserted - 1)]), np.inf)

        ids = fresh(entry)
        gaps, open_ = gaps_of(ids), np.ones(ids.shape, bool)
        while True:
            waiting = np.where(open_ & (ids < inserted), gaps, np.inf)
            some = np.argsort(waiting, axis=1)[:, :EXPANDED]
            going = np.isfinite(np.take_along_axis(waiting, some, 1))
            if not going.any():
                break
            np.put_along_axis(open_, some, False, 1)
            around = links[np.take_along_axis(ids, some, 1).clip(max=inserted - 1)]
            around = np.where(going[:, :, None], around, -1).reshape(q, -1)
            new = fresh(around.astype(np.int64))
            ids, gaps = np.concatenate([ids, new], 1), np.concatenate([gaps, gaps_of(new)], 1)
            open_ = np.concatenate([open_, np.ones(new.shape, bool)], 1)
            best = np.argsort(gaps, axis=1, kind="stable")[:, :width]
            ids, gaps, open_ = (np.take_along_axis(x, best, 1) for x in (ids, gaps, open_))
        order = np.argsort(gaps, axis=1, kind="stable")
        ids, gaps = np.take_along_axis(ids, order, 1), np.take_along_axis(gaps, order, 1)
        return np.where(np.isfinite(gaps), ids, -1), gaps

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Nodes near each query, -1 where fewer than ``width`` were met."""
        n = len(self.vectors)
        if n <= width:
            return np.broadcast_to(np.arange(n), (len(queries), n))
        entry = np.broadcast_to(np.arange(self.sizes[-1]), (len(queries), self.sizes[-1]))
        for level in range(len(self.sizes) - 1, -1, -1):
            entry, _ = self._beam(queries, level, entry, width if level == 0 else 16, self.sizes[level])
        return entry


def _usable(vector: Column) -> Column:
    """Not null, of finite components only, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy().astype(kind).reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_vectors: int = SHARD_VECTORS, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for
    each query, by Euclidean distance in double precision, ties to the
    smaller vec_id.  Both tables have ``vec_id`` and ``embedding``.

    Rows with the query's own vec_id are no candidates for it.  Vectors that
    are null, zero or hold null or non-finite components take no part; those
    of another dimension are never near.  Queries are numbered by vec_id, so
    repeated query rows share their ranks' places; repeated candidates stay.
    An empty side gives an empty result; other columns are not read.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    prepared = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    # Of the copies of a vector the k smallest vec_ids besides a query's own
    # can be among its answer; a vec_id may have several rows.
    prepared = prepared.groupBy("embedding", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    smallest = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    prepared = prepared.withColumn("place", smallest).filter(F.col("place") <= k + 1)
    prepared = prepared.groupBy("embedding").agg(F.collect_list("vec_id").alias("ids"), F.collect_list("n").alias("repeats"))
    prepared = written_table(prepared.withColumn("dim", F.size("embedding")), "distinct-vectors")
    counts = {r["dim"]: r["n"] for r in prepared.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    # Shards are numbered through, dimension by dimension.
    shards, first = {}, 0
    for dim, n in sorted(counts.items()):
        shards[dim] = (first, -(-n // shard_vectors))
        first += shards[dim][1]

    def by_dim(which: int) -> Column:
        pairs = [F.lit(x) for dim, s in (shards or {-1: (0, 1)}).items() for x in (dim, s[which])]
        return F.create_map(*pairs)[F.col("dim")].cast("long")

    def index(table: pa.Table) -> pa.Table:
        order = np.random.default_rng(0).permutation(table.num_rows)
        table = table.take(pa.array(order)).combine_chunks()
        rows, members = _rows(table["embedding"], kind), pc.list_value_length(table["ids"]).to_numpy()
        ids, repeats = (pc.list_flatten(table[c]).to_numpy() for c in ("ids", "repeats"))
        graph = Graph.build(rows)
        raw = [*(x.astype("<i8") for x in (ids, repeats, members)), rows.astype(kind), np.array(graph.sizes, "<i8"), np.concatenate([x.ravel() for x in graph.links]).astype("<i4")]
        return pa.table({"shard": table["shard"].slice(0, 1), **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("ids", "repeats", "members", "vectors", "levels", "links"), raw)}})

    dealt = prepared.withColumn("shard", by_dim(0) + F.pmod(F.xxhash64("embedding"), by_dim(1)))
    indexes = written_table(dealt.select("shard", "ids", "repeats", "embedding").groupBy("shard").applyInArrow(index, INDEX), "graphs")

    asked = queries.select(F.col("vec_id").cast("long"), "embedding").filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    asked = asked.withColumn("dim", F.size("embedding")).filter(by_dim(0).isNotNull())
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    packed = (
        asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)))
        .groupBy("block", "dim")
        .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("q"))
        .withColumn("shard", F.explode(F.sequence(by_dim(0), by_dim(0) + by_dim(1) - 1)))
        .select("shard", F.col("q.vec_id").alias("query_ids"), F.flatten("q.embedding").alias("query_vectors"))
    )

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                own = np.array(row["query_ids"].values)
                points = np.asarray(row["query_vectors"].values).astype(kind).reshape(len(own), -1)
                ids, repeats, members, sizes = (np.frombuffer(row[c].as_py(), "<i8") for c in ("ids", "repeats", "members", "levels"))
                rows = np.frombuffer(row["vectors"].as_py(), kind).reshape(len(members), -1)
                flat, links, at = np.frombuffer(row["links"].as_py(), "<i4"), [], 0
                for level, size in enumerate(sizes.tolist()):
                    each = LINKS * (2 if level == 0 else 1)
                    links.append(flat[at : at + size * each].reshape(size, each))
                    at += size * each
                found = Graph(rows, sizes.tolist(), links).search(points, max(width, k + 1))
                score = np.sqrt(_squared(points.astype("<f8"), rows[np.maximum(found, 0)].astype("<f8")))
                # Nodes found become the rows that have their vector.
                query, at = np.nonzero(found >= 0)
                node, score = found[query, at], score[query, at]
                many = members[node]
                place = np.repeat((np.cumsum(members) - members)[node] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                query, score = np.repeat(query, many), np.repeat(score, many)
                others = ids[place] != own[query]
                again = np.where(others, repeats[place], 0)
                query, score, near = (np.repeat(x, again) for x in (query, score, ids[place]))
                best = np.lexsort((near, score, query))
                query, score, near = query[best], score[best], near[best]
                keep = np.arange(len(query)) - np.searchsorted(query, query) < k
                columns = [own[query[keep]], near[keep], score[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    met = packed.join(indexes, "shard").mapInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
