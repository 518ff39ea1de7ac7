"""Short codes of vectors: each part of a vector by its nearest of few entries.

Entries are found by rounds of exact assignment and averaging in integers.
Vectors are dealt over chunks; for each part of a chunk an anchors hierarchy
is built once: points gather around far-apart anchors, the same happens
inside each anchor, and sibling balls are merged in pairs up to one.  Every
ball knows the sum and count of its points.  In a round a ball takes over
the entries that its parent could not rule out, rules out more, and when one
is left its sums go to that entry as a whole.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.joins import lookup
from basketlens.functions.shared_tables import written_table

#: Vector components of a chunk.
CHUNK_COMPONENTS = 1 << 18
#: Balls of no more points are not divided.
LEAF_POINTS = 12
#: Relative error that a distance in double precision surely stays within.
ERROR = 1e-9

CHUNK = "ids array<bigint>, labels array<string>, data binary"


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def _ranks(groups: np.ndarray) -> np.ndarray:
    """Places 0, 1, ... within runs of equal numbers."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups)


def gathered(points: np.ndarray, groups: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """An anchor's number within its group for each point.  Anchors are added
    one by one, each the point farthest from its own so far, up to
    ``wanted`` in each group; points move to a new anchor that is nearer.
    Points no farther from theirs than half of what the new one is from it
    cannot move and are not looked at.  ``groups`` are 0, 1, ..., ascending."""
    starts = np.searchsorted(groups, np.arange(len(wanted)))
    anchors = np.repeat(starts[:, None], max(1, int(wanted.max(initial=1))), axis=1)
    slot, gaps = np.zeros(len(points), np.int64), np.sqrt(_squares(points, points[starts[groups]]))
    for step in range(1, anchors.shape[1]):
        reach = np.maximum.reduceat(gaps, starts)
        reach[(wanted <= step) | (reach == 0)] = np.inf
        rim = np.flatnonzero(gaps == reach[groups])
        if not len(rim):
            break
        going, first = np.unique(groups[rim], return_index=True)
        anchors[going, step] = rim[first]
        between = np.zeros((len(wanted), step))
        between[:] = np.inf
        between[going] = np.sqrt(_squares(points[anchors[going, :step]], points[anchors[going, step]][:, None]))
        near = np.flatnonzero(2 * gaps >= between[groups, slot])
        new = np.sqrt(_squares(points[near], points[anchors[groups[near], step]]))
        closer = new < gaps[near]
        slot[near[closer]], gaps[near[closer]] = step, new[closer]
    return slot


class Forest:
    """One tree of balls for each part of the points, in flat arrays.  A ball
    holds a run of its part's points in tree order; node ``p`` is the root of
    part ``p``."""

    FIELDS = ("order", "part", "children", "low", "high", "sums", "radius")

    def __init__(self, points: np.ndarray, **fields: np.ndarray):
        """``points``: integers, by part, vector and position."""
        self.points = points.reshape(-1, points.shape[2])
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.counts = self.high - self.low
        self.pivots = self.sums / self.counts[:, None]

    @classmethod
    def grown(cls, points: np.ndarray) -> "Forest":
        parts, n, width = points.shape
        flat = points.reshape(-1, width).astype(np.float64)
        order, groups = np.arange(parts * n), np.repeat(np.arange(parts), n)
        node, pairs = np.arange(parts), {}  # the node of each group; children of nodes
        total = parts
        while True:
            sizes = np.bincount(groups, minlength=len(node))
            wanted = np.where(sizes > LEAF_POINTS, np.ceil(np.sqrt(sizes)).astype(np.int64), 1)
            slot = gathered(flat[order], groups, wanted)
            again = np.lexsort((slot, groups))
            order, groups, slot = order[again], groups[again], slot[again]
            key, inner = np.unique(groups * (int(slot.max(initial=0)) + 1) + slot, return_inverse=True)
            owner = key // (int(slot.max(initial=0)) + 1)
            if len(key) == len(node):
                break
            counts = np.bincount(inner)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            centers = np.add.reduceat(flat[order], bounds[:-1]) / counts[:, None]
            radii = np.sqrt(np.maximum.reduceat(_squares(flat[order], centers[inner]), bounds[:-1]))
            node, total = cls._merged(node, owner, centers, radii, pairs, total)
            groups = inner
        children = np.full((total, 2), -1, np.int64)
        for parent, both in pairs.values():
            children[parent] = both
        return cls._laid_out(points, flat, order, groups, node, children, parts)

    @staticmethod
    def _merged(node, owner, centers, radii, pairs, total):
        """Merge the balls of each owner in pairs, at each step the two with
        the smallest common ball, until its own node is what is left."""
        rank, many = _ranks(owner), np.bincount(owner, minlength=len(node))
        place = np.where(many[owner] == 1, node[owner], -1)
        new = np.flatnonzero(place < 0)
        place[new] = total + np.arange(len(new))
        total += len(new)
        for k in np.unique(many[many > 1]).tolist():
            own = np.flatnonzero(many == k)
            balls = np.flatnonzero(many[owner] == k).reshape(len(own), k)
            ids, middle, radius = place[balls], centers[balls], radii[balls]
            rows, eye = np.arange(len(own)), np.eye(k, dtype=bool)

            def common(i):
                """Radius around the balls ``i`` and each other one."""
                apart = np.sqrt(_squares(middle[rows, i][:, None], middle))
                one = radius[rows, i][:, None]
                return np.maximum(np.maximum(one, radius), (apart + one + radius) / 2), apart

            cost = np.stack([common(np.full(len(own), i))[0] for i in range(k)], axis=1)
            cost[:, eye] = np.inf
            for step in range(k - 1):
                best = cost.reshape(len(own), -1).argmin(1)
                a, b = np.minimum(best // k, best % k), np.maximum(best // k, best % k)
                _, apart = common(a)
                both = cost[rows, a, b]
                share = np.clip((both - radius[rows, a]) / np.maximum(apart[rows, b], 1e-300), 0, 1)
                share = np.where(both <= radius[rows, a], 0.0, np.where(both <= radius[rows, b], 1.0, share))
                parent = node[own] if step == k - 2 else total + rows
                total += 0 if step == k - 2 else len(own)
                pairs[len(pairs)] = (parent, np.stack([ids[rows, a], ids[rows, b]], axis=1))
                ids[rows, a] = parent
                middle[rows, a] += (middle[rows, b] - middle[rows, a]) * share[:, None]
                radius[rows, a] = both
                radius[rows, b] = np.inf
                cost[rows, a] = common(a)[0]
                cost[rows, :, a] = cost[rows, a]
                cost[rows, b], cost[rows, :, b], cost[rows, a, a] = np.inf, np.inf, np.inf
        return place, total

    @classmethod
    def _laid_out(cls, points, flat, order, groups, node, children, parts):
        """Put the points in tree order and find what each ball holds."""
        total, width = len(children), flat.shape[1]
        counts = np.zeros(total, np.int64)
        counts[node] = np.bincount(groups, minlength=len(node))
        levels, here, part = [], np.arange(parts), np.arange(total)
        while len(here):
            levels.append(here)
            here = here[children[here, 0] >= 0]
            part[children[here]] = part[here][:, None]
            here = children[here].ravel()
        for level in levels[::-1]:
            inner = level[children[level, 0] >= 0]
            counts[inner] = counts[children[inner]].sum(1)
        low = np.zeros(total, np.int64)
        low[:parts] = np.arange(parts) * points.shape[1]
        for level in levels:
            inner = level[children[level, 0] >= 0]
            low[children[inner, 0]] = low[inner]
            low[children[inner, 1]] = low[inner] + counts[children[inner, 0]]
        order = order[np.argsort(low[node][groups], kind="stable")]
        high = low + counts
        before = np.zeros((len(flat) + 1, width), np.int64)
        np.cumsum(points.reshape(-1, width)[order], axis=0, out=before[1:])
        sums = before[high] - before[low]
        pivots, radius, placed = sums / counts[:, None], np.zeros(total), flat[order]
        for level in levels:
            level = level[np.argsort(low[level])]
            many = counts[level]
            bounds = np.cumsum(many) - many
            inside = np.repeat(low[level] - bounds, many) + np.arange(many.sum())
            radius[level] = np.sqrt(np.maximum.reduceat(_squares(placed[inside], np.repeat(pivots[level], many, axis=0)), bounds))
        return cls(points, order=order, part=part, children=children, low=low, high=high, sums=sums, radius=radius)

    def saved(self) -> dict[str, np.ndarray]:
        return {name: getattr(self, name) if name in ("sums", "radius") else getattr(self, name).astype(np.int32) for name in self.FIELDS}

    def assigned(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Sums and counts of the points by part and nearest entry, the entry
        of each point in tree order, and how many distances of points to
        entries were computed.  ``entries``: integers, by part, entry and
        position; the lower of two equally near ones wins."""
        parts, many, width = entries.shape
        as_float = entries.astype(np.float64)
        apart = np.sqrt(_squares(as_float[:, :, None], as_float[:, None]))
        # An entry equal to a lower one is nobody's.
        lower = np.tril(np.ones((many, many), bool), -1)
        alive = ~((apart == 0) & lower).any(2)
        sums, counts = np.zeros((parts * many, width), np.int64), np.zeros(parts * many, np.int64)
        of_point, computed = np.zeros(len(self.points), np.int64), 0
        nodes, held = np.arange(parts), alive
        while len(nodes):
            part = self.part[nodes]
            gaps = _squares(self.pivots[nodes][:, None], as_float[part])
            masked = np.where(held, gaps, np.inf)
            best = masked.argmin(1)
            least = masked[np.arange(len(nodes)), best][:, None]
            reach = 2 * self.radius[nodes][:, None] * apart[part, best]
            held = held & (gaps - least <= reach + ERROR * (gaps + least + reach))
            owned = held.sum(1) == 1
            own = nodes[owned]
            slots = self.part[own] * many + best[owned]
            np.add.at(sums, slots, self.sums[own])
            np.add.at(counts, slots, self.counts[own])
            inside, which = self._inside(own)
            of_point[inside] = best[owned][which]
            leaf = ~owned & (self.children[nodes, 0] < 0)
            if leaf.any():
                inside, which = self._inside(nodes[leaf])
                points, part = self.points[self.order[inside]], self.part[nodes[leaf]][which]
                allowed = held[leaf][which]
                row, entry = np.nonzero(allowed)
                far = np.full(allowed.shape, np.iinfo(np.int64).max)
                far[row, entry] = _squares(points[row], entries[part[row], entry])
                computed += len(row)
                nearest = far.argmin(1)
                of_point[inside] = nearest
                np.add.at(sums, part * many + nearest, points)
                np.add.at(counts, part * many + nearest, 1)
            more = ~owned & ~leaf
            nodes, held = self.children[nodes[more]].ravel(), np.repeat(held[more], 2, axis=0)
        return sums, counts, of_point, computed

    def _inside(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in tree order of the points in balls, and in which of them."""
        many = self.counts[nodes]
        which = np.repeat(np.arange(len(nodes)), many)
        return np.repeat(self.low[nodes] - (np.cumsum(many) - many), many) + np.arange(many.sum()), which


def _parts_of(vectors: np.ndarray, parts: int) -> np.ndarray:
    return np.ascontiguousarray(vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2))


def _loaded(row: bytes, parts: int) -> tuple[np.ndarray, Forest]:
    held = np.load(io.BytesIO(row))
    vectors = held["vectors"].astype(np.int64)
    fields = {n: held[n].astype(held[n].dtype if n == "radius" else np.int64) for n in Forest.FIELDS}
    return vectors, Forest(_parts_of(vectors, parts), **fields)


def _chunks(usable: DataFrame, dimension: int, parts: int, scale: int) -> DataFrame:
    most = max(LEAF_POINTS, CHUNK_COMPONENTS // dimension)
    kind = np.int32 if dimension > 1 else np.int64  # by what sums of squares leave room for

    def chunk(batches):
        def row(table):
            flat = table["embedding"].combine_chunks()
            flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
            vectors = np.floor(scale * flat.to_numpy().astype(np.float64)).astype(np.int64).reshape(-1, dimension)
            held = io.BytesIO()
            np.savez(held, vectors=vectors.astype(kind), **Forest.grown(_parts_of(vectors, parts)).saved())
            lists = [pa.array([table[c].to_pylist()], pa.list_(t)) for c, t in (("vec_id", pa.int64()), ("label", pa.string()))]
            return pa.RecordBatch.from_arrays([*lists, pa.array([held.getvalue()], pa.binary())], names=["ids", "labels", "data"])

        waiting, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - rows)
                waiting.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == most:
                    yield row(pa.Table.from_batches(waiting))
                    waiting, rows = [], 0
        if rows:
            yield row(pa.Table.from_batches(waiting))

    return written_table(usable.select("vec_id", "label", "embedding").mapInArrow(chunk, CHUNK), "metric-trees")


def _round(chunks: DataFrame, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (as Python's integers) and counts by part and entry.  A task
    sends a number per entry and position, whatever it holds."""
    parts, many, width = entries.shape

    def add_up(batches):
        totals = np.zeros((parts * many, width + 1), np.int64)
        for batch in batches:
            for data in batch.column(0):
                sums, counts, *_ = _loaded(data.as_py(), parts)[1].assigned(entries)
                totals += np.concatenate([sums, counts[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(totals.size)), pa.array(totals.ravel())], names=["slot", "total"])

    found = chunks.select("data").mapInArrow(add_up, "slot long, total long").groupBy("slot")
    totals = np.zeros(parts * many * (width + 1), object)
    for r in found.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        totals[r["slot"]] = int(r["total"])
    totals = totals.reshape(parts, many, width + 1)
    return totals[:, :, :width], totals[:, :, width]


def first_entries(usable: DataFrame, entries: int, parts: int, scale: int) -> np.ndarray:
    rows = usable.filter("vec_id IS NOT NULL").select("vec_id", "embedding").orderBy("vec_id", "embedding").limit(entries).collect()
    vectors = np.floor(scale * np.array([r["embedding"] for r in rows], np.float64)).astype(np.int64)
    return _parts_of(vectors, parts)


def compressed(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row whose
    vector is set and has finite components only.

    A component x counts as floor(scale * x).  The codebook of a part starts
    as that part of the rows with the ``entries`` smallest vec_ids (fewer
    rows: fewer entries); each round moves every used entry to the floor of
    the mean of the parts nearest to it, ties to the lower entry.  ``code``
    has two hexadecimal digits a part, ``error`` the sum of squared distances
    to the entries, ``label_error`` its sum over rows of one label, nulls
    together.

    Repeated rows count each and get equal codes; among rows of one vec_id
    the smaller vector comes first; rows without vec_id are never first
    entries.  The dimension is the most frequent one, among rows with a vec_id, that ``parts`` divides
    (the larger of equals): rows of another, and those with components beyond
    what 64 bits hold as sums of squares (46,000 for 64 components at the
    scale 4096), take no part and have a null code and error.  If no row has
    a vec_id or a fitting dimension, all codes are null.  An empty table
    gives an empty result; other columns are not read.
    """
    if entries > 256:
        raise ValueError("two hexadecimal digits name 256 entries")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding").filter(F.coalesce(finite, F.lit(False)))
    small = F.forall("embedding", lambda x: 2 * scale * F.abs(x.cast("double")) < F.sqrt(F.lit(2.0**63) / F.size("embedding")) - 4)
    fits = (F.size("embedding") > 0) & (F.size("embedding") % parts == 0) & small
    sizes = kept.filter(fits & F.col("vec_id").isNotNull()).groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        text, number = (F.lit(None).cast(t) for t in ("string", "long"))
        names = [text.alias("code"), number.alias("error"), number.alias("label_error"), text.alias("codebooks_sha256")]
        return kept.select("vec_id", *names)
    dimension = common["d"]
    fits &= F.size("embedding") == dimension
    usable = kept.filter(fits)
    book = first_entries(usable, entries, parts, scale)
    chunks = _chunks(usable, dimension, parts, scale)
    for _ in range(rounds):
        sums, counts = _round(chunks, book)
        used = counts > 0
        moved = book.copy()
        moved[used] = (sums[used] // counts[used][:, None]).astype(np.int64)
        if (moved == book).all():
            break  # and so would all further rounds
        book = moved
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()

    def encode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held, forest = _loaded(batch.column("data")[i].as_py(), parts)
                placed = forest.assigned(book)[2]
                codes = np.empty_like(placed)
                codes[forest.order] = placed
                codes = codes.reshape(parts, -1)
                nearest = book[np.arange(parts)[:, None], codes]
                error = _squares(_parts_of(held, parts), nearest).sum(0)
                texts = [row.tobytes().hex() for row in np.ascontiguousarray(codes.T.astype(np.uint8))]
                own = [batch.column(c)[i].values for c in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(texts), pa.array(error)], names=["vec_id", "label", "code", "error"])

    coded = chunks.mapInArrow(encode, "vec_id long, label string, code string, error long")
    others = kept.filter(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = written_table(coded.unionByName(others), "codes")
    named = [F.col("label").isNull().alias("unlabelled"), F.coalesce("label", F.lit("")).alias("label")]
    coded = coded.select("vec_id", "code", "error", *named)
    by_label = coded.groupBy("unlabelled", "label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    by_label = written_table(by_label.withColumn("label_error", F.expr("try_cast(label_error AS bigint)")), "label-errors")
    found = lookup(coded, by_label, ["unlabelled", "label"])
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def compressed_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in SQL, every part against every entry, for tables with one
    row a vec_id and one dimension."""
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, embedding, len(embedding) AS size FROM embeddings WHERE embedding IS NOT NULL "
        "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "long AS (SELECT vec_id, size, unnest(embedding) AS x, unnest(range(size)) AS pos FROM kept)",
        f"p AS MATERIALIZED (SELECT vec_id, pos // (size // {parts}) AS part, list(CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) ORDER BY pos) AS v "
        f"FROM long GROUP BY vec_id, pos // (size // {parts}))",
        f"b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c FROM p "
        f"WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))",
    ]
    for k in range(rounds + 1):
        gap = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"d{k} AS MATERIALIZED (SELECT vec_id, part, v, entry, CAST({gap} AS BIGINT) AS gap FROM p JOIN b{k} USING (part))")
        steps.append(
            f"a{k} AS MATERIALIZED (SELECT vec_id, part, v, entry, gap FROM d{k} "
            "QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY gap, entry) = 1)"
        )
        if k < rounds:
            mean = "CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT)"
            steps.append(
                f"m{k} AS MATERIALIZED (SELECT part, entry, list(c ORDER BY pos) AS c FROM (SELECT part, entry, pos, {mean} AS c FROM "
                f"(SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{k}) GROUP BY part, entry, pos) GROUP BY part, entry)"
            )
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (part, entry))")
    return f"""
WITH {", ".join(steps)},
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
r AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(gap) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN kept USING (vec_id), s
"""
