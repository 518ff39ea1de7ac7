"""Near-duplicates by SimHash fingerprints in vantage-point trees.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most one
bit of some 32-bit half.  So each half (or smaller part, for more bits) has
a tree of its own, searched with radius 1, where triangle bounds prune far
better than with the whole radius over all bits.  The levels of a tree, built from a bounded sample, cut the
space into shards; a fingerprint has its home in one shard and visits those
whose bound its ball overlaps.  A shard looks up the values of the part that
differ in at most one bit and compares whole fingerprints there.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import written_table
from basketlens.llm.components import components
from basketlens.llm.rolling import mixed

#: Fingerprints that have their home in one shard, about.
SHARD_SIZE = 16_384
#: The same where there are several words: fewer visits for larger shards.
SHARD_SIZE_OF_WORDS = 524_288
#: Shards of a part, and fingerprints sampled to place their bounds.
MOST_SHARDS = 4_096
SAMPLED_PER_SHARD = 16
LEAF_SIZE = 64
BLOCK = 512
#: Pairs of fingerprints that are compared at once, some 40 bytes each.
CANDIDATES = 1 << 18

_LOW_BITS = np.uint64(0x0101010101010101)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint_of(hashes: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bit is set where more than half of a text's hashes have it."""
    result = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return result
    # Sums of 255 hashes or fewer fit into the bytes of a number: each adds up
    # one bit of eight.
    pieces = -(-counts[some] // 255)
    begins = np.cumsum(pieces) - pieces
    starts = np.repeat(firsts[some] - 255 * begins, pieces) + 255 * np.arange(pieces.sum())
    ones = np.empty((len(some), 8, 8), np.int64)
    for bit in range(8):
        sums = np.add.reduceat(hashes >> np.uint64(bit) & _LOW_BITS, starts).astype("<u8").view(np.uint8)
        ones[:, :, bit] = np.add.reduceat(sums.reshape(-1, 8), begins, axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > counts[some, None, None], axis=2, bitorder="little")
    result[some] = bits.reshape(-1, 8).view("<u8").ravel()
    return result


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, repeats included; of the whole
    sequence if it is shorter, of nothing if there is no word."""
    from xxhash import xxh64_digest

    words = (text or "").encode().translate(_LOWER).split()  # at 0x20 and 0x09 to 0x0D
    line, at, ends = b" ".join(words), 0, []
    for word in words:
        at += len(word)
        ends.append(at)
        at += 1
    starts = [0, *(e + 1 for e in ends)]
    if len(words) >= shingle:
        digests = [xxh64_digest(line[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :])]
    else:
        digests = [xxh64_digest(line, 42)] if words else []
    return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64)


def fingerprints_of_hashes(texts: Iterable[np.ndarray], per_text: int = 1) -> np.ndarray:
    """A row for each text with ``per_text`` fingerprints: the first of the
    hashes themselves, the others of what ``mixed`` makes of them."""
    found, group, held = [], [], 0

    def close():
        sizes, hashes = np.array([len(h) for h in group], np.int64), np.concatenate([*group, np.empty(0, np.uint64)])
        each = [hashes, *(mixed(hashes + np.uint64(k)) for k in range(1, per_text))]
        found.append(np.stack([fingerprint_of(h, np.cumsum(sizes) - sizes, sizes) for h in each], axis=1))

    for hashes in texts:
        group.append(hashes)
        held += len(hashes)
        if held >= 200_000:
            close()
            group, held = [], 0
    close()
    return np.concatenate(found)


def fingerprints(docs: DataFrame, shingle: int = 3, words: int = 1) -> DataFrame:
    """(doc_id, fingerprint as a long, or as an array of ``words`` longs).
    Null texts and texts without a word have fingerprint zero; shorter texts
    are one shingle."""

    def compute(batches):
        for batch in batches:
            hashes = (shingle_hashes(t, shingle) for t in batch.column(1).to_pylist())
            made = fingerprints_of_hashes(hashes, words).view(np.int64)
            column = pa.array(made[:, 0]) if words == 1 else pa.array(made.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["doc_id", "fp"])

    kind = "long" if words == 1 else "array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, f"doc_id long, fp {kind}")


def parts_for(bits: int) -> int:
    """The fewest equal parts, a power of two, of which one differs in at
    most one bit wherever ``bits`` bits differ."""
    parts = 1
    while bits // parts > 1:
        parts *= 2
    return parts


def _part(fps: np.ndarray, part: int, parts: int) -> np.ndarray:
    width = 64 // parts
    return fps >> np.uint64(width * part) & np.uint64(2**width - 1)


def _split(points: np.ndarray, tries: int = 8) -> tuple[np.uint64, int] | None:
    """A vantage point and the distance that cuts ``points`` most evenly,
    None where no tried point tells them apart."""
    best, even = None, 0
    for vantage in points[np.linspace(0, len(points) - 1, tries).astype(np.int64)]:
        distances = np.bitwise_count(points ^ vantage)
        bound = int(np.sort(distances)[(len(distances) - 1) // 2])
        for bound in (bound, bound - 1):
            inside = int((distances <= bound).sum())
            if min(inside, len(points) - inside) > even:
                best, even = (vantage, bound), min(inside, len(points) - inside)
    return best


def shard_tree(sample: np.ndarray, shards: int) -> list[tuple]:
    """Nodes (vantage point, bound, inner child, outer child), or (shard,) at
    the ends; node 0 is the root."""
    nodes: list = []

    def grow(points: np.ndarray, wanted: int) -> int:
        me = len(nodes)
        nodes.append(None)
        cut = _split(points) if wanted > 1 and len(points) > 1 else None
        if cut is None:
            nodes[me] = (sum(1 for n in nodes if n and len(n) == 1),)
        else:
            inner = np.bitwise_count(points ^ cut[0]) <= cut[1]
            nodes[me] = (int(cut[0]), cut[1], grow(points[inner], wanted // 2), grow(points[~inner], wanted - wanted // 2))
        return me

    grow(sample, shards)
    return nodes


def _sides(distances: np.ndarray, home: np.ndarray, bound: int, radius: int):
    """For the inner and the outer side: who goes there, and who lives there."""
    inner = distances <= bound
    return ((inner | (distances <= bound + radius), home & inner), (~inner | (distances > bound - radius), home & ~inner))


def routed(points: np.ndarray, tree: list[tuple], radius: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per shard: the points that belong or visit there, and which live there."""
    found, todo = [], [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        node, who, home = todo.pop()
        if not len(who):
            continue
        if len(tree[node]) == 1:
            found.append((tree[node][0], who, home))
            continue
        vantage, bound, *children = tree[node]
        distances = np.bitwise_count(points[who] ^ np.uint64(vantage)).astype(np.int64)
        for child, (goes, lives) in zip(children, _sides(distances, home, bound, radius)):
            todo.append((child, who[goes], lives[goes]))
    return found


class _Groups:
    """Sets of places that links have joined."""

    def __init__(self, n: int):
        self.roots = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots[a], self.roots[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.roots, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = self.roots[self.roots]
                if (jumped == self.roots).all():
                    break
                self.roots = jumped


def _tree_pairs(fps: np.ndarray, live: np.ndarray, ask: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As ``close_pairs``, by a vantage-point tree over all bits."""
    todo = [(live, ask)]
    while todo:
        live, ask = todo.pop()
        if not len(live) or not len(ask):
            continue
        cut = _split(fps[live]) if len(live) > LEAF_SIZE else None
        if cut is not None:
            at = np.bitwise_count(fps[ask] ^ cut[0]).astype(np.int64)
            inner = np.bitwise_count(fps[live] ^ cut[0]) <= cut[1]
            sides = _sides(at, np.zeros(len(ask), bool), cut[1], bits)
            children = [(live[inner], ask[sides[0][0]]), (live[~inner], ask[sides[1][0]])]
            if max(len(x[0]) * len(x[1]) for x in children) < 0.9 * len(live) * len(ask):
                todo.extend(children)
                continue
        for i in range(0, len(ask), BLOCK):
            for j in range(0, len(live), BLOCK):
                a, b = ask[i : i + BLOCK], live[j : j + BLOCK]
                x, y = np.nonzero(np.bitwise_count(fps[a][:, None] ^ fps[b][None, :]) <= bits)
                yield a[x], b[y]


def _by_value(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``places`` in the order of their values, the distinct values, and where
    each begins and how many there are."""
    places = places[np.argsort(values[places], kind="stable")]
    return (places, *np.unique(values[places], return_index=True, return_counts=True))


def close_pairs(
    fps: np.ndarray, live: np.ndarray, ask: np.ndarray, part: int, bits: int, once: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b) of fingerprints of a shard at ``bits`` or fewer differing
    bits, of which at most one in this part, a among ``ask`` and b among
    ``live``, in blocks.  ``once``: both are the same places, and pairs of
    unlike parts come in one order only.

    A value of the part meets itself and the values that differ in one bit,
    which are looked up among the sorted ones.  Where many share a value, a
    tree over all bits goes on."""
    if not len(live) or not len(ask):
        return
    parts = parts_for(bits)
    own = _part(fps, part, parts)
    live, values, begins, held = _by_value(own, live)
    ask, asked, firsts, numbers = _by_value(own, ask)
    fps_live, fps_ask = fps[live], fps[ask]
    for flip in [0, *(1 << k for k in range(64 // parts))] if bits // parts else [0]:
        sought = asked ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(values, sought), len(values) - 1)
        met = values[at] == sought
        if once and flip:
            met &= sought > asked
        met = np.flatnonzero(met)
        at = at[met]
        heavy = held[at] * numbers[met] > BLOCK * BLOCK
        for i, j in zip(met[heavy], at[heavy]):
            yield from _tree_pairs(fps, live[begins[j] : begins[j] + held[j]], ask[firsts[i] : firsts[i] + numbers[i]], bits)
        met, at = met[~heavy], at[~heavy]
        # a row for each that asks: where what it meets begins, and how many these are
        many = numbers[met]
        rows = np.repeat(firsts[met] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        begin, width = np.repeat(begins[at], many), np.repeat(held[at], many)
        ends = np.cumsum(width)
        first = 0
        while first < len(rows):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CANDIDATES, side="right")))
            wide = width[first:last]
            x = np.repeat(np.arange(first, last), wide)
            y = np.arange(len(x)) + np.repeat(begin[first:last] - (np.cumsum(wide) - wide), wide)
            close = np.flatnonzero(np.bitwise_count(np.repeat(fps_ask[rows[first:last]], wide) ^ fps_live[y]) <= bits)
            yield ask[rows[x[close]]], live[y[close]]
            first = last


def _gathered(pairs: Iterable[tuple[np.ndarray, np.ndarray]], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, ``least`` or more at a time but for the last."""
    held, number = [], 0
    for a, b in pairs:
        if len(a) >= least:
            yield a, b
            continue
        held.append((a, b))
        number += len(a)
        if number >= least:
            yield tuple(map(np.concatenate, zip(*held)))
            held, number = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def shard_groups(fps: np.ndarray, home: np.ndarray, part: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place of the group of each fingerprint of a shard, where
    links go from any fingerprint to one that lives here, and the first
    place that a link leads to directly."""
    groups, direct = _Groups(len(fps)), np.arange(len(fps))
    lives, visits = np.flatnonzero(home), np.flatnonzero(~home)
    found = itertools.chain(close_pairs(fps, lives, lives, part, bits, True), close_pairs(fps, lives, visits, part, bits))
    for a, b in _gathered(found, len(fps)):
        groups.join(a, b)
        np.minimum.at(direct, np.maximum(a, b), np.minimum(a, b))
    return groups.roots, direct


def placed(distinct: DataFrame, bits: int, shard_size: int, words: int) -> DataFrame:
    """Each fingerprint ``fp`` of a ``word`` with its other columns in every
    ``shard`` it lives in (``home``) or visits.  ``shard // words`` modulo
    ``parts_for(bits)`` is the part a shard compares.

    The upper levels come from at most ``MOST_SHARDS * SAMPLED_PER_SHARD``
    fingerprints; any sample gives right results, it only balances shards.
    """
    count = distinct.count()
    shards = max(1, min(MOST_SHARDS, -(-count // (words * shard_size))))
    sample = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(shards * SAMPLED_PER_SHARD)
    sampled = np.array([r["fp"] for r in sample.collect()], np.int64).view(np.uint64)
    parts = parts_for(bits)
    trees = [shard_tree(np.unique(_part(sampled, part, parts)), shards) for part in range(parts)]
    others = [c for c in distinct.columns if c not in ("fp", "word")]
    names = ["shard", "home", "fp", *others]

    def route(batches):
        for batch in batches:
            fps, word = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            rest = [batch.column(k).to_numpy() for k in range(2, batch.num_columns)]
            for part, tree in enumerate(trees):
                for shard, who, home in routed(_part(fps, part, parts), tree, bits // parts):
                    place = ((shard * parts + part) * words + word[who]).astype(np.int32)
                    columns = [place, home, fps[who].view(np.int64), *(c[who] for c in rest)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    kinds = ", ".join(f"{c} long" for c in others)
    return distinct.select("fp", "word", *others).mapInArrow(route, f"shard int, home boolean, fp long, {kinds}")


def fingerprint_links(distinct: DataFrame, bits: int = 3, shard_size: int = SHARD_SIZE, words: int = 1) -> DataFrame:
    """Links a - b between the ``node`` values of fingerprints ``fp`` of the
    same ``word`` (0 to ``words`` - 1) at ``bits`` or fewer differing bits.  Of a linked set within one shard it
    gives a star, not all pairs, so that components are whole and a large
    group of near copies stays linear.  ``near`` is the first node of the
    shard that is itself close to ``a``.
    """
    if "word" not in distinct.columns:
        distinct = distinct.withColumn("word", F.lit(0))
    parts = parts_for(bits)

    def link(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table["node"].to_numpy(), kind="stable")
        fps, nodes = table["fp"].to_numpy()[order].view(np.uint64), table["node"].to_numpy()[order]
        roots, direct = shard_groups(fps, table["home"].to_numpy()[order], key[0].as_py() // words % parts, bits)
        linked = np.flatnonzero(roots != np.arange(len(roots)))
        return pa.table({"a": nodes[linked], "b": nodes[roots[linked]], "near": nodes[direct[linked]]})

    places = placed(distinct.select("fp", "word", "node"), bits, shard_size, words)
    return places.groupBy("shard").applyInArrow(link, "a long, b long, near long")


def links_of_words(distinct: DataFrame, bits: int, words: int) -> DataFrame:
    """Links a - b and a - near, as of ``fingerprint_links``, between nodes
    that any word of their fingerprints links.  Nodes that share a word whole
    are linked to its smallest before the search."""
    each = distinct.select("node", F.posexplode("fp").alias("word", "fp"))
    firsts = written_table(each.groupBy("word", "fp").agg(F.min("node").alias("node")), "words")
    same = each.join(firsts.withColumnRenamed("node", "b"), ["word", "fp"]).filter("node <> b")
    found = fingerprint_links(firsts, bits, SHARD_SIZE_OF_WORDS, words)
    return found.unionByName(same.select(F.col("node").alias("a"), "b", F.col("b").alias("near")).distinct())


def near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3, words: int = 1) -> DataFrame:
    """(doc_id, fingerprint, component_id): ``component_id`` is the smallest
    doc_id that links of ``bits`` or fewer differing bits reach.

    With more ``words``, texts have as many independent fingerprints, of
    which one is enough for a link: copies that one misses by chance are
    found by another.  ``fingerprint`` is the first.

    Texts without a word (null ones too) share fingerprint zero.  Rows
    without doc_id get no component and link nothing.  Repeated rows stay; a
    doc_id with several texts links them.  Only ``doc_id`` and ``text`` are
    read; an empty table gives an empty result.
    """
    fps = written_table(fingerprints(docs, shingle, words), "fingerprints")
    distinct = written_table(fps.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct")
    shared = fps.filter("doc_id IS NOT NULL").join(distinct, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    repeated = shared.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most")).filter("least <> most")
    repeated = shared.join(repeated.select("a"), "a", "left_semi").distinct()
    links = fingerprint_links(distinct, bits) if words == 1 else links_of_words(distinct, bits, words)
    linked = components(links.select("a", "b").unionByName(repeated))
    classes = distinct.join(linked, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    labelled = fps.join(classes, "fp", "left")
    return labelled.select(
        "doc_id",
        F.lower(F.lpad(F.hex(F.col("fp") if words == 1 else F.col("fp")[0]), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
