"""Operators on texts against brute force."""

import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash

from basketlens.llm import anchors, blocks, components, quality, rolling, runindex, simhash, similar

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_quality_equals_brute_force(docs, plain, nothing):
    want = collections.Counter()
    for i, text in plain:
        words, seen, dups = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dups += line in seen
                seen.add(line)
        runs = [tuple(words[j : j + 5]) for j in range(len(words) - 4)]
        counts = collections.Counter(runs)
        inside = {k for j, r in enumerate(runs) if counts[r] > 1 for k in range(j, j + 5)}
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        want[i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), failed] += 1
    found = quality.repetition_quality(docs)
    assert by_id(found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
    assert found.filter("kept AND base_failed").isEmpty()
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(docs).count() == found.filter("kept").count()
    assert quality.repetition_quality(nothing).isEmpty() and quality.keep_good(nothing).isEmpty()


def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks.written_blocks, "__defaults__", (20_000, ()))


def test_anchors_equal_brute_force(docs, plain, nothing, monkeypatch):
    small_blocks(monkeypatch)
    least, want, texts = {}, collections.Counter(), collections.Counter()
    key = lambda i: -1 if i is None else i
    for i, text in plain:
        words = WORD.findall(text)
        for j in range(len(words) - 49):
            run = tuple(words[j : j + 50])
            least[run] = min(least.get(run, 1 << 60), key(i))
    for i, text in plain:
        words = WORD.findall(text)
        gone = [False] * len(words)
        for j in range(len(words) - 49):
            if least[tuple(words[j : j + 50])] < key(i):
                gone[j : j + 50] = [True] * 50
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        want[i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
        if kept or not any(gone):
            texts[i, kept if any(gone) else text] += 1
    assert by_id(anchors.deduplicated(docs)) == want
    rebuilt = anchors.without_repeats(docs)
    assert rebuilt.columns == docs.columns
    assert collections.Counter((r["doc_id"], r["text"] or "") for r in rebuilt.collect()) == texts
    assert anchors.deduplicated(nothing).isEmpty()
    with pytest.raises(ValueError):
        anchors.deduplicated(docs, window=10)


def test_hashes_of_words_hold_few_powers(monkeypatch):
    texts = [b"", b"one two", b"w" * 700_000, b"some words again " * 60_000, b" x"]
    words = rolling.Words(texts)
    want = [rolling.Rolling(rolling.byte_values(words.data, k), k).of(words.starts, words.ends) for k in range(2)]
    short = rolling.Words([t for t in texts if len(t) != 700_000])
    monkeypatch.setattr(rolling, "_POWERS", [rolling._Powers(b) for b in rolling._BASES])
    for k in range(2):
        short.hashes(k)
        assert len(rolling._POWERS[k].tables[0]) <= 2 * rolling.GROUP_BYTES
        assert (words.hashes(k) == want[k]).all()  # a word longer than a group too
    assert not len(rolling.Words([b"", b" "]).hashes())


def test_blocks_are_compressed_once(docs, plain):
    import pyarrow.parquet as pq

    written = blocks.written_blocks(docs, 5_000)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in written.inputFiles()]
    codecs = {m.row_group(g).column(c).compression for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)}
    assert codecs == {"UNCOMPRESSED"}
    found = [t.decode() for r in written.collect() for t in blocks.Block(*(r[c] for c in blocks.COLUMNS)).texts]
    assert sorted(found) == sorted(t for _, t in plain)


def test_difference_cover_has_every_difference():
    assert {(a - b) % anchors.PERIOD for a in anchors.COVER for b in anchors.COVER} == set(range(anchors.PERIOD))


@pytest.mark.parametrize("limits", [{}, {"most": 3, "index_bytes": 5_000}])
def test_run_index_equals_brute_force(docs, plain, nothing, monkeypatch, limits):
    small_blocks(monkeypatch)
    raws = [(i, t.encode()) for i, t in plain]
    counts = collections.Counter(r[j : j + 400] for _, r in raws for j in range(len(r) - 399))
    want = collections.Counter()
    for i, raw in raws:
        gone = bytearray(len(raw))
        for j in range(len(raw) - 399):
            if counts[raw[j : j + 400]] > 1:
                gone[j : j + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want[i, len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    assert by_id(runindex.without_repeats(docs, **limits)) == want
    assert limits or runindex.without_repeats(nothing).isEmpty()


def test_suffix_order_and_matches():
    rng = np.random.default_rng(3)
    segments = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (60, 1, 0, 45, 80)]
    index = runindex.RunIndex(segments)
    flags = index.repeated(8)
    counts = collections.Counter(s[j : j + 8] for s in segments for j in range(len(s) - 7))
    for start, s in zip(index.starts, segments):
        want = [any(counts[s[j : j + 8]] > 1 for j in range(max(0, k - 7), min(k, len(s) - 8) + 1)) for k in range(len(s))]
        assert flags[start : start + len(s)].tolist() == want


def _split_mixed(x: int) -> int:
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


@pytest.mark.parametrize("bits,shingle,count", [(3, 3, 1), (7, 5, 1), (7, 5, 8)])
def test_simhash_equals_brute_force(docs, plain, nothing, bits, shingle, count):
    prints = []
    for _, text in plain:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        runs = [" ".join(words[j : j + shingle]) for j in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        each = [hashes, *([_split_mixed((h + k) % 2**64) for h in hashes] for k in range(1, count))]
        prints.append([sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) for hs in each])
    known = [k for k, (i, _) in enumerate(plain) if i is not None]
    fps, ids = np.array(prints, np.uint64), np.array([-1 if i is None else i for i, _ in plain])
    near = (np.bitwise_count(fps[known][:, None] ^ fps[known][None, :]) <= bits).any(axis=2) | (ids[known][:, None] == ids[known][None, :])
    label = ids[known]
    while (new := np.array([label[row].min() for row in near])).tolist() != label.tolist():
        label = new
    want = collections.Counter({})
    want.update((int(ids[k]), f"{prints[k][0]:016x}", int(c)) for k, c in zip(known, label))
    want.update((None, f"{prints[k][0]:016x}", None) for k in range(len(plain)) if k not in known)
    assert by_id(simhash.near_duplicates(docs, bits, shingle, count)) == want
    assert simhash.near_duplicates(nothing, words=count).isEmpty()


def _edited_copies(rng):
    """Stars, chains and loose families of edited texts."""
    vocabulary, texts = [f"w{n}" for n in range(3000)], []
    for family in range(60):
        first = list(rng.choice(vocabulary, rng.integers(40, 160)))
        texts.append(first)
        for copy in range(8):
            words = list(texts[-1] if family % 3 else first)
            for at in rng.integers(0, len(words), 1 + family % 5):
                words[at] = rng.choice(vocabulary)
            texts.append(words[: len(words) - family % 4])
    return [" ".join(texts[k]) for k in rng.permutation(len(texts))]


@pytest.mark.parametrize("bits,count,small", [(7, 2, False), (15, 2, True), (7, 8, True)])
def test_similar_groups_equal_brute_force(spark, docs, plain, nothing, monkeypatch, bits, count, small):
    if small:
        monkeypatch.setattr(simhash, "SHARD_SIZE_OF_WORDS", 70)
        monkeypatch.setattr(similar, "ASKED_AT_ONCE", 9)
    made = [(10_000 + n, t) for n, t in enumerate(_edited_copies(np.random.default_rng(bits)))] + [(10_003, "quite another"), (10_005, "")]
    rows = [(i, t) for i, t in plain if i is not None] + made
    sets, prints = [], []
    for _, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        runs = {" ".join(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
        hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        each = [hashes, *([_split_mixed((h + k) % 2**64) for h in hashes] for k in range(1, count))]
        prints.append([sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) for hs in each])
        sets.append(runs)
    fps, label = np.array(prints, np.uint64), np.array([i for i, _ in rows])
    near = label[:, None] == label[None, :]
    proposed = (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits).any(axis=2)
    for a, b in zip(*np.nonzero(np.triu(proposed))):
        common, every = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        near[a, b] = near[b, a] = near[a, b] or 5 * common >= 4 * every
    assert (proposed & ~near).any()
    while (new := np.array([label[row].min() for row in near])).tolist() != label.tolist():
        label = new
    table = docs.unionByName(spark.createDataFrame(made, "doc_id long, text string"), allowMissingColumns=True)
    found = similar.similar_groups(table, 0.8, 5, bits, count)
    assert by_id(found) == collections.Counter({(i, int(c)) for (i, _), c in zip(rows, label)})
    assert similar.similar_groups(nothing).isEmpty()


def test_similar_groups_find_isolated_pairs_at_the_bound(spark):
    """Pairs with a true similarity of 0.8 to 0.82 and no third text."""
    rng = np.random.default_rng(12)
    vocabulary, rows = np.array([f"w{n}" for n in range(3000)]), []
    while len(rows) < 600:
        first = rng.choice(vocabulary, rng.integers(200, 400))
        second = first.copy()
        at = rng.choice(len(first), len(first) // 45, replace=False)
        second[at] = rng.choice(vocabulary, len(at))
        a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (first, second))
        if 0.8 <= len(a & b) / len(a | b) < 0.82:
            rows += [(len(rows), " ".join(first)), (len(rows) + 1, " ".join(second))]
    hashes = [similar.shingle_set(t, 5) for _, t in rows]
    fps = simhash.fingerprints_of_hashes(hashes, similar.FINGERPRINTS)
    proposed = (np.bitwise_count(fps[::2] ^ fps[1::2]) <= 7).any(axis=1).mean()
    found = similar.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 0.8)
    joined = found.filter("doc_id % 2 = 1 AND component_id = doc_id - 1").count()
    print("at 8:", (np.bitwise_count(fps[::2, :8] ^ fps[1::2, :8]) <= 7).any(axis=1).mean(), "all:", proposed, "joined:", joined)
    assert joined >= 0.99 * 300


def test_bitmaps_lose_no_similar_set():
    rng = np.random.default_rng(8)
    for most in (1, 30, 400, 6000):
        sets = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, most).astype(np.uint64)
            sets += [np.unique(rng.choice(pool, max(1, int(most * share)), replace=False)) for share in (1, 0.97, 0.9, 0.8, 0.6)]
        a, b = np.triu_indices(len(sets), 1)
        bitmaps, sizes = np.stack([similar.bitmap_of(s) for s in sets]), np.array([len(s) for s in sets])
        common = np.array([len(np.intersect1d(sets[i], sets[j], True)) for i, j in zip(a, b)])
        alike = common >= 0.8 * (sizes[a] + sizes[b] - common)
        may_be = similar.may_be_similar(bitmaps, sizes, a, b, 0.8)
        assert alike.any() and may_be[alike].all()
        assert most in (1, 6000) or not may_be[common == 0].any()


def test_a_family_near_but_not_similar_gives_few_pairs(spark):
    """Texts that share a passage: all close by fingerprints, none similar."""
    rng = np.random.default_rng(9)
    vocabulary = np.array([f"w{n}" for n in range(5000)])
    common = rng.choice(vocabulary, 150)
    texts = [(n, " ".join([*common, *rng.choice(vocabulary, 50)])) for n in range(200)]
    texts += [(200, texts[0][1] + " more"), (201, texts[7][1] + " words")]
    made = similar._described(spark.createDataFrame(texts, "doc_id long, text string"), 5, 8).withColumnRenamed("doc_id", "node")
    made = made.selectExpr("*", "node AS label", "node = 0 AS main").drop("key")
    found = {(r["a"], r["b"]) for r in similar.crossing_pairs(made, 15, 8, 0.8).collect()}
    assert {(0, 200), (7, 201)} <= found and len(found) < 200


def test_texts_asked_for_are_met_by_a_bitmap_before_they_move(spark, docs, plain, monkeypatch):
    monkeypatch.setattr(similar, "ASKED_BITS", 128)  # several ids share a bit
    asked = docs.filter("doc_id % 9 = 0").selectExpr("CAST(doc_id AS long) doc_id").distinct()
    found = similar._asked_texts(docs, asked)
    want = collections.Counter((i, t) for i, t in plain if i is not None and i % 9 == 0)
    assert collections.Counter((r["doc_id"], r["text"] or "") for r in found.collect()) == want
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in x]
    assert "word" not in joins[0] and "word" in joins[1]


@pytest.mark.parametrize("bits", [3, 7])
def test_shards_lose_no_link(spark, docs, bits):
    """Close groups over many small shards, a part that all share too."""
    rng = np.random.default_rng(5)
    seeds = np.concatenate([rng.integers(0, 2**63, 40), rng.integers(0, 2**32, 200)]).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (len(seeds), 8)).astype(np.uint64)
    fps = np.unique(np.concatenate([seeds[:, None] ^ np.bitwise_xor.accumulate(flips, axis=1), seeds[:, None]], axis=1))
    table = spark.createDataFrame([(int(f), n) for n, f in enumerate(fps.view(np.int64))], "fp long, node long")
    found = {r["node"]: r["component"] for r in components.components(simhash.fingerprint_links(table, bits, shard_size=60)).collect()}
    near, label = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits, np.arange(len(fps))
    while (new := np.array([label[row].min() for row in near])).tolist() != label.tolist():
        label = new
    assert [found.get(n, n) for n in range(len(fps))] == label.tolist()


def test_components_of_a_long_chain(spark):
    links = [(n, n + 1) for n in range(100)] + [(500, 400), (400, 500), (7, 7), (None, 3)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{n: 0 for n in range(101)}, 400: 400, 500: 400}


def test_close_pairs_compares_few(monkeypatch):
    fps = np.unique(np.random.default_rng(5).integers(0, 2**64, 20_000, dtype=np.uint64))
    fps[:50] = fps[50:100] ^ np.uint64(0b1011 << 20)
    places, compared, count = np.arange(len(fps)), [0], np.bitwise_count
    own = fps >> np.uint64(16) & np.uint64(0xFFFF)
    want = {(i, i + 50) for i in range(50) if count(own[i] ^ own[i + 50]) <= 1}

    def counting(x):
        compared[0] += np.size(x)
        return count(x)

    monkeypatch.setattr(simhash.np, "bitwise_count", counting)
    found = [(a, b) for a, b in simhash.close_pairs(fps, places, places, 1, 7)]
    pairs = {(int(x), int(y)) for a, b in found for x, y in zip(a, b) if x < y}
    assert pairs == want
    # each meets the 17 of 65,536 values that differ in at most one bit: some 5 others
    assert compared[0] < 10 * len(fps)
