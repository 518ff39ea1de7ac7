"""Tokens, packing, graphs, mixtures, models and the pipeline."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from basketlens.functions.shared_tables import new_path
from basketlens.llm import graph, language, mixing, packing, shards, toxicity
from basketlens.llm.tokens import default_tokenizer

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoded(plain):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return [(i, e.ids) for (i, _), e in zip(plain, tokenizer.encode_batch([t for _, t in plain], add_special_tokens=False))]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_is_whole_and_tight(docs, encoded, nothing):
    found = packing.pack_documents(docs, default_tokenizer(), capacity=256).collect()
    want = collections.Counter()
    for i, ids in encoded:
        ids, start, length = [*ids, 0], 0, (len(ids) + 1) % 256 or 256
        for piece in itertools.count():
            want[i, piece, start, length, crc(ids[start : start + length])] += 1
            start, length = start + length, 256
            if start >= len(ids):
                break
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    bins = collections.defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        assert [o for o, _ in sorted(places)] == list(itertools.accumulate((n for _, n in sorted(places)), initial=0))[:-1]
        assert sum(n for _, n in places) <= 256
    assert len(bins) <= math.ceil(sum(r["length"] for r in found) / 256) + 1
    assert packing.pack_documents(nothing, default_tokenizer()).isEmpty()


def test_fullest_set_is_the_fullest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(1, 30, 8).tolist()
        room = int(rng.integers(1, 80))
        best = max(s for n in range(9) for c in itertools.combinations(lengths, n) if (s := sum(c)) <= room)
        chosen = packing.fullest_set(collections.Counter(lengths), room)
        assert sum(k * n for k, n in chosen.items()) == best
        assert not collections.Counter(chosen) - collections.Counter(lengths)


def test_shards_round_trip(spark, docs, encoded, nothing):
    path = new_path(spark, "test-shards")
    shards.write_shards(docs, path, default_tokenizer(), shard_tokens=2_000)
    opened = shards.open_shards(spark, path)
    found = shards.read_documents(opened).collect()
    want = collections.Counter((i, len(ids) + 1, crc([*ids, 2])) for i, ids in encoded)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == list(itertools.accumulate((r["n_tokens"] for r in ordered), initial=0))[:-1]
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert keys == sorted(keys)
    got = {r["doc_id"]: r["ids"] for r in shards.fetch(opened, [0, 7, 9009, 123456789]).collect()}
    assert set(got) == {0, 7, 9009} and got[7] == [*dict(encoded)[7], 2]
    path = new_path(spark, "test-shards")
    shards.write_shards(nothing, path, default_tokenizer())
    assert shards.read_documents(shards.open_shards(spark, path)).isEmpty()


def test_perfect_hash_has_a_slot_for_each_key():
    keys = np.unique(np.random.default_rng(2).integers(-(2**62), 2**62, 5_000))
    index = shards.PerfectHash.of(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert (index.slots(keys + 1) >= 0).mean() < 0.01


def test_neighbours_have_high_recall(spark, docs):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1_500, 16)) + rng.integers(0, 6, (1_500, 1))
    rows = [(n, [float(x) for x in p]) for n, p in enumerate(points)]
    odd = [(2_000, None), (2_001, [0.0] * 16), (2_002, [math.nan] * 16), (2_003, [None] * 16), (2_004, [1.0, 2.0]), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    asked = table.filter("vec_id % 20 = 0")
    found = collections.defaultdict(list)
    for r in graph.nearest(table, asked, k=10, shard_vectors=400, width=64).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 1_500, 20))
    hits = 0
    for q, near in found.items():
        gaps = np.sqrt(((points - points[q]) ** 2).sum(1))
        assert all(abs(gaps[v] - s) < 1e-12 for v, s in near) and [s for _, s in near] == sorted(s for _, s in near)
        gaps[q] = np.inf
        hits += len({v for v, _ in near} & set(np.argsort(gaps)[:10].tolist()))
    assert hits >= 0.9 * 10 * len(found)
    few = graph.nearest(table.filter("vec_id < 4"), table.filter("vec_id < 1"), k=10)
    assert few.count() == 3
    assert graph.nearest(table.limit(0), table).isEmpty() and graph.nearest(table, table.limit(0)).isEmpty()


def test_copies_of_a_vector_hide_no_neighbours(spark):
    """A third of the rows share one vector; full shards; near vectors beyond the copies."""
    rng = np.random.default_rng(14)
    points = rng.normal(size=(1_800, 12))
    points[1_200:] = points[0]
    points[1:6] = points[0] + 0.01 * rng.normal(size=(5, 12))
    ids = rng.permutation(1_800)
    rows = [(int(i), [float(x) for x in p]) for i, p in zip(ids, points)]
    rows.append(rows[7])  # a row twice
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    asked = [*range(8), *range(1_200, 1_800, 30), *range(8, 1_200, 40)]
    queries = spark.createDataFrame([rows[n] for n in asked], table.schema)
    found = collections.defaultdict(list)
    for r in graph.nearest(table, queries, k=10, shard_vectors=300, width=64).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    hits, every = 0, np.append(points, [points[7]], axis=0)
    labels = np.append(ids, ids[7])
    for n in asked:
        gaps = np.sqrt(((every - points[n]) ** 2).sum(1))
        gaps[labels == ids[n]] = np.inf
        right = labels[np.lexsort((labels, gaps))[:10]].tolist()
        hits += sum((collections.Counter(right) & collections.Counter(found[ids[n]])).values())
        if n < 6 or n >= 1_200:
            assert found[ids[n]] == right
    assert hits >= 0.95 * 10 * len(asked)


def test_raking_meets_its_targets():
    rng = np.random.default_rng(6)
    tokens = rng.integers(100, 1_000, 24).astype(float)
    places = [np.repeat(np.arange(4), 6), np.tile(np.arange(6), 4)]
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.full(6, 1 / 6)]
    weights = mixing.rake(tokens, places, targets, 0.2 * tokens.sum())
    for place, share in zip(places, targets):
        assert np.bincount(place, weights) / weights.sum() == pytest.approx(share, abs=1e-6)
    assert (mixing.rake(tokens, places, targets, 10 * tokens.sum()) <= tokens).all()


def test_mixture_draws_by_cell(docs, nothing):
    found = mixing.mixture(docs).collect()
    assert len(found) == docs.count()
    assert len({(r["source"], r["lang"], r["topic"], r["probability"]) for r in found}) == len({(r["source"], r["lang"], r["topic"]) for r in found})
    assert all(0 <= r["probability"] <= 1 and (r["chosen"] or r["n_tokens"]) for r in found)
    kept = mixing.chosen_rows(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["chosen"] for r in found)
    assert mixing.mixture(nothing).isEmpty() and mixing.chosen_rows(nothing).isEmpty()


def test_languages_are_told_apart(spark, docs, nothing):
    model = language.fit(docs.filter("doc_id % 2 = 0"))
    found = language.predict(docs, model).alias("p").join(docs.alias("d"), "doc_id")
    held = found.filter("doc_id % 2 = 1 AND doc_id < 9000").agg(F.avg((F.col("lang_pred") == F.col("d.lang")).cast("int"))).first()[0]
    assert held > 0.95
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert odd[9004] == odd[9005] == odd[9006] == ("und", 0.0)
    assert language.predict(docs, language.fit(nothing)).filter("lang_pred <> 'und'").isEmpty()


def test_toxic_words_raise_the_score(spark, docs, nothing):
    rng = np.random.default_rng(8)
    plain = [" ".join(rng.choice(["lorem", "ipsum", "dolor", "amet", "elit", "sed", "magna"], 40)) for _ in range(300)]
    texts = [t + (" wretched " * 3 if n % 5 == 0 else "") + t for n, t in enumerate(plain)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n % 5 == 0)) for n in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(table.filter("doc_id < 200"), labels)
    rows = toxicity.score(table.filter("doc_id >= 200"), model).collect()
    right = sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in rows)
    assert right > 0.95 * len(rows)
    assert toxicity.score(docs, model).count() == docs.count()
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).filter("score > 0").isEmpty()


def test_held_out_toxic_documents_are_found(spark):
    folder = "/root/testdata/sf0.1"
    found = entry.queries()["op7_toxicity_by_compression"](spark, folder).filter("held_out")
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    hits = sum(r["toxic"] for r in rows if r["predicted"])
    assert hits >= 0.75 * sum(r["toxic"] for r in rows) and hits >= 0.9 * sum(r["predicted"] for r in rows)


def test_pipeline_stages(spark, docs):
    stage, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    columns = stage.columns
    for name, function in corpus_pipeline.STAGES:
        made = function(spark, stage, FOLDER)
        path = new_path(spark, "test-stage")
        made.write.parquet(path)
        stage = spark.read.parquet(path)
        seen.append(stage.count())
        assert name == corpus_pipeline.STAGES[-1][0] or stage.columns == columns
    assert 0 < seen[3] < seen[2] <= seen[1] < seen[0] < 200
    assert corpus_pipeline.run(spark, FOLDER).count() == seen[-1]


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op")))
def test_registered_queries_run(spark, name):
    found = entry.queries()[name](spark, FOLDER)
    assert found.count() >= (2 if name.startswith("op4") else 200)
