"""Vector codes, licence notices and the filter audit against brute force."""

import collections
import hashlib
import itertools
import math
import re

import numpy as np
import pytest

from basketlens.llm import audit, codes, licences

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAN, INF = float("nan"), float("inf")


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def brute_codes(rows, parts, entries, rounds, scale=4096):
    """(vec_id, label, vector) rows with integer components, in plain Python."""
    width = len(rows[0][2]) // parts
    ints = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in rows]
    first = sorted((i, v) for i, _, v in ints if i is not None)[:entries]
    book = [[v[p * width : (p + 1) * width] for _, v in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        found = []
        for _, _, v in ints:
            cut = [v[p * width : (p + 1) * width] for p in range(parts)]
            found.append([min((gap(cut[p], c), k) for k, c in enumerate(book[p])) for p in range(parts)])
        return found

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(book[p])):
                own = [v[p * width : (p + 1) * width] for (_, _, v), f in zip(ints, found) if f[p][1] == k]
                if own:
                    book[p][k] = [sum(column) // len(own) for column in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for p in book for c in p for x in c).encode()).hexdigest()
    found, errors = assign(), collections.Counter()
    for (_, label, _), f in zip(ints, found):
        errors[label] += sum(g for g, _ in f)
    return collections.Counter(
        (i, "".join(f"{k:02x}" for _, k in f), sum(g for g, _ in f), errors[label], digest) for (i, label, _), f in zip(ints, found)
    )


def made_vectors(kind):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(300, 16))
    if kind == "hot":  # a third of all rows is one vector, and the first rows are equal in parts
        v[100:200], v[:4, :4] = v[3], 0.25
    if kind == "grid":  # ties everywhere
        v = np.round(v)
    rows = [(int(k), [None, 1, 2][k % 3], r.astype(np.float32).tolist()) for k, r in enumerate(v)]
    return rows + [(5, 2, rows[9][2]), (5, 2, rows[9][2]), (None, 1, rows[11][2]), (900, None, [0.0] * 16), (-3, 9, [-2.0] * 16)]


@pytest.mark.parametrize("kind,chunk", [("plain", 1 << 18), ("hot", 1 << 9), ("grid", 1 << 10)])
def test_codes_equal_brute_force(spark, monkeypatch, kind, chunk):
    monkeypatch.setattr(codes, "CHUNK_COMPONENTS", chunk)
    rows = made_vectors(kind)
    odd = [(901, 1, None), (902, 1, [NAN] * 16), (903, None, [INF] + [0.0] * 15), (904, 1, [None] + [0.5] * 15)]
    ddl = "vec_id long, label int, embedding array<float>, code string, error long, chunk int"
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows + odd], ddl).repartition(3)
    assert rows_of(codes.compressed(table, 4, 6, 3)) == brute_codes(rows, 4, 6, 3)
    assert codes.compressed(table.limit(0)).isEmpty()


def test_codes_of_vectors_that_do_not_fit(spark):
    rows = [(1, 1, [1.0] * 8), (2, 1, [2.0] * 8), (3, 1, [1.0] * 5), (4, 2, [1e30] * 8), (5, 2, [])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = {r["vec_id"]: r for r in codes.compressed(table, 4, 16, 6).collect()}
    assert {i: r["code"] for i, r in found.items()} == {1: "00000000", 2: "01010101", 3: None, 4: None, 5: None}
    assert {i: r["label_error"] for i, r in found.items()} == {1: 0, 2: 0, 3: 0, 4: None, 5: None}
    assert {r["code"] for r in codes.compressed(table.filter("vec_id > 2"), 4).collect()} == {None}
    unnumbered = table.selectExpr("CAST(NULL AS BIGINT) AS vec_id", "label", "embedding")
    assert [r["code"] for r in codes.compressed(unnumbered, 4).collect()] == [None] * 5


def test_balls_spare_distances():
    """On clustered points most balls are owned before their points are looked at."""
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(1, 40, 8)) * 1000)[:, rng.integers(0, 40, 4000)] + rng.integers(-9, 9, (1, 4000, 8))
    points = points.astype(np.int64)
    forest = codes.Forest.grown(points)
    _, counts, _, computed = forest.assigned(points[:, :16])
    assert counts.sum() == 4000 and computed < 0.05 * 16 * 4000
    assert (forest.sums[0] == points.sum(1)[0]).all() and forest.counts[0] == 4000
    inner = forest.children[:, 0] >= 0
    assert (forest.sums[forest.children[inner]].sum(1) == forest.sums[inner]).all()


def brute_licences(text, templates):
    words = licences.words_of(text)
    base, labels, base_labels, score = [], set(), set(), 0.0
    for t in templates:
        stands = lambda at, start, n: at >= 0 and words[at : at + n] == list(t.words[start : start + n])
        for o in range(-len(t.words), len(words)):
            ok = stands(o + t.phrases[0][0], *t.phrases[0])
            for start, n in t.phrases[1:]:
                ok = ok and any(stands(o + start + s, start, n) for s in range(-licences.SLACK, licences.SLACK + 1))
            if ok:
                labels.add(t.label)
                same = sum(0 <= o + k < len(words) and words[o + k] == w for k, w in enumerate(t.words))
                score = max(score, same / len(t.words))
                if t.base:
                    base.append(o + t.phrases[0][0])
                    base_labels.add(t.label)
    joined = [",".join(sorted(s)) for s in (base_labels, labels)]
    return (len(words), len(base), min(base, default=None), max(base, default=None), *joined, score)


NOTICES = [
    "/* Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance\n * with the License. */",
    "except in compliance with the license under the apache license",
    "Redistribution and use in source and binary forms, with or without any modification, are permitted provided that the following conditions are met:",
    "redistribution and use in source and binary forms " + "more " * 14 + "provided that the following conditions are met",
    "apache license " + "x " * 40 + "except in compliance with the license",
    "license you may not use this file apache license you may except in compliance with the license",
    "CC BY cc-by CC by-nc, general PUBLIC license all rights reserved.",
    "rights reserved", "all rights", "ccby cc by éall rights reserved all rights reserved", "general public", "license", "cc", "by cc",
    "GENERAL general public license public license",
    " ".join(notice for _, notice, _ in licences.NOTICES),
    "all rights reserved " * 3000,
]


def test_licences_equal_brute_force(spark, docs, plain, nothing):
    templates = licences.default_templates()
    table = docs.unionByName(spark.createDataFrame(list(enumerate(NOTICES, 20_000)), "doc_id long, text string"), True)
    want = collections.Counter((i, *brute_licences(text, templates)) for i, text in plain + list(enumerate(NOTICES, 20_000)))
    assert rows_of(licences.scan(table)) == want
    assert len({row[6] for row in want}) > 8
    assert licences.scan(nothing).isEmpty()


def test_all_notices_are_found_in_themselves():
    templates = licences.default_templates()
    index = licences.RareWordIndex(templates, {}, 10)
    for label, notice, _ in licences.NOTICES:
        *_, labels, score = index.scan([b"", notice.encode(), b"none"])
        assert label in labels[1].as_py().split(",") and score.to_pylist() == [0.0, 1.0, 0.0]
    with pytest.raises(ValueError):
        licences.Template.of("x", "some words", ["other words"])


def test_index_uses_the_rarest_word(docs, plain):
    counts, total = licences.document_counts(docs, ["license", "the", "zzz"])
    held = [set(licences.words_of(t)) for _, t in plain]
    assert counts == {w: sum(w in h for h in held) for w in ("license", "the", "zzz")} and total == len(plain)
    template = licences.Template.of("x", "the one license of", ["the one license"])
    index = licences.RareWordIndex([template], {"the": 9, "one": 2, "license": 5, "of": 0}, 9)
    assert [index.vocabulary.words[row[0]] for row in index.postings[0]] == ["one"]


def test_measures_of_texts():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("aaab AB\n#$é日 "), rng.integers(0, 400))) for _ in range(60)]
    texts += ["", " ", "x" * 3000, " ".join("word%d" % (k % 7) for k in range(900)), "longer-than-eight longer-than-eighT longer-than-eight", "ab b\x00 b ab\x00"]
    found = np.stack(audit.measured([t.encode() for t in texts], audit.byte_classes("#$%&*|")), axis=1).tolist()
    words = [WORD.findall(t) for t in texts]
    assert found == [
        [len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))] for t, w in zip(texts, words)
    ]


def test_words_with_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(audit.SpanTable, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    found = audit.measured([b"a b a c longer-word-1 longer-word-2", b"a a b"], audit.byte_classes("#"))
    assert [c.tolist() for c in found[:2]] == [[6, 3], [5, 2]]


def brute_audit(docs, labels):
    """docs: (doc_id, text, lang) rows."""
    least, good, toxic = {}, set(), set()
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, quality, bad in labels:
        good |= {i} if quality == 1 and i is not None else set()
        toxic |= {i} if bad == 1 and i is not None else set()
    judged = []
    for i, text, lang in docs:
        t = text or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)}
        fails |= {"D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        judged.append((lang or "", {k for k, f in fails.items() if f}, i in good, i in toxic))
    want = {}
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            alive = own
            for step, letter in enumerate(order, 1):
                gone = [j for j in alive if letter in j[1]]
                alive = [j for j in alive if letter not in j[1]]
                shapley[letter] += len(gone)
                redundant = sum(letter in j[1] for j in own) - len(gone)
                alone = sum(j[1] == {letter} for j in own)
                want[part, "".join(order), step] = [len(alive), len(gone), redundant, alone, sum(j[2] for j in gone), sum(j[3] for j in gone)]
        for part_, order, step in list(want):
            if part_ == part:
                want[part, order, step].append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in want.items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_audit_equals_brute_force(spark, docs, nothing, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    copies = [(30_000 + k // 2, "the same text " * 40, "en" if k % 3 else None) for k in range(120)] + [(None, "the same text " * 40, "fr")] * 3
    copies += [(None, "only here", "xx"), (None, "only here", "xx"), (40_000, "only there", "xx"), (40_000, "other", "xx"), (29_999, "one two", "en")]
    table = docs.unionByName(spark.createDataFrame(copies, "doc_id long, text string, lang string"), True)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    more = [(30_000, 1, 1), (30_001, None, 1), (30_001, 1, None), (30_005, 0, 0), (30_005, 0, 1), (None, 1, 1), (9009, 1, 0), (40_000, 1, 1)]
    labels = labels.unionByName(spark.createDataFrame(more, "doc_id long, quality int, toxic int")).withColumn("part", audit.F.lit("x"))
    found = audit.audit(table, labels).collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found}
    assert len(found) == len(got)
    assert got == brute_audit([(r["doc_id"], r["text"], r["lang"]) for r in table.collect()], marks + more)
    assert audit.audit(nothing, labels).isEmpty()
    assert {r["good_lost"] for r in audit.audit(table, labels.limit(0)).collect()} == {0}
