"""Toxicity by compression distance.

Two zstandard dictionaries hold what tells the classes apart: the stretches
of words whose byte n-grams documents of one class hold more often, and those
of the other.  An overlapping window of words that the toxic one makes
shorter is closer to toxic text.  Weights of these gains are fitted on
labelled documents by cross-fitting: each is measured by dictionaries made
from the other folds, and the dictionaries in use are made from all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import written_table
from basketlens.llm.rolling import slices

#: Labelled documents of a class that are learned from, at most, and folds.
LEARNED_DOCUMENTS = 3_000
FOLDS = 4
#: Byte n-grams and stretches of words of a class kept for its dictionary.
GRAMS, SPANS = 3_000, 3_000
DICTIONARY_BYTES, SPAN_BYTES = 1 << 16, 64
#: Words of a window; windows start at every second of them.
WINDOW_WORDS, STEP_WORDS = 4, 2
#: Bytes of an n-gram, and the shortest match of the compressor.
GRAM_BYTES = 6
#: Log-likelihood ratio from which a byte n-gram tells the classes apart.
LEAST_RATIO = 25.0
#: Ends each dictionary and begins each window, so that every window has a
#: match and a further one costs no section header.
MARK = b"\x01plain or toxic\x02"
#: Ranks of the largest gains, and bytes from which gains are counted.
RANKS, LEAST_GAINS = (0, 1, 3, 7), (1, 2, 3, 4, 6)
FEATURES = len(RANKS) + len(LEAST_GAINS) + 1
_NO_WORD = re.compile(r"[^\w]+")


def _grams(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8).astype(np.int64)
    if len(data) < GRAM_BYTES:
        return np.empty(0, np.int64)
    grams = np.zeros(len(data) - GRAM_BYTES + 1, np.int64)
    for i in range(GRAM_BYTES):
        grams = grams << 8 | data[i : i + len(grams)]
    return grams


def _line(text: str | None) -> bytes:
    """Words in lower case, without punctuation, a space around each."""
    words = _NO_WORD.sub(" ", (text or "").lower()).split()
    return b" %b " % " ".join(words).encode() if words else b""


def _spans(word: bytes, ratios: dict[int, float]):
    """Stretches of a word, with the spaces around it, of n-grams in
    ``ratios`` one behind the other, and the largest ratio of each."""
    padded = b" %b " % word
    found = [ratios.get(g, 0.0) for g in _grams(padded).tolist()] + [0.0]
    begin = None
    for i, ratio in enumerate(found):
        if ratio and begin is None:
            begin = i
        elif not ratio and begin is not None:
            for at in range(begin, i, SPAN_BYTES - GRAM_BYTES + 1):
                end = min(i, at + SPAN_BYTES - GRAM_BYTES + 1)
                yield padded[at : end + GRAM_BYTES - 1], max(found[at:end])
            begin = None


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Largest gains and counts of gains of windows, and the logarithm of
        the number of windows.  Windows without an n-gram of a dictionary
        have no gain and are not compressed."""
        import zstandard

        options = dict(min_match=GRAM_BYTES, strategy=zstandard.STRATEGY_FAST, window_log=18)
        options |= dict(write_content_size=False, write_checksum=False, write_dict_id=False)

        def shorter(content: bytes):
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(3, **options), dict_data=own).compress

        plain, toxic = shorter(self.ordinary + MARK), shorter(self.toxic + MARK)
        known = np.unique(np.concatenate([_grams(self.ordinary), _grams(self.toxic)]))
        rows = np.zeros((len(texts), FEATURES))
        for i, text in enumerate(texts):
            line = _line(text)
            spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
            words = max(len(spaces) - 1, 0)
            windows = max(1, -(-(words - WINDOW_WORDS) // STEP_WORDS) + 1) if words else 0
            rows[i, -1] = np.log1p(windows)
            grams = _grams(line)
            if not windows or not len(known) or not len(grams):
                continue
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
            if not len(at):
                continue
            word = np.unique(np.searchsorted(spaces, at, "right") - 1)
            near = (word // STEP_WORDS)[:, None] - np.arange(-(-WINDOW_WORDS // STEP_WORDS))
            gains = []
            for first in np.unique(near[(near >= 0) & (near < windows)]).tolist():
                first *= STEP_WORDS
                window = MARK + line[spaces[first] : spaces[min(first + WINDOW_WORDS, words)] + 1]
                gains.append(len(plain(window)) - len(toxic(window)))
            largest = np.sort(np.array(gains + [0] * (RANKS[-1] + 1)))[::-1]  # the other windows' are zero
            rows[i, : len(RANKS)] = largest[list(RANKS)]
            rows[i, len(RANKS) : -1] = [np.log1p((largest >= least).sum()) for least in LEAST_GAINS]
        return rows

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.toxic:
            return np.zeros(len(texts))
        x = (self.features(texts) - self.centre) / self.spread
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    z, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w - np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (weight * (p - y)) + penalty * w)
    return w


def _nothing() -> ToxicityModel:
    return ToxicityModel(b"", b"", np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1))


def _contrast(grams: DataFrame, own: str, own_size: int, other: str, other_size: int) -> dict[int, float]:
    """The byte n-grams that documents of one class hold more often, with
    the ratio, at most ``GRAMS`` of them."""
    a, b = F.col(own), F.col(other)
    part = lambda x, n: F.when(x > 0, x * F.log(x * (own_size + other_size) / ((a + b) * n))).otherwise(0.0)
    rest = lambda x, n: F.when(n > x, (n - x) * F.log((n - x) * (own_size + other_size) / ((own_size + other_size - a - b) * n))).otherwise(0.0)
    ratio = 2 * (part(a, own_size) + part(b, other_size) + rest(a, F.lit(own_size)) + rest(b, F.lit(other_size)))
    found = grams.filter(a / own_size > b / other_size).select("gram", ratio.alias("ratio")).filter(F.col("ratio") >= LEAST_RATIO)
    return {r["gram"]: r["ratio"] for r in found.orderBy(F.desc("ratio"), "gram").limit(GRAMS).collect()}


def _dictionaries(texts: DataFrame) -> list[ToxicityModel]:
    """For each fold the dictionaries made from the other folds, then those
    made from all of ``texts`` (text, toxic, fold)."""

    def count(batches):
        for batch in slices(batches):
            folds, toxic = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("fold", "toxic"))
            for fold in np.unique(folds).tolist():
                own = np.flatnonzero(folds == fold)
                each = [np.unique(_grams(_line(t))) for t in batch.column("text").take(pa.array(own)).to_pylist()]
                grams, n = np.unique(np.concatenate(each), return_inverse=True)
                kinds = np.repeat(toxic[own], [len(e) for e in each])
                counts = [np.bincount(n, k, len(grams)).astype(np.int64) for k in (kinds, 1 - kinds)]
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(np.full(len(grams), fold)), *map(pa.array, counts)], names=["gram", "fold", "toxic", "ordinary"])

    sizes = {(r["fold"], r["toxic"]): r["n"] for r in texts.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    used = {k: F.col("fold") != k for k in range(FOLDS + 1)}
    sums = [F.sum(F.when(of, F.col(c)).otherwise(0)).alias(f"{c}_{k}") for k, of in used.items() for c in ("toxic", "ordinary")]
    grams = texts.select("text", "toxic", "fold").mapInArrow(count, "gram long, fold long, toxic long, ordinary long")
    grams = written_table(grams.groupBy("gram").agg(*sums), "grams")
    ratios = {}
    for k in used:
        toxic, ordinary = (sum(n for (fold, kind), n in sizes.items() if fold != k and kind == t) for t in (1, 0))
        if toxic and ordinary:
            ratios[k, 1] = _contrast(grams, f"toxic_{k}", toxic, f"ordinary_{k}", ordinary)
            ratios[k, 0] = _contrast(grams, f"ordinary_{k}", ordinary, f"toxic_{k}", toxic)

    def list_spans(batches):
        for batch in slices(batches):
            rows = []
            for text, toxic, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                words = set(_line(text).split())
                for k in range(FOLDS + 1):
                    own = ratios.get((k, toxic)) if k != fold else None
                    if own:
                        best: dict[bytes, float] = {}
                        for word in words:
                            for span, ratio in _spans(word, own):
                                best[span] = max(best.get(span, 0.0), ratio)
                        rows += [(k, toxic, span, ratio) for span, ratio in best.items()]
            columns = list(zip(*rows)) or [[]] * 4
            kinds = pa.int64(), pa.int64(), pa.binary(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["k", "toxic", "span", "ratio"])

    spans = texts.select("text", "toxic", "fold").mapInArrow(list_spans, "k long, toxic long, span binary, ratio double")
    spans = written_table(spans.groupBy("k", "toxic", "span").agg(F.max("ratio").alias("ratio"), F.count("*").alias("n")), "spans")
    made = []
    for k in used:
        made.append(_nothing())
        for kind in (0, 1):
            if ratios.get((k, kind)):
                best = spans.filter((F.col("k") == k) & (F.col("toxic") == kind)).orderBy(F.desc("ratio"), F.desc("n"), "span").limit(SPANS).collect()
                content = b"\n".join(bytes(r["span"]) for r in reversed(best))[-DICTIONARY_BYTES:]
                setattr(made[-1], "toxic" if kind else "ordinary", content)
    return made


def fit(docs: DataFrame, labels: DataFrame, learned: int = LEARNED_DOCUMENTS) -> ToxicityModel:
    """Learn from at most ``learned`` documents of each class, those whose id
    has the smallest hashes.  Labels without id or class are left out; of
    several labels of a document the largest counts.  Without documents of
    both classes, or without anything that tells them apart, every text
    scores 0."""
    classes = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = classes.join(docs.select("doc_id").distinct(), "doc_id")
    totals = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return _nothing()
    order = F.xxhash64("doc_id"), F.col("doc_id")
    picked = usable.filter("toxic = 0").orderBy(*order).limit(learned).unionByName(usable.filter("toxic = 1").orderBy(*order).limit(learned))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])  # 2 * learned ids
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS))
    texts = written_table(texts.select("text", F.col("toxic").cast("long").alias("toxic"), fold.alias("fold")), "labelled")
    *others, model = _dictionaries(texts)
    if not model.toxic:
        return _nothing()

    def gauge(batches):
        for batch in slices(batches):
            folds, found = np.array(batch.column("fold").to_pylist()), np.zeros((batch.num_rows, FEATURES))
            for k in np.unique(folds).tolist():
                own = np.flatnonzero(folds == k)
                found[own] = others[k].features(batch.column("text").take(pa.array(own)).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["toxic", "features"])

    rows = texts.select("text", "toxic", "fold").mapInArrow(gauge, "toxic long, features array<double>").collect()
    y, x = np.array([r["toxic"] for r in rows], float), np.array([r["features"] for r in rows]).reshape(-1, FEATURES)
    model.centre, model.spread = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y == 1, totals[1] / y.sum(), totals[0] / (1 - y).sum()) * len(y) / sum(totals.values())
    model.weights = _logistic((x - model.centre) / model.spread, y, weight)
    return model


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every whole text, null and empty ones
    as texts without a window.  Repeated rows get equal scores; an empty
    table gives an empty result; only ``doc_id`` and ``text`` are read."""

    def apply(batches):
        for batch in batches:
            found = model.scores(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(apply, "doc_id long, score double, predicted int")

