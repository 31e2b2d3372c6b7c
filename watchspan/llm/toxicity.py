"""Toxicity by maximum-scoring segments.

Learning. Features are words and four-letter heads of longer words, counted once per labelled document and class. Their
log-odds between the classes have an informative Dirichlet prior in proportion to the feature's count in both classes. A
head's log-odds are drawn towards zero as far as they are uncertain, a word's towards those of its head. Every feature of the
labelled documents is kept, those that speak for clean text too; the model is bounded by the number of labels that are
used (`most_labels`). A token scores its word's log-odds, those of its head if the word is unknown, or zero, less `gap`, the
log-odds that a token has in advance.

Search. A linear-time scan finds all maximal scoring segments of a text's token scores. Under random clean text the number
of segments of score S in n words is about K n exp(-lambda S), an extreme-value law: lambda solves
sum p(s) exp(lambda s) = 1 over the word scores of clean documents, K comes from the segments found in them. Segments
with an expectation of at most `most_expected` are significant passages.

Score. A text's evidence is the sum of -ln(expectation) over its segments where that is positive; a logistic curve
fitted to the labelled documents turns it into a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from watchspan.llm.common import counted, slices, stored, unused

_WORD = re.compile(r"\w+")
HEAD = 4
SLICE = 1 << 20  # bytes of text whose words a task holds at a time
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


@dataclass(frozen=True)
class Weights:
    """Log-odds by feature; features are held as 64-bit hashes in order."""

    hashes: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(features: list[str], values: np.ndarray) -> Weights:
        hashes = _hashes(features)
        order = np.argsort(hashes)
        return Weights(hashes[order], np.asarray(values, np.float64)[order])

    def find(self, features: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds (0 where unknown) and which are known."""
        if not len(self.hashes) or not features:
            return np.zeros(len(features)), np.zeros(len(features), bool)
        asked = _hashes(features)
        at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        known = self.hashes[at] == asked
        return np.where(known, self.values[at], 0.0), known

    def words(self, words: list[str]) -> np.ndarray:
        """Log-odds of words: their own, else those of their head, else 0."""
        own, known = self.find(words)
        rest = [i for i in np.flatnonzero(~known).tolist() if len(words[i]) > HEAD]
        own[rest] = self.find([words[i][:HEAD] + "*" for i in rest])[0]
        return own


def _hashes(items: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in items), np.uint64, len(items))


NO_WEIGHTS = Weights(np.zeros(0, np.uint64), np.zeros(0))


@dataclass(frozen=True)
class ToxicModel:
    weights: Weights
    gap: float
    decay: float  # lambda
    rate: float  # K
    intercept: float
    slope: float

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-(self.intercept + self.slope * math.log1p(evidence))))


def token_scores(weights: Weights, gap: float, texts: list[list[str]]) -> Iterator[list[float]]:
    """The scores of each text's words; every distinct word of the texts is looked up once."""
    distinct = list({w for words in texts for w in words})
    score = dict(zip(distinct, (weights.words(distinct) - gap).tolist(), strict=True))
    for words in texts:
        yield [score[w] for w in words]


def scored_hits(scores: list[float]) -> tuple[list[tuple[int, float]], list[float]]:
    """Place and score of the tokens above zero, and what the tokens between each and the one before it sum up to."""
    hits, lost, sum_ = [], [], 0.0
    for i, s in enumerate(scores):
        if s > 0:
            hits.append((i, s))
            lost.append(sum_)
            sum_ = 0.0
        else:
            sum_ += s
    return hits, lost


def features(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:HEAD] + "*" for w in words if len(w) > HEAD}


def maximal_segments(hits: list[tuple[int, float]], gap: float, lost: list[float] | None = None) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text in one scan over its hits (place, positive score).
    The words before each hit sum up to `lost`; without it, each of them scores `gap` below zero.

    A segment is kept with the running total before it and after it. A new one reaches back over earlier segments as
    long as one of them began from a lower total; it swallows them if it also ends higher.
    """
    kept: list[tuple[int, int, float, float]] = []  # first, last, total before, total after
    below: list[int] = []  # for each kept segment, the last earlier one that began from a lower total
    total, after = 0.0, -1
    for i, (place, score) in enumerate(hits):
        total += -gap * (place - after - 1) if lost is None else lost[i]
        first, last, low, high = place, place, total, total + score
        total, after = high, place
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = below[j]
            if j < 0 or kept[j][3] >= high:
                kept.append((first, last, low, high))
                below.append(j)
                break
            first, low = kept[j][0], kept[j][2]
            nxt = below[j]
            del kept[j:], below[j:]
            j = nxt
    return [(f, l, h - b) for f, l, b, h in kept]


def decay_of(shares: dict[float, float]) -> float:
    """The positive root of sum p exp(x s) = 1 for word scores s with shares p and a negative mean (1 if there is none)."""
    if not any(s > 0 and p > 0 for s, p in shares.items()) or sum(s * p for s, p in shares.items()) >= 0:
        return 1.0
    def excess(x: float) -> float:
        return sum(p * math.exp(min(x * s, 700)) for s, p in shares.items()) - 1
    high = 1.0
    while excess(high) <= 0:
        high *= 2
    low = 0.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _labelled(docs: DataFrame, labels: DataFrame, most_labels: int) -> DataFrame:
    """Texts with one label each: toxic if any label row of the document says so; null labels are ignored.

    At most `most_labels` labelled ids count, those of the smallest hash, so that they can be broadcast and no text is shuffled.
    """
    known = labels.filter("doc_id is not null and toxic is not null")
    draw = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 30) - 1))
    # about the right number by a bound on the hash first, so that few rows reach the exact cut
    share = min(1.0, 1.5 * most_labels / max(known.count(), 1))
    marks = known.filter(draw < int((1 << 30) * share)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = stored(marks.orderBy(draw, "doc_id").limit(most_labels), "labels")
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic")


def train(
    docs: DataFrame, labels: DataFrame, gap: float = 1.5, prior: float = 0.1, most_labels: int = 50_000
) -> ToxicModel:
    """Learn from the documents (doc_id, text) that labels (doc_id, toxic 0/1) covers. Without a labelled document, or
    without one of both classes, nothing scores and every probability is the share of toxic labels (one half without any)."""
    rows = _labelled(docs, labels, most_labels)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for batch in slices(batches, most=SLICE):
                for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                    yield toxic, [*features(text), ""]

        def emit(held) -> pa.RecordBatch:
            clean, toxic = held.get(0, {}), held.get(1, {})
            names = [*clean, *(f for f in toxic if f not in clean)]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic.get(f, 0) for f in names]), pa.array([clean.get(f, 0) for f in names])],
                ["feature", "y1", "y0"],
            )

        yield from counted(items(), emit, 150_000)

    parts = rows.mapInArrow(count, "feature string, y1 long, y0 long")
    counts = stored(parts.groupBy("feature").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")), "features")
    docs_of = counts.filter("feature = ''").first()
    toxic, clean = (docs_of.y1, docs_of.y0) if docs_of else (0, 0)
    base = (toxic + 0.5) / (toxic + clean + 1)
    flat_model = ToxicModel(NO_WEIGHTS, gap, 1.0, 1.0, math.log(base / (1 - base)), 0.0)
    if not toxic or not clean:
        return flat_model
    totals = counts.filter("feature <> ''").agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0")).first()
    if not totals.n1 or not totals.n0:
        return flat_model
    a = prior * (F.col("y1") + F.col("y0"))
    a0 = prior * (totals.n1 + totals.n0)
    odds = [F.log((F.col(y) + a) / (F.lit(float(n)) + F.lit(a0) - F.col(y) - a)) for y, n in (("y1", totals.n1), ("y0", totals.n0))]
    variance = 1 / (F.col("y1") + a) + 1 / (F.col("y0") + a)
    rows_of = counts.filter("feature <> ''").select("feature", (odds[0] - odds[1]).alias("weight"), variance.alias("variance")).toArrow()
    names, raw, spread = (rows_of.column(c) for c in ("feature", "weight", "variance"))
    names, raw, spread = names.to_pylist(), raw.to_numpy(), spread.to_numpy()
    alone = Weights.of(names, raw / (1 + spread))
    long_ = np.array([len(f) > HEAD and f[HEAD:] != "*" for f in names])
    heads = np.where(long_, alone.find([f[:HEAD] + "*" for f in names])[0], 0.0)
    weights = Weights.of(names, (raw + heads * spread) / (1 + spread))
    if weights.values.max() <= gap:
        return flat_model
    return _calibrated(rows, weights, gap)


def _calibrated(rows: DataFrame, weights: Weights, gap: float) -> ToxicModel:
    """Decay, rate and logistic curve from a scan over all labelled documents."""
    held = rows.sparkSession.sparkContext.broadcast(vars(weights))
    step = 0.25  # scores are binned for the moment equation and the curve

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for batch in slices(batches, most=SLICE):
                texts = [_WORD.findall(t.lower()) for t in batch.column("text").to_pylist()]
                for scores, toxic in zip(token_scores(Weights(**held.value), gap, texts), batch.column("toxic").to_pylist(), strict=True):
                    hits, lost = scored_hits(scores)
                    yield "all", [("word", toxic, math.ceil(s / step)) for s in scores]
                    yield "all", [("segment", toxic, math.ceil(s / step)) for *_, s in maximal_segments(hits, gap, lost)]

        def emit(group) -> pa.RecordBatch:
            c = group["all"]
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in c]), pa.array([k[1] for k in c], pa.int32()), pa.array([k[2] for k in c], pa.int32()), pa.array(list(c.values()))], ["kind", "toxic", "bin", "n"])

        yield from counted(items(), emit)

    parts = rows.mapInArrow(scan, "kind string, toxic int, bin int, n long").groupBy("kind", "toxic", "bin").agg(F.sum("n").alias("n"))
    table = {(r.kind, r.bin): r.n for r in parts.filter("toxic = 0").collect()}
    words = sum(n for (kind, _), n in table.items() if kind == "word")
    decay = decay_of({b * step: n / max(words, 1) for (kind, b), n in table.items() if kind == "word"})
    least = 2.0  # the law holds for high scores; segments from here on tell its rate
    found = sum(n for (kind, b), n in table.items() if kind == "segment" and b * step >= least)
    rate = (found + 0.5) / (words + 1) * math.exp(min(decay * least, 500))
    model = ToxicModel(weights, gap, decay, rate, 0.0, 1.0)
    bins = rows.mapInArrow(_scan_with(rows, model, keep=["toxic"]), StructType.fromDDL("toxic int, toxic_evidence double, toxic_passages " + PASSAGES))
    bins = bins.groupBy("toxic", F.round(F.log1p("toxic_evidence"), 1).alias("x")).agg(F.count(F.lit(1)).alias("n")).collect()
    intercept, slope = fit_logistic([(r.x, r.toxic, r.n) for r in bins])
    return ToxicModel(weights, gap, decay, rate, intercept, slope)


def fit_logistic(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of a one-variable logistic curve over (x, class, count), by damped Newton steps; a small
    ridge keeps separable data finite, and the slope is not below zero."""
    a, b, ridge = 0.0, 0.0, 1e-2
    for _ in range(100):
        g0 = g1 = h00 = h01 = h11 = 0.0
        for x, y, n in points:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * x))))
            g0, g1 = g0 + n * (y - p), g1 + n * (y - p) * x
            w = n * p * (1 - p)
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        g0, g1, h00, h11 = g0 - ridge * a, g1 - ridge * b, h00 + ridge, h11 + ridge
        det = h00 * h11 - h01 * h01
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        size = max(abs(da), abs(db), 1.0)
        a, b = a + da / size, b + db / size
        if abs(da) + abs(db) < 1e-9:
            break
    return a, max(b, 0.0)


def _scan_with(frame: DataFrame, model: ToxicModel, keep: list[str], of: str = "text", most_expected: float = 0.05):
    held = frame.sparkSession.sparkContext.broadcast(vars(model) | {"weights": vars(model.weights)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicModel(**held.value | {"weights": Weights(**held.value["weights"])})
        for batch in slices(batches, of, SLICE):
            evidence, passages = [], []
            raw = batch.column(of).to_pylist()
            cut = [_WORD.findall(t.lower()) for t in raw]
            for text, words, scores in zip(raw, cut, token_scores(m.weights, m.gap, cut), strict=True):
                hits, lost = scored_hits(scores)
                found = [(f, l, s, m.rate * len(words) * math.exp(-m.decay * s)) for f, l, s in maximal_segments(hits, m.gap, lost)]
                evidence.append(sum(max(0.0, -math.log(max(e, 1e-300))) for *_, e in found))
                found = [x for x in found if x[3] <= most_expected]
                passages.append(_places(text, words, found) if found else [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(evidence, pa.float64()), pa.array(passages, _PASSAGES)],
                [*keep, "toxic_evidence", "toxic_passages"],
            )

    return run


_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))


def _places(text: str, words: list[str], found: list[tuple[int, int, float, float]]) -> list[dict]:
    """Segments in words as passages in characters of the text (start, and the place behind the end)."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if len(spans) != len(words):  # lower-casing a few letters changes where words are cut
        spans = [m.span() for m in _WORD.finditer(text.lower())]
    return [{"start": spans[f][0], "end": spans[l][1], "score": s, "expected": e} for f, l, s, e in found]


def score(docs: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """docs with toxic_score (probability, 0 to 1), toxic_evidence and toxic_passages: array of (start, end, score,
    expected) for each significant passage, in characters. Null and empty texts have no evidence and get the curve's
    lowest value. Columns of these names are replaced; all others pass unchanged.
    """
    names = [c for c in docs.columns if c not in ("toxic_score", "toxic_evidence", "toxic_passages")]
    of = unused("_text", names)
    base = docs.select(*(docs[f"`{c}`"] for c in names), docs[f"`{text}`"].alias(of))
    fields = base.schema.fields[:-1]
    scored = base.mapInArrow(_scan_with(docs, model, names, of), StructType([*fields, *StructType.fromDDL(f"toxic_evidence double, toxic_passages {PASSAGES}").fields]))
    x = F.lit(model.intercept) + F.lit(model.slope) * F.log1p("toxic_evidence")
    return scored.withColumn("toxic_score", 1 / (1 + F.exp(-x)))
