"""Toxicity as ordinal severity: cumulative-link regression on sparse word features.

Severity grades come from the labels: 0 not toxic, 1 toxic, 2 toxic and of low quality. The
chance of a grade up to k is logistic(threshold[k] - score); the score is the sum of the weights of
the distinct words of a text, shared by all thresholds, which stay in order. The weights are
found by accelerated proximal steps with an absolute-value penalty, so that only words
that carry the grade keep a weight. The result is the expected severity.

Fit on a bounded sample: at most ``sample`` labelled rows, chosen by a hash of their id, and words in
``min_docs`` (or a thousandth) to half of them. Everything else covers all rows and whole texts. Words
are runs of letters in lower case.

A null or empty text has score 0. Labels that contradict each other for one id count with the
highest grade; null labels do not count. Without any toxic label, or any clean one, the model has no
weights and calls nothing toxic. Repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import fresh
from lumenfold.plans.stage import stage

SAMPLE = 20_000
MIN_DOCS = 5
# The weight of the penalty is PENALTY / sqrt(rows): noise shrinks with the sample, so it may too.
PENALTY = 0.028
STEPS = 250
GRADES = 3
# The limit of severity is chosen on rows that the model judging them has not seen: FOLDS fits, each without a part of the
# sample. It makes recall - ALARM_WEIGHT * (share of clean texts at or above it) as large as possible. Without toxic or clean
# rows it is DEFAULT_LIMIT.
FOLDS, ALARM_WEIGHT, DEFAULT_LIMIT = 3, 4.0, 0.5
WORDS = re.compile(r"[^\W\d_]+")
STEM = 6


def features(text: str | None) -> set[str]:
    """The distinct words of a text, and the first letters of those longer than ``STEM``, marked."""
    words = set(WORDS.findall((text or "").lower()))
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]
    limit: float = DEFAULT_LIMIT

    def score(self, text: str | None) -> float:
        return sum(map(self.weights.__getitem__, self.weights.keys() & features(text)))

    def expected(self, score: np.ndarray) -> np.ndarray:
        """The sum over k of the chance of a grade above k."""
        return sum(1 - logistic(t - score) for t in self.thresholds)


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def grade(toxic: Column, quality: Column) -> Column:
    return F.when(toxic == 0, 0).when(toxic == 1, F.when(quality == 0, 2).otherwise(1))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, grade) of about ``sample`` labelled rows at most.

    The labels are cut first, so the join broadcasts them. Where ids repeat among the
    documents, the joined rows are cut once more.
    """
    graded = labels.select("doc_id", grade(F.col("toxic"), F.col("quality")).alias("grade")).where(
        F.col("grade").isNotNull() & F.col("doc_id").isNotNull()
    )
    one = graded.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    n = one.count()
    share = int(min(1.0, sample / max(n, 1)) * (1 << 30))
    chosen = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share).limit(sample)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "grade")
    rows = stage(joined.withColumn("row", F.monotonically_increasing_id()), "labelled")
    more = int(min(1.0, sample / max(rows.count(), 1)) * (1 << 30))
    return rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) <= more).drop("row")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, min_docs: int = MIN_DOCS, penalty: float = PENALTY) -> Model:
    """A model from the labelled rows of ``docs``. The driver sees word numbers of the sample."""
    rows = labelled_sample(docs, labels, sample)
    n = rows.count()

    @F.arrow_udf("array<string>")
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array([list(features(t.as_py())) for t in texts], pa.list_(pa.string()))

    text, least = F.col("text").cast("string"), max(min_docs, n // 1000)
    counts = rows.select(F.explode(distinct(text)).alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    known = counts.where((F.col("docs") >= least) & (F.col("docs") <= max(n // 2, least))).select("word").toArrow()
    words = sorted(known.column("word").to_pylist())
    number = {w: i for i, w in enumerate(words)}

    @F.arrow_udf("array<int>")
    def numbered(texts: pa.Array) -> pa.Array:
        return pa.array([[number[w] for w in features(t.as_py()) if w in number] for t in texts], pa.list_(pa.int32()))

    fold = F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(FOLDS)).cast("int")
    found = rows.select("grade", fold.alias("fold"), numbered(text).alias("ids")).toArrow().combine_chunks()
    y, folds, ids = found.column("grade").to_numpy(), found.column("fold").to_numpy(), found.column("ids").combine_chunks()
    if not len(y) or y.min() > 0 or y.max() < 1:
        return Model({}, tuple([np.inf] * (GRADES - 1)))
    offsets, col = ids.offsets.to_numpy(), ids.values.to_numpy()
    offsets, col = offsets - offsets[0], col[offsets[0] : offsets[-1]]
    weights, thresholds = ordinal_fit(offsets, col, y, len(words), penalty / np.sqrt(len(y)))
    model = Model({w: float(v) for w, v in zip(words, weights, strict=True) if v}, tuple(map(float, thresholds)))
    return replace(model, limit=best_limit(unseen_severity(offsets, col, y, folds, len(words), penalty), y > 0))


def unseen_severity(offsets: np.ndarray, col: np.ndarray, y: np.ndarray, folds: np.ndarray, width: int, penalty: float) -> np.ndarray:
    """The severity of every row by a model fitted to the rows of the other folds; NaN if those have one grade only."""
    severity = np.full(len(y), np.nan)
    of_row = np.repeat(folds, np.diff(offsets))
    for f in range(FOLDS):
        rest, mine = folds != f, folds == f
        if not mine.any() or not rest.any() or y[rest].min() > 0 or y[rest].max() < 1:
            continue
        starts = np.concatenate([[0], np.cumsum(np.diff(offsets)[rest])])
        weights, thresholds = ordinal_fit(starts, col[of_row != f], y[rest], width, penalty / np.sqrt(rest.sum()))
        scores = segment_sums(weights[col], offsets)[mine]
        severity[mine] = Model({}, tuple(map(float, thresholds))).expected(scores)
    return severity


def best_limit(severity: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the best range of limits for unseen rows."""
    seen = ~np.isnan(severity)
    high, low = np.sort(severity[seen & toxic]), np.sort(severity[seen & ~toxic])
    if not len(high) or not len(low):
        return DEFAULT_LIMIT
    limits = np.unique(np.concatenate([high, low, [low[-1] + 1e-6]]))
    recall = 1 - np.searchsorted(high, limits) / len(high)
    alarms = 1 - np.searchsorted(low, limits) / len(low)
    best = int(np.argmax(recall - ALARM_WEIGHT * alarms))
    below = limits[best - 1] if best else limits[best]
    return float((limits[best] + below) / 2)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of neighbouring values; a segment without values has sum 0."""
    out, filled = np.zeros(len(offsets) - 1), np.diff(offsets) > 0
    if filled.any():
        out[filled] = np.add.reduceat(values, offsets[:-1][filled])
    return out


def ordinal_fit(offsets: np.ndarray, col: np.ndarray, y: np.ndarray, width: int, penalty: float, steps: int = STEPS) -> tuple:
    """(weights, thresholds) by accelerated proximal gradient on presence features, row after row in ``col``."""
    n, cuts = len(y), GRADES - 1
    offsets = offsets - offsets[0]
    by_col = np.argsort(col, kind="stable")
    row_by_col = np.repeat(np.arange(n), np.diff(offsets))[by_col]
    col_offsets = np.concatenate([[0], np.cumsum(np.bincount(col, minlength=width))])
    share = np.array([(y <= k).mean() for k in range(cuts)]).clip(1e-3, 1 - 1e-3)
    w, t = np.zeros(width), np.log(share / (1 - share)) + 1e-3 * np.arange(cuts)
    times = lambda v: segment_sums(v[col], offsets)
    back = lambda g: segment_sums(g[row_by_col], col_offsets)
    v = np.ones(width)
    for _ in range(20):
        v = back(times(v)) / n
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.25 * (np.linalg.norm(back(times(v)) / n) + cuts + 1))
    w0, t0, wm, tm, momentum = w, t, w, t, 1.0
    for _ in range(steps):
        bounds = np.concatenate([[-np.inf], tm, [np.inf]])
        score = times(wm)
        hi, lo = logistic(bounds[y + 1] - score), logistic(bounds[y] - score)
        chance = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / chance, lo * (1 - lo) / chance
        gw = back(dhi - dlo) / n
        gt = np.array([dlo[y == k + 1].sum() - dhi[y == k].sum() for k in range(cuts)]) / n
        w = wm - step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        t = np.maximum.accumulate(tm - step * gt + 1e-6 * np.arange(cuts))
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        wm, tm = w + (momentum - 1) / after * (w - w0), np.maximum.accumulate(t + (momentum - 1) / after * (t - t0))
        tm = tm + 1e-6 * np.arange(cuts)
        w0, t0, momentum = w, t, after
    return w, t


def with_severity(docs: DataFrame, model: Model, into: str) -> DataFrame:
    """``docs`` with the expected severity of every whole text."""

    @F.arrow_udf("double")
    def severity(texts: pa.Array) -> pa.Array:
        return pa.array(model.expected(np.array([model.score(t.as_py()) for t in texts], float)), pa.float64())

    return docs.withColumn(into, severity(F.col("text").cast("string")))


def assess(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, limit: float | None = None) -> DataFrame:
    """Per document row: doc_id, severity (0 to 2), toxic (severity at or above ``limit``, by default the model's)."""
    model = fit(docs, labels, sample)
    least = model.limit if limit is None else limit
    scored = with_severity(docs.select("doc_id", "text"), model, "severity")
    return scored.select("doc_id", F.round("severity", 6).alias("severity"), (F.col("severity") >= least).alias("toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, limit: float | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose expected severity is below ``limit``, by default the model's."""
    model, severity = fit(docs, labels, sample), fresh(docs, "severity")
    least = model.limit if limit is None else limit
    return with_severity(docs, model, severity).where(F.col(severity) < least).drop(severity)
