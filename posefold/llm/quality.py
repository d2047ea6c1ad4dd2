"""Quality classifier: Naive Bayes log-count ratios on n-gram indicators, then a linear hinge-loss model.

Indicators are words, and one to three successive word shapes (letter case, digits and punctuation,
a sign for a word that repeats the one before it). A run without white space of more than ``LONG_WORD``
characters is no word: all of its overlapping pairs of characters stand for it. The class log-count ratio of every indicator comes
from all labelled training rows. Indicators scaled by it feed a support vector machine that dual
coordinate descent fits on a bounded sample of the labelled rows; margins of held-back thirds of that
sample give the logistic that turns a margin into a score.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import filtered, slices, stage, text_or_empty

FEATURE_BITS = 18
LONG_WORD = 64
FIT_ROWS = 20_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 8
THRESHOLD = 0.3
FOLDS = 5
BROADCAST_LABELS = 500_000
MEMO_WORDS = 300_000
BLOCK_WORDS = 200_000
_SAME = np.uint64(zlib.crc32(b"="))
_RUNS = (("A", re.compile(r"A+")), ("a", re.compile(r"a+")), ("9", re.compile(r"9+")))
_memo: dict[str, int] = {}


def shape(word: str) -> str:
    """Letter case, digits and punctuation of a word, with runs cut short."""
    signs = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    for sign, run in _RUNS:
        signs = run.sub(lambda m: sign * min(2, len(m[0])) if sign == "A" else sign, signs)
    return re.sub(r"([^\w])\1+", r"\1\1", signs)


def words_of(text: str) -> list[str]:
    words = text.split()
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    out = []
    for word in words:
        if len(word) <= LONG_WORD:
            out.append(word)
        else:
            out += map("".join, zip(word, word[1:]))
    return out


def _codes(words: list[str]) -> np.ndarray:
    if len(_memo) > MEMO_WORDS:
        _memo.clear()
    for word in set(words).difference(_memo):
        _memo[word] = zlib.crc32(word.lower().encode()) << 32 | zlib.crc32(shape(word).encode())
    return np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))


def indicators(text: str, bits: int = FEATURE_BITS) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    words = words_of(text)
    if not words:
        return np.zeros(1, dtype=np.int64)
    found = []
    for at in range(0, len(words), BLOCK_WORDS):
        first = max(0, at - 3)  # two words that grams reach back to, and the one before these
        codes = _codes(words[first : at + BLOCK_WORDS])
        shapes = codes & np.uint64(0xFFFFFFFF)
        shapes[1:][codes[1:] == codes[:-1]] = _SAME
        if at:
            codes, shapes = codes[1:], shapes[1:]
        n = len(codes)
        grams = [codes >> np.uint64(32), shapes * np.uint64(3) + np.uint64(1)]
        for size, factor in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
            if n >= size:
                gram = np.zeros(n - size + 1, dtype=np.uint64)
                for i in range(size):
                    gram = gram * np.uint64(factor) + shapes[i : n - size + 1 + i]
                grams.append(gram)
        for kind, gram in enumerate(grams):
            mixed = (gram + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
            found.append(np.unique(mixed >> np.uint64(64 - bits)))
    return np.unique(np.concatenate(found)).astype(np.int64)


def log_count_ratio(good: np.ndarray, bad: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    p, q = good + smoothing, bad + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], signs: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights (already times ``ratio``) and bias of the hinge-loss model over scaled indicators."""
    weights, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    scaled = [ratio[row] for row in rows]
    squares = np.array([x @ x for x in scaled]) + 1.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ scaled[i] + bias) - 1.0
            after = min(max(alpha[i] - gradient / squares[i], 0.0), cost)
            if step := (after - alpha[i]) * signs[i]:
                weights[rows[i]] += step * scaled[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = after
        if moved < 1e-4:
            break
    return weights * ratio, bias


def logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """``(a, b)`` of ``1 / (1 + exp(-(a * margin + b)))``, by Newton steps on softened targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-6 * theta)
        theta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray) -> dict:
    signs = np.where(good, 1.0, -1.0)
    if not (good.any() and (~good).any()):
        return constant(float((good.sum() + 1) / (len(good) + 2)), len(ratio))
    margins = np.zeros(len(rows))
    thirds = np.arange(len(rows)) % 3
    for third in range(3):
        inside = np.flatnonzero(thirds != third)
        if not (good[inside].any() and (~good[inside]).any()):
            inside = np.arange(len(rows))
        w, b = dual_coordinate_descent([rows[i] for i in inside], signs[inside], ratio)
        for i in np.flatnonzero(thirds == third):
            margins[i] = w[rows[i]].sum() + b
    a, c = logistic(margins, good)
    weights, bias = dual_coordinate_descent(rows, signs, ratio)
    return {"weights": weights.astype(np.float32), "bias": bias, "a": max(a, 1e-3), "c": c}


def constant(score: float, features: int) -> dict:
    """The model where one class or none has labels."""
    return {"weights": np.zeros(features, np.float32), "bias": 0.0, "a": 1.0, "c": float(np.log(score / (1 - score)))}


def train(
    documents: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, bits: int, fit_rows: int
) -> dict:
    """The model, from labelled rows outside the held-out fold; a few megabytes, whatever the input."""
    known = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
        .where(F.crc32(F.col(id_column).cast("string")) % FOLDS != 0)
        .groupBy(F.col(id_column).alias("id"))
        .agg((F.avg(label_column) >= 0.5).alias("good"))
    )
    known = stage(known, "labels")
    if (n := known.limit(BROADCAST_LABELS + 1).count()) == 0:
        return constant(0.5, 1 << bits)
    if n <= BROADCAST_LABELS:
        known = F.broadcast(known)  # an id and a flag each, counted
    rows = documents.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("body")).join(known, "id")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << bits), dtype=np.int64)
        for batch in slices(batches):
            for text, good in zip(batch.column("body").to_pylist(), batch.column("good").to_pylist()):
                total[int(good), indicators(text, bits)] += 1
        seen = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[0, seen]), pa.array(total[1, seen])], ["feature", "bad", "good"])

    summed = rows.select("body", "good").mapInArrow(counts, "feature bigint, bad bigint, good bigint")
    table = summed.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()  # 2 ** bits lines at most
    bad, good = np.zeros(1 << bits), np.zeros(1 << bits)
    bad[table.feature], good[table.feature] = table.bad, table.good
    ratio = log_count_ratio(good, bad)

    # The sample: the rows whose hashes are smallest, so many that a task can hold their features.
    sample = known.select("id", F.xxhash64("id", F.lit("fit")).alias("draw")).orderBy("draw", "id").limit(fit_rows)
    chosen = rows.join(F.broadcast(sample.select("id")), "id", "left_semi")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [indicators(t, bits) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("good"), pa.array([f.astype("<u4").tobytes() for f in found], pa.binary())],
                ["id", "good", "features"],
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, flags = [], []
        for batch in batches:
            held += [np.frombuffer(f, "<u4").astype(np.int64) for f in batch.column("features").to_pylist()]
            flags += batch.column("good").to_pylist()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(held, np.array(flags, dtype=bool), ratio))])], ["model"])

    id_type = rows.schema["id"].dataType.simpleString()
    sampled = chosen.mapInArrow(features, f"id {id_type}, good boolean, features binary")
    model = (
        sampled.repartition(1)
        .sortWithinPartitions(F.xxhash64("id"), "features")
        .select("good", "features")
        .mapInArrow(fitted, "model binary")
        .first()
    )
    return pickle.loads(model["model"]) if model else constant(0.5, 1 << bits)


def scores_of(texts: list[str], model: dict, bits: int = FEATURE_BITS) -> np.ndarray:
    margins = np.array([model["weights"][indicators(t, bits)].sum() for t in texts], dtype=float)
    return 1 / (1 + np.exp(-np.clip(model["a"] * (margins + model["bias"]) + model["c"], -35, 35)))


def accepted(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", threshold: float = THRESHOLD, bits: int = FEATURE_BITS, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The rows, with all their columns, that ``classify`` predicts 1 for."""
    model = documents.sparkSession.sparkContext.broadcast(
        train(documents, labels, id_column, text_column, label_column, bits, fit_rows)
    )
    return filtered(documents, text_column, lambda texts: scores_of(texts, model.value, bits) >= threshold)


def classify(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    threshold: float = THRESHOLD,
    bits: int = FEATURE_BITS,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per document: ``id, held_out, score, predicted``.

    Rows whose ``crc32(id as text) mod 5`` is 0 are held out: their labels are never looked at. Scores
    see the text alone. A null text counts as empty and is scored like any other; null ids are scored,
    held out and never train; a label that is null is none, labels that repeat an id are averaged. With
    labels of one class or none every score is a constant. An empty table gives no rows. Other columns
    are not looked at, whatever their names. ``fit_rows`` bounds the rows the hinge-loss model is fitted on;
    the log-count ratios come from all labelled rows of the other folds.
    """
    model = documents.sparkSession.sparkContext.broadcast(
        train(documents, labels, id_column, text_column, label_column, bits, fit_rows)
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = scores_of(batch.column("body").to_pylist(), model.value, bits)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    rows = documents.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("body"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {id_type}, score double").select(
        F.col("id").alias(id_column),
        (F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % FOLDS == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
