"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: one to three neighbouring word shapes, and lower-case words. A word's
shape is what remains of it once letter runs become A, a or Aa, digits 0, and repeated signs two;
a word equal to the one before it gets a shape of its own, so does the start of a line that the text has
had before. Each indicator is scaled by the log-ratio of its smoothed counts in both classes,
and a linear hinge-loss model (squared, with bias) is fitted to the scaled rows by dual
coordinate descent. A logistic curve through the margins of rows held back from the fit gives scores.

The fit sees a sample of labelled rows bounded by ``sample_rows``, features hashed to 2**18 places, so what
reaches the driver is bounded; every text is scored, whole. With one class or none the score is a
constant: the smoothed share of good labels (a half without any). Null texts are empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.llm.common import GOLDEN, M1, col, id_type, labelled_sample, slices, text_of

PLACES = 1 << 18
SAMPLE_ROWS = 12_000
EPOCHS = 12
COST = 1.0
SMOOTHING = 1.0
CACHED_WORDS = 400_000
SLICE_BYTES = 2 << 20

LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"\d+")
REPEATED = re.compile(r"([^\w\s])\1+")


def letter_class(run: str) -> str:
    return "a" if run.islower() or len(run) == 1 else "A" if run.isupper() else "Aa"


def shape(word: str) -> str:
    # Most words are letters and perhaps one sign: the same answer without patterns.
    if word.isalpha():
        return letter_class(word)
    if word[-1] in ".,!?;:" and word[:-1].isalpha():
        return letter_class(word[:-1]) + word[-1]
    signs = LETTERS.sub(lambda run: letter_class(run.group()), word)
    return REPEATED.sub(r"\1\1", DIGITS.sub("0", signs))


class Codes(dict):
    """Word to 20 bits of its shape before the place of the word; forgets when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        plain = word.lower().strip(SIGNS)
        out = (xxhash.xxh32_intdigest(shape(word)) >> 12) * PLACES + xxhash.xxh32_intdigest(plain, 1) % PLACES
        self[word] = out
        return out


SIGNS = "!\"#$%&'()*+,-./:;<=>?@[]^_{|}~"
CODE_OF = Codes()
SAME_AGAIN, LINE_AGAIN = 1 << 20, 1 << 21


def features(text: str) -> np.ndarray:
    """The places of a text's n-grams, ascending."""
    words = text.split()
    code = np.fromiter(map(CODE_OF.__getitem__, words), dtype=np.int64, count=len(words))
    one = code // PLACES
    one[1:] += SAME_AGAIN * np.fromiter(map(str.__eq__, words, words[1:]), dtype=bool, count=max(len(words) - 1, 0))
    lines = text.split("\n")
    if len(set(lines)) < len(lines):
        at, places, seen = 0, [], set()
        for line in lines:
            if line and line in seen:
                places.append(at)
            seen.add(line)
            at += len(line.split())
        one = np.insert(one, places, LINE_AGAIN)
    one = one.astype(np.uint64)
    grams = [one]
    for n in (2, 3):
        if len(one) >= n:
            gram = one[: len(one) - n + 1].copy()
            for k in range(1, n):
                gram = gram * GOLDEN + one[k : len(one) - n + 1 + k]
            grams.append(gram + np.uint64(n))
    taken = [((g * M1) >> np.uint64(46)).astype(np.int64) for g in grams]
    flags = np.zeros(PLACES, dtype=bool)
    for places in (*taken, code % PLACES):
        flags[places] = True
    return np.flatnonzero(flags).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, epochs: int, cost: float) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for a squared hinge loss over rows of unit length.

    One dual variable for each row; a step solves for it alone, keeping the primal weights up to date.
    """
    weights, bias = np.zeros(len(ratio)), 0.0
    values = [ratio[r] / max(np.linalg.norm(ratio[r]), 1e-12) for r in rows]
    share = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y <= 0).sum(), 1)))
    slack = 1 / (2 * cost * share)
    diagonal = np.array([v @ v + 1.0 for v in values]) + slack
    dual = np.zeros(len(rows))
    dice = np.random.default_rng(7)
    for _ in range(epochs):
        for k in dice.permutation(len(rows)):
            row, value = rows[k], values[k]
            gradient = y[k] * (weights[row] @ value + bias) - 1 + slack[k] * dual[k]
            new = max(dual[k] - gradient / diagonal[k], 0.0)
            if step := (new - dual[k]) * y[k]:
                weights[row] += step * value
                bias += step
                dual[k] = new
    return weights, bias


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small penalty."""
    a = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ x, -30, 30)))
        gradient = x @ (p - y) + 1e-2 * (a - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-2 * np.eye(2), gradient)
        a -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a[0], 1e-3)), float(a[1])


def fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    y = np.where(good > 0, 1.0, -1.0)
    n_good, n = int((y > 0).sum()), len(y)
    if n_good in (0, n):
        share = (n_good + 0.5) / (n + 1.0)
        return Model(np.zeros(PLACES), 0.0, 1.0, float(np.log(share / (1 - share))))

    def counts(of: np.ndarray) -> np.ndarray:
        chosen = [r for r, c in zip(rows, of, strict=True) if c]
        total = SMOOTHING + np.bincount(np.concatenate(chosen), minlength=PLACES)
        return total / total.sum()

    ratio = np.log(counts(y > 0) / counts(y < 0))

    def train(chosen: np.ndarray) -> tuple[np.ndarray, float]:
        return descend([rows[k] for k in chosen], y[chosen], ratio, EPOCHS, COST)

    def margin(weights: np.ndarray, bias: float, row: np.ndarray) -> float:
        value = ratio[row]
        return float(weights[row] @ value / max(np.linalg.norm(value), 1e-12) + bias)

    fold = np.arange(n) % 3
    held = np.zeros(n)
    for f in range(3):
        weights, bias = train(np.flatnonzero(fold != f))
        for k in np.flatnonzero(fold == f):
            held[k] = margin(weights, bias, rows[k])
    slope, shift = logistic(held, (y > 0).astype(float))
    weights, bias = train(np.arange(n))
    return Model(np.stack([weights, ratio]), bias, slope, shift)


def probability(model: Model, row: np.ndarray) -> float:
    """Of a good label."""
    if model.weights.ndim == 1:
        margin = 0.0
    else:
        value = model.weights[1][row]
        margin = model.weights[0][row] @ value / max(np.linalg.norm(value), 1e-12) + model.bias
    return float(1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -500, 500))))


def learn(
    docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, sample_rows: int
) -> Model:
    sample = labelled_sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, bound=sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label"), pa.array(rows, pa.binary())],
                names=["id", "label", "row"],
            )

    # Rows that share an id count once; the order of the fit is that of the rows.
    rows = sample.mapInArrow(run, "id string, label int, row binary").groupBy("id").agg(
        F.max("label").alias("label"), F.min("row").alias("row")
    )
    found = sorted((r["id"], r["label"], bytes(r["row"])) for r in rows.collect())
    return fit([np.frombuffer(r, dtype=np.int32) for _, _, r in found], np.array([c for _, c, _ in found]))


def score_quality(
    docs: DataFrame, labels: DataFrame, *, keep: list[str] | None = None, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality", teach: Column | None = None, sample_rows: int = SAMPLE_ROWS,
    learn_from: DataFrame | None = None, result: str = "score",
) -> DataFrame:
    """The columns ``keep`` (the id alone) of every document and ``result``, the chance of label 1.

    ``teach`` says which rows of ``labels`` may be learned from; ``learn_from`` holds their texts (``docs``).
    """
    usable = labels if teach is None else labels.where(teach)
    model = learn(
        docs if learn_from is None else learn_from, usable,
        id_col=id_col, text_col=text_col, label_col=label_col, sample_rows=sample_rows,
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = keep or [id_col]
    rows = docs.select(*[col(c).alias(f"c{k}") for k, c in enumerate(names)], text_of(text_col).alias("scored"))
    schema = T.StructType(
        [*(T.StructField(c, id_type(docs, c)) for c in names), T.StructField(result, T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch, "scored", SLICE_BYTES):
                scores = [probability(model, features(t)) for t in part.column("scored").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(names))), pa.array(scores, pa.float64())],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
