"""Toxicity as cumulative-link ordinal regression.

Severity has grades 0 < 1 < ... < m. One weight for each word is shared by all thresholds:

    P(grade >= k) = 1 / (1 + exp(-(w . x - t_k))),  t_1 <= ... <= t_m

where x are indicators of a text's words (lower case, without signs at their ends) and of their
first five letters, hashed. The expected severity is the sum of these chances. Weights have an L1 penalty, so that words that say
nothing weigh nothing however long a text is; the fit is accelerated proximal gradient descent.

Where labels only say toxic or not, ``severity_grades`` grades the toxic rows by how many
different cues they hold, in thirds; cues are words far more frequent in toxic rows than in others.

The fit sees a sample of labelled rows bounded by ``sample_rows``; every text is scored, whole. Without labelled
rows, or with one grade only, the chances are the smoothed shares. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.llm.common import col, id_type, labelled_sample, slices, text_of

PLACES = 1 << 20
SAMPLE_ROWS = 8_000
LEAST_ROWS = 4
PENALTY = 3e-4
STEPS = 120
CUE_ODDS, CUE_ROWS = 2.0, 5
REJECT_AT = 0.4
BEGINNING = 5
CACHED_WORDS = 400_000
SLICE_BYTES = 2 << 20
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[]^_{|}~"


class WordPlaces(dict):
    """Word to its place and its beginning's, as one number; forgets when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        plain = word.lower().strip(SIGNS)
        places = (xxhash.xxh32_intdigest(plain) % PLACES, xxhash.xxh32_intdigest(plain[:BEGINNING], 1) % PLACES)
        out = self[word] = places[0] * PLACES + places[1]
        return out


PLACES_OF = WordPlaces()


def features(text: str) -> np.ndarray:
    """The places of a text's words and their beginnings, ascending."""
    words = text.split()
    both = np.fromiter(map(PLACES_OF.__getitem__, words), dtype=np.int64, count=len(words))
    return np.unique(np.concatenate([both // PLACES, both % PLACES])).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # by place
    thresholds: np.ndarray


def counted(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(PLACES, dtype=np.int64)
    for row in rows:
        out[row] += 1
    return out


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """0 for rows that aren't toxic, else 1 to 3 by the number of cues."""
    grades = (toxic > 0).astype(int)
    n_toxic = int(grades.sum())
    if not n_toxic:
        return grades
    with_word = counted([r for r, g in zip(rows, grades, strict=True) if g])
    without = counted([r for r, g in zip(rows, grades, strict=True) if not g])
    odds = np.log((with_word + 0.5) / (n_toxic + 1)) - np.log((without + 0.5) / (len(rows) - n_toxic + 1))
    cue = (odds > CUE_ODDS) & (with_word >= CUE_ROWS)
    n_cues = np.array([cue[r].sum() for r in rows])
    bounds = np.quantile(n_cues[grades > 0], [1 / 3, 2 / 3])
    return np.where(grades > 0, 1 + (n_cues[:, None] > bounds).sum(axis=1), 0)


def fit(rows: list[np.ndarray], grades: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> Model:
    n, top = len(rows), int(grades.max(initial=1))
    above = grades[:, None] >= np.arange(1, top + 1)
    share = (above.sum(axis=0) + 0.5) / (n + 1.0)
    model = Model(np.zeros(PLACES), np.log((1 - share) / share))
    if n == 0 or grades.min() == grades.max():
        return model
    frequent = counted(rows) >= LEAST_ROWS
    used = np.flatnonzero(frequent)
    number = (np.cumsum(frequent) - 1).astype(np.int32)
    places = [number[r[frequent[r]]] for r in rows]
    row = np.repeat(np.arange(n, dtype=np.int32), [len(p) for p in places])
    column = np.concatenate(places)
    del places
    target = above.astype(float)
    # Proximal gradient with momentum; the step halves until the smooth part is below its bound.
    w = z = np.zeros(len(used))
    t = s = model.thresholds.copy()
    momentum, step = 1.0, 4.0

    def loss(w: np.ndarray, t: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(row, weights=w[column], minlength=n)[:, None] - t
        return float((np.logaddexp(0, margin) - target * margin).sum() / n), margin

    for _ in range(steps):
        value, margin = loss(z, s)
        off = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target) / n
        gw, gt = np.bincount(column, weights=off.sum(axis=1)[row], minlength=len(used)), -off.sum(axis=0)
        while True:
            new_w = z - step * gw
            new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
            new_t = np.maximum.accumulate(s - step * gt)
            dw, dt = new_w - z, new_t - s
            bound = value + gw @ dw + gt @ dt + (dw @ dw + dt @ dt) / (2 * step)
            if loss(new_w, new_t)[0] <= bound + 1e-12 or step < 1e-6:
                break
            step /= 2
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z, s = new_w + (momentum - 1) / grown * (new_w - w), new_t + (momentum - 1) / grown * (new_t - t)
        w, t, momentum, step = new_w, new_t, grown, step * 1.1
    model.weights[used] = w
    model.thresholds = t
    return model


def chances(model: Model, row: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k from 1."""
    return 1 / (1 + np.exp(-np.clip(model.weights[row].sum() - model.thresholds, -500, 500)))


def learn(
    docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, sample_rows: int, graded: bool
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
    own = [np.frombuffer(r, dtype=np.int32) for _, _, r in found]
    labels_of = np.array([max(c, 0) for _, c, _ in found], dtype=int)
    return fit(own, labels_of if graded else severity_grades(own, labels_of))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, keep: list[str] | None = None, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic", graded: bool = False, sample_rows: int = SAMPLE_ROWS,
    reject_at: float = REJECT_AT, learn_from: DataFrame | None = None, teach: Column | None = None,
    result: str = "toxicity",
) -> DataFrame:
    """The columns ``keep`` (the id alone) of every document and ``result``: a struct of the
    expected ``severity``, the likeliest ``grade``, the ``chance`` of grade 1 or more, and ``rejected``.

    ``graded`` says that labels are grades rather than yes or no; ``teach`` which of their rows may
    be learned from; ``learn_from`` holds the texts of labelled documents (``docs``).
    """
    model = learn(
        docs if learn_from is None else learn_from, labels if teach is None else labels.where(teach),
        id_col=id_col, text_col=text_col, label_col=label_col, sample_rows=sample_rows, graded=graded,
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = keep or [id_col]
    rows = docs.select(*[col(c).alias(f"c{k}") for k, c in enumerate(names)], text_of(text_col).alias("scored"))
    fields = [("severity", T.DoubleType()), ("grade", T.IntegerType()), ("chance", T.DoubleType()), ("rejected", T.BooleanType())]
    schema = T.StructType(
        [*(T.StructField(c, id_type(docs, c)) for c in names),
         T.StructField(result, T.StructType([T.StructField(n, t) for n, t in fields]))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch, "scored", SLICE_BYTES):
                p = np.array([chances(model, features(t)) for t in part.column("scored").to_pylist()])
                p = p.reshape(len(part), len(model.thresholds))
                exactly = -np.diff(np.hstack([np.ones((len(p), 1)), p, np.zeros((len(p), 1))]), axis=1)
                made = [
                    pa.array(p.sum(axis=1)), pa.array(exactly.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0]),
                    pa.array(p[:, 0] >= reject_at),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(names))),
                     pa.StructArray.from_arrays(made, names=[n for n, _ in fields])],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
