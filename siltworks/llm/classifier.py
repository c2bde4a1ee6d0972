"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's score is a weighted sum of hashed words (logarithm of their count) and of a few shares that describe
its form; the weights are shared by all grades.  P(grade <= k) = sigmoid(threshold_k - score) with thresholds in
order.  The score gives the expected grade and the tail probability P(grade >= g) by which documents are selected.

The model is fitted on the driver, on at most ``sample`` labelled rows chosen by a seeded hash; every document is
scored where it is read, with nothing shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released
from .textops import Chunk, chunks

BITS = 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(x) for x in "!#$%&*+/<=>@[\\]^_{|}~"]] = True
FORM = ("upper_words", "marked_words", "repeated_words", "letter_share", "word_length", "mean_distinct", "log_words", "bias")


def _share(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    n = np.diff(bounds)
    return (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(n, 1)


def features(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, hashed word, value) of the words that differ, and the documents' form (one row each)."""
    raw = c.data
    letters, count = np.concatenate([[0], np.cumsum(_ALPHA[raw])]), c.ends - c.starts
    upper, marks = np.concatenate([[0], np.cumsum(_UPPER[raw])]), np.concatenate([[0], np.cumsum(_MARK[raw])])
    within = lambda t: t[c.ends] - t[c.starts]
    few = within(letters)
    lower = Chunk(c.first, c.size, _LOWER[raw], c.offsets, c.starts, c.ends, c.bounds)
    # words without the marks and stops around them: cut at the first and after the last letter
    at = np.flatnonzero(_ALPHA[raw])
    if len(at):
        left = at[np.minimum(np.searchsorted(at, c.starts), len(at) - 1)]
        right = at[np.maximum(np.searchsorted(at, c.ends) - 1, 0)] + 1
        has = few > 0
        lower.starts, lower.ends = np.where(has, left, c.starts), np.where(has, right, c.ends)
    h = lower.hashes()
    doc = c.doc_of_word()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    key, n = np.unique((doc.astype(np.int64) << BITS) | (h >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    words = np.diff(c.bounds)
    kinds = np.bincount(key >> BITS, minlength=c.size)
    form = np.stack([
        *(np.minimum(_share(x, c.bounds) * 4, 1) for x in ((within(upper) == few) & (few > 1), within(marks) > 0, same)), _share(_ALPHA[raw], c.offsets),
        np.minimum(_share(count, c.bounds) / 10, 3), kinds / np.maximum(np.sqrt(words), 1) / 10, np.log1p(words) / 5, np.ones(c.size),
    ], axis=1)
    return key >> BITS, key & ((1 << BITS) - 1), np.log1p(n), form


@dataclass
class Model:
    """weights of hashed words and of the form, and ordered thresholds; no thresholds: nothing was learnt."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    form: np.ndarray = field(default_factory=lambda: np.zeros(len(FORM)))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, doc: np.ndarray, word: np.ndarray, value: np.ndarray, form: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=self.weights[word] * value, minlength=len(form)) + form @ self.form

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K, one row a document."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def fit(doc: np.ndarray, word: np.ndarray, value: np.ndarray, form: np.ndarray, grade: np.ndarray, grades: int, steps: int = 400, rate: float = 0.05, l2: float = 0.3, least: int = 3) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam over all rows.

    Words in fewer than ``least`` rows, or whose rows' grades are no further from the mean than chance has it (1.5
    standard errors), get no weight.
    """
    if not len(grade):
        return Model()
    seen = np.bincount(word, minlength=1 << BITS)
    lift = np.bincount(word, weights=(grade - grade.mean())[doc], minlength=1 << BITS) / np.sqrt(np.maximum(seen, 1) * max(grade.var(), 1e-9))
    used = np.flatnonzero((seen >= least) & (np.abs(lift) >= 1.5))
    slot = np.full(1 << BITS, -1)
    slot[used] = np.arange(len(used))
    ok = slot[word] >= 0
    doc, col = doc[ok], slot[word[ok]]
    pull = np.minimum(np.abs(lift[used]) / 3, 3)  # a word that goes with the grades by itself is penalised less
    value = value[ok] * pull[col]
    n = len(grade)
    share = np.array([(grade >= k).mean() for k in range(1, grades)]).clip(0.5 / (n + 1), 1 - 0.5 / (n + 1))
    first = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(first), 1e-2))
    x = np.concatenate([np.zeros(len(used) + form.shape[1]), first[:1], gaps])
    m, v = np.zeros_like(x), np.zeros_like(x)
    w, f = len(used), len(used) + form.shape[1]
    penalty = np.concatenate([np.full(w, l2), np.full(f - w, l2 / 10)])
    mean, low, high = form.mean(axis=0), grade, grade + 1
    form_c = form - mean
    for t in range(1, steps + 1):
        th = np.concatenate([[-np.inf], x[f] + np.concatenate([[0], np.cumsum(np.exp(x[f + 1 :]))]), [np.inf]])
        s = np.bincount(doc, weights=x[col] * value, minlength=n) + form_c @ x[w:f]
        a, b = 1 / (1 + np.exp(np.clip(s - th[low], -50, 50))), 1 / (1 + np.exp(np.clip(s - th[high], -50, 50)))
        p = np.maximum(b - a, 1e-9)
        da, db = a * (1 - a), b * (1 - b)
        ds = (db - da) / p  # of the negative log likelihood, to the score
        dth = np.zeros(grades + 1)
        np.add.at(dth, low, da / p)
        np.add.at(dth, high, -db / p)
        inner = dth[1:-1]
        g = np.concatenate([np.bincount(col, weights=ds[doc] * value, minlength=w), ds @ form_c, [inner.sum()], [inner[k:].sum() * np.exp(x[f + k]) for k in range(1, grades - 1)]])
        g[:f] += penalty * x[:f]
        g /= n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = x[:w] * pull
    thresholds = x[f] + np.concatenate([[0], np.cumsum(np.exp(x[f + 1 :]))]) + mean @ x[w:f]
    return Model(weights, x[w:f], thresholds)


def graded(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 toxic, 1 of low quality, 2 of good quality; null where the labels do not say."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)


def labelled_features(docs: DataFrame, labels: DataFrame, sample: int, seed: int) -> tuple[np.ndarray, ...]:
    """Features and grades of at most ``sample`` rows of labels (doc_id, grade) that have a document."""
    chosen = labels.where("grade is not null and doc_id is not null").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "grade").limit(sample)
    chosen = chosen.groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grade = batch.column("grade").to_numpy()
            for c in chunks(batch.column("text")):
                doc, word, value, form = features(c)
                edge = np.searchsorted(doc, np.arange(c.size + 1))
                words = [word[edge[i] : edge[i + 1]].astype(np.int32).tobytes() for i in range(c.size)]
                values = [value[edge[i] : edge[i + 1]].astype(np.float32).tobytes() for i in range(c.size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grade[c.first : c.first + c.size].astype(np.int32)), pa.array(words, pa.binary()), pa.array(values, pa.binary()), pa.array([x.tobytes() for x in form], pa.binary())],
                    names=["grade", "word", "value", "form"],
                )

    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # an id that rows repeat gives one of them, folded before the shuffle, so that no more than sample rows arrive
    one = F.min(F.struct(F.xxhash64("text").alias("place"), "text", "grade")).alias("one")
    joined = joined.groupBy("doc_id").agg(one).select("one.text", "one.grade")
    rows = joined.mapInArrow(released(run), "grade int, word binary, value binary, form binary").toArrow()
    if not rows.num_rows:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0), np.zeros((0, len(FORM))), none
    order = np.lexsort(([x.as_py() for x in rows.column("form")], rows.column("grade").to_numpy()))  # the same sums whatever order rows arrive in
    rows = rows.take(pa.array(order))
    word = [np.frombuffer(x.as_buffer(), np.int32) for x in rows.column("word")]
    value = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in rows.column("value")]).astype(np.float64)
    form = np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in rows.column("form")])
    return np.repeat(np.arange(len(word)), [len(x) for x in word]), np.concatenate(word).astype(np.int64), value, form, rows.column("grade").to_numpy().astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, grades: int = 3, sample: int = 6000, seed: int = 11) -> Model:
    """labels (doc_id, grade in 0 .. grades - 1); at most ``sample`` rows are used, whatever the size of the tables."""
    doc, word, value, form, grade = labelled_features(docs, labels, sample, seed)
    keep = (grade >= 0) & (grade < grades)
    if not keep.all():
        at = np.flatnonzero(keep)
        new = np.full(len(grade), -1)
        new[at] = np.arange(len(at))
        ok = new[doc] >= 0
        doc, word, value, form, grade = new[doc[ok]], word[ok], value[ok], form[at], grade[at]
    return fit(doc, word, value, form, grade, grades)


def score(docs: DataFrame, model: Model, tail: int = 2, least: float = 0.5) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, expected_grade, tail, selected.

    tail is P(grade >= ``tail``); selected if it is at least ``least``.  Without labels nothing is known: the grade is
    null, the tail 1 and every text with a word is selected.  Texts without words (null, empty) are never selected.
    Null and repeated ids are documents like others; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column("text")):
                grade, upper = _grade(c, model, tail)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(c.first, c.size), grade, pa.array(upper), pa.array((upper >= least) & (np.diff(c.bounds) > 0))],
                    names=["doc_id", "expected_grade", "tail", "selected"],
                )

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, expected_grade double, tail double, selected boolean")


def _grade(c: Chunk, model: Model, tail: int) -> tuple[pa.Array, np.ndarray]:
    if not len(model.thresholds):
        return pa.nulls(c.size, pa.float64()), np.ones(c.size)
    tails = model.tails(model.score(*features(c)))
    return pa.array(tails.sum(axis=1)), tails[:, tail - 1]


def select(docs: DataFrame, model: Model, tail: int = 2, least: float = 0.5) -> DataFrame:
    """The rows of docs whose text is selected (see score), columns as they were."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [(_grade(c, model, tail)[1] >= least) & (np.diff(c.bounds) > 0) for c in chunks(batch.column("_text"))]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0, bool), *keep])))

    return rows.mapInArrow(released(run), rows.schema).select("_row.*")
