"""Toxicity: cumulative-link ordinal regression over sparse word features.

A document's grade runs from 0 (clean) to `grades` - 1. Every threshold k
has P(grade >= k) = sigmoid(w . x - t_k) with one weight vector w for all
thresholds and t_1 <= t_2 <= ..., so the sum of these probabilities is the
expected severity. Labels say only toxic or not; toxic training documents
are graded by their density of words that lean to toxic documents.

The model is fitted on at most `sample` labelled documents (chosen by a hash
of their id), one text of each id (the first by hash), so that an id that repeats
weighs no more than others; everything else reads all rows and whole texts.

Defined results: null or empty texts have no features. Labels that are null
are ignored; of repeated labels of one id the highest counts. Without toxic
or without clean labels the severity is 0 and nothing is rejected. Repeated rows are graded
each on their own, null ids are kept, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import alnum_words, as_bytes, per_batch, stored

#: Most labelled documents that the model is fitted on.
SAMPLE_DOCUMENTS = 12_000
#: Most words with a weight.
VOCABULARY = 2_000
#: Least log-likelihood ratio of a word with a weight: one in a thousand words that tell nothing has more.
LEAST_RATIO = 10.83


@dataclass
class Model:
    words: dict[bytes, int] = field(default_factory=dict)
    lean: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(3, 30.0))

    def at_least(self, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """P(grade >= k), k = 1.., for rows of word counts."""
        return _sigmoid((features(counts, sizes, self.lean) @ self.weights)[:, None] - self.thresholds)


def features(counts: np.ndarray, sizes: np.ndarray, lean: np.ndarray) -> np.ndarray:
    """Per word the log of 1 + its count in 100 words; last, whether any word that leans to toxic texts stands there."""
    density = np.log1p(100 * counts / np.maximum(1, sizes)[:, None])
    return np.concatenate([density, (counts[:, lean] > 0).any(axis=1, keepdims=True)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_ordinal(row: np.ndarray, col: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int, n_grades: int,
                steps: int = 1500, rate: float = 0.05, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the mean likelihood of a sparse matrix (row, col, value)."""
    share = np.array([(grade >= k).mean() for k in range(1, n_grades)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - share) / share)
    free = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    one, two = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, steps + 1):
        w, gaps = free[:n_features], np.exp(free[n_features + 1:])
        t = free[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, value * w[col], len(grade))
        p = np.concatenate([np.ones((len(grade), 1)), _sigmoid(score[:, None] - t), np.zeros((len(grade), 1))], axis=1)
        mass = np.maximum(p[np.arange(len(grade)), grade] - p[np.arange(len(grade)), grade + 1], 1e-9)
        slope = p * (1 - p)
        up, down = slope[np.arange(len(grade)), grade], slope[np.arange(len(grade)), grade + 1]
        d_score = -(up - down) / mass / len(grade)
        d_t = np.zeros(n_grades + 1)
        np.add.at(d_t, grade, up / mass / len(grade))
        np.add.at(d_t, grade + 1, -down / mass / len(grade))
        d_t = d_t[1:n_grades]
        later = np.cumsum(d_t[::-1])[::-1]
        slope_free = np.concatenate([np.bincount(col, value * d_score[row], n_features) + decay * w, later[:1], later[1:] * gaps])
        one, two = 0.9 * one + 0.1 * slope_free, 0.999 * two + 0.001 * slope_free ** 2
        free = free - rate * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.999 ** step)) + 1e-9)
    return free[:n_features], free[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(free[n_features + 1:]))])


def _counts(texts: list[bytes], words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x vocabulary) counts, and the number of words of each row."""
    counts, sizes = np.zeros((len(texts), len(words)), np.float32), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = alnum_words(text)
        sizes[i] = len(own)
        for w in own:
            if w in words:
                counts[i, words[w]] += 1
    return counts, sizes


def vocabulary(sample: DataFrame, size: int = VOCABULARY, least_ratio: float = LEAST_RATIO) -> list[tuple[str, bool]]:
    """(word, leans to toxic documents) of the words that tell most about the label. Input: toxic, text.

    Measure: the log-likelihood ratio of word and label over distinct texts; kept are words with at least
    `least_ratio`, at most `size`. The bound is the same for all words, so a frequent toxic vocabulary
    doesn't displace a rare one (that of another language); the fit weighs them.
    """
    def distinct(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [{w for w in alnum_words(t) if len(w) <= 64} for t in as_bytes(batch.column(1))]
        toxic = np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])
        words = [w.decode("utf-8", "replace") for s in sets for w in s]
        return pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(words, pa.string())], names=["toxic", "word"])

    texts = sample.select("toxic", "text").distinct()
    totals = dict(texts.groupBy("toxic").count().collect())
    n1, n0 = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not n1 or not n0:
        return []
    part = lambda seen, expected: F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)
    a, b, n = F.col("a"), F.col("b"), n1 + n0
    ratio = sum(part(seen, of * total / n) for of, pairs in ((a + b, ((a, n1), (b, n0))), (n - a - b, ((n1 - a, n1), (n0 - b, n0)))) for seen, total in pairs)
    found = (
        texts.mapInArrow(per_batch(distinct, 128), "toxic int, word string")
        .groupBy("word").agg(F.count_if(F.col("toxic") == 1).cast("double").alias("a"), F.count_if(F.col("toxic") == 0).cast("double").alias("b"))
        .where("a + b >= 3").select("word", (a / n1 > b / n0).alias("leans"), F.round(ratio, 6).alias("ratio"))
        .where(F.col("ratio") >= least_ratio).orderBy(F.desc("ratio"), "word").limit(size)
    )
    return [(r.word, r.leans) for r in found.collect()]


def one_text_of_each(rows: DataFrame) -> DataFrame:
    """doc_id, toxic, text: the text of the smallest hash of every id, combined before the shuffle."""
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    return rows.groupBy("doc_id", "toxic").agg(first.alias("first")).select("doc_id", "toxic", "first.text")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, n_grades: int = 4) -> Model:
    """Fit on at most `sample` labelled documents. Input: doc_id, text and doc_id, toxic."""
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    held = stored(one_text_of_each(texts.join(F.broadcast(chosen), "doc_id")), "toxicity-sample")  # at most `sample` rows
    known = vocabulary(held)
    if not known:
        return Model(thresholds=np.full(n_grades - 1, 30.0))
    words = {w.encode(): i for i, (w, _) in enumerate(known)}
    lean = np.array([leans for _, leans in known])

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, sizes = _counts(as_bytes(batch.column(2)), words)
        x = features(counts, sizes, lean)
        cols = [np.flatnonzero(r) for r in x]
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([c.astype("<i4").tobytes() for c in cols], pa.binary()),
            pa.array([r[c].astype("<f8").tobytes() for r, c in zip(x, cols)], pa.binary()),
            pa.array(counts[:, lean].sum(axis=1) / np.maximum(1, sizes), pa.float64()),
        ], names=["doc_id", "toxic", "cols", "vals", "density"])

    rows = held.mapInArrow(per_batch(sparse, 128), "doc_id long, toxic int, cols binary, vals binary, density double").collect()
    rows.sort(key=lambda r: (r.doc_id, r.toxic, r.density, r.cols))
    cols = [np.frombuffer(r.cols, "<i4") for r in rows]
    toxic, dense = np.array([r.toxic for r in rows]), np.array([r.density for r in rows])
    some = dense[(toxic == 1) & (dense > 0)]
    cuts = np.quantile(some, np.arange(1, n_grades - 1) / (n_grades - 1)) if len(some) else np.full(n_grades - 2, np.inf)
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, dense, side="right"), 0)
    row = np.repeat(np.arange(len(rows)), [len(c) for c in cols])
    values = np.concatenate([np.frombuffer(r.vals, "<f8") for r in rows])
    weights, thresholds = fit_ordinal(row, np.concatenate(cols), values, grade, len(words) + 1, n_grades)
    return Model(words, lean, weights, thresholds)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_words, toxic_probability, expected_severity, severity (most likely grade) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("toxic_probability", pa.float64()), ("expected_severity", pa.float64()), ("severity", pa.int32())])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, sizes = _counts(as_bytes(batch.column(1)), model.words)
        p = model.at_least(counts, sizes)
        each = -np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1), axis=1)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(p[:, 0], pa.float64()), pa.array(p.sum(axis=1), pa.float64()), pa.array(each.argmax(axis=1), pa.int32())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(per_batch(of_batch, 128), "doc_id long, n_words long, toxic_probability double, expected_severity double, severity int")


def grade_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Fit on the labelled documents, grade all; `toxic` where P(grade >= 1) reaches the threshold."""
    return grade(docs, fit(docs, labels)).withColumn("toxic", F.col("toxic_probability") >= threshold)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents, all columns, of which P(grade >= 1) stays under the threshold; one pass, no shuffle."""
    model, at = fit(docs, labels), docs.columns.index("text")

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model.at_least(*_counts(as_bytes(batch.column(at)), model.words))
        return batch.filter(pa.array(p[:, 0] < threshold))

    return docs.mapInArrow(per_batch(of_batch, 128), docs.schema)
