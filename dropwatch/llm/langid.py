"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are the three-character strings of the lower-cased text (with a space at both ends),
hashed into BUCKETS, weighted by TF-IDF and scaled to a sum of SCALE. Document frequencies are
counted over all documents that may be learned from. The weights are fitted by
follow-the-regularised-leader with L1 and L2 penalties on a bounded sample: at most PER_LANGUAGE
documents of a language and MAX_SAMPLE in all, those with the smallest hash of their id. A fifth
of the sample is left out of the fit and sets the temperature of the scores.

A null text, or one without letters, is ``und`` with score 0. A null lang is never learned from; a
null doc_id is held back from learning. Without any labelled document all are ``und``. Repeated
rows each give a row, other columns are ignored, an empty table gives an empty result. Ties between
languages go to the first by name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.llm.common import map_batches

BUCKETS = 1 << 15
PER_LANGUAGE = 1000
MAX_SAMPLE = 6000
SCALE = 20.0
UNDECIDED = "und"


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.5
    beta: float = 0.1
    l1: float = 0.01
    l2: float = 0.01
    epochs: int = 4


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray  # BUCKETS
    weights: np.ndarray  # BUCKETS x languages
    temperature: float = 1.0

    def __post_init__(self):
        self.weighted = (self.weights * self.idf[:, None]).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNDECIDED, 0.0
        at = grams(text)
        logits = self.weighted[at].sum(axis=0, dtype=np.float64) * (SCALE / self.idf[at].sum())
        p = softmax(logits / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def grams(text: str) -> np.ndarray:
    """Bucket of every three-character string of the whole text, in order."""
    padded = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    c = np.frombuffer(padded, np.uint32)
    mixed = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:]
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
    return (mixed >> np.uint32(17)).astype(np.int64)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts; one vector per task."""

    def count(batches):
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                mark = np.zeros(BUCKETS, np.bool_)
                mark[grams(text.as_py())] = True
                seen += mark
                n += 1
        if n:
            found = np.flatnonzero(seen)
            buckets, counts = np.append(found, BUCKETS), np.append(seen[found], n)
            yield pa.RecordBatch.from_pydict({"bucket": buckets, "n": counts})

    counted = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total, frequencies = 0, np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.collect():  # at most BUCKETS + 1 rows
        if bucket == BUCKETS:
            total = n
        else:
            frequencies[bucket] = n
    return frequencies, total


def sample(labelled: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Language, buckets and counts of each sampled document, in the order of the ids' hashes."""
    spark = labelled.sparkSession
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = (
        labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
        .withColumn("rank", F.row_number().over(by_hash))
        .where(F.col("rank") <= PER_LANGUAGE)
        .orderBy("rank", "h", "doc_id")
        .limit(MAX_SAMPLE)
        .select("doc_id")
        .distinct()
    )
    chosen = spark.createDataFrame([(r.doc_id,) for r in ids.collect()], "doc_id long")
    rows = labelled.join(F.broadcast(chosen), "doc_id", "left_semi")  # at most MAX_SAMPLE ids

    def features(batch):
        buckets, counts = [], []
        for text in batch.column(2):
            b, n = np.unique(grams(text.as_py()), return_counts=True)
            buckets.append(b.astype(np.int32).tobytes())
            counts.append(n.astype(np.int32).tobytes())
        yield [batch.column(0), batch.column(1), buckets, counts]

    schema = "doc_id long, lang string, buckets binary, counts binary"
    found = map_batches(rows.select("doc_id", "lang", "text"), features, schema)
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "buckets").limit(2 * MAX_SAMPLE)
    return [
        (r.lang, np.frombuffer(r.buckets, np.int32), np.frombuffer(r.counts, np.int32))
        for r in found.collect()
    ]


def fit_weights(rows, n_languages: int, settings: Ftrl) -> np.ndarray:
    """FTRL-proximal, one example at a time; rows hold (language number, buckets, values)."""
    s = settings
    z = np.zeros((BUCKETS, n_languages))
    g2 = np.zeros((BUCKETS, n_languages))

    def solve(zi, ni):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2)

    order = np.random.default_rng(0)
    for _ in range(s.epochs):
        for k in order.permutation(len(rows)):
            y, at, x = rows[k]
            zi, ni = z[at], g2[at]
            w = solve(zi, ni)
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / s.alpha * w
            g2[at] = grown
    return solve(z, g2)


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        x = logits / np.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(truth)), truth]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, settings: Ftrl = Ftrl()) -> LanguageModel:
    """Fit on the documents that are not held out and have a lang and a text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text")
    labelled = rows.where(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sampled = sample(labelled)
    languages = sorted({lang for lang, _, _ in sampled})
    if not languages:
        return LanguageModel([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)))
    frequencies, n = document_frequencies(labelled.select("text"))
    idf = np.log((1 + n) / (1 + frequencies)) + 0.1
    number = {lang: k for k, lang in enumerate(languages)}
    examples = []
    for lang, at, counts in sampled:
        x = counts * idf[at]
        examples.append((number[lang], at, x * (SCALE / x.sum())))
    weights = fit_weights([e for k, e in enumerate(examples) if k % 5], len(languages), settings)
    left_out = [e for k, e in enumerate(examples) if k % 5 == 0]
    logits = np.array([x @ weights[at] for _, at, x in left_out])
    truth = np.array([y for y, _, _ in left_out])
    return LanguageModel(languages, idf, weights, fit_temperature(logits, truth))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of every row, from its text alone."""

    def run(batch):
        found = [model.predict(text.as_py()) for text in batch.column(1)]
        yield [batch.column(0), [f[0] for f in found], [f[1] for f in found]]

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least_score: float) -> DataFrame:
    """The rows of docs, all columns, whose language is found with at least this score."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(place)]
            yield batch.filter(pa.array([lang != UNDECIDED and p >= least_score for lang, p in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
