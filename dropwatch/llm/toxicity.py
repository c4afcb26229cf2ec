"""Toxicity by a bag of subwords: embeddings averaged into a linear softmax, trained jointly.

A text's features are its words, marked with a boundary at both ends, and their runs of
SHORTEST to LONGEST characters, hashed into BUCKETS; a text of unseen words or misspellings still
has known subwords. The embeddings of all features are averaged (times SCALE) and go through a linear
softmax of two classes. Embeddings and softmax are fitted together, one text at a time, by AdaGrad
in numpy. As the model is linear in the averaged embeddings, every bucket has one number when a text
is scored, so scoring is one lookup per feature of the whole text.

Trained on a bounded sample of the labelled rows that are not held out: of each class the
PER_CLASS with the smallest hash of their id. Rows whose doc_id leaves 0 when its crc32 is divided
by HELD_OUT are never learned from.

A null text is empty; a text without features has the score of the softmax's bias. A null doc_id is
held out, a null label is no label. Of a doc_id that is repeated in the documents or labels, each
pair of text and label counts (PER_CLASS pairs at most). Without labels of both classes every score
is that class's label (0 without any). Repeated rows each give a row, other columns are ignored, an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import map_batches, text_of

BUCKETS = 1 << 16
SHORTEST, LONGEST = 3, 5
PER_CLASS = 2000
HELD_OUT = 5
SCALE = 20.0
NEUTRAL = 100  # features of embedding zero in every average
PIECE = 1 << 20  # characters whose features are held at a time

M1, M2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
# ASCII characters that do not belong to words.
BREAKS = np.array([not chr(c).isalnum() for c in range(128)])


@dataclass(frozen=True)
class Training:
    size: int = 16  # of an embedding
    rate: float = 0.1
    epochs: int = 4
    l2: float = 1e-6


@dataclass
class ToxicityModel:
    scores: np.ndarray  # per bucket: log odds of class 1 that a text of this feature alone would add
    bias: float

    def score(self, text: str) -> float:
        at, counts = bag(text)
        odds = self.bias + float(shares(counts) @ self.scores[at])
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * M2
    return ((h ^ (h >> np.uint32(13))) * M1 >> np.uint32(16)).astype(np.int64)


def features(codes: np.ndarray) -> np.ndarray:
    """Buckets of all words and subwords of one piece of text, given as lower-case code points."""
    breaks = codes < 128
    breaks[breaks] = BREAKS[codes[breaks]]
    edge = np.concatenate(([True], breaks, [True]))
    c = np.concatenate(([0], np.where(breaks, 0, codes), [0])).astype(np.uint32)
    inner = np.concatenate(([0], np.cumsum(edge)))  # breaks before each place
    found, h = [], c.copy()
    for n in range(2, LONGEST + 1):
        h = h[: len(c) - n + 1] * M1 + (c[n - 1 :] ^ np.uint32(n * 0x51ED27))
        if n >= SHORTEST:
            # Only the ends may be boundaries.
            whole = inner[n - 1 : n - 1 + len(h)] == inner[1 : 1 + len(h)]
            found.append(_mixed(h[whole]))
    # Words: sums of their characters' products with the powers of their places.
    starts, ends = np.flatnonzero(edge[:-1] & ~edge[1:]) + 1, np.flatnonzero(~edge[:-1] & edge[1:]) + 1
    if len(starts):
        place = np.arange(len(c)) - np.repeat(
            np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(c)])))
        )
        value = (c * M2 + M1) * (place.astype(np.uint32) * np.uint32(2) + np.uint32(1)) ** np.uint32(3)
        sums = np.concatenate(([0], np.cumsum(value, dtype=np.uint32))).astype(np.uint32)
        found.append(_mixed(sums[ends] - sums[starts]))
    return np.concatenate(found)


def feature_pieces(text: str):
    """features() of the whole text, cut between words about every PIECE characters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    start = 0
    while start < len(codes):
        end = min(len(codes), start + PIECE)
        while end < len(codes) and not (codes[end] < 128 and BREAKS[codes[end]]):
            end += 1
        yield features(codes[start:end])
        start = end


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the whole text and how often each occurs."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in feature_pieces(text):
        counts += np.bincount(at, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found].astype(np.int32)


def shares(counts: np.ndarray) -> np.ndarray:
    """What each feature's embedding counts in the average, times SCALE."""
    damped = 1 + np.log(counts)
    return damped * (SCALE / (damped.sum() + NEUTRAL))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Label, buckets and counts of the sampled texts, in the order of their ids' hashes."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("toxic in (0, 1)")
    known = known.where(~is_held_out(F.col("doc_id"))).withColumn("h", F.xxhash64(F.lit("toxicity"), "doc_id"))
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))

    def features_of(batch):
        bags = [bag(text.as_py()) for text in batch.column(3)]
        yield [batch.column(0), batch.column(1), batch.column(2), *([b[k].tobytes() for b in bags] for k in (0, 1))]

    schema = "toxic int, h long, doc_id long, buckets binary, counts binary"
    found = []
    for label in (0, 1):
        chosen = known.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(PER_CLASS).distinct()
        texts = rows.join(F.broadcast(chosen), "doc_id").select("toxic", "h", "doc_id", "text")  # PER_CLASS rows
        bags = map_batches(texts, features_of, schema).orderBy("h", "doc_id", "buckets", "counts").limit(PER_CLASS)
        found += bags.collect()
    found.sort(key=lambda r: (r.h, r.doc_id, r.toxic))
    return [(r.toxic, np.frombuffer(r.buckets, np.int32), np.frombuffer(r.counts, np.int32)) for r in found]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], training: Training = Training()) -> ToxicityModel:
    """Embeddings and softmax, jointly, by AdaGrad on the log loss."""
    ones = sum(y for y, _, _ in rows)
    if not 0 < ones < len(rows):
        return ToxicityModel(np.zeros(BUCKETS, np.float32), 500.0 if ones else -500.0)
    t, random = training, np.random.default_rng(12)
    embeddings = random.uniform(-1 / t.size, 1 / t.size, (BUCKETS, t.size)).astype(np.float32)
    softmax, bias = np.zeros((t.size, 2), np.float32), np.zeros(2, np.float32)
    softmax[:, 1] = random.choice([-1.0, 1.0], t.size)  # so that embeddings learn from the start
    grown = [np.full_like(x, 1e-8) for x in (embeddings, softmax, bias)]
    examples = [(y, at, shares(n).astype(np.float32)) for y, at, n in rows]
    for _ in range(t.epochs):
        for k in random.permutation(len(examples)):
            y, at, share = examples[k]
            mean = share @ embeddings[at]
            logits = mean @ softmax + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[y] -= 1
            steps = (
                (embeddings, at, share[:, None] * (softmax @ error) + t.l2 * embeddings[at]),
                (softmax, slice(None), np.outer(mean, error)),
                (bias, slice(None), error),
            )
            for (x, where, g), seen in zip(steps, grown, strict=True):
                seen[where] += g * g
                x[where] -= t.rate * g / np.sqrt(seen[where])
    lift = softmax[:, 1] - softmax[:, 0]
    return ToxicityModel((embeddings @ lift).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> ToxicityModel:
    return fit(sample(docs, labels), training)


def predict(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted of every row, from its text alone."""

    def run(batch):
        scores = [model.score(text.as_py()) for text in batch.column(1)]
        yield [batch.column(0), scores, [int(s >= 0.5) for s in scores]]

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return map_batches(rows, run, "doc_id long, score double, predicted int")
