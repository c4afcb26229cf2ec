"""Importance resampling of a corpus towards a target distribution of hashed n-grams.

Features are all runs of 1 to `orders` consecutive words, hashed into buckets. They are counted over
the whole corpus and the whole target; a bucket's gain is the log ratio of its smoothed shares, a
document's weight the sum of its features' gains. Weight plus Gumbel noise, drawn from a hash of the
doc_id, makes the order in which documents are taken without replacement; a stated share of those
long enough is drawn.

Batch concatenation: the texts of a slice are joined with sentinel bytes that no word contains, one
regex pass finds all words, a binary search in the documents' offsets tells whose each word is, and
n-grams that reach from one document into the next are masked before the counting.

A null text has no words. A null doc_id is below all others, and its noise is that of an empty id;
rows that share a doc_id each have a row, equal rows in any order. Other columns are ignored. An
empty corpus gives an empty result, an empty target a gain to the buckets that the corpus lacks.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.llm.common import NO_ID, id_of, map_batches, text_of
from dropwatch.session import staged

SENTINEL = b"\x00"
SLICE_BYTES = 4 << 20  # of text, about, that are joined at a time
# Fixed value: words of lower-cased text, as UTF-8; everything above ASCII is a letter.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Resampling:
    orders: int = 1  # longest run of words
    buckets: int = 10000
    seed: int = 2024
    least_words: int = 20  # of a document that may be drawn
    percent: int = 10  # of those documents, drawn


def slices(texts: pa.Array) -> Iterator[list[bytes]]:
    """The texts in order, about SLICE_BYTES at a time; a longer text is alone or last."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_buffer().to_pybytes())
        size += len(part[-1])
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def features(texts: list[bytes], orders: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The document and the bucket of every feature, and the number of words of each document."""
    joined = SENTINEL.join(texts).lower()  # lower() of bytes changes A-Z only
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.cumsum(sizes + len(SENTINEL)) - sizes - len(SENTINEL)
    found = [(m.start(), m.group()) for m in WORD.finditer(joined)]
    starts = np.fromiter((f[0] for f in found), np.int64, len(found))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    known: dict[bytes, int] = {w: zlib.crc32(w) for w in {f[1] for f in found}}
    numbers = np.fromiter((known[f[1]] for f in found), np.int64, len(found))
    documents, hashed = [owner], [numbers]
    for n in range(2, orders + 1):
        # A run's checksum goes on from that of the run without its last word.
        tails = (b" " + f[1] for f in found[n - 1 :])
        numbers = np.fromiter(map(zlib.crc32, tails, numbers[: len(found) - n + 1].tolist()), np.int64)
        inside = owner[: len(numbers)] == owner[n - 1 :]
        documents.append(owner[: len(numbers)][inside])
        hashed.append(numbers[inside])
    words = np.bincount(owner, minlength=len(texts))
    return np.concatenate(documents), np.concatenate(hashed) % buckets, words


def bucket_counts(texts: DataFrame, settings: Resampling = Resampling()) -> np.ndarray:
    """How many features of all texts (column text) fall into each bucket; one vector per task."""
    orders, buckets = settings.orders, settings.buckets

    def count(batches):
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                seen += np.bincount(features(part, orders, buckets)[1], minlength=buckets)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"bucket": found, "n": seen[found]})

    counted = texts.select(text_of().cast("binary")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # at most `buckets` rows
        total[bucket] = n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of each bucket's smoothed shares, rounded down."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray, settings: Resampling = Resampling()) -> DataFrame:
    """did, n_words, n_features, weight of every row."""
    orders, buckets = settings.orders, settings.buckets

    def run(batch):
        words, n_features, weights = [], [], []
        for part in slices(batch.column(1)):
            document, bucket, n = features(part, orders, buckets)
            # Sums of whole numbers are exact in doubles up to 2**53.
            total = np.bincount(document, weights=gain[bucket], minlength=len(part))
            words.append(n)
            n_features.append(np.bincount(document, minlength=len(part)))
            weights.append(total.astype(np.int64))
        if words:
            yield [batch.column(0), *(np.concatenate(c) for c in (words, n_features, weights))]

    rows = docs.select(id_of().alias("did"), text_of().cast("binary").alias("raw"))
    return map_batches(rows, run, "did long, n_words long, n_features long, weight long")


def noise(did: Column, seed: int) -> Column:
    """A thousand times a standard Gumbel draw, rounded down, from the hash of seed and id."""
    shown = F.when(did == NO_ID, "").otherwise(did.cast("string"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), shown).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with their place (from 1) in the order. Sorted by ranges of the whole key, so no task
    holds more than a range; a place is that in the range, after the sizes of the ranges before.
    Staged, because a range sort done again may cut its ranges elsewhere."""
    ranged = rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = staged(ranged.withColumn("range", F.shiftright("at", 33)), "places")
    blocks = ranged.groupBy("range").agg(F.min("at").alias("start"), F.count("*").alias("size"))
    # One row per range.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    shift = blocks.select("range", (before - F.col("start") + 1).alias("shift"))
    return ranged.join(shift, "range").withColumn("place", F.col("at") + F.col("shift")).drop("range", "at", "shift")


def resample(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling()) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and, if it is drawn, its rank."""
    gain = gains(bucket_counts(docs, settings), bucket_counts(target, settings))
    scored = weigh(docs, gain, settings).withColumn("score", F.col("weight") + noise(F.col("did"), settings.seed))
    scored = staged(scored.withColumn("able", F.col("n_words") >= settings.least_words), "weighed")
    drawn = scored.where("able").count() * settings.percent // 100
    ordered = placed(scored, [F.desc("able"), F.desc("score"), F.asc("did")])
    return ordered.select(
        F.when(F.col("did") != NO_ID, F.col("did")).alias("doc_id"),
        "n_features",
        "weight",
        "score",
        F.when(F.col("able") & (F.col("place") <= drawn), F.col("place")).alias("rank"),
    )
