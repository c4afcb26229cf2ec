"""Repeated word windows: every word covered by 50 words that also start in a smaller document goes.

Seeds are runs of ten words, winnowed: of the seeds in every 50 words at least one, chosen by
content, is an anchor, and documents meet on anchors (see windows.py). The dealt method extends
each match word by word; here it is replaced by a comparison of fixed reach: all windows around an
anchor are compared at once by the number of their whole context, and, where contexts of an anchor
differ, window by window. Neighbouring windows that match are joined to maximal repeats, which have 50
words or more by construction.

A word is removed if a window of 50 words that covers it also starts in a document with a smaller
doc_id; windows are judged on the input. A null text has no words; a null doc_id is below all
others. Rows that share a doc_id remove nothing from each other. Other columns are ignored, an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import NO_ID, map_batches
from dropwatch.llm.windows import Shape, covered, keyed, packed, repeats, unpacked

LENGTH = 50
SEED = 10


def words_of(raw: memoryview) -> list[bytes]:
    """Words between ASCII white space."""
    return bytes(raw).split()


def numbers_of(raw: memoryview) -> np.ndarray:
    words = words_of(raw)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


SHAPE = Shape(LENGTH, SEED, numbers_of, lambda numbers: numbers, by_document=True)


def dedup(docs: DataFrame, shape: Shape = SHAPE) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, spans (start:end of each maximal repeat)."""
    rows = keyed(docs)
    marked = packed(rows).join(repeats(rows, shape, np.uint64), ["did", "tag"], "left").select("did", "raw", "items")

    def run(batch):
        out = []
        for did, raw, items in zip(*batch.columns, strict=True):
            words = kept = words_of(unpacked(raw))
            spans = np.zeros((0, 2), int)
            if items.is_valid:
                gone = covered(items.values.to_numpy(), len(words), shape.length)
                spans = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).reshape(-1, 2)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            listed = ",".join(f"{a}:{b}" for a, b in spans)
            digest = hashlib.sha256(b" ".join(kept)).hexdigest()
            out.append((did.as_py(), len(words), len(words) - len(kept), digest, listed))
        if out:
            yield [list(c) for c in zip(*out, strict=True)]

    schema = "did long, n_words long, n_removed long, kept_sha256 string, spans string"
    found = map_batches(marked, run, schema)
    return found.withColumn("doc_id", F.when(F.col("did") != NO_ID, F.col("did"))).drop("did")
