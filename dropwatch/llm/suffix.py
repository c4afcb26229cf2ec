"""Repeated byte strings: every byte covered by a 100-byte string that also starts earlier goes.

The dealt method, bucket-pointer refinement of all suffixes, is replaced: no suffix order is made
and no positions are sorted on the bucket identifiers of later offsets, as that shuffles every
position of the corpus once per round. Instead (see windows.py) positions are sampled by content, one
in every string of 100 bytes at least; the numbers of 32 bytes there are composed to those of 64 and
100 bytes from the numbers at later offsets; and only where a bucket still holds different strings
are its single positions compared, by two 64-bit numbers each. Runs of one context are told apart
by one 64-bit number.

Repeats are judged on the input and never cross texts. A null text is empty; a null doc_id is below
all others. Rows that share a doc_id count as ordered by a hash of their text; identical rows of
one doc_id are one place and remove nothing from each other. Other columns are ignored, an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import NO_ID, map_batches
from dropwatch.llm.windows import Shape, covered, keyed, packed, repeats, unpacked

LENGTH = 100
Q = 32
# A number for each byte value, from a fixed seed.
BYTE_NUMBERS = np.random.default_rng(4).integers(0, 1 << 63, 256, dtype=np.uint64)


def bytes_of(raw: memoryview) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def numbers_of(units: np.ndarray) -> np.ndarray:
    return BYTE_NUMBERS[units]


SHAPE = Shape(LENGTH, Q, bytes_of, numbers_of, by_document=False)


def dedup(docs: DataFrame, shape: Shape = SHAPE) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start:end, bytes)."""
    rows = keyed(docs)
    marked = packed(rows).join(repeats(rows, shape, np.uint8), ["did", "tag"], "left").select("did", "raw", "items")

    def run(batch):
        out = []
        for did, raw, items in zip(*batch.columns, strict=True):
            text = np.frombuffer(unpacked(raw), np.uint8)
            spans = np.zeros((0, 2), int)
            if items.is_valid:
                gone = covered(items.values.to_numpy(), len(text), shape.length)
                spans = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).reshape(-1, 2)
                text = text[~gone]
            listed = ",".join(f"{a}:{b}" for a, b in spans)
            removed = int((spans[:, 1] - spans[:, 0]).sum())
            digest = hashlib.sha256(text.tobytes()).hexdigest()
            out.append((did.as_py(), len(text) + removed, removed, len(spans), digest, listed))
        if out:
            yield [list(c) for c in zip(*out, strict=True)]

    schema = "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string"
    found = map_batches(marked, run, schema)
    return found.withColumn("doc_id", F.when(F.col("did") != NO_ID, F.col("did"))).drop("did")
