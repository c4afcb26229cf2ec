"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius.

Terms are the words of a text. A term's 64-bit hash votes on each bit with the term's weight
(1 + ln of its count); a bit is set where the votes for it outweigh those against it. Equal texts
have equal fingerprints; a text without words has the fingerprint 0. Likeness is 1 minus the share
of bits that differ.

The edited text of a document ends with the beginning of the next document by doc_id. Documents are
range-partitioned and sorted once; only the first and the last document of a partition are paired
in a second, small step.

Nulls: a null text is empty; a null doc_id sorts first. Rows that share a doc_id are ordered by
text; repeated rows each give a row. With a single row, the next document is the row itself. Other
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.llm.common import NO_ID, id_of, map_batches, text_of
from dropwatch.session import staged

BITS = 64
BLOCKS = 6
RADIUS = 3
ROWS_OUT = 2000


def fingerprint(text: str) -> int:
    counts = Counter(text.split())
    if not counts:
        return 0
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts))
    weights = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    bits = np.unpackbits(hashed.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    # Votes for less votes against. Rounded, so that the order of the terms can't tip a tie.
    votes = np.round(2 * (weights @ bits) - weights.sum(), 6)
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    return 1 - (a ^ b).bit_count() / BITS


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


SCHEMA = (
    "edge int, first long, did long, n_chars long, edited_sha256 string, fp long, edited_fp long, "
    "near_edited double, near_next double, text string"
)
DONE, HEAD, TAIL = 0, 1, 2


def _pair(did: int, text: str, fp: int, following: str, next_fp: int) -> tuple:
    new = edited(text, following)
    new_fp = fp if new == text else fingerprint(new)
    digest = hashlib.sha256(new.encode()).hexdigest()
    near = likeness(fp, new_fp), likeness(fp, next_fp)
    return did, len(text), digest, _signed(fp), _signed(new_fp), *near


def _walk(batches):
    """Rows of one sorted partition: all but the last are done; its ends are passed on."""
    import pyarrow as pa

    from dropwatch.llm.common import arrow_schema

    kinds = arrow_schema(SCHEMA)
    out: list[tuple] = []
    first, last = None, None

    def flush():
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, schema=kinds)

    for batch in batches:
        for did, text in zip(batch.column(0), batch.column(1), strict=True):
            did, text = did.as_py(), text.as_py()
            fp = fingerprint(text)
            if last is None:
                first = did
                out.append((HEAD, first, did, None, None, _signed(fp), None, None, None, text))
            else:
                out.append((DONE, first, *_pair(*last, text, fp), None))
            last = did, text, fp
            if len(out) >= ROWS_OUT:
                yield flush()
    if last is not None:
        out.append((TAIL, first, last[0], None, None, _signed(last[2]), None, None, None, last[1]))
        yield flush()


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp (long), near_edited, near_next per row."""
    rows = docs.select(id_of().alias("did"), text_of().alias("text"))
    ordered = rows.repartitionByRange("did").sortWithinPartitions("did", "text")
    walked = staged(ordered.mapInArrow(_walk, SCHEMA), "simhash-walked")
    ends = walked.where(F.col("edge") != DONE)
    # One small row per partition finds its successor; the texts are joined to it, not sorted.
    starts = ends.where(F.col("edge") == HEAD).select("first")
    lowest = starts.agg(F.min("first").alias("lowest"))
    following = starts.withColumn("next", F.lead("first").over(Window.orderBy("first")))
    following = following.crossJoin(F.broadcast(lowest)).select(
        "first", F.coalesce("next", "lowest").alias("next")
    )
    tails = ends.where(F.col("edge") == TAIL).select("first", "did", "text", "fp")
    heads = ends.where(F.col("edge") == HEAD).select(
        F.col("first").alias("next"), F.col("text").alias("next_text"), F.col("fp").alias("next_fp")
    )

    def finish(batch):
        unsigned = (1 << 64) - 1
        rows = [
            _pair(did, text, fp & unsigned, following, next_fp & unsigned)
            for did, text, fp, following, next_fp in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        ]
        if rows:
            yield [list(c) for c in zip(*rows, strict=True)]

    schema = ", ".join(SCHEMA.split(", ")[2:9])
    pairs = tails.join(following, "first").join(heads, "next")
    last = map_batches(pairs.select("did", "text", "fp", "next_text", "next_fp"), finish, schema)
    done = walked.where(F.col("edge") == DONE).select(*(x.split()[0] for x in schema.split(", ")))
    return done.unionByName(last).withColumn("doc_id", F.when(F.col("did") != NO_ID, F.col("did"))).drop("did")


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Masks of the permuted tables: two fingerprints within the radius agree on `blocks - radius`
    of the blocks, so they meet in the table of those blocks."""
    edges = [k * BITS // blocks for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(chosen)) for chosen in combinations(parts, blocks - radius)]


def neighbours(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """fp of each distinct query, near_fp of each distinct fingerprint within the radius, distance.

    Both sides are reduced to distinct fingerprints first, so copies meet once. A pair counts in
    the first table in which it meets, which needs no distinct over the pairs.
    """
    masks = F.array(*(F.lit(m) for m in block_masks(blocks, radius)))

    def tables(df: DataFrame, fp: str) -> DataFrame:
        return df.select("fp").distinct().select(
            F.col("fp").alias(fp), F.posexplode(masks).alias("table", "mask")
        ).select(fp, "table", F.col(fp).bitwiseAND(F.col("mask")).alias("block"))

    met = tables(queries, "fp").join(tables(fingerprints, "near_fp"), ["table", "block"])
    differ = F.col("fp").bitwiseXOR(F.col("near_fp"))
    agree = F.transform(masks, lambda m: differ.bitwiseAND(m) == 0)
    first = F.array_position(agree, True) == F.col("table") + 1
    distance = F.bit_count(differ)
    return met.where((distance <= radius) & first).select("fp", "near_fp", distance.alias("distance"))


def as_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
