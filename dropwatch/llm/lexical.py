"""Ranked lexical search over an inverted index, by a hybrid of term- and document-at-a-time.

Index: every task inverts its texts in parts of about PART_BYTES. A part is one row with its
documents, its vocabulary and, per term, the documents that hold it and how often. Building shuffles
nothing. Statistics (documents, words, documents per term) are taken over all parts.

Search: a task puts parts together to blocks and ranks each block's documents for every query.

* Term at a time: a query's shortest lists, as many as fit in a share of the block's documents, are
  added up into accumulators. These are then one more list, whose bound is its largest sum.
* Document at a time: that list and the long ones are read window by window of documents. Lists
  whose bounds in the window do not reach the query's k-th best score together are optional: only
  documents of the others are candidates, and these are looked up in the optional lists from the
  largest bound down, as long as what is left can still lift them. A window that cannot reach the
  score is skipped whole. The bound is not strict, so equal scores of smaller doc_ids are kept.

The k best rows per query of each task meet in one window per query. Queries come to the driver
as term counts, in chunks of at most CHUNK_BYTES (or one item); each chunk is one pass over the
index, so neither the driver nor a task ever holds all queries of a large table.

A null text has no terms; a document without terms is in no result. A null doc_id is below all
others; rows that share a doc_id are ranked each for itself. Repeated items each have their rows, a
null item_id stays null. Other columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.llm.common import NO_ID, id_of, map_batches, text_of
from dropwatch.session import staged

PART_BYTES = 1 << 20  # of text, about, in a part of the index
BLOCK_PARTS = 16  # parts that a task searches together
CHUNK_BYTES = 8 << 20  # of query terms that are searched together
WINDOW = 1024  # documents that are bounded together
SHORT_SHARE = 4  # short lists have a 1/SHORT_SHARE of the block's documents, in sum
NORM = 75  # percent of the length normalisation

# Fixed value: terms of lower-cased text, as UTF-8; everything above ASCII is a letter.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

INDEX = (
    "n_docs long, n_words long, ids binary, lengths binary, vocabulary binary, ends binary, "
    "postings binary, counts binary"
)


def terms_of(raw: bytes) -> list[bytes]:
    return TERM.findall(raw.lower())  # lower() of bytes changes A-Z only


def invert(ids: list[int], texts: list[bytes]) -> tuple | None:
    """One row of the index: lists of all terms one behind another, each by document."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    found = []
    for raw in texts:
        words = terms_of(raw)
        found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    lengths = np.array([len(f) for f in found], np.int64)
    if not numbers:
        return None
    document = np.repeat(np.arange(len(texts)), lengths)
    pairs, counts = np.unique(np.concatenate(found) * len(texts) + document, return_counts=True)
    ends = np.cumsum(np.bincount(pairs // len(texts), minlength=len(numbers)))
    columns = ends.astype(np.int32), (pairs % len(texts)).astype(np.int32), counts.astype(np.int32)
    return (
        int((lengths > 0).sum()),
        int(lengths.sum()),
        np.array(ids, np.int64).tobytes(),
        lengths.tobytes(),
        b" ".join(numbers),
        *(c.tobytes() for c in columns),
    )


def build_index(docs: DataFrame) -> DataFrame:
    """The index of all rows' texts, staged."""

    def run(batch):
        rows, ids, texts, size = [], [], [], 0
        for did, raw in zip(*batch.columns, strict=True):
            ids.append(did.as_py())
            texts.append(raw.as_buffer().to_pybytes())
            size += len(texts[-1])
            if size >= PART_BYTES:
                rows.append(invert(ids, texts))
                ids, texts, size = [], [], 0
        rows.append(invert(ids, texts))
        for row in filter(None, rows):
            yield [[value] for value in row]

    rows = docs.select(id_of().alias("did"), text_of().cast("binary").alias("raw"))
    return staged(map_batches(rows, run, INDEX), "lexical-index")


Lists = dict[int, tuple[int, int]]


def lists_in(vocabulary: pa.Scalar, ends: pa.Scalar, wanted: dict[bytes, int]) -> Lists:
    """Where in a part the lists of the wanted terms start and end."""
    stop = np.frombuffer(ends.as_buffer(), np.int32)
    words = vocabulary.as_buffer().to_pybytes().split(b" ")
    held = [(k, wanted[word]) for k, word in enumerate(words) if word in wanted]
    return {term: (int(stop[k - 1]) if k else 0, int(stop[k])) for k, term in held}


def frequencies(index: DataFrame, wanted: dict[bytes, int]) -> np.ndarray:
    """The number of documents that hold each wanted term; one vector per task."""

    def run(batches):
        held = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for vocabulary, ends in zip(*batch.columns, strict=True):
                for term, (start, end) in lists_in(vocabulary, ends, wanted).items():
                    held[term] += end - start
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": found, "n": held[found]})

    total = np.zeros(len(wanted), np.int64)
    counted = index.select("vocabulary", "ends").mapInArrow(run, "term long, n long")
    for term, n in counted.groupBy("term").agg(F.sum("n")).collect():  # at most the chunk's terms
        total[term] = n
    return total


class Part:
    """A row of the index: documents, and the lists of those terms that are asked for."""

    def __init__(self, row: tuple, wanted: dict[bytes, int]):
        ids, lengths, vocabulary, ends, postings, counts = row
        self.ids, self.lengths = (np.frombuffer(x.as_buffer(), np.int64) for x in (ids, lengths))
        self.postings, self.counts = (np.frombuffer(x.as_buffer(), np.int32) for x in (postings, counts))
        self.lists = lists_in(vocabulary, ends, wanted)


def parts_of(batches, wanted: dict[bytes, int]) -> Iterator[Part]:
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            yield Part(row, wanted)


def norms(lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    longest = int(lengths.max(initial=0))
    if NORM * longest * n_docs >= 1 << 62:  # whole numbers beyond 64 bits
        return np.array([100 - NORM + NORM * n * n_docs // n_words for n in lengths.tolist()], np.int64)
    return 100 - NORM + NORM * lengths * n_docs // n_words


class Block:
    """Parts put together: for every wanted term its documents and their contributions."""

    def __init__(self, parts: list[Part], n_docs: int, n_words: int):
        self.ids = np.concatenate([p.ids for p in parts])
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        gathered, base = defaultdict(list), 0
        for part in parts:
            m = norms(part.lengths, n_docs, n_words)
            for term, (start, end) in part.lists.items():
                at, tf = part.postings[start:end], part.counts[start:end].astype(np.int64)
                gathered[term].append((at + base, 1_000_000_000 * tf // (1000 * tf + 8 * m[at])))
            base += len(part.ids)
        for term, found in gathered.items():
            self.lists[term] = tuple(np.concatenate(c) for c in zip(*found, strict=True))


class Best:
    """The k best (score, doc_id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 1  # only scores above 0 count
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.k:
            self.least = max(1, int(self.scores[-1]))


def summed(lists: list[tuple], n_docs: int) -> list[tuple]:
    """The lists with the shortest ones replaced by one list of their sums."""
    lists = sorted(lists, key=lambda x: len(x[0]))
    room = n_docs // SHORT_SHARE
    short = int(np.searchsorted(np.cumsum([len(at) for at, _ in lists]), room, side="right"))
    if short < 2:
        return lists
    sums = np.zeros(n_docs, np.int64)
    for at, values in lists[:short]:
        sums[at] += values
    at = np.flatnonzero(sums)
    return [(at, sums[at]), *lists[short:]]


def rank_block(lists: list[tuple], ids: np.ndarray, best: Best) -> None:
    """Offer the block's documents to best; lists are (documents in order, contributions)."""
    if sum(int(values.max()) for _, values in lists) < best.least:
        return
    lists = summed(lists, len(ids))
    edges = np.arange(0, len(ids) + WINDOW, WINDOW)
    cuts = [np.searchsorted(at, edges) for at, _ in lists]
    for w in range(len(edges) - 1):
        here = []
        for (at, values), cut in zip(lists, cuts, strict=True):
            if cut[w] < cut[w + 1]:
                found = values[cut[w] : cut[w + 1]]
                here.append((int(found.max()), at[cut[w] : cut[w + 1]] - edges[w], found))
        here.sort(key=lambda x: x[0])
        bounds = np.cumsum([bound for bound, _, _ in here])
        optional = int(np.searchsorted(bounds, best.least, side="left"))
        if optional == len(here):
            continue
        sums = np.zeros(WINDOW, np.int64)
        for _, at, values in here[optional:]:
            sums[at] += values
        able = np.flatnonzero(sums)
        sums = sums[able]
        for k in range(optional - 1, -1, -1):
            stay = sums + bounds[k] >= best.least
            able, sums = able[stay], sums[stay]
            _, at, values = here[k]
            place = np.minimum(np.searchsorted(at, able), len(at) - 1)
            sums = sums + np.where(at[place] == able, values[place], 0)
        stay = sums >= best.least
        if stay.any():
            best.add(sums[stay], ids[able[stay] + edges[w]])


def chunks(items: DataFrame) -> Iterator[list[tuple[int, dict[bytes, int]]]]:
    """item_id and term counts of the items, in chunks of bounded size."""

    def run(batch):
        found = [Counter(terms_of(raw.as_buffer().to_pybytes())) for raw in batch.column(1)]
        counts = [np.array(list(c.values()), np.int64).tobytes() for c in found]
        yield [batch.column(0), [b" ".join(c) for c in found], counts]

    rows = items.select(id_of("item_id").alias("item_id"), text_of().cast("binary").alias("raw"))
    counted = map_batches(rows, run, "item_id long, terms binary, counts binary").where("length(terms) > 0")
    chunk, size = [], 0
    for item, terms, counts in counted.toLocalIterator():
        words = bytes(terms).split(b" ")
        chunk.append((item, dict(zip(words, np.frombuffer(bytes(counts), np.int64).tolist(), strict=True))))
        size += len(terms) + len(counts)
        if size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def search_chunk(index: DataFrame, chunk: list[tuple[int, dict]], k: int, n_docs: int, n_words: int) -> DataFrame:
    """The k best documents for each item of one chunk."""
    wanted = {term: number for number, term in enumerate(dict.fromkeys(t for _, c in chunk for t in c))}
    df = frequencies(index, wanted)
    weights = [math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * n + 1))) for n in df.tolist()]
    # Of every item the terms that some document has and that can add to a score.
    asked = [
        [(wanted[t], weights[wanted[t]] * n) for t, n in counts.items() if df[wanted[t]] and weights[wanted[t]] > 0]
        for _, counts in chunk
    ]

    def run(batches):
        best = [Best(k) for _ in asked]

        def rank(parts):
            block = Block(parts, n_docs, n_words)
            for query, kept in zip(asked, best, strict=True):
                lists = [(*block.lists[t], weight) for t, weight in query if t in block.lists]
                if lists:
                    rank_block([(at, values * weight) for at, values, weight in lists], block.ids, kept)

        parts = []
        for part in parts_of(batches, wanted):
            parts.append(part)
            if len(parts) == BLOCK_PARTS:
                rank(parts)
                parts = []
        if parts:
            rank(parts)
        query = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
        yield pa.RecordBatch.from_pydict(
            {
                "query": query,
                "item_id": np.array([item for item, _ in chunk], np.int64)[query],
                "doc_id": np.concatenate([b.ids for b in best]),
                "score": np.concatenate([b.scores for b in best]),
            }
        )

    rows = index.select("ids", "lengths", "vocabulary", "ends", "postings", "counts")
    found = rows.mapInArrow(run, "query long, item_id long, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents with a score above 0 of every item."""
    index = build_index(docs)
    n_docs, n_words = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    spark, result = docs.sparkSession, None
    for number, chunk in enumerate(chunks(items) if n_docs else ()):
        found = staged(search_chunk(index, chunk, k, n_docs, n_words), f"lexical-{number}")
        result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    null_safe = [F.when(F.col(c) != NO_ID, F.col(c)).alias(c) for c in ("item_id", "doc_id")]
    return result.select(null_safe[0], "rank", null_safe[1], "score")
