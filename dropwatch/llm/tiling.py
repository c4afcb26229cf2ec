"""Benchmark decontamination by greedy string tiling.

Words (letters, digits, lower case; in scripts without spaces each character) of documents and
benchmark items meet in shared seeds of SEED words, or of all words of an item that has fewer. For each document and item that share one, the longest common run of unmarked words is
marked, again and again, until no run of SEED words is left: these tiles do not overlap, and they
catch an item whose passages appear in another order. A pair is a leak if its tiles cover at least
COVERAGE of the item's words.

Common runs are found by Karp-Rabin: rolling hashes of all windows of SEED words, equal hashes
confirmed word by word; neighbouring hits on one diagonal are one longer run.

A benchmark of up to SMALL characters is sent to every task and the documents are never shuffled.
A larger one is joined: the documents' seeds with the items' seeds, then the pairs with their
texts. Both ways give the same rows.

A null text has no words. Items without words match nothing. An item of fewer than SEED words leaks
where all its words stand together; if they have fewer than LEAST_CHARS characters in all, they are
no passage of their own, and the item leaks into texts only that have no other words. A null doc_id or item_id stays null in the result. Repeated documents each give their rows; rows that
share an item_id are items of their own. Of equally long runs the first in the item, then in the
document, is marked first. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import id_of, map_batches, text_of, unused

SEED = 5
COVERAGE = 0.5
SMALL = 16 << 20
LEAST_CHARS = 12  # of an item of fewer than SEED words that is looked for among other words
# Thai, Lao, Burmese, Khmer, kana and Han characters.
SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[{SPACELESS}]|[^\W{SPACELESS}]+")
BASE = np.uint64(0x100000001B3)
SCHEMA = "doc_id long, item_id long, coverage double, n_tiles long, longest_tile long"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, width: int = SEED) -> np.ndarray:
    """Polynomial hashes of all windows of a sequence of word numbers."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total = total * BASE + ids[j : n + j]
    total ^= np.uint64(width << 56)
    return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def common_runs(
    item: np.ndarray, doc: np.ndarray, hashes: np.ndarray, places: np.ndarray, width: int = SEED
) -> list[tuple]:
    """Maximal common runs of width words and more: (length, start in item, start in doc).

    hashes and places: the document's windows that can be in an item, and where they start.
    """
    own = rolling(item, width)
    order = np.argsort(own, kind="stable")
    low = np.searchsorted(own[order], hashes, "left")
    high = np.searchsorted(own[order], hashes, "right")
    times = high - low
    at = np.repeat(places, times)
    steps = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    mine = order[np.repeat(low, times) + steps]
    same = np.ones(len(at), bool)
    for j in range(width):
        same &= item[mine + j] == doc[at + j]
    at, mine = at[same], mine[same]
    if not len(at):
        return []
    by_diagonal = np.lexsort((mine, at - mine))
    at, mine = at[by_diagonal], mine[by_diagonal]
    breaks = (np.diff(at - mine) != 0) | (np.diff(mine) != 1)
    first = np.flatnonzero(np.append(True, breaks))
    last = np.append(first[1:], len(at)) - 1
    return [
        (int(mine[b] - mine[a]) + width, int(mine[a]), int(at[a])) for a, b in zip(first, last, strict=True)
    ]


def tiles(runs: list[tuple], n_item: int, width: int = SEED) -> list[tuple]:
    """Mark the longest run of unmarked words until none of width words is left."""
    heap = [(-n, i, j) for n, i, j in runs]
    heapq.heapify(heap)
    in_item, in_doc, out = bytearray(n_item), set(), []
    while heap:
        n, i, j = heapq.heappop(heap)
        free = [k for k in range(-n) if not in_item[i + k] and j + k not in in_doc]
        if len(free) == -n:
            out.append((-n, i, j))
            in_item[i : i - n] = b"\x01" * -n
            in_doc.update(range(j, j - n))
            continue
        start = 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= width:
                    heapq.heappush(heap, (start - k, i + free[start], j + free[start]))
                start = k
    return out


@dataclass
class Items:
    """Benchmark items as word numbers (from 1; 0 is a word of no item), and who has which seed."""

    rows: list[tuple[int | None, str | None]]

    def __post_init__(self):
        self.number: dict[str, int] = {}
        self.ids, self.alone, windows = [], [], {}
        for k, (_, text) in enumerate(self.rows):
            words = words_of(text)
            found = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            self.ids.append(np.array(found, np.uint64))
            self.alone.append(len(words) < SEED and sum(map(len, words)) < LEAST_CHARS)
            if words:
                width = min(SEED, len(words))
                windows.setdefault(width, []).append((k, rolling(self.ids[-1], width)))
        self.tables = []  # width, seeds in order, their items
        for width, found in sorted(windows.items()):
            seeds = np.concatenate([w for _, w in found])
            owner = np.repeat([k for k, _ in found], [len(w) for _, w in found])
            order = np.argsort(seeds, kind="stable")
            self.tables.append((width, seeds[order], owner[order]))

    def leaks(self, text: str | None, coverage: float) -> list[tuple]:
        """(item number, share covered, tiles, longest) of the items that leak into a text."""
        number = self.number
        doc = np.array([number.get(w, 0) for w in words_of(text)], np.uint64)
        out = []
        for width, seeds, owner in self.tables:
            hashes = rolling(doc, width)
            near = np.minimum(np.searchsorted(seeds, hashes), len(seeds) - 1)
            places = np.flatnonzero(seeds[near] == hashes)
            if not len(places):
                continue
            hashes = hashes[places]
            low, high = (np.searchsorted(seeds, hashes, side) for side in ("left", "right"))
            spans = set(zip(low.tolist(), high.tolist(), strict=True))
            for k in sorted({int(o) for a, b in spans for o in owner[a:b]}):
                item = self.ids[k]
                if self.alone[k] and len(doc) != len(item):
                    continue
                found = tiles(common_runs(item, doc, hashes, places, width), len(item), width)
                share = sum(t[0] for t in found) / len(item)
                if share >= coverage:
                    out.append((k, share, len(found), max(t[0] for t in found)))
        return sorted(out)


def small_items(benchmark: DataFrame) -> Items | None:
    """The items, if they are few enough to send to every task."""
    rows = benchmark.select(benchmark["item_id"].cast("long"), text_of().alias("text"))
    size = rows.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    return Items([(r.item_id, r.text) for r in rows.collect()]) if size <= SMALL else None


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """A row for every document and item with a leak."""
    items = small_items(benchmark)
    if items is None:
        return leaks_by_join(docs, benchmark, coverage)

    def run(batch):
        out = [
            (doc_id, items.rows[k][0], *found)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            for k, *found in items.leaks(text.as_py(), coverage)
        ]
        if out:
            yield [list(c) for c in zip(*out, strict=True)]

    return map_batches(docs.select(docs["doc_id"].cast("long"), text_of().alias("text")), run, SCHEMA)


def _seeds(rows: DataFrame, name: str, widths: list[int] | None = None) -> DataFrame:
    """Distinct seed hashes of each row's text: of the widths, or as an item."""

    def run(batch):
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            words = words_of(text.as_py())
            ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            own = [min(SEED, len(words))] if words else []
            hashes = [rolling(ids, width) for width in (own if widths is None else widths)]
            found = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)])).view(np.int64)
            yield [[key.as_py()] * len(found), found]

    return map_batches(rows.select(name, "text"), run, f"{name} long, seed long")


def _widths(items: DataFrame) -> list[int]:
    """The widths of the items' seeds, SEED values at most."""

    def run(batch):
        n = {min(SEED, len(words_of(text.as_py()))) for text in batch.column(0)}
        yield [sorted(n - {0})]

    return sorted(r.width for r in map_batches(items.select("text"), run, "width int").distinct().collect())


def leaks_by_join(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The same for a benchmark of any size: seeds are joined, then the texts of the pairs."""
    return _keyed_leaks(docs, benchmark, coverage).drop("key")


def _keyed_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """leaks_by_join with key, xxhash64 of the document's text: rows that share a doc_id may differ."""
    texts = docs.select(docs["doc_id"].cast("long"), text_of().alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    items = benchmark.select(benchmark["item_id"].cast("long"), text_of().alias("text"))
    items = items.withColumn("item", F.xxhash64("text"))
    doc_seeds = _seeds(texts.dropDuplicates(["key"]), "key", _widths(items))
    pairs = doc_seeds.join(_seeds(items.dropDuplicates(["item"]), "item"), "seed").select("key", "item").distinct()
    item_texts = items.select("item", "item_id", F.col("text").alias("item_text"))
    both = pairs.join(item_texts, "item").join(texts, "key").select("doc_id", "text", "item_id", "item_text", "key")

    def run(batch):
        out = []
        for doc_id, text, item_id, item_text, key in zip(*batch.columns, strict=True):
            item = Items([(item_id.as_py(), item_text.as_py())])
            for _, *found in item.leaks(text.as_py(), coverage):
                out.append((doc_id.as_py(), item_id.as_py(), *found, key.as_py()))
        if out:
            yield [list(c) for c in zip(*out, strict=True)]

    return map_batches(both, run, SCHEMA + ", key long")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of docs, all columns, without those into which an item leaks."""
    items = small_items(benchmark)
    if items is None:
        did, key = unused(docs, "did"), unused(docs, "key")
        bad = _keyed_leaks(docs, benchmark, coverage).select(id_of().alias(did), F.col("key").alias(key)).distinct()
        rows = docs.withColumns({did: id_of(), key: F.xxhash64(text_of())})
        return rows.join(bad, [did, key], "left_anti").select(docs.columns)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            clean = [not items.leaks(text.as_py(), coverage) for text in batch.column(place)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
