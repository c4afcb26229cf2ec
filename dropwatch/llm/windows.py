"""Windows of fixed length that occur more than once, over sequences of any units.

Used by the suffix (bytes) and substring (words) operators. A sequence is an array of 64-bit unit
numbers. Every window of `length` units has an anchor: the leftmost least of its seeds (runs of
`seed` units), so equal windows have equal anchors at equal places, and neighbouring windows
mostly share one. The windows of one anchor form a run; runs, not windows, are shuffled.

1. Runs. Runs with the same seed and the same context (the number of all units their windows touch)
   are equal window by window: all but the first are repeats. A run whose seed occurs nowhere else
   is finished. Every task settles its own runs first and sends on one of each kind, so what a third
   of all rows share arrives once per part of a task. Runs of one seed meet in one range of seeds; where a
   part has many contexts of a seed, they meet by seed and context.
2. Windows. First runs whose seed has several contexts are compared window by window, again by
   range of seeds, or of windows where a seed has many contexts.

A text is known by did and tag, the whole 64-bit hash of the text, so rows that share a doc_id (null
ones too) keep apart. A run is a text and at: its first window's start and its number of windows. Sorting and comparing is done in arrays, within ranges whose number grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import id_of, text_of
from dropwatch.session import staged

SEGMENT = 1 << 20  # windows treated at a time within one long text
RANGE_BYTES = 4 << 20  # of runs, about, that meet in one group
PART_BYTES = 8 << 20  # of text, about, whose runs a task holds at a time
MANY = 16  # contexts of a seed in a batch, from which on they are spread
MOST = 4096  # the same in a range
RUN_BITS = 7  # of a run's number of windows

A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def combine(a, b):
    """The number of a pair: of two neighbouring runs of units, whose numbers are known."""
    x = a * A + (b ^ (b >> np.uint64(31))) * B
    x ^= x >> np.uint64(32)
    x *= C
    return x ^ (x >> np.uint64(29))


@dataclass(frozen=True)
class Shape:
    length: int  # units of a window
    seed: int  # units of a seed
    units: Callable[[memoryview], np.ndarray]  # the units of a text's bytes, as they are shuffled
    number: Callable[[np.ndarray], np.ndarray]  # 64-bit numbers of units
    by_document: bool  # a repeat must begin in a smaller document (else also earlier in the same)


def seed_numbers(units: np.ndarray, seed: int) -> np.ndarray:
    """Numbers of all runs of `seed` units, each made of the numbers of two shorter runs."""
    ids, n = units, 1
    while n < seed:
        step = min(n, seed - n)
        ids = combine(ids[:-step], ids[step:]) if len(ids) > step else ids[:0]
        n += step
    return ids


def window_numbers(ids: np.ndarray, at: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each window that starts in `at`: of its first and of its last part, which
    overlap. Numbers of longer runs are looked up at later offsets of shorter ones."""
    n = shape.seed
    while 2 * n < shape.length:
        n *= 2

    def number(at: np.ndarray, n: int) -> np.ndarray:
        return ids[at] if n == shape.seed else combine(number(at, n // 2), number(at + n // 2, n // 2))

    n = n if n <= shape.length else n // 2
    return number(at, n), number(at + (shape.length - n), n)


def anchors(ids: np.ndarray, windows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each run; width: seeds in a window."""
    n = windows + width - 1
    mask = np.uint64((2 * SEGMENT) - 1)
    keys = (ids[:n] & ~mask) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, ~np.uint64(0))
    padded[:n] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & mask
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    return least[first].astype(np.int64), first, np.diff(np.append(first, windows))


def runs(ids: np.ndarray, shape: Shape):
    """Seed number, context number, first window and windows of every run of one text."""
    total = len(ids) - (shape.length - shape.seed)
    out = []
    for start in range(0, max(0, total), SEGMENT):
        part = ids[start : start + SEGMENT + shape.length - shape.seed]
        anchor, first, n = anchors(part, min(SEGMENT, total - start), shape.length - shape.seed + 1)
        low, high = window_numbers(part, first, shape), window_numbers(part, first + n - 1, shape)
        context = combine(combine(low[0], low[1]), combine(high[0], high[1]))
        context = combine(context, ((anchor - first) * 1024 + n).astype(np.uint64))
        out.append((part[anchor], context, first + start, n))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None


def _pack(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << RUN_BITS) | n


def keyed(docs: DataFrame) -> DataFrame:
    """did, tag (tells texts of one doc_id apart), raw (the text's bytes) of every row."""
    text = text_of()
    return docs.select(id_of().alias("did"), F.xxhash64(text).alias("tag"), text.cast("binary").alias("raw"))


def packed(rows: DataFrame) -> DataFrame:
    """The same with raw compressed, for a shuffle of the texts."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            small = [pack(raw.as_buffer()) for raw in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(small, pa.binary())], names=["did", "tag", "raw"]
            )

    return rows.mapInArrow(run, "did long, tag long, raw binary")


def unpacked(raw: pa.Scalar) -> memoryview:
    return memoryview(zstandard.ZstdDecompressor().decompress(raw.as_buffer()))


def firsts(keys: tuple[np.ndarray, ...], places: tuple[np.ndarray, ...], shape: Shape):
    """Order by keys, then places (did, tag, at); and in that order, which rows begin an equal class
    and which are repeats."""
    order = np.lexsort((*reversed(places), *reversed(keys)))
    head = np.zeros(len(order), bool)
    head[:1] = True
    for k in keys:
        head[1:] |= k[order][1:] != k[order][:-1]
    if not len(order):
        return order, head, head
    first = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
    repeat = np.zeros(len(order), bool)
    for place in places[: 1 if shape.by_document else None]:
        repeat |= place[order] != place[first]
    return order, head, repeat


def _spread(key: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each key. Anchors are least seeds, so their numbers are small: mixed once more."""
    x = combine(key.view(np.uint64), key.view(np.uint64))
    return (((x >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


BLOBS = "kind int, r int, a binary, b binary, did binary, tag binary, at binary"
NAMES = ("a", "b", "did", "tag", "at")
BLOB_SCHEMA = pa.schema([("kind", pa.int32()), ("r", pa.int32()), *((n, pa.binary()) for n in NAMES)])


def _blobs(kind: int, r: np.ndarray, columns: tuple[np.ndarray, ...], ranges: int) -> list[tuple]:
    """One row per range with the columns' values there, in the order of documents."""
    order = np.lexsort((*columns[:1:-1], r))
    edges = np.searchsorted(r[order], np.arange(ranges + 1))
    columns = [c[order] for c in columns]
    return [
        (kind, k, *(c[x:y].tobytes() for c in columns))
        for k, (x, y) in enumerate(zip(edges, edges[1:], strict=False))
        if x < y
    ]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), BLOB_SCHEMA.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=BLOB_SCHEMA)


def _gather(group: pa.Table, kind: int, names=NAMES) -> list[np.ndarray]:
    mine = group.filter(pa.compute.equal(group.column("kind"), kind))
    return [
        np.concatenate([*(np.frombuffer(x.as_buffer(), np.int64) for x in mine.column(n)), np.zeros(0, np.int64)])
        for n in names
    ]


RUN, SPREAD, REPEAT, WINDOWS = range(4)


def _parts(batch: pa.RecordBatch):
    """A batch in slices of about PART_BYTES of its column raw, so that memory stays bounded."""
    start, size = 0, 0
    for k, raw in enumerate(batch.column("raw")):
        size += raw.as_buffer().size
        if size >= PART_BYTES:
            yield batch.slice(start, k + 1 - start)
            start, size = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _send(shape: Shape, ranges: int):
    """Per batch: repeats within it; of the others, the first run of each seed and context."""

    def run(batches):
        for batch in (part for whole in batches for part in _parts(whole)):
            parts = []
            for did, tag, raw in zip(*batch.columns, strict=True):
                units = shape.number(shape.units(memoryview(raw.as_buffer())))
                found = runs(seed_numbers(units, shape.seed), shape)
                if found is not None:
                    seed, context, start, n = found
                    text = (np.full(len(seed), x.as_py()) for x in (did, tag))
                    parts.append((seed, context, *text, _pack(start, n)))
            if not parts:
                continue
            seed, context, *places = (np.concatenate(c) for c in zip(*parts, strict=True))
            parts.clear()
            seed, context = seed.view(np.int64), context.view(np.int64)
            order, head, repeat = firsts((seed, context), tuple(places), shape)
            seed, context, *places = (c[order] for c in (seed, context, *places))
            gone = [c[repeat] for c in places]
            rows = _blobs(REPEAT, np.full(len(gone[0]), abs(int(places[0][0])) % ranges), (gone[0], gone[0], *gone), ranges)
            new = np.append(True, seed[1:] != seed[:-1])
            contexts = np.add.reduceat(head, np.flatnonzero(new))[np.cumsum(new) - 1]
            many, stay = ~repeat & (contexts > MANY), ~repeat & (contexts <= MANY)
            rows += _blobs(RUN, _spread(seed[stay], ranges), tuple(c[stay] for c in (seed, context, *places)), ranges)
            if many.any():
                spread = tuple(c[many] for c in (seed, context, *places))
                both = combine(spread[0].view(np.uint64), spread[1].view(np.uint64))
                rows += _blobs(SPREAD, _spread(both, ranges), spread, ranges)
                # A mark (at = -1) tells the seed's range that its other contexts are elsewhere.
                marked = np.unique(spread[0])
                mark = np.full(len(marked), -1)
                rows += _blobs(RUN, _spread(marked, ranges), (marked, mark, mark, mark, mark), ranges)
            yield _batch(rows)

    return run


DONE, COLD, HOT = range(3)
SETTLED = "state int, seed long, did long, tag long, at long"


def _meet_runs(shape: Shape):
    """Of the runs of one range: repeats, and first runs whose seed has several contexts."""

    def states(seed, context, *places, spread: bool):
        order, head, repeat = firsts((seed, context), places, shape)
        seed, *places = (c[order] for c in (seed, *places))
        if not len(seed):
            return seed, seed, *places
        new = np.append(True, seed[1:] != seed[:-1])
        number = np.cumsum(new) - 1
        mark = places[-1] == -1
        contexts = np.add.reduceat(head & ~mark, np.flatnonzero(new))[number]
        told = np.logical_or.reduceat(mark, np.flatnonzero(new))[number]
        hot = told | (contexts > MOST) | spread
        state = np.where(repeat, DONE, np.where(hot, HOT, COLD))
        keep = ~mark & (repeat | (contexts > 1) | hot)
        return state[keep], seed[keep], *(c[keep] for c in places)

    def run(group: pa.Table) -> pa.Table:
        _, _, *told = _gather(group, REPEAT)
        parts = [
            states(*_gather(group, RUN), spread=False),
            states(*_gather(group, SPREAD), spread=True),
            (np.full(len(told[0]), DONE), np.zeros(len(told[0]), np.int64), *told),
        ]
        state, *rest = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.table(dict(zip(("state", "seed", "did", "tag", "at"), (state.astype(np.int32), *rest), strict=True)))

    return run


def _windows(packed_runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the runs: which run it is of, and its place among the run's."""
    n = packed_runs & ((1 << RUN_BITS) - 1)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _cut(shape: Shape, ranges: int):
    """The contexts of the open runs, by range of seeds; of spread seeds the windows' numbers."""

    def run(batches):
        for batch in (part for whole in batches for part in _parts(whole)):
            cold, hot = [], []
            for did, tag, raw, items in zip(*batch.columns, strict=True):
                listed = items.values
                at, seed, state = (listed.field(n).to_numpy() for n in ("item", "seed", "state"))
                order = np.lexsort((at, state))
                at, seed, state = at[order], seed[order], state[order]
                units = shape.units(unpacked(raw))
                did, tag = did.as_py(), tag.as_py()
                for item, key in zip(at[state == COLD].tolist(), seed[state == COLD], strict=True):
                    start, n = item >> RUN_BITS, item & ((1 << RUN_BITS) - 1)
                    cold.append((key, units[start : start + n - 1 + shape.length].tobytes(), did, tag, item))
                wide = at[state == HOT]
                if len(wide):
                    owner, place = _windows(wide)
                    start = (wide >> RUN_BITS)[owner] + place
                    w1, w2 = window_numbers(seed_numbers(shape.number(units), shape.seed), start, shape)
                    text = (np.full(len(start), x) for x in (did, tag))
                    hot.append((w1.view(np.int64), w2.view(np.int64), *text, _pack(start, np.ones_like(start))))
            rows = []
            if cold:
                r = _spread(np.array([c[0] for c in cold], np.int64), ranges)
                for k in np.unique(r).tolist():
                    mine = [cold[i] for i in np.flatnonzero(r == k)]
                    columns = zip(*((len(c[1]), *c[2:]) for c in mine), strict=True)
                    text = b"".join(c[1] for c in mine)
                    rows.append((RUN, k, text, *(np.array(x, np.int64).tobytes() for x in columns)))
            if hot:
                w1, w2, *places = (np.concatenate(c) for c in zip(*hot, strict=True))
                order, _, repeat = firsts((w1, w2), tuple(places), shape)
                gone, stay = [c[order[repeat]] for c in places], order[~repeat]
                rows += _blobs(REPEAT, np.full(len(gone[0]), abs(int(places[0][0])) % ranges), (gone[0], gone[0], *gone), ranges)
                rows += _blobs(WINDOWS, _spread(w1[stay], ranges), tuple(c[stay] for c in (w1, w2, *places)), ranges)
            if rows:
                yield _batch(rows)

    return run


def _meet_windows(shape: Shape, dtype):
    """The repeats among the windows of one range, as runs of one window or more."""

    def run(group: pa.Table) -> pa.Table:
        mine = group.filter(pa.compute.equal(group.column("kind"), RUN))
        text = b"".join(x.as_py() for x in mine.column("a"))
        sizes, did, tag, at = _gather(group, RUN, NAMES[1:])
        units = np.frombuffer(text, dtype)
        begin = (np.cumsum(sizes) - sizes) // units.itemsize
        owner, place = _windows(at)
        ids = seed_numbers(shape.number(units), shape.seed)
        w1, w2 = window_numbers(ids, begin[owner] + place, shape)
        more = _gather(group, WINDOWS)
        w1, w2 = (np.concatenate([w.view(np.int64), m]) for w, m in zip((w1, w2), more[:2], strict=True))
        start = (at[owner] >> RUN_BITS) + place
        places = did[owner], tag[owner], _pack(start, np.ones_like(start))
        places = tuple(np.concatenate(c) for c in zip(places, more[2:], strict=True))
        order, _, repeat = firsts((w1, w2), places, shape)
        told = _gather(group, REPEAT)[2:]
        found = (np.append(c[order[repeat]], t) for c, t in zip(places, told, strict=True))
        return pa.table(dict(zip(("did", "tag", "at"), _joined(*found), strict=True)))

    return run


def _joined(did: np.ndarray, tag: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Single windows as runs of neighbours, as long as a run can be."""
    order = np.lexsort((at, tag, did))
    did, tag, start = did[order], tag[order], at[order] >> RUN_BITS
    new = np.append(True, (did[1:] != did[:-1]) | (tag[1:] != tag[:-1])) if len(did) else np.zeros(0, bool)
    keep = new.copy()
    keep[1:] |= start[1:] != start[:-1]
    did, tag, start, new = did[keep], tag[keep], start[keep], new[keep]
    step = new.copy()
    step[1:] |= start[1:] != start[:-1] + 1
    since = np.arange(len(did)) - np.flatnonzero(step)[np.cumsum(step) - 1] if len(did) else start
    head = since % ((1 << RUN_BITS) - 1) == 0
    n = np.diff(np.append(np.flatnonzero(head), len(did)))
    return did[head], tag[head], _pack(start[head], n)


def repeats(rows: DataFrame, shape: Shape, dtype) -> DataFrame:
    """did, tag, items (packed runs of window starts that are repeats) of the texts that have any;
    dtype: of shape.units."""
    size = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    ranges = int(size / (shape.length - shape.seed) * 64 / RANGE_BYTES) + 1
    sent = rows.mapInArrow(_send(shape, ranges), BLOBS)
    settled = staged(sent.groupBy("r").applyInArrow(_meet_runs(shape), SETTLED), "settled-runs")
    listed = F.collect_list(F.struct(F.col("at").alias("item"), "seed", "state")).alias("items")
    open_runs = settled.where(F.col("state") != DONE).groupBy("did", "tag").agg(listed)
    texts = packed(rows).join(open_runs, ["did", "tag"]).select("did", "tag", "raw", "items")
    cut = texts.mapInArrow(_cut(shape, ranges), BLOBS)
    single = cut.groupBy("r").applyInArrow(_meet_windows(shape, dtype), "did long, tag long, at long")
    both = settled.where(F.col("state") == DONE).select("did", "tag", "at").unionByName(single)
    return both.groupBy("did", "tag").agg(F.collect_list("at").alias("items"))


def covered(items: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n units lie in a window that starts in one of the packed runs."""
    steps = np.zeros(n + 1, np.int32)
    first, windows = items >> RUN_BITS, items & ((1 << RUN_BITS) - 1)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + windows - 1 + length, -1)
    return np.cumsum(steps[:-1]) > 0
