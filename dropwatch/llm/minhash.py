"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union-find grouping.

A document's set holds its distinct k-word shingles (ASCII lower-cased words between ASCII white
space; with fewer than k words, the whole sequence). Documents with equal sets form one class and
go on as one. In a SuperMinHash signature every shingle gives each slot a rank of one random
permutation plus a fraction; a slot keeps the least. Ranks are tried in rising order and stop when
no slot can fall any more. Classes that agree in all ROWS slots of a band meet in a bucket; a pair
with similarity 0.8 meets in none of the BANDS with a chance under one in a million.

Links are confirmed on the full sets. First every class is compared with the leader of each of its
buckets, the class that meets most others. Classes of one leader that are then in different groups are compared
only if the shingles that come first in both, those that the leader lacks before all others, allow
the similarity (an exact prefix and position filter). So a group of thousands of near copies, close
or loose, costs about one comparison each. What is lost are only pairs that meet in no band.

Links are between classes, never between doc_ids, as texts that differ may share one or have none.
A null or wordless text has the empty set and is linked with nothing. A null doc_id is below all
others (its component is null). Rows that share a doc_id share a component, but only texts that are
linked replace each other: of them the one with the least doc_id, then the least tkey, is kept.
Repeated rows each give a row. Other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import NO_ID, id_of, map_batches, text_of
from dropwatch.session import staged

ROWS = 6
BANDS = 48
SLOTS = ROWS * BANDS
BLOCK = 4096  # shingles whose permutations are in memory at a time
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, k: int) -> np.ndarray:
    """The sorted distinct 64-bit numbers of a text's k-word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        total = mixed(total * MIX + h[j : len(h) - width + 1 + j])
    return np.unique(total)


def signature(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of a non-empty set: slot k holds the least rank + fraction over the elements."""
    best = np.full(slots, np.inf)
    for at in range(0, len(elements), BLOCK):
        part = elements[at : at + BLOCK]
        order = np.tile(np.arange(slots, dtype=np.uint16), (len(part), 1))
        rows = np.arange(len(part))
        for rank in range(slots):
            if rank > best.max():
                break
            draw = mixed(part + np.uint64((int(MIX) * (rank + 1)) & (2**64 - 1)))
            pick = rank + ((draw >> np.uint64(40)) % np.uint64(slots - rank)).astype(np.int64)
            slot = order[rows, pick]
            order[rows, pick] = order[:, rank]
            value = rank + (draw & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32
            np.minimum.at(best, slot, value)
    return best


def band_keys(best: np.ndarray) -> np.ndarray:
    rows = best.view(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * MIX + rows[:, j])
    return key.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection >= 80 * union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def _sketch(docs: DataFrame, k: int) -> DataFrame:
    """did, tkey, n, s1, s2 (digest of the set), bands (binary, null for the empty set)."""

    def run(batch):
        n, s1, s2, bands = [], [], [], []
        for text in batch.column(2):
            elements = shingles(text.as_py(), k)
            digest = np.frombuffer(hashlib.blake2b(elements.tobytes(), digest_size=16).digest(), np.int64)
            n.append(len(elements))
            s1.append(int(digest[0]))
            s2.append(int(digest[1]))
            bands.append(band_keys(signature(elements)).tobytes() if len(elements) else None)
        yield [batch.column(0), batch.column(1), n, s1, s2, bands]

    return map_batches(docs, run, "did long, tkey long, n long, s1 long, s2 long, bands binary")


def _buckets(classes: DataFrame) -> DataFrame:
    def run(batch):
        for node, n, bands in zip(*batch.columns, strict=True):
            keys = np.frombuffer(bands.as_py(), np.int64)
            yield [keys, np.full(len(keys), node.as_py()), np.full(len(keys), n.as_py())]

    def gathered(batch):
        parts = list(run(batch))
        if parts:
            yield [np.concatenate(c) for c in zip(*parts, strict=True)]

    return map_batches(classes.select("node", "n", "bands"), gathered, "bucket long, node long, n long")


def _close_in_size():
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return 100 * small >= 80 * large


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batch):
        known: dict[int, np.ndarray] = {}
        kept_a, kept_b = [], []
        for a, b, a_text, b_text in zip(*batch.columns, strict=True):
            a, b = a.as_py(), b.as_py()
            for node, text in ((a, a_text), (b, b_text)):
                if node not in known:
                    if len(known) >= 64:
                        known.clear()
                    known[node] = shingles(text.as_py(), k)
            if a not in known:
                known[a] = shingles(a_text.as_py(), k)
            if similar(known[a], known[b]):
                kept_a.append(a)
                kept_b.append(b)
        yield [kept_a, kept_b]

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "a_text", "b_text")
    return map_batches(joined, run, "a long, b long")


PREFIXES = "leader long, shingle long, node long, n long, place long, g long, stray boolean"


def _prefixes(members: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """The first shingles of each member, those that its leader lacks before all others.

    Two sets with similarity 0.8 share one of the first n - ceil(0.8 n) + 1 shingles of each, in
    whatever order, as long as it is the same for both.
    """

    def run(batch):
        for leader, node, g, stray, l_text, text in zip(*batch.columns, strict=True):
            own, its = shingles(text.as_py(), k), shingles(l_text.as_py(), k)
            n = len(own)
            ordered = np.concatenate([np.setdiff1d(own, its, assume_unique=True), np.intersect1d(own, its)])
            first = ordered[: n - -(-4 * n // 5) + 1].view(np.int64)
            same = lambda x, m=len(first): np.full(m, x)
            yield [
                same(leader.as_py()), first, same(node.as_py()), same(n), np.arange(len(first)),
                same(g.as_py()), same(stray.as_py()),
            ]

    def gathered(batch):
        parts = []
        for columns in run(batch):
            parts.append(columns)
            if len(parts) == 500:
                yield [np.concatenate(c) for c in zip(*parts, strict=True)]
                parts = []
        if parts:
            yield [np.concatenate(c) for c in zip(*parts, strict=True)]

    left = texts.select(F.col("node").alias("leader"), F.col("text").alias("l_text"))
    joined = members.join(texts, "node").join(left, "leader")
    return map_batches(joined.select("leader", "node", "g", "stray", "l_text", "text"), gathered, PREFIXES)


def _unsettled(met: DataFrame, grouped: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Pairs (a, b) of one leader, but of different groups, that can still be similar enough.

    Comparing all of them would square the size of a family of loose copies. What a copy does not
    share with its leader tells copies apart, so pairs must share a shingle among their first ones,
    at a place behind which enough shingles are left (an exact prefix and position filter). Pairs
    within the leader's group are settled, so one of the two is always a stray.
    """
    members = met.select(F.col("leader.node").alias("leader"), "node").distinct()
    component = grouped.select(F.col("node").alias("leader"), F.col("component").alias("leader_g"))
    members = (
        members.join(grouped, "node", "left")
        .join(component, "leader", "left")
        .select(
            "leader",
            "node",
            F.coalesce("component", "node").alias("g"),
            (F.coalesce("component", "node") != F.coalesce("leader_g", "leader")).alias("stray"),
        )
    )
    members = staged(members, "minhash-members")
    open_ = members.where("stray").select("leader").distinct()
    prefixes = _prefixes(members.join(open_, "leader", "left_semi"), texts, k)
    prefixes = staged(prefixes, "minhash-prefixes")
    # Shingles that a single member has first join nothing.
    held = prefixes.groupBy("leader", "shingle").agg(F.count("*").alias("m"), F.max("stray").alias("any"))
    shared = prefixes.join(held.where("m > 1 AND any").select("leader", "shingle"), ["leader", "shingle"], "left_semi")
    shared = staged(shared, "minhash-shared")
    side = lambda x: [F.col(c).alias(f"{x}_{c}") for c in ("node", "n", "place", "g", "stray")]
    left = shared.where("stray").select("leader", "shingle", *side("a"))
    both = left.join(shared.select("leader", "shingle", *side("b")), ["leader", "shingle"])
    left_over = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    enough = (F.col("a_g") != F.col("b_g")) & (9 * left_over >= 4 * (F.col("a_n") + F.col("b_n")))
    once = ~F.col("b_stray") | (F.col("a_node") < F.col("b_node"))
    found = both.where(enough & once & _close_in_size())
    return found.select(
        F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")
    ).distinct()


def _forest(batches):
    """Union-find over the links of one partition: every node with the least of its group."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_pydict(
        {"a": pa.array(nodes, pa.int64()), "b": pa.array([root(x) for x in nodes], pa.int64())}
    )


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node it reaches) for every node with a link (a, b).

    Union-find shrinks the links of each partition to stars; then large-star and small-star steps
    (each node points its larger, then its smaller neighbours to the least one) join the stars of
    all partitions, until nothing changes.
    """
    stars = staged(links.select("a", "b").mapInArrow(_forest, "a long, b long"), "links")
    seen = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        turned = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = staged(turned.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        check = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == seen:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = check


def _by_doc_id(found: DataFrame) -> DataFrame:
    """found, where all rows of a did have the least component that their texts reach."""
    ends = found.groupBy("did").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    if not ends.where("low < high").take(1):
        return found
    links = found.where("did != component").select(F.col("did").alias("a"), F.col("component").alias("b"))
    shared = components(links.distinct()).select(F.col("node").alias("did"), F.col("component").alias("least"))
    joined = found.join(shared, "did", "left")
    return joined.withColumn("component", F.coalesce("least", "did")).drop("least")


def groups(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs; tkey is xxhash64 of its text."""
    rows = docs.select(id_of().alias("did"), text_of().alias("text"))
    rows = rows.select("did", F.xxhash64("text").alias("tkey"), "text")
    sketches = staged(_sketch(rows, k), "minhash-sketches")
    filled = sketches.where("n > 0")
    classes = staged(
        filled.groupBy("s1", "s2").agg(
            F.min(F.struct("did", "tkey")).alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ).select("s1", "s2", "least", F.monotonically_increasing_id().alias("node"), "n", "bands"),
        "minhash-classes",
    )
    buckets = _buckets(classes)
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = staged(buckets.join(sizes, "bucket"), "minhash-shared")
    # A bucket's leader is the class that meets most others in all its buckets: a central one.
    # The node numbers differ from run to run; ties are settled by what does not.
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    weights = weights.join(classes.select("node", F.struct("s1", "s2").alias("order")), "node")
    leaders = shared.join(weights, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", "order", "node", "n")).alias("leader")
    )
    met = staged(shared.join(leaders, "bucket").select("bucket", "node", "n", "leader"), "minhash-met")
    needed = met.select("node").distinct().join(classes.select("node", "least.did", "least.tkey"), "node")
    texts = staged(
        rows.join(needed, ["did", "tkey"]).select("node", "text").dropDuplicates(["node"]),
        "minhash-texts",
    )
    pairs = met.select(
        F.col("leader.node").alias("a"), F.col("node").alias("b"), F.col("leader.n").alias("a_n"), F.col("n").alias("b_n")
    )
    pairs = pairs.where((F.col("a") != F.col("b")) & _close_in_size())
    first = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = staged(first, "minhash-pairs")
    links = staged(_confirmed(first, texts, k), "minhash-links")
    grouped = components(links)
    rest = _unsettled(met, grouped, texts, k).join(first, ["a", "b"], "left_anti")
    more = staged(_confirmed(staged(rest, "minhash-rest"), texts, k), "minhash-more")
    grouped = components(links.unionByName(more)) if more.take(1) else grouped
    by_class = classes.join(grouped, "node", "left").select(
        "s1", "s2", "least", F.coalesce("component", "node").alias("g")
    )
    first_of = by_class.groupBy("g").agg(F.min("least").alias("stays"))
    by_class = by_class.join(first_of, "g").select("s1", "s2", "stays")
    own = F.struct("did", "tkey")
    found = sketches.join(by_class, ["s1", "s2"], "left").withColumn("stays", F.coalesce("stays", own))
    found = found.select(
        "did", "n", F.col("stays.did").alias("component"), (own == F.col("stays")).alias("kept"), "tkey"
    )
    found = _by_doc_id(staged(found, "minhash-found"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(
        real("did").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        real("component").alias("component_id"),
        "kept",
        "tkey",
    )
