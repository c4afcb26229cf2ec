"""Personal data: fixed kinds, and identifiers found by bootstrapped contexts.

The base kinds (email, ip, card, phone) are found by rule in the whole text. They are the seeds:
what stands around them are lexical patterns (the word before with the word after, the two words
before, the word before). Any other word of LEAST_CHARS characters in such a place is a possible
instance. Spark scores the graph of patterns and instances in rounds, until nothing is added:

* Known instances are the seeds, with score 1, and the instances accepted so far. A pattern's trust
  is the sum of its known instances' scores over that sum plus one: unknown instances are neutral,
  and a pattern with few known ones scores little. It must reach TRUSTED, and known instances must
  make up LEAST_SHARE of all places of the pattern, which the words before ordinary words do not.
* An instance's score is the chance that not all of its trusted patterns are wrong. It is accepted
  (kind ``id``) if at least LEAST_INSIDE of its places in the corpus lie in trusted patterns, which
  those of ordinary words do not. Its other places give new patterns.

Each step that looks for patterns or instances reads the texts, as every word is a possible
instance: a bit map, whose size follows the numbers asked for, tells which words to look at closer,
joins then tell exactly.
Without a pattern of enough seeds the texts are read once more in all. Base spans are never changed.

Places count code points, ends are exclusive. A null text is empty; a null doc_id gives a row.
Repeated rows each give a row with the same spans; rows that share a doc_id but not a text keep
their own. Case is folded by character, where that gives one character. Ties do not occur: spans are ordered by kind, then start. Other columns are ignored and
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import id_of, map_batches, text_of, unused
from dropwatch.session import staged

KINDS = ("email", "ip", "card", "phone")
TRUSTED = 0.8  # trust of a pattern: four known instances at least
LEAST_SHARE = 0.05  # of a pattern's places that hold known instances
LEAST_INSIDE = 0.1  # of an instance's places that lie in trusted patterns
LEAST_CHARS = 3  # of an instance
BITS_EACH = 64  # per number, of the map that tells which words to look at closer; two of them are set
MAP_BITS = (1 << 18, 1 << 27)  # of the smallest and of the largest map
BITMAP = 1 << 15  # bits of each part of the map that Spark puts together
MOST_HELD = 1 << 18  # numbers whose counts a task holds
BLOCK = 1 << 18  # characters whose words a task holds as arrays at a time, or one longer text
SPACE, HYPHEN, LETTER = 1, 2, 3  # what a code point can be

# The patterns of the base kinds. Possessive and look-behind forms match the same
# texts as the plain ones and take linear time.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

DIGITS = re.compile(r"[0-9]")
CHUNK = re.compile(r"\S+")
BLANK = re.compile(r"\s+")
LETTERS = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        doubled = d * 2 if k % 2 else d
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The address patterns, found from their at-signs: what stands before one is the longest run
    of allowed characters behind the address before."""
    found, taken, last = [], 0, 0
    for m in DOMAIN.finditer(text):
        at = m.start()
        before = text[max(taken, last) : at]
        start = at - len(before) + len(before.rstrip(LOCAL))
        if start < at:
            found.append((start, m.end()))
            taken = m.end()
        last = at + 1
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        spans["email"] = emails(text)
    if DIGITS.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                spans["ip"].append(m.span())
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans["card"].append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    spans["phone"].append(m.span())
    return spans


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: whether it is SPACE, HYPHEN, LETTER (of a word) or none, its lower case,
    and a random number."""
    chars = "".join(map(chr, range(sys.maxunicode + 1)))
    sort = np.zeros(len(chars), np.uint8)
    for kind, runs in ((SPACE, BLANK), (LETTER, LETTERS)):
        for m in runs.finditer(chars):
            sort[m.start() : m.end()] = kind
    sort[ord("-")] = HYPHEN
    low = np.arange(len(chars), dtype=np.uint32)
    for c in range(0x20000):  # no letter behind has a lower case
        if len(x := chars[c].lower()) == 1:
            low[c] = ord(x)
    return sort, low, _spread(np.arange(1, len(chars) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2 ** 64."""
    base = 0x2545F4914F6CDD1D
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64))) for b in (base, pow(base, -1, 1 << 64)))


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Numbers:
    """64-bit numbers of the parts of a text, from sums over its code points; 0 for an empty part."""

    def __init__(self, codes: np.ndarray):
        # Few lengths, so that the powers are seldom computed again.
        self.powers, self.inverse = _powers(max(BLOCK * 2, 1 << len(codes).bit_length()))
        values = _tables()[2][codes] * self.powers[: len(codes)]
        self.sums = np.append(np.uint64(0), np.cumsum(values))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        parts = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return _spread(parts ^ (end - start).astype(np.uint64))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _numbers_of(words: list[str], lower: bool) -> np.ndarray:
    codes = _codes("".join(words))
    end = np.cumsum([len(w) for w in words])
    return Numbers(_tables()[1][codes] if lower else codes)(np.append(0, end[:-1]), end)


def _pieces(text: str, start: int, end: int, step: int, wanted: int) -> list[str]:
    """The whole pieces between white space next to a place, before (step -1) or after it."""
    reach = 64
    while True:
        near = text[max(0, start - reach) : start] if step < 0 else text[end : end + reach]
        found = near.split()
        whole = start <= reach if step < 0 else end + reach >= len(text)
        # One piece more than wanted, as the outermost may be cut.
        if whole or len(found) > wanted:
            return found[-wanted:] if step < 0 else found[:wanted]
        reach *= 4


def _mixed(kind: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit number of a kind of pattern and the numbers of two pieces, in this order."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + second
    return _spread(x).view(np.int64)


def patterns(earlier: np.ndarray, one: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The three patterns (rows) of places with these pieces around them."""
    return np.stack([_mixed(1, one, after), _mixed(2, earlier, one), _mixed(3, np.zeros_like(one), one)])


def describe(text: str) -> tuple[list[int], str, list[tuple[str, str, str, str]]]:
    """Counts by kind, base spans, and each seed with the two pieces before and the one after it."""
    spans = base_spans(text)
    base = ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])
    seeds = []
    for a, b in (s for found in spans.values() for s in found):
        before = _pieces(text, a, b, -1, 2)
        if before:
            after = _pieces(text, a, b, 1, 1)
            seeds.append((text[a:b], before[0] if len(before) > 1 else "", before[-1], *(after or [""])))
    return [len(spans[kind]) for kind in KINDS], base, seeds


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(id_of().alias("did"), F.xxhash64(text_of()).alias("key"), text_of().alias("text"))


def _seeds(found: list[tuple[str, str, str, str]]) -> str:
    """Instance and patterns of each seed."""
    if not found:
        return ""
    instance, *around = zip(*found, strict=True)
    rows = np.vstack([_numbers_of(instance, False).view(np.int64), patterns(*(_numbers_of(x, True) for x in around))])
    return ",".join(" ".join(map(str, row)) for row in rows.T.tolist())


def _describe_all(docs: DataFrame) -> DataFrame:
    def run(batch):
        counts, base, digests, seeds = [], [], [], []
        for text in batch.column(2):
            n, spans, found = describe(text.as_py())
            counts.append(n)
            base.append(spans)
            digests.append(hashlib.sha256(spans.encode()).hexdigest())
            seeds.append(_seeds(found))
        by_kind = [[n[k] for n in counts] for k in range(len(KINDS))]
        yield [batch.column(0), batch.column(1), *by_kind, digests, base, seeds]

    schema = (
        "did long, key long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, base string, seeds string"
    )
    return map_batches(_rows(docs), run, schema)


def bit_map(numbers: DataFrame) -> np.ndarray:
    """A map, as bytes, with the two bits of each number of the only column set. Other numbers have
    both set with a chance of one in a thousand at most, until the map has its largest size; that is
    16 MB, of which the driver gets no more than the parts that are not empty."""
    wanted, bits = numbers.count() * BITS_EACH, MAP_BITS[0]
    while bits < min(wanted, MAP_BITS[1]):
        bits *= 2
    number = F.col(numbers.columns[0])
    places = F.array(*[F.pmod(x, F.lit(bits)) for x in (number, F.shiftrightunsigned(number, 32))])
    parts = numbers.select(F.explode(places).alias("bit")).groupBy(F.expr(f"bit div {BITMAP}").alias("part"))
    flags = np.zeros((bits // BITMAP, BITMAP // 8), np.uint8)
    for part, found in parts.agg(F.bitmap_construct_agg(F.col("bit") % BITMAP)).collect():
        flags[part] = np.frombuffer(found, np.uint8)
    return flags.ravel()


class Part(NamedTuple):
    """A part of a text with two pieces before and one behind it: the text's place in its batch and
    its base spans; where the part begins, where its words do, and where these and the part end."""

    row: int
    text: str
    taken: list[tuple[int, int]]
    begin: int
    first: int
    last: int
    end: int


def _parts(row: int, text: str) -> Iterator[Part]:
    """The text in parts of about BLOCK characters, cut at white space."""
    taken = sorted(x for spans in base_spans(text).values() for x in spans)
    first = 0
    while first < len(text):
        cut = BLANK.search(text, first + BLOCK)
        last = cut.start() if cut else len(text)
        yield Part(row, text, taken, _beyond(text, first, -1, 2), first, last, _beyond(text, last, 1, 1))
        first = last


def _beyond(text: str, at: int, step: int, wanted: int) -> int:
    """Where the wanted pieces between white space before or after a place in white space end."""
    reach = 64
    while True:
        begin, end = (max(0, at - reach), at) if step < 0 else (at, min(len(text), at + reach))
        found = [m.span() for m in CHUNK.finditer(text[begin:end])]
        if begin == 0 if step < 0 else end == len(text):
            return begin if step < 0 else end
        if len(found) > wanted:
            return begin + (found[-wanted][0] if step < 0 else found[wanted - 1][1])
        reach *= 4


def _blocks(texts: list[str]) -> Iterator[list[Part]]:
    """The parts of the texts, put together to blocks of about BLOCK characters."""
    block, size = [], 0
    for row, text in enumerate(texts):
        for part in _parts(row, text):
            block.append(part)
            size += part.end - part.begin
            if size >= BLOCK:
                yield block
                block, size = [], 0
    if block:
        yield block


def _edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of set flags."""
    steps = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]).astype(np.int8))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


class Block:
    """The words of some parts that lie outside base spans, as arrays: the place of their text in
    the batch, start and end there, their number, and those of the pieces around them (0: none)."""

    def __init__(self, parts: list[Part]):
        codes = _codes("\n".join([p.text[p.begin : p.end] for p in parts]))
        row, begin, first, last, end = np.array([(p.row, p.begin, p.first, p.last, p.end) for p in parts], np.int64).T
        offsets = np.cumsum(end - begin + 1) - (end - begin + 1)
        sorts, low, _ = _tables()
        sort = sorts[codes]
        chunk_start, chunk_end = _edges(sort != SPACE)
        start, stop = self._words(sort)
        chunk = np.searchsorted(chunk_start, start, "right") - 1
        exact, lower = Numbers(codes), Numbers(low[codes])
        # Pieces beside a chunk are those of the same part; a place without one stands at each end.
        pieces = np.pad(lower(chunk_start, chunk_end), (2, 1))
        part = np.searchsorted(offsets, chunk_start, "right") - 1
        of = np.pad(part, (2, 1), constant_values=-1)

        def beside(step):
            at = chunk + 2 + step
            return np.where(of[at] == part[chunk], pieces[at], np.uint64(0))

        a, b = chunk_start[chunk], chunk_end[chunk]
        head, tail = start > a, stop < b
        one = np.where(head, lower(a, start), beside(-1))
        earlier = np.where(head, beside(-1), beside(-2))
        after = np.where(tail, lower(stop, b), beside(1))
        here = part[chunk]
        move = begin[here] - offsets[here]
        free = (start + move >= first[here]) & (start + move < last[here]) & self._untaken(parts, offsets, start, stop)
        self.row, self.start, self.end = row[here][free], (start + move)[free], (stop + move)[free]
        self.instance = exact(start, stop)[free].view(np.int64)
        self.earlier, self.one, self.after = earlier[free], one[free], after[free]

    def _words(self, sort: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the first to the last letter of each run of letters and hyphens."""
        letters = np.flatnonzero(sort == LETTER)
        begins, ends = _edges(sort >= HYPHEN)
        a, b = np.searchsorted(letters, begins), np.searchsorted(letters, ends)
        some = b > a
        start, stop = letters[a[some]], letters[b[some] - 1] + 1
        long = stop - start >= LEAST_CHARS
        return start[long], stop[long]

    def _untaken(self, parts: list[Part], offsets: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        taken = [
            (max(a, p.begin) - p.begin + k, min(b, p.end) - p.begin + k)
            for p, k in zip(parts, offsets.tolist(), strict=True)
            for a, b in p.taken
            if a < p.end and b > p.begin
        ]
        if not taken:
            return np.ones(len(start), bool)
        begins, ends = np.array(taken, np.int64).T
        # Spans of different kinds may overlap: the furthest end of those that begin before.
        return np.append(0, np.maximum.accumulate(ends))[np.searchsorted(begins, stop)] <= start

    def patterns(self) -> np.ndarray:
        return patterns(self.earlier, self.one, self.after)


def _having(flags: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    last = np.uint64(len(flags) * 8 - 1)

    def is_set(x):
        at = x & last
        return (flags[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)

    x = numbers.view(np.uint64)
    having = is_set(x)
    having[having] = is_set(x[having] >> np.uint64(32))
    return having


def _found(docs: DataFrame, flags: np.ndarray) -> DataFrame:
    """The free places that may have a pattern of the bit map, with their patterns."""

    def run(batch):
        for block in map(Block, _blocks(batch.column(2).to_pylist())):
            numbers = block.patterns()
            which = np.flatnonzero((block.one > 0) & _having(flags, numbers).any(axis=0))
            rows = block.row[which]
            if len(rows):
                ids = [batch.column(0).take(rows), batch.column(1).take(rows)]
                yield [*ids, block.start[which], block.end[which], block.instance[which], *numbers[:, which]]

    schema = "did long, key long, start long, end long, instance long, around long, two long, one long"
    return map_batches(_rows(docs), run, schema)


def _summed(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """number, n of parts of a task, each number once for up to MOST_HELD numbers."""
    held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for found, n in parts:
        held, places = np.unique(np.append(held, found), return_inverse=True)
        counts = np.bincount(places, np.append(counts, n)).astype(np.int64)
        if len(held) > MOST_HELD:
            yield [held, counts]
            held, counts = held[:0], counts[:0]
    if len(held):
        yield [held, counts]


def _counted(docs: DataFrame, flags: np.ndarray, by_instance: bool) -> DataFrame:
    """How many free places each pattern, or each instance, has whose bits are set: number, n.

    Counts are added up within a task, not only within a block: the rows are those of the numbers
    that tasks hold, and not of these in every block."""

    def parts(batches):
        for batch in batches:
            for block in map(Block, _blocks(batch.column(2).to_pylist())):
                numbers = block.instance if by_instance else block.patterns()[:, block.one > 0].ravel()
                found, n = np.unique(numbers[_having(flags, numbers)], return_counts=True)
                if len(found):
                    yield found, n

    def run(batches):
        for columns in _summed(parts(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["number", "n"])

    counted = _rows(docs).mapInArrow(run, "number long, n long")
    return counted.groupBy("number").agg(F.sum("n").alias("n"))


def _places_of(docs: DataFrame, flags: np.ndarray) -> DataFrame:
    """instance, pattern of every free place of likely instances."""

    def run(batch):
        for block in map(Block, _blocks(batch.column(2).to_pylist())):
            which = (block.one > 0) & _having(flags, block.instance)
            if which.any():
                yield [np.tile(block.instance[which], 3), block.patterns()[:, which].ravel()]

    return map_batches(_rows(docs), run, "instance long, pattern long")


class Counts:
    """The numbers of free places of patterns, or of instances. They do not change between rounds,
    so only what was not asked for before is counted."""

    def __init__(self, docs: DataFrame, by_instance: bool):
        self.docs, self.by_instance, self.rounds, self.counted = docs, by_instance, 0, None

    def of(self, wanted: DataFrame) -> DataFrame:
        """number, n of the numbers wanted, a stored table's only column; 0 for those not found."""
        wanted = wanted.toDF("number")
        new = wanted if self.counted is None else wanted.join(self.counted, "number", "left_anti")
        flags = bit_map(new)
        if flags.any():
            n = F.coalesce("n", F.lit(0).cast("long")).alias("n")
            more = new.join(_counted(self.docs, flags, self.by_instance), "number", "left").select("number", n)
            more = more if self.counted is None else more.unionByName(self.counted)
            kind = "instances" if self.by_instance else "patterns"
            self.counted = staged(more, f"pii-{kind}-{self.rounds}")
            self.rounds += 1
        return self.counted if self.counted is not None else wanted.withColumn("n", F.lit(0).cast("long"))


def trusted_patterns(edges: DataFrame, counts: Counts, name: str) -> DataFrame:
    """pattern, trust of the patterns that the edges (pattern, instance, score, seeds, others:
    places of the known instance) and all places of the texts speak for."""
    pos = F.sum("score")
    known = edges.groupBy("pattern").agg(
        (pos / (pos + 1)).alias("trust"),
        F.sum("seeds").alias("seeds"),
        F.sum("others").alias("others"),
    )
    known = staged(known.where(F.round("trust", 9) >= TRUSTED), f"pii-candidates-{name}")
    places = counts.of(known.select("pattern")).withColumnRenamed("number", "pattern")
    share = (F.col("seeds") + F.col("others")) / (F.col("seeds") + F.greatest("others", "n"))
    judged = known.join(places, "pattern").where(share >= LEAST_SHARE)
    return staged(judged.select("pattern", "trust"), f"pii-trusted-{name}")


def accepted(trusted: DataFrame, docs: DataFrame, counts: Counts, name: str) -> tuple[DataFrame, DataFrame]:
    """The places in trusted patterns, and of their instances instance, score that are accepted."""
    found = _found(docs, bit_map(trusted.select("pattern"))).withColumn("m", F.monotonically_increasing_id())
    found = staged(found, f"pii-found-{name}")
    listed = found.withColumn("pattern", F.explode(F.array("around", "two", "one")))
    sure = listed.join(trusted.select("pattern", "trust"), "pattern")
    places = sure.groupBy("instance").agg(F.count_distinct("m").alias("inside"))
    doubt = F.sum(F.log(1 - F.col("trust")))
    belief = sure.select("instance", "pattern", "trust").distinct().groupBy("instance")
    belief = belief.agg((1 - F.exp(doubt)).alias("belief"))
    likely = staged(places.join(belief, "instance"), f"pii-likely-{name}")
    total = counts.of(likely.select("instance")).withColumnRenamed("number", "instance")
    known = likely.join(total, "instance").where(F.col("inside") >= LEAST_INSIDE * F.col("n"))
    mentions = sure.select("did", "key", "start", "end", "instance").distinct()
    known = known.select("instance", F.col("belief").alias("score"))
    return mentions, staged(known, f"pii-accepted-{name}")


def discovered(seeds: DataFrame, docs: DataFrame) -> DataFrame | None:
    """did, key, start, end of the places of identifiers found by context; None without any. seeds
    has instance, pattern per place of a seed."""
    zero = F.lit(0).cast("long")
    edges = seeds.groupBy("pattern", "instance").agg(F.count("*").alias("seeds"))
    edges = edges.select("pattern", "instance", F.lit(1.0).alias("score"), "seeds", zero.alias("others"))
    first = staged(edges, "pii-edges")
    of_patterns, of_instances = Counts(docs, False), Counts(docs, True)
    edges, before, mentions, known, places = first, 0, None, None, None
    k = 0
    while True:  # patterns are only added, so this ends
        trusted = trusted_patterns(edges, of_patterns, str(k))
        n = trusted.count()
        if n <= before:
            break
        mentions, known = accepted(trusted, docs, of_instances, str(k))
        new = known.select("instance")
        new = new if places is None else new.join(places.select("instance"), "instance", "left_anti")
        flags = bit_map(new)
        if flags.any():
            more = _places_of(docs, flags).join(new, "instance", "left_semi").groupBy("pattern", "instance")
            more = more.agg(F.count("*").alias("others"))
            places = staged(more if places is None else more.unionByName(places), f"pii-places-{k}")
        if places is None:
            break
        more = places.join(known, "instance")
        more = more.select("pattern", "instance", "score", zero.alias("seeds"), "others")
        edges, before, k = first.unionByName(more), n, k + 1
    if mentions is None:
        return None
    return mentions.join(known, "instance", "left_semi").select("did", "key", "start", "end")


def find(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, counts and digest of the base spans, all spans, and a key.

    key is xxhash64 of the text; with doc_id it joins spans to their rows.
    """
    described = staged(_describe_all(docs), "pii-described")
    listed = described.where("seeds != ''").select(F.explode(F.split("seeds", ",")).alias("seed"))
    fields = F.split("seed", " ").cast("array<long>")
    seeds = listed.select(fields[0].alias("instance"), F.explode(F.slice(fields, 2, 3)).alias("pattern"))
    places = discovered(seeds, docs)
    shown = [F.when(F.col("did") != -(2**63), F.col("did")).alias("doc_id"), *[f"n_{k}" for k in KINDS], "base_sha256"]
    if places is None:
        return described.select(*shown, F.col("base").alias("spans"), "key")
    found = places.groupBy("did", "key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("found"))
    more = F.transform("found", lambda s: F.concat_ws(":", F.lit("id"), s["start"], s["end"]))
    found = found.select("did", "key", F.array_join(more, ",").alias("more"))
    both = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "more")
    return described.join(found, ["did", "key"], "left").select(*shown, both.alias("spans"), "key")


def mask(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first."""
    cut = sorted((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for a, b, kind in cut:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns; text is masked, and n_chars, if there is one, follows it."""
    did, key, found = (unused(docs, name) for name in ("did", "key", "spans"))
    spans = find(docs).where("spans != ''").select(id_of().alias(did), F.col("key").alias(key), F.col("spans").alias(found))
    rows = docs.withColumns({did: id_of(), key: F.xxhash64(text_of())})
    rows = rows.join(spans.distinct(), [did, key], "left").select(*docs.columns, found)
    place, length = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in batches:
            texts, found = batch.column(place).to_pylist(), batch.column(len(docs_columns)).to_pylist()
            new = [mask(t, s) if t is not None and s else t for t, s in zip(texts, found, strict=True)]
            columns = list(batch.columns[: len(docs_columns)])
            columns[place] = pa.array(new, columns[place].type)
            if length is not None:
                old = columns[length].to_pylist()
                n = [len(t) if s else o for t, s, o in zip(new, found, old, strict=True)]
                columns[length] = pa.array(n, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return rows.mapInArrow(run, docs.schema)
