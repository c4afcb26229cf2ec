"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def sha256(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def shingle_set(text: str | None, k: int) -> frozenset:
    words = SPACES.findall(ascii_lower(text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_groups(rows: list[tuple[int, str | None]], k: int) -> list[tuple]:
    """doc_id, size of the set, component, kept."""
    sets = [shingle_set(text, k) for _, text in rows]
    having = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            having[x].append(n)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for m in having[x]:
                if m < n:
                    common[m] += 1
        for m, both in common.items():
            if 100 * both >= 80 * (len(s) + len(sets[m]) - both):
                parent[root(n)] = root(m)
    least = {}
    for n, (doc_id, _) in enumerate(rows):
        least[root(n)] = min(least.get(root(n), doc_id), doc_id)
    return [(d, len(sets[n]), least[root(n)], d == least[root(n)]) for n, (d, _) in enumerate(rows)]


def byte_repeats(rows: list[tuple[int, str | None]], length: int = 100) -> list[tuple]:
    """doc_id, bytes, bytes removed, spans, digest of what is kept."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = hashlib.blake2b(raw[p : p + length], digest_size=12).digest()
            if window in seen:
                gone[p : p + length] = b"\x01" * length
            seen.add(window)
        out.append(_removed(doc_id, raw, gone))
    return out


def _removed(doc_id, raw, gone):
    spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
    return doc_id, len(raw), sum(gone), spans, sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g))


def word_repeats(rows: list[tuple[int, str | None]], length: int = 50) -> list[tuple]:
    """doc_id, words, words removed, digest of the kept words."""
    first: dict[tuple, int] = {}
    lists = [(d, SPACES.findall(t or "")) for d, t in sorted(rows, key=lambda r: r[0])]
    for d, words in lists:
        for p in range(len(words) - length + 1):
            first.setdefault(tuple(words[p : p + length]), d)
    out = []
    for d, words in lists:
        gone = bytearray(len(words))
        for p in range(len(words) - length + 1):
            if first[tuple(words[p : p + length])] < d:
                gone[p : p + length] = b"\x01" * length
        out.append((d, len(words), sum(gone), sha256(" ".join(w for w, g in zip(words, gone, strict=True) if not g))))
    return out


def luhn(digits: str) -> bool:
    return sum(sum(map(int, str(int(d) * (1 + k % 2)))) for k, d in enumerate(reversed(digits))) % 10 == 0


# The base patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        return {
            "email": lambda: True,
            "ip": lambda: all(int(p.lstrip("0")[:5] or 0) <= 255 for p in found.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 9 <= len(digits) <= 15,
        }[kind]()

    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m.group())] for k, p in BASE.items()}


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def archive_rows(pages: list[tuple[int, str | None]]) -> list[tuple]:
    largest: dict[bytes, int] = {}
    for page, html in pages:
        raw = (html or "").encode()
        largest[raw] = max(largest.get(raw, page), page)
    out = []
    for page, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        leader = largest[raw]
        out.append((page, len(raw), digest, "response" if page == leader else "revisit", None if page == leader else leader))
    return out


def terms(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def ranked(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], k: int = 10) -> list[tuple]:
    """item_id, rank, doc_id, score; every document is scored for every item."""
    bags = [(d, terms(t)) for d, t in docs]
    bags = [(d, Counter(words), len(words)) for d, words in bags if words]
    n_docs, n_words = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, counts, _ in bags for t in counts)
    out = []
    for item, text in items:
        scores = []
        for doc, counts, n in bags:
            m, score = 25 + 75 * n * n_docs // n_words, 0
            for t in terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            scores.append((-score, doc))
        best = [x for x in sorted(scores) if x[0] < 0][:k]
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(best, 1)]
    return out


def resampled(docs, target, orders=1, buckets=10000, seed=2024, least=20, percent=10) -> list[tuple]:
    """doc_id, n_features, weight, score, rank."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))

    def hashed(text):
        w = words(text)
        runs = [" ".join(w[i : i + n]) for n in range(1, orders + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    corpus, wanted = Counter(), Counter()
    for _, t in docs:
        corpus.update(hashed(t))
    for _, t in target:
        wanted.update(hashed(t))
    s_all, t_all = corpus.total(), wanted.total()

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets))))

    rows = []
    for d, t in docs:
        found, h = hashed(t), int(sha256(f"{seed}:{d}")[:8], 16)
        weight = sum(map(gain, found))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(found), weight, score, len(words(t)) >= least))
    able = sorted((-r[3], r[0]) for r in rows if r[4])
    place = {d: k for k, (_, d) in enumerate(able[: len(able) * percent // 100], 1)}
    return [(*r[:4], place.get(r[0])) for r in rows]


def found_by_context(texts: list[str | None], trusted=0.8, share=0.05, least_inside=0.1) -> list[list[tuple[int, int]]]:
    """For each text the places of identifiers that contexts of base spans tell of."""

    def patterns(text, a, b):
        before, after = text[:a].lower().split()[-2:], text[b:].lower().split()[:1]
        return [("around", before[-1], *after), ("two", *before), ("one", before[-1])] if before else []

    seeds, free = defaultdict(Counter), []
    for t, text in enumerate(texts):
        text = text or ""
        base = [s for found in base_spans(text).values() for s in found]
        for a, b in base:
            for p in patterns(text, a, b):
                seeds[p][text[a:b]] += 1
        for m in re.finditer(r"\w[\w-]*\w", text):
            a, b = m.span()
            if b - a >= 3 and not any(x < b and a < y for x, y in base):
                free.append((t, a, b, m.group(), patterns(text, a, b)))
    occurrences = Counter(p for *_, found in free for p in found)
    total = Counter(x for _, _, _, x, _ in free)
    known: dict[str, float] = {}
    while True:
        others = defaultdict(Counter)
        for _, _, _, x, found in free:
            if x in known:
                for p in found:
                    others[p][x] += 1
        trust = {}
        for p in {*seeds, *others}:
            pos = len(seeds[p]) + sum(known[x] for x in others[p])
            n = seeds[p].total() + others[p].total()
            if round(pos / (pos + 1), 9) >= trusted and n >= share * (seeds[p].total() + occurrences[p]):
                trust[p] = pos / (pos + 1)
        inside, by = Counter(), defaultdict(set)
        for _, _, _, x, found in free:
            good = {p for p in found if p in trust}
            by[x] |= good
            inside[x] += bool(good)
        new = {x: 1 - math.prod(1 - trust[p] for p in ps) for x, ps in by.items() if ps and inside[x] >= least_inside * total[x]}
        if new.keys() == known.keys():
            break
        known = new
    out = [[] for _ in texts]
    for t, a, b, x, found in free:
        if x in known and any(p in trust for p in found):
            out[t].append((a, b))
    return out


def tiled(doc: list[str], item: list[str], width: int = 5) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest common run of unmarked words, again and again."""
    free_item, free_doc, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_item[i + n] and free_doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < width:
            return out
        out.append(best)
        free_item[i : i + n] = free_doc[j : j + n] = [False] * n
