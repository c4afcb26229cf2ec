"""Repeats of byte strings and of word windows against plain versions."""

import brute
import numpy as np
import pytest
import xxhash
from fixtures import docs, edited, odd_texts, prose, rows_of

from dropwatch.llm import substring, suffix, windows

BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def family(n):
    base, line = prose(1, 220), prose(2, 30)
    texts = [edited(base, k, 0.01 * (k % 12)) for k in range(n)]
    return [t + " " + line + " " + prose(100 + k, 60) for k, t in enumerate(texts)] + [base + line] * 3


@pytest.mark.parametrize("many", [windows.MANY, 1])
@pytest.mark.parametrize("segment", [windows.SEGMENT, 64])
def test_equal_to_brute_force(spark, monkeypatch, many, segment):
    monkeypatch.setattr(windows, "MANY", many)
    monkeypatch.setattr(windows, "MOST", 4096 if many > 1 else 2)
    monkeypatch.setattr(windows, "SEGMENT", segment)
    texts = odd_texts() + family(25)
    df = docs(spark, texts, clash=True).repartition(5)
    rows = list(enumerate(texts))
    assert rows_of(suffix.dedup(df), *BYTES) == sorted(brute.byte_repeats(rows), key=repr)
    assert rows_of(substring.dedup(df), *WORDS) == sorted(brute.word_repeats(rows), key=repr)


def test_a_long_text_in_few_blocks_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(windows, "RANGE_BYTES", 4096)
    texts = family(12)
    rows = list(enumerate(texts))
    df = docs(spark, texts).repartition(3)
    assert rows_of(suffix.dedup(df), *BYTES) == sorted(brute.byte_repeats(rows), key=repr)
    assert rows_of(substring.dedup(df), *WORDS) == sorted(brute.word_repeats(rows), key=repr)


def test_spans_cover_what_is_removed(spark):
    base = prose(3, 120)
    found = {r.doc_id: r for r in substring.dedup(docs(spark, [base, "own words first " + base])).collect()}
    assert found[0].spans == "" and found[1].spans == "3:123"
    found = {r.doc_id: r for r in suffix.dedup(docs(spark, [base, "own " + base])).collect()}
    assert found[1].spans == f"4:{4 + len(base)}" and found[1].n_spans == 1


def test_null_and_repeated_ids(spark):
    base = prose(4, 90)
    df = docs(spark, [base, base, base, prose(5, 90) + " " + base], ids=[7, 7, None, 9])
    assert rows_of(substring.dedup(df), "doc_id", "n_removed") == [(7, 90), (7, 90), (9, 90), (None, 0)]
    removed = {r.doc_id: r.n_removed for r in suffix.dedup(df.where("doc_id IS NULL OR doc_id = 9")).collect()}
    assert removed[None] == 0 and removed[9] == len(base)
    same = rows_of(suffix.dedup(df.where("doc_id = 7")), "doc_id", "n_removed")
    assert same == [(7, 0), (7, 0)]


@pytest.mark.parametrize("doc_id", [None, 3])
def test_many_texts_without_an_id_of_their_own(spark, doc_id):
    shared = prose(6, 60)
    texts = [f"{prose(k % 40, 30)} {k} {shared[: 150 + k % 200]} {k}" for k in range(5000)]
    size = max(map(len, texts))
    texts = [t.ljust(size, "x") if k % 2 else t for k, t in enumerate(texts)]
    df = docs(spark, texts, ids=[doc_id] * len(texts)).repartition(4)
    order = sorted(texts, key=lambda t: np.int64(np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42))))
    expected = brute.byte_repeats(list(enumerate(order)))
    assert rows_of(suffix.dedup(df), *BYTES[1:]) == sorted((r[1:] for r in expected), key=repr)
    kept = [(r[1], 0, r[3]) for r in brute.word_repeats([(k, t) for k, t in enumerate(texts)], length=10**9)]
    assert rows_of(substring.dedup(df), *WORDS[1:]) == sorted(kept, key=repr)


def test_empty_table(spark):
    empty = docs(spark, [])
    assert suffix.dedup(empty).count() == 0 and substring.dedup(empty).count() == 0
