"""Near-duplicate groups, fingerprints and tiling against plain versions."""

import random

import brute
import numpy as np
import pytest
from fixtures import docs, edited, odd_texts, prose, rows_of
from pyspark.sql import functions as F

from dropwatch.llm import minhash, simhash, tiling

GROUPS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("k", [2, 5])
def test_groups_equal_brute_force(spark, k):
    base, other = prose(1, 150), prose(2, 150)
    texts = odd_texts() + [edited(t, n, 0.004 * n) for n in range(30) for t in (base, other)]
    texts += [base + " " + prose(50 + n, 60) for n in range(10)]
    rows = list(enumerate(texts))
    found = minhash.groups(docs(spark, texts, clash=True).repartition(4), k)
    assert rows_of(found, *GROUPS) == sorted(brute.near_groups(rows, k), key=repr)


def test_loose_families_lose_no_link(spark):
    # Copies of copies: most are far from the first, near to some other.
    texts = [prose(3, 120)]
    for n in range(60):
        texts.append(edited(texts[n // 2], n, 0.04))
    rows = list(enumerate(texts))
    assert rows_of(minhash.groups(docs(spark, texts), 2), *GROUPS) == sorted(brute.near_groups(rows, 2), key=repr)


def test_components_join_chains_over_partitions(spark):
    links = [(n, n + 1) for n in range(0, 40)] + [(n + 1, n) for n in range(100, 120)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    found = dict(rows_of(minhash.components(df), "node", "component"))
    assert found == {n: 0 for n in range(1, 41)} | {n: 100 for n in range(101, 121)}


def test_null_repeated_and_no_rows(spark):
    base = prose(4, 60)
    found = minhash.groups(docs(spark, [base, base, base, None, ""], ids=[5, 5, None, None, 6]), 5)
    assert rows_of(found, "doc_id", "component_id", "kept") == [
        (5, None, False), (5, None, False), (6, 6, True), (None, None, True), (None, None, True)
    ]
    assert minhash.groups(docs(spark, []), 5).count() == 0


def test_signatures_estimate_similarity():
    r = np.random.default_rng(0)
    pool = r.integers(0, 1 << 63, 1500, dtype=np.uint64)
    a, b = minhash.signature(pool[:1000]), minhash.signature(pool[250:1250])
    assert abs((a == b).mean() - 750 / 1250) < 0.1
    assert np.isfinite(minhash.signature(pool[:1])).all()
    many = r.integers(0, 1 << 63, 3 * minhash.BLOCK, dtype=np.uint64)
    halves = [minhash.signature(many[: minhash.BLOCK]), minhash.signature(many[minhash.BLOCK :])]
    assert (minhash.signature(many) == np.minimum(*halves)).all()


def test_fingerprints_of_edits(spark):
    texts = odd_texts()
    df = docs(spark, texts, clash=True).repartition(5)
    found = {r.doc_id: r for r in simhash.fingerprint_edits(df).collect()}
    plain = [t or "" for t in texts]
    for k, text in enumerate(plain):
        following, cut = plain[(k + 1) % len(plain)], len(text) // 2
        new = text[: len(text) - cut] + following[:cut]
        assert (found[k].n_chars, found[k].edited_sha256) == (len(text), brute.sha256(new))
        assert found[k].fp == simhash._signed(simhash.fingerprint(text))
        assert found[k].near_next == simhash.likeness(simhash.fingerprint(text), simhash.fingerprint(following))
    assert found[5].fp == found[6].fp


def test_fingerprint_edges(spark):
    one = simhash.fingerprint_edits(docs(spark, ["some words"])).first()
    assert one.near_next == 1.0 and one.n_chars == 10
    assert simhash.fingerprint_edits(docs(spark, [])).count() == 0
    rows = simhash.fingerprint_edits(docs(spark, ["b c", "a b", "z"], ids=[4, 4, None])).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in rows) == [(False, 3), (False, 3), (True, 1)]


def test_neighbours_are_all_within_the_radius(spark):
    r = np.random.default_rng(1)
    base = [int(x) for x in r.integers(0, 1 << 63, 40)]
    near = [b ^ sum(1 << int(x) for x in r.choice(64, n % 6, replace=False)) for n, b in enumerate(base)]
    fps = [simhash._signed(x % 2**64) for x in base + near + base[:5]]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    found = rows_of(simhash.neighbours(df, df), "fp", "near_fp", "distance")
    wanted = {(a, b, ((a ^ b) & (2**64 - 1)).bit_count()) for a in fps for b in fps}
    assert found == sorted((x for x in wanted if x[2] <= 3), key=repr)


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_leaks_are_found_in_any_order_and_size(spark):
    item = prose(7, 40)
    words = item.split()
    turned = " ".join(words[20:] + ["between"] + words[:20])
    texts = [None, "", prose(8, 200), prose(9, 50) + " " + item.upper() + "! " + prose(10, 50), turned,
             " ".join(words[:15]), " ".join(words[:22]), item + " " + item, "the " * 3000]
    df = docs(spark, texts, clash=True)
    bench = items(spark, [item, None, "", "too short", prose(11, 30), "the " * 12])
    found = rows_of(tiling.leaks(df, bench), "doc_id", "item_id", "n_tiles", "longest_tile")
    assert found == [(3, 0, 1, 40), (4, 0, 2, 20), (6, 0, 1, 22), (7, 0, 1, 40), (8, 5, 1, 12)]
    joined = tiling.leaks_by_join(df, bench)
    assert rows_of(joined, *joined.columns) == rows_of(tiling.leaks(df, bench), *joined.columns)
    kept = tiling.drop_leaks(df, bench)
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [0, 1, 2, 5] and kept.columns == df.columns
    assert tiling.leaks(docs(spark, []), bench).count() == 0
    assert tiling.leaks(df, items(spark, [])).count() == 0


def test_short_and_unspaced_items_leak(spark):
    han = "".join(chr(0x4E00 + k * 7 % 900) for k in range(60))
    bench = items(spark, ["which pelican flies backwards", "supercalifragilistic" * 3, han, "is it so", "yes"])
    texts = [
        "I ask: Which pelican flies backwards?", "x " + "supercalifragilistic" * 3 + " y", "前置" + han[5:50] + "後",
        "Is it so?", "and is it so, yes", "yes!", "which pelican flies", "supercalifragilistic", han[:20], None, "",
    ]
    df = docs(spark, texts, clash=True)
    expected = [(0, 0), (1, 1), (2, 2), (3, 3), (5, 4)]
    assert rows_of(tiling.leaks(df, bench), "doc_id", "item_id") == expected
    assert rows_of(tiling.leaks_by_join(df, bench), "doc_id", "item_id") == expected


def test_tiles_equal_plain_greedy_tiling():
    r = random.Random(4)
    for _ in range(150):
        words = [f"w{k}" for k in range(r.choice([3, 9, 40]))]
        item = [r.choice(words) for _ in range(r.randint(1, 24))]
        doc = [r.choice(words) for _ in range(r.randint(0, 40))]
        doc[3:3] = item[: r.randint(0, 12)]
        doc += item[r.randint(0, len(item)) :]
        plain = brute.tiled(doc, item, min(5, len(item)))
        found = tiling.Items([(1, " ".join(item))]).leaks(" ".join(doc), 0.0)
        short = len(item) < 5 and sum(map(len, item)) < 12 and len(doc) != len(item)
        expected = [] if short or not plain else [(0, sum(t[0] for t in plain) / len(item), len(plain), plain[0][0])]
        assert found == expected, (doc, item)


def test_a_large_benchmark_is_joined(spark, monkeypatch):
    item = prose(7, 40)
    df, bench = docs(spark, [prose(8, 90), item]), items(spark, [item])
    monkeypatch.setattr(tiling, "SMALL", 1)
    assert rows_of(tiling.leaks(df, bench), "doc_id", "item_id") == [(1, 0)]
    assert [r.doc_id for r in tiling.drop_leaks(df, bench).collect()] == [0]


def test_a_large_benchmark_judges_rows_by_their_own_text(spark, monkeypatch):
    item = prose(7, 40)
    texts = [item, prose(8, 90), item, prose(9, 90), None]
    df, bench = docs(spark, texts, ids=[None, None, 3, 3, 3], clash=True), items(spark, [item])
    small = rows_of(tiling.drop_leaks(df, bench), *df.columns)
    monkeypatch.setattr(tiling, "SMALL", 1)
    large = tiling.drop_leaks(df, bench)
    assert rows_of(large, *df.columns) == small and len(small) == 3 and large.columns == df.columns


def test_tiles_mark_the_longest_first_and_do_not_overlap():
    found = tiling.tiles([(10, 0, 0), (8, 6, 100), (6, 12, 50)], 20)
    assert sorted(found) == [(6, 12, 50), (10, 0, 0)]
    assert sum(t[0] for t in tiling.tiles([(10, 0, 0), (10, 0, 30), (12, 5, 60)], 17)) == 17


def test_texts_that_share_a_doc_id_keep_their_own_links(spark):
    a, b, c = prose(21, 120), prose(22, 120), prose(23, 120)
    near = [t + " and more" for t in (a, b, c)]
    # Two texts of one id, each with a near copy; rows of doc_id 9 join 4 and 9.
    df = docs(spark, [a, b, *near[:2], c, near[2], prose(24, 120)], ids=[5, 5, 7, 8, 9, 4, 9])
    found = minhash.groups(df.repartition(3), 5)
    got = {(r.doc_id, r.tkey): (r.component_id, r.kept) for r in found.collect()}
    key = {r.text: r.k for r in df.select("text", F.xxhash64("text").alias("k")).collect()}
    assert got == {
        (5, key[a]): (5, True), (5, key[b]): (5, True), (7, key[near[0]]): (5, False), (8, key[near[1]]): (5, False),
        (9, key[c]): (4, False), (4, key[near[2]]): (4, True), (9, key[prose(24, 120)]): (4, True),
    }


def test_near_copies_without_a_doc_id_are_compared(spark):
    a, b = prose(25, 120), prose(26, 120)
    df = docs(spark, [a, a + " and more", b, b + " and more", prose(27, 120)], ids=[None, None, None, 3, None])
    found = rows_of(minhash.groups(df, 5), "doc_id", "component_id", "kept")
    assert found == [(3, None, False), (None, None, False), *[(None, None, True)] * 3]
