import random

import brute
import numpy as np
import pytest
from fixtures import docs, odd_texts, prose, rows_of

from dropwatch.llm import importance, lexical, toxicity

ITEMS = "item_id long, text string"


def corpus(n, seed=1):
    """Texts with some words in nearly all documents and others in few; copies and empty ones too."""
    r = random.Random(seed)
    rare = [f"r{k}" for k in range(300)]
    out = []
    for k in range(n):
        words = [w for w in ("the", "of", "AND", "been") for _ in range(r.randint(0, 9))]
        words += [r.choice(rare) for _ in range(r.randint(0, 25))] + ["é3", "ß"] * r.randint(0, 2)
        r.shuffle(words)
        out.append(r.choice([" ", ", ", "-", "\x00"]).join(words))
        if k % 7 == 0:
            out.append(out[r.randrange(len(out))])
    return out + ["", None]


@pytest.fixture(params=[dict(), dict(PART_BYTES=400, BLOCK_PARTS=3, WINDOW=4, CHUNK_BYTES=60)])
def sizes(request, monkeypatch):
    for name, value in request.param.items():
        monkeypatch.setattr(lexical, name, value)


def test_search_equals_scoring_everything(spark, sizes):
    texts = corpus(400)
    items = [(1, "the OF r1 r2 r3 r3 been"), (2, "of the and been"), (3, "r7 r9 ß é3 ß"), (4, None), (5, "zzz"), (6, "r5")]
    items += [(k, texts[k]) for k in range(10, 22)]
    expected = brute.ranked(list(enumerate(texts)), items)
    found = lexical.search(docs(spark, texts).repartition(3), spark.createDataFrame(items, ITEMS))
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == sorted(expected, key=repr)


def test_search_keeps_ties_of_smaller_ids_whatever_the_order(spark, sizes):
    texts, ids = ["a b"] * 60 + ["a b c"] * 60, list(range(120, 0, -1))
    items = [(1, "a b"), (2, "c")]
    expected = brute.ranked(list(zip(ids, texts, strict=True)), items)
    found = lexical.search(docs(spark, texts, ids), spark.createDataFrame(items, ITEMS))
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == sorted(expected, key=repr)


def test_window_bounds_lose_nothing():
    r = np.random.default_rng(3)
    for _ in range(40):
        n, k = int(r.integers(1, 3000)), int(r.integers(1, 12))
        lists, total = [], np.zeros(n, np.int64)
        for share in r.choice([0.001, 0.01, 0.3, 0.95], int(r.integers(1, 9))):
            at = np.flatnonzero(r.random(n) < share)
            if len(at):
                lists.append((at, r.integers(1, 50, len(at))))
                total[at] += lists[-1][1]
        best, ids = lexical.Best(k), r.permutation(n)
        if lists:
            lexical.rank_block(lists, ids, best)
        order = [x for x in np.lexsort((ids, -total)) if total[x] > 0][:k]
        assert best.ids.tolist() == ids[order].tolist() and best.scores.tolist() == total[order].tolist()


def test_search_stands_odd_rows(spark):
    texts = odd_texts()
    table = docs(spark, texts, ids=[None if k % 3 == 0 else k // 2 for k in range(len(texts))], clash=True)
    items = spark.createDataFrame([(None, "the one"), (1, "the one"), (1, "the one"), (2, "")], ITEMS)
    found = lexical.search(table, items, k=3).collect()
    of = {i: sorted((r.rank, r.doc_id, r.score) for r in found if r.item_id == i) for i in (None, 1, 2)}
    assert len(of[None]) == 3 and sorted(of[None] * 2, key=repr) == sorted(of[1], key=repr) and not of[2]
    none = table.limit(0)
    assert lexical.search(none, items).count() == 0
    assert lexical.search(table, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(none, items.limit(0)).count() == 0


def test_norms_beyond_64_bits():
    lengths = np.array([1, 10**6, 0])
    found = lexical.norms(lengths, 10**14, 10**17)
    assert found.tolist() == [25 + 75 * n * 10**14 // 10**17 for n in lengths.tolist()]


@pytest.mark.parametrize("orders", [1, 3])
def test_resampling_equals_plain_counting(spark, orders, monkeypatch):
    monkeypatch.setattr(importance, "SLICE_BYTES", 3000)
    texts = corpus(300, 2) + [prose(k, 40) for k in range(40)]
    target = [(k, t) for k, t in enumerate([prose(1, 60), "the of r1", None, "", "THE r2"])]
    settings = importance.Resampling(orders=orders, buckets=97, percent=30)
    found = importance.resample(docs(spark, texts).repartition(3), spark.createDataFrame(target, ITEMS), settings)
    expected = brute.resampled(list(enumerate(texts)), target, orders, 97, percent=30)
    assert rows_of(found, "doc_id", "n_features", "weight", "score", "rank") == sorted(expected, key=repr)


def test_resampling_stands_odd_rows(spark):
    texts = odd_texts()
    ids = [None if k % 4 == 0 else k // 2 for k in range(len(texts))]
    table, target = docs(spark, texts, ids, clash=True), spark.createDataFrame([(1, "one two")], ITEMS)
    found = importance.resample(table, target, importance.Resampling(percent=50)).collect()
    able = sum(len(brute.terms(t)) >= 20 for t in texts)
    assert len(found) == len(texts)
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, able // 2 + 1))
    assert importance.resample(table.limit(0), target).count() == 0
    assert importance.resample(table, target.limit(0)).count() == len(texts)


def plain_features(text):
    """What toxicity.features hashes, as strings."""
    marked = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower())
    padded, out = f" {marked} ", []
    for n in (3, 4, 5):
        out += [padded[i : i + n] for i in range(len(padded) - n + 1) if " " not in padded[i + 1 : i + n - 1]]
    return out + [f"<{w}>" for w in marked.split()]


def test_features_are_the_subwords_and_words():
    text = "Is it, an idi0t? Ÿes - no!!  ok" + prose(3, 200)
    known, hashes = plain_features(text), toxicity.bag(text)
    assert hashes[1].sum() == len(known)
    # Equal strings share a bucket, and hardly any others do.
    assert abs(len(hashes[0]) - len(set(known))) <= 0.03 * len(set(known))
    for one in (" id", "a", "thanea", "ß"):
        a, b = toxicity.bag(f"{one} {one}"), toxicity.bag(one)
        assert a[0].tolist() == b[0].tolist() and (a[1] == 2 * b[1]).all()


def test_a_long_text_is_cut_between_words(monkeypatch):
    text = prose(4, 3000)
    whole = toxicity.bag(text)
    monkeypatch.setattr(toxicity, "PIECE", 100)
    cut = toxicity.bag(text)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))


def abuse(r, words):
    """Misspellings of a word: a letter doubled, or an ending added."""
    w = r.choice(words)
    k = r.randrange(len(w))
    return r.choice([w, w[:k] + w[k] + w[k:], w + r.choice(["s", "ish", "oo"])])


def test_unseen_misspellings_are_found_on_held_out_rows(spark):
    r, rows, labels = random.Random(5), [], []
    for k in range(1500):
        words, toxic = prose(k % 50, 30).split(" "), k % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(r.randrange(30), abuse(r, ["worthless", "pathetic", "blockhead"]))
        rows.append(" ".join(words))
        labels.append((k, int(toxic)))
    table, known = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(table, known)
    found = toxicity.predict(table, model).withColumn("held_out", toxicity.is_held_out(toxicity.F.col("doc_id")))
    held = [(x.predicted, labels[x.doc_id][1]) for x in found.where("held_out").collect()]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert model.score("you worthlesss blockkhead") > 0.5 > model.score(prose(3, 30))


def test_plain_gradient_step_equals_the_fit():
    """One text, one epoch: the analytic AdaGrad step of a two-class softmax over the average."""
    rows = [(1, np.array([3, 8], np.int32), np.array([1, 2])), (0, np.array([8], np.int32), np.array([4]))]
    settings = toxicity.Training(epochs=30, rate=0.2)
    model = toxicity.fit(rows, settings)
    lift = [model.bias + toxicity.shares(n) @ model.scores[at] for _, at, n in rows]
    assert lift[0] > 0 > lift[1]
    shares = toxicity.shares(np.array([1, 2]))
    damped = np.array([1, 1 + np.log(2)])
    assert np.allclose(shares, toxicity.SCALE * damped / (damped.sum() + toxicity.NEUTRAL))


def test_toxicity_stands_odd_rows(spark):
    texts = odd_texts()
    ids = [None if k % 4 == 0 else k // 2 for k in range(len(texts))]
    table = docs(spark, texts, ids, clash=True)
    labels = spark.createDataFrame(
        [(k, q, "x", "y") for k in [*range(9), 1, None] for q in (k and k % 2, None)],
        "doc_id long, toxic int, text string, h string",
    )
    model = toxicity.train(table, labels)
    found = toxicity.predict(table, model).collect()
    assert len(found) == len(texts) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.predict(table.limit(0), model).count() == 0
    for rows, answer in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        scores = toxicity.predict(table, toxicity.train(table, rows)).collect()
        assert {round(r.score, 6) for r in scores} == {answer}
