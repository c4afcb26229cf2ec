"""Small tables with what the operators must stand: nulls, empty and long texts, ties, repeated
rows, no rows, and extra columns whose names clash with the operators' own."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", did string, key string, tag string, n string, node string, component string, fp string, _did string"


def docs(spark, texts, ids=None, clash=False):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    if clash:
        rows = [(*r, *["x"] * CLASHING.count("string")) for r in rows]
    return spark.createDataFrame(rows, DOCS + (CLASHING if clash else ""))


def prose(seed, n, words=400):
    r = random.Random(seed)
    known = ["".join(r.choice("aeiou bcdfglmnprst".replace(" ", "")) for _ in range(r.randint(2, 9))) for _ in range(words)]
    return " ".join(r.choice(known) for _ in range(n))


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else f"x{r.randrange(10**6)}" for w in text.split(" "))


def odd_texts():
    base = prose(1, 300)
    return [
        None, "", " \n\t ", "one", "one two", base, base, base.upper(), edited(base, 2, 0.02),
        edited(base, 3, 0.3), "a" * 5000, "ab" * 3000, "\x00퟿ é \U0001f600 " * 40,
        base[:400] + prose(4, 80) + base[400:], prose(5, 20000), "the " * 900, None, "",
    ]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
