"""Chat formatting, personal data, language ID, pieces and archives."""

import random
import re
import time

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from fixtures import docs, odd_texts, prose, rows_of
from pyspark.sql import functions as F

from dropwatch.llm import chat, langid, pieces, pii, queries, warc

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def test_chat_reads_back_every_conversation(spark):
    clash = ["</s>", r"<\/s>", r"<\\s>", "[INST]", r"[\/INST]", "<<SYS>>a", "<", "[", "", None, "<</SYS>", "a\nb", "\\"]
    rows = [(k, 0, role, t) for k, t in enumerate(clash) for role in ("user", "assistant")]
    rows += [(100, n, r, f"{n}</s>") for n, r in enumerate(["system", None, "", "a b\n<s>", "user", "user"])]
    rows += [(101, 1, "user", "x"), (101, 1, "user", "x"), (101, None, "user", "first"), (None, 0, "user", "y")]
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit("clash")).withColumn("loss", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        listed = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns), brute.sha256(listed)), turns
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), brute.sha256(loss))
    assert got[0].escaped and got[100].escaped and not got[101].escaped
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


@pytest.mark.parametrize(
    ("rendered", "turns"),
    [
        ("[INST]x[/INST]<s>y</s>", [("user", "x"), ("assistant", "y")]),
        ("<<SYS>>a+b\nz\n<</SYS>>", [("a b", "z\n")]),
        ("", []),
        ("[INST]x</s>", None),
        ("junk[INST]x[/INST]junk", None),
        ("[INST]x[/INST] <s>y</s>", None),
        ("[INST]x[/INST]y[/INST]", None),
        ("<<SYS>>no line<</SYS>>", [("no line", None)]),
        ("[INST]a<s>b[/INST]", [("user", None)]),
        (r"[INST]a<\s>b[/INST]", [("user", "a<s>b")]),
    ],
)
def test_the_parser_takes_the_grammar_only(spark, rendered, turns):
    found = spark.createDataFrame([(rendered,)], "f string").select(chat.parse(F.col("f")).alias("p")).first().p
    assert (found if found is None else [tuple(t) for t in found]) == turns


def test_chat_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    mine = queries.op1_chat(spark, SF)
    relation = connection.sql(queries.oracle_sql()["op1_chat"])
    theirs = sorted((tuple(r) for r in relation.select(*mine.columns).fetchall()), key=repr)
    assert rows_of(mine, *mine.columns) == theirs


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(0)
    texts = ["".join(r.choice("a@.1234+-() 0\n") for _ in range(r.randrange(50))) for _ in range(20000)]
    texts += ["a.b@c-d.ef@g.h", "1.2.3.4.5.6.7.8", "256.1.1.1 " + "0" * 5000 + ".1.1.1", "+1 (23) 45-67.89 x", "4111 1111-1111 1111"]
    for text in texts:
        assert pii.base_spans(text) == brute.base_spans(text), text
    assert pii.emails("a" * 100000 + "@b.c") == [(0, 100004)]


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"{prose(n, 10)} reach me under acct a{n}.{n}@mail{n}.example.com soon" for n in range(30)]
    texts += ["please reach me under acct XK20481-77 soon", "just 2048177 then", None, "", "x" * 50000 + " 10.0.0.1"]
    df = docs(spark, texts, clash=True)
    found = {r.doc_id: r for r in pii.find(df).collect()}
    assert found[30].spans == "id:27:37" and texts[30][27:37] == "XK20481-77"
    assert found[31].spans == "" and found[32].spans == "" and found[34].n_ip == 1
    for k, text in enumerate(texts):
        spans = ",".join(f"{kind}:{a}:{b}" for kind, s in brute.base_spans(text or "").items() for a, b in s)
        assert found[k].base_sha256 == brute.sha256(spans) and found[k].spans.startswith(spans)
    masked = {r.doc_id: r for r in pii.masked(df).collect()}
    assert masked[30].text == "please reach me under acct [ID] soon" and masked[30].n_chars == len(masked[30].text)
    assert "@" not in masked[0].text and masked[32].text is None and masked[31].text == texts[31]
    assert pii.masked(df).columns == df.columns and pii.find(docs(spark, [])).count() == 0


def planted(n_seeds, n_unseen):
    """Texts with identifiers of three characters up, with and without digits, in one context each
    size, and what is planted."""
    r, texts, where = random.Random(n_seeds), [], []
    for n in n_unseen:
        seeds = [f"u{k}.{n}@mail{k}.example.com" for k in range(n_seeds)]
        unseen = [r.choice([f"ZK{k}{n}-7", f"q{k:02d}", "".join(r.choices("bcdfgh", k=3 + k % 6)) + "x" * (k % 2)]) for k in range(n)]
        for x in seeds + unseen:
            text = f"{prose(r.randrange(60), 12)} the member ref{n}: {x} was noted, {prose(r.randrange(60), 5)}"
            texts.append(text)
            if x in unseen:
                where.append((len(texts) - 1, text.index(f": {x} ") + 2, text.index(f": {x} ") + 2 + len(x)))
    return texts, where


@pytest.mark.parametrize("n_seeds", [10, 100])
def test_unseen_identifiers_are_found_whatever_their_number(spark, n_seeds):
    texts, where = planted(n_seeds, [1, 10, 30, 100])
    found = {r.doc_id: r.spans.split(",") for r in pii.find(docs(spark, texts).repartition(4)).collect()}
    ids = {(d, *map(int, s.split(":")[1:])) for d, spans in found.items() for s in spans if s.startswith("id:")}
    assert len(set(where) & ids) >= 0.9 * len(where)
    assert len(ids - set(where)) <= 0.02 * len(where)  # ordinary words
    plain = brute.found_by_context(texts)
    assert ids == {(t, a, b) for t, spans in enumerate(plain) for a, b in spans}


def test_ordinary_words_behind_known_instances_stay(spark):
    texts = [f"{prose(k, 9)} call +1 (555) 010-{1000 + k} or call the office of {prose(k, 9)}" for k in range(40)]
    texts += [f"the {prose(k, 30)} of the office" for k in range(300)]
    found = pii.find(docs(spark, texts)).where("spans LIKE '%id:%'")
    assert found.count() == 0 and not any(brute.found_by_context(texts))


def test_scores_spread_until_none_changes(spark):
    # Identifiers of each level are known only by contexts they share with those of the level before.
    known, texts = [f"u{n}@m.example.com" for n in range(12)], []
    for level in range(5):
        new = [f"ZK{level}{n:02d}-77" for n in range(12)]
        for part in range(6):
            tag = "abcde"[level] * 3 + "pqrstu"[part]
            texts.append(" ".join(f"reach{tag} via{tag} {x} end{tag}" for x in known + new[2 * part : 2 * part + 2]))
        known = new
    plain = brute.found_by_context(texts)
    for r in pii.find(docs(spark, texts)).collect():
        assert r.spans.count("id:") == (2 if r.doc_id < 6 else 14) == len(plain[r.doc_id]), r.doc_id


def test_personal_data_keeps_repeated_and_null_rows(spark):
    df = docs(spark, ["a@b.c", "a@b.c", "1.2.3.4", "d@e.f"], ids=[1, 1, 1, None])
    assert rows_of(pii.find(df), "doc_id", "spans") == [(1, "email:0:5"), (1, "email:0:5"), (1, "ip:0:7"), (None, "email:0:5")]
    assert pii.masked(df).count() == 4


def test_language_of_held_out_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(df)
    found = langid.identify(df, model).join(df.select("doc_id", "lang"), "doc_id")
    found = found.withColumn("held_out", langid.is_held_out(F.col("doc_id"))).collect()
    assert all(r.held_out == brute.held_out(r.doc_id) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found) and (model.weights == 0).mean() > 0.3
    assert model.predict(None) == model.predict("") == model.predict("12 .;") == ("und", 0.0)
    odd = docs(spark, odd_texts(), clash=True)
    assert langid.identify(odd, model).count() == len(odd_texts())
    kept = {r.doc_id for r in langid.keep_identified(odd, model, 0.0).collect()}
    assert kept.isdisjoint({0, 1, 2, 16, 17}) and 5 in kept


def test_language_without_labels(spark):
    unlabelled = docs(spark, ["some text", None]).withColumn("lang", F.lit(None).cast("string"))
    for df in (unlabelled, unlabelled.limit(0)):
        model = langid.train(df)
        assert {r.lang_pred for r in langid.identify(df, model).collect()} <= {"und"}


def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(0)
    texts = ["".join(r.choice("ab e\n▁tionth<>/.,1 é日\U0001f600") for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += [t or "" for t in odd_texts()] + ["a" * 3000, " " * 500 + "x", "for (i=0;i<9;++i){\n        z\n}", "<s>[INST]</s>"]
    model = pieces.model(path)
    for text in texts:
        ids = library.encode(text, add_eos=True)
        n, joined, decoded = model.encoded(text)
        assert (n, joined, decoded) == (len(ids), " ".join(map(str, ids)), library.decode(ids)), text
        assert model.encode(text) == ids and model.decode(ids) == library.decode(ids)
    found = pieces.encode_and_decode(docs(spark, odd_texts(), clash=True), path).collect()
    assert {r.doc_id: r.n_tokens for r in found}[0] == 1 and len(found) == len(odd_texts())


PAGES = "page_id long, url string, html string"
PAGE = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pages(spark):
    big = prose(1, 9000)
    rows = [(1, "http://a/é", "x"), (2, None, "x"), (3, "u\r\nv", None), (4, "u", ""), (5, "u", big), (6, "u", big),
            (9, "u" * 3000, "é\x00\U0001f600"), (7, "u", big + "!")]
    return rows, spark.createDataFrame(rows, PAGES).withColumn("record", F.lit("clash")).withColumn("sha1", F.lit(0))


@pytest.mark.parametrize("chunk", [warc.CHUNK, 1000])
def test_archives_read_back(spark, monkeypatch, chunk):
    rows, df = pages(spark)
    archive = warc.write_archive(df.repartition(2), chunk=chunk)
    assert rows_of(warc.read_archive(archive), *PAGE) == sorted(brute.archive_rows([(p, h) for p, _, h in rows]), key=repr)
    # Records cut apart by file splits, and larger than what a reader keeps.
    monkeypatch.setattr(warc, "HOLD", 2000)
    shuffled = archive.repartition(6)
    assert rows_of(warc.read_archive(shuffled), *PAGE) == sorted(brute.archive_rows([(p, h) for p, _, h in rows]), key=repr)


def test_the_chunks_of_an_archive_are_a_warc_file(spark):
    rows, df = pages(spark)
    chunks = warc.write_archive(df, chunk=1000).orderBy("record", "chunk").collect()
    raw, found = b"".join(bytes(r.data) for r in chunks), []
    while raw:
        head, raw = raw.split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert head.startswith(b"WARC/1.1") and raw[n : n + 4] == b"\r\n\r\n"
        payload = raw[:n].split(b"\r\n\r\n", 1)[1]
        found.append((int(fields["X-Page-ID"]), payload if fields["WARC-Type"] == "response" else None))
        raw = raw[n + 4 :]
    texts = {p: (h or "").encode() for p, _, h in rows}
    assert sorted(p for p, _ in found) == sorted(texts)
    assert all(payload is None or payload == texts[p] for p, payload in found)


def test_an_unbroken_part_takes_linear_time():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, r = pieces.model(path), random.Random(2)
    text = "".join(r.choices("etaoinshrdlu", k=1_000_000))
    begin = time.perf_counter()
    ids = model.encode(text)
    assert time.perf_counter() - begin < 60
    assert ids == sentencepiece.SentencePieceProcessor(model_file=path).encode(text, add_eos=True)


def test_archive_edges(spark):
    rows = [(5, "u", "x"), (5, "u", "x"), (5, "u", "y"), (None, "u", "x"), (None, "u", "z")]
    df = spark.createDataFrame(rows, PAGES)
    found = rows_of(warc.read_archive(warc.write_archive(df)), "page_id", "record_type", "refers_to")
    assert found == [(5, "response", None), (5, "response", None), (5, "response", None), (None, "response", None), (None, "revisit", 5)]
    small = rows_of(warc.read_archive(warc.write_archive(df, least_bytes=2)), "record_type")
    assert small == [("response",)] * 5
    assert warc.read_archive(warc.write_archive(df.limit(0))).count() == 0


def test_a_damaged_archive_is_an_error(spark):
    _, df = pages(spark)
    archive = warc.write_archive(df, chunk=1000)
    for broken in (
        archive.where("NOT (chunk = 3)"),
        archive.withColumn("data", F.when(F.col("chunk") == 2, F.lit(b"!")).otherwise(F.col("data"))),
    ):
        with pytest.raises(Exception, match="missing|damaged"):
            warc.read_archive(broken).collect()


def test_words_of_blocks_equal_the_plain_patterns(monkeypatch):
    # Parts of a few characters, cut between pieces, give the words and contexts of the whole text.
    r, seen, want = random.Random(1), {}, {}
    texts = ["".join(r.choice("abÉ-_.,1 \n @é語+") for _ in range(r.randrange(300))) for _ in range(300)] + ["", " ", "x" * 500]
    texts += ["call a@b.cd 10.0.0.1 +1 (555) 010-1000 or 4111 1111 1111 1111, then XK-77 " * 20]
    numbered = lambda w: int(pii._numbers_of([w], True)[0]) if w else 0
    for size in (1 << 20, 40):
        monkeypatch.setattr(pii, "BLOCK", size)
        pii._powers.cache_clear()
        found = []
        for block in map(pii.Block, pii._blocks(texts)):
            words = [texts[k][a:b] for k, a, b in zip(block.row, block.start, block.end, strict=True)]
            assert not words or (pii._numbers_of(words, False).view("int64") == block.instance).all()
            columns = (block.row, block.start, block.end, block.earlier, block.one, block.after)
            found += zip(*(c.tolist() for c in columns), strict=True)
        seen[size] = found
    for k, text in enumerate(texts):
        base = [s for spans in brute.base_spans(text).values() for s in spans]
        for m in re.finditer(r"\w[\w-]*\w", text):
            a, b = m.span()
            if b - a >= 3 and not any(x < b and a < y for x, y in base):
                before, after = text[:a].split()[-2:], text[b:].split()[:1]
                want[k, a, b] = tuple(numbered(w) for w in (*[""] * (2 - len(before)), *before, *(after or [""])))
    for found in seen.values():
        assert {x[:3]: x[3:] for x in found} == want and len(found) == len(want)
    pii._powers.cache_clear()


def test_counts_are_summed_in_a_task_and_exact(spark, monkeypatch):
    texts = ["see ref: ab12 or ref: cd34 now, see ref: ab12 or then"] * 40 + [prose(7, 300), None, "", "ref: ab12 or"]
    wanted = [pii.patterns(*(pii._numbers_of([x], True) for x in around)) for around in (("see", "ref:", "or"), ("a", "b", "c"))]
    numbers = spark.createDataFrame([(int(x),) for x in np.unique(np.concatenate(wanted))], "number long")
    plain = rows_of(pii.Counts(docs(spark, texts), False).of(numbers), "number", "n")
    # Many small blocks in one task: a row for each number, as of one large block.
    monkeypatch.setattr(pii, "BLOCK", 64)
    one_task = docs(spark, texts).coalesce(1)
    flags = pii.bit_map(numbers)
    assert pii._having(flags, np.array([r.number for r in numbers.collect()])).all()
    blocks = [b.patterns()[:, b.one > 0].ravel() for b in map(pii.Block, pii._blocks([t or "" for t in texts]))]
    made = list(pii._summed((np.unique(x[pii._having(flags, x)], return_counts=True) for x in blocks)))
    assert len(blocks) > 20 and len(made) == 1 and len(set(made[0][0])) == len(made[0][0]) <= numbers.count()
    assert rows_of(pii.Counts(one_task, False).of(numbers), "number", "n") == plain
    # In each of the forty texts, and in the last: "see ref:" twice, "ref: .. or" twice, "ref:" three times.
    assert sorted(n for _, n in plain) == [0, 0, 0, 80, 81, 121]
    monkeypatch.setattr(pii, "MOST_HELD", 1)
    assert rows_of(pii.Counts(one_task, False).of(numbers), "number", "n") == plain


def test_the_bit_map_follows_the_numbers_asked_for(spark):
    asked = spark.range(40000).select(F.xxhash64("id").alias("number"))
    flags = pii.bit_map(asked)
    known = np.array([r.number for r in asked.collect()])
    others = np.array([r.number for r in spark.range(100000, 300000).select(F.xxhash64("id").alias("number")).collect()])
    assert pii._having(flags, known).all() and pii._having(flags, others).mean() < 0.003
    assert not pii.bit_map(asked.limit(0)).any()
