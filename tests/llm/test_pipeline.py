"""The corpus pipeline against plain versions of its stages, and its place in the entry."""

import brute
import public_tokenizers
import sentencepiece
from fixtures import docs, odd_texts, prose, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from dropwatch.llm import langid, tiling

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "personal_data", "pieces"]
    known = set(entry.queries())
    assert "pipeline" in known and all(any(q.startswith(f"op{n}_") for q in known) for n in range(1, 11))


def test_run_equals_plain_stages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(table)
    rows = {r.doc_id: r.text for r in table.collect()}
    rows = {i: t for i, t in rows.items() if model.predict(t)[0] != "und" and model.predict(t)[1] >= 0.5}
    kept = {d for d, _, _, stays in brute.near_groups(sorted(rows.items()), 5) if stays}
    rows = {i: t for i, t in rows.items() if i in kept}
    bench = [tiling.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seeds = [{tuple(b[i : i + 5]) for i in range(len(b) - 4)} for b in bench]

    def leaks(text):
        words = tiling.words_of(text)
        mine = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        return any(s and len(s & mine) > 0.6 * len(s) for s in seeds)

    rows = {i: t for i, t in rows.items() if not leaks(t)}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(found) == set(rows)
    for doc_id, text in rows.items():
        if not any(brute.base_spans(text).values()) and not any(c.isdigit() for c in text):
            ids = library.encode(text, add_eos=True)
            assert found[doc_id].n_tokens == len(ids)
            assert found[doc_id].ids_sha256 == brute.sha256(" ".join(map(str, ids)))


def test_stages_stand_odd_rows(spark):
    texts = odd_texts() + [prose(9, 200) + " write to a.b@c.example.org", prose(9, 200) + " write to a.b@c.example.org"]
    df = docs(spark, texts, ids=[None, *range(len(texts) - 1)], clash=True)
    df = df.unionByName(df.where("doc_id = 4"))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        found = stage(spark, df, SF)
        assert found.columns == df.columns, name
        assert stage(spark, df.limit(0), SF).count() == 0
    assert corpus_pipeline.personal_data(spark, df, SF).where(F.col("text").contains("@")).count() == 0
    kept = corpus_pipeline.near_duplicates(spark, df, SF)
    ids = [r[0] for r in rows_of(kept, "doc_id")]
    assert len(ids) == len(set(ids)) and 4 in ids and 5 not in ids


def test_near_duplicates_keep_one_of_each_group(spark):
    base = prose(1, 100)
    df = docs(spark, [base, base + " more", base, prose(2, 100)], ids=[8, 3, 5, 9])
    assert rows_of(corpus_pipeline.near_duplicates(spark, df, SF), "doc_id") == [(3,), (9,)]


def test_near_duplicates_without_a_doc_id(spark):
    base = prose(1, 100)
    df = docs(spark, [base, base + " more", prose(2, 100), prose(2, 100) + " more"], ids=[None, None, 7, 7])
    found = [r.text.removesuffix(" more") for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()]
    assert sorted(found) == sorted([base, prose(2, 100)])


def test_near_duplicates_keep_wordless_rows_and_take_any_column(spark):
    base = prose(1, 80)
    df = docs(spark, [base, base, "", "", None, " ", base], ids=[1, 1, 2, 2, 2, 3, 4])
    df = df.withColumn("more", F.create_map(F.lit("a"), F.col("doc_id")))
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert sorted((r.doc_id for r in kept.collect())) == [1, 2, 2, 2, 3] and kept.columns == df.columns
