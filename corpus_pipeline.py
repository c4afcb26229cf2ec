"""A corpus in five stages: language ID, near-duplicate removal, decontamination, personal data,
encoding. Each stage is written as Parquet to the shared folder and read by the next one.

Stages keep all columns of their input but for the last, which returns a row per document with its
id and the number and digests of its piece ids and decoded text. Null, empty and repeated rows:

* language: documents without letters (null and empty texts too), and those whose language scores
  under LEAST_SCORE, go;
* near_duplicates: five-word shingles, similarity 0.8; of a group one text stays, once: that of the
  smallest doc_id (null is smallest; if it has several, that of the smallest xxhash64). Documents
  without words have no duplicates;
* decontamination: documents into which a benchmark item leaks go;
* personal_data: spans are replaced by their kind, n_chars follows; a null text stays null;
* pieces: a null text is encoded as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dropwatch.llm import langid, minhash, pieces, pii, tiling
from dropwatch.llm.common import id_of, table, text_of, unused
from dropwatch.session import staged

LEAST_SCORE = 0.5
PIECE_MODEL = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.train(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = minhash.groups(docs, k=5).where("kept")
    did, key, copy, empty = (unused(docs, name) for name in ("did", "key", "copy", "empty"))
    kept = kept.select(id_of().alias(did), F.col("tkey").alias(key), (F.col("n_shingles") == 0).alias(empty))
    rows = docs.withColumns({did: id_of(), key: F.xxhash64(text_of())})
    # As JSON, columns of any type have an order.
    rest = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")], did))
    copies = Window.partitionBy(did, key).orderBy(rest)
    stay = rows.join(kept.distinct(), [did, key]).withColumn(copy, F.row_number().over(copies))
    return stay.where((F.col(copy) == 1) | F.col(empty)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tiling.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_and_decode(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", encoding),
]

# A trained classifier and merges can't be said in SQL; tests/llm has a plain version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
