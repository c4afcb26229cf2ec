"""What the operators leave in Python workers, which other stages use again."""

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from dropwatch.llm import pieces


def test_a_task_leaves_no_piece_model_in_its_worker(spark):
    path = public_tokenizers.path(corpus_pipeline.PIECE_MODEL)
    docs = spark.createDataFrame([(n, f"some words {n}") for n in range(20)], "doc_id long, text string").repartition(4)
    done = pieces.encode_and_decode(docs, path)
    assert done.count() == 20

    def left(batches):
        list(batches)
        yield pa.RecordBatch.from_pydict({"id": pa.array([pieces.model.cache_info().currsize], pa.int64())})

    assert done.agg(F.sum("n_tokens")).first()[0] > 0
    assert {r.id for r in spark.range(64, numPartitions=16).mapInArrow(left, "id long").collect()} == {0}
