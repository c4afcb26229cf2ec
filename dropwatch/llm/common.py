"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}
NO_ID = -(2**63)  # stands in for a null id inside an operator: smaller than all others


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_of(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(n, ARROW[k]) for n, k in (x.split() for x in schema.split(", "))])


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[list]], schema: str, done: Callable | None = None
) -> DataFrame:
    """df.mapInArrow; fn yields for each batch any number of lists of columns. done is called at the
    end of a task: workers are used again, also by other stages, and keep what is not given back."""
    kinds = arrow_schema(schema)

    def run(batches):
        try:
            for batch in batches:
                for columns in fn(batch):
                    arrays = [pa.array(c, t) for c, t in zip(columns, kinds.types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=kinds)
        finally:
            if done:
                done()

    return df.mapInArrow(run, schema)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
