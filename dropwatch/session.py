"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; adaptive execution sizes reducers, splits skewed join partitions and
# broadcasts a join side only after its real size is known.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the runtime settings. Give a generous shuffle_partitions on a cluster (about
    shuffled bytes / 128 MB): adaptive execution merges what turns out to be too small."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder reachable by every executor: the session's checkpoint folder. Only a local
    session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="dropwatch-"))
    return context.getCheckpointDir()


# Paths that this process has handed out and not yet deleted.
_own_paths: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark).rstrip('/')}/dropwatch/{name}-{uuid.uuid4().hex}"
    _own_paths.append(path)
    return path


# Fixed value: bytes of data files that one task is given where rows are multiplied.
BYTES_PER_TASK = 4 * 2**20


def tasks_for(df: DataFrame) -> int:
    """A number of partitions that follows the size of the files df is read from, so that a task's
    share stays the same; without files, the session's number."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    size = sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)
    return max(spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_TASK))


def delete_staged(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process. For the end of a job: results that are still
    to be computed from them are lost."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _own_paths:
        path = jvm.org.apache.hadoop.fs.Path(_own_paths.pop())
        path.getFileSystem(conf).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once and read it back, so that several consumers share one computation.

    The table survives the loss of executors, cuts the lineage, is columnar (each consumer
    reads only its columns) and has a known size, which join planning uses.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
