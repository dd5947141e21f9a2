"""Where intermediate results live: the folder the cluster shares."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_test_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the context's checkpoint
    folder.  Only a local session without either (a laptop, a test) takes a
    folder of this machine; a cluster has to name one that it shares."""
    global _test_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _test_folder is None:
        _test_folder = tempfile.mkdtemp(prefix="statwright-")
    return _test_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/statwright-{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder, so a
    lost executor can re-read the rows instead of computing other ones."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Other settings of the session for a while."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def written(df: DataFrame, release: bool = False, batch: int | None = None) -> DataFrame:
    """The same as a Parquet table in the shared folder: smaller than a
    checkpoint, and later steps read only the columns they use.  ``release``:
    Spark drops the shuffle files of this write as soon as it is done.
    ``batch``: bytes after which a batch of rows goes to a Python worker, so
    that few large rows are not held together."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    with settings(spark, {CLEANUP: "true"} if release else {}), settings(spark, {BATCH_BYTES: str(batch)} if batch else {}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, **options: str) -> DataFrame:
    """The same as a Parquet table in buckets of ``key``, as many as shuffles have partitions: joins by ``key`` read it in place."""
    spark = df.sparkSession
    name = f"statwright_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).sortBy(key).format("parquet").options(**options).option("path", scratch_path(spark, "table")).saveAsTable(name)
    return spark.table(name)
