"""Helpers shared by the operators of this subpackage: staging, bounds, input frames."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares: ``spark.checkpoint.dir``, or the context's checkpoint
    folder. Without either, a local master gets a temporary one; any other session raises."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _LOCAL.setdefault("folder", tempfile.mkdtemp(prefix="staged-"))
    return folder.rstrip("/")


_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, name: str, keep: bool = False, by: str | None = None,
          compression: str = "snappy") -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back. This cuts the lineage:
    a lost executor costs tasks, never rows, and nothing is computed twice. Within
    ``intermediates`` the folder goes at its end, unless it is to be kept. With ``by`` each value
    of that column has a folder of its own, so a filter on it reads no others."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path, compression=compression)
    if not keep and (paths := _STAGED.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession):
    """Delete what is staged inside the block once it ends: for whoever writes a result there."""
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of rows that a Python stage gets at once. Else it's 10,000 rows, and a task's buffers on either side grow with the texts.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of about ``BATCH_BYTES``, or of fewer
    bytes or rows if that is set. A longer row is a batch of its own, so nothing is cut."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark a frame for broadcast if it is proven to hold no more than ``max_rows`` rows of
    fixed width; a larger one is returned as it is and joined by a shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def texts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The frame with the text column cast to string (null stays null)."""
    return df.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
