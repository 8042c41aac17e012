"""Fixed intermediate copies."""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame

from .session import checkpoint_dir


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.

    A copy that is read several times, or that replaces what it was computed from, must neither change nor get lost with
    an executor. Being a parquet file it also keeps column pruning and filter pushdown.
    """
    return _copy(df)[0]


def _copy(df):
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def read_once(df: DataFrame) -> DataFrame:
    """``df`` for several passes: as it is where a pass only scans, staged where it would join or aggregate every time."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return stage(df) if any(f"{node} " in plan for node in ("Join", "Aggregate", "Window")) else df


@contextmanager
def staged(df: DataFrame):
    """Like :func:`stage` for work that is done by the end of the block; the copy is removed then."""
    copy, path = _copy(df)
    try:
        yield copy
    finally:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
