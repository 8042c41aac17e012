"""What the operators of this package share: fixed copies, shared files, and Arrow helpers for work inside tasks."""

import inspect
import posixpath
import uuid
from functools import wraps

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: ASCII white space as the operators' contracts write it: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"


def fixed(df):
    """``df`` computed once and kept in the shared checkpoint folder; a lost executor costs nothing of it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def by_place(function):
    """Makes a function of (docs, ..., id_col, text_col, ...) that returns rows of ``docs`` blind to the columns' names: it
    sees them numbered, so no caller's column can meet one of its own."""
    signature = inspect.signature(function)

    @wraps(function)
    def run(*args, **options):
        given = signature.bind(*args, **options)
        given.apply_defaults()
        docs = given.arguments["docs"]
        numbered = {name: f"c{k}" for k, name in enumerate(docs.columns)}
        lowered = {name.lower(): place for name, place in numbered.items()}
        for column in ("id_col", "text_col"):
            name = given.arguments[column]
            given.arguments[column] = numbered.get(name) or lowered[name.lower()]
        given.arguments["docs"] = docs.toDF(*numbered.values())
        return function(*given.args, **given.kwargs).toDF(*docs.columns)

    return run


def drawn(rows, draw, n):
    """At most ``n`` rows, those with the smallest values of ``draw``, a column of evenly spread longs.

    Few more than ``n`` rows leave the tasks: a threshold is set from the number of rows before they are sorted.
    """
    total = rows.count()
    if total > 2 * n:
        reach = int((2 * n + 100) / total * 2.0**64) - 2**63
        rows = rows.where(F.col(draw) <= F.lit(min(reach, 2**63 - 1)))
    return rows.orderBy(*[draw, *[c for c in rows.columns if c != draw]]).limit(n)


def folder(spark, name):
    """A new folder's path below the shared checkpoint folder, for files that tasks write."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(path):
    """(file system, path in it) of a path or URI; whatever pyarrow reaches: mounted folders, HDFS, object stores."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def put_file(path, data):
    """Writes a file under a name of its own and renames it, so that a reader sees all of it or nothing."""
    store, name = file_system(path)
    store.create_dir(posixpath.dirname(name), recursive=True)
    part = f"{name}.part-{uuid.uuid4().hex}"
    with store.open_output_stream(part, compression=None) as out:
        out.write(data)
    store.move(part, name)


def binary_column(batch, name):
    """A text or binary column of a record batch as a list of bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.binary())
    return [v or b"" for v in column.to_pylist()]


#: Functions that drop what a Python worker remembers from task to task.
FORGET = []


def forget():
    """Called where a worker turns to work of another kind, so that tables of different operators don't add up."""
    for drop in FORGET:
        drop()


#: Rows of an Arrow batch, where the session leaves Spark's default of 10,000: rows of whole texts are large.
BATCH_ROWS = 1000


def importable(spark):
    """Readies a session for these operators: lets Python workers import this package where it isn't installed (they get
    the folder it was imported from), and keeps Arrow batches of texts small unless the session says otherwise."""
    root = posixpath.dirname(posixpath.dirname(posixpath.dirname(posixpath.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
    return spark
