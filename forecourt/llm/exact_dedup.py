"""Exact deduplication: frequent digests are settled on the map side, all others by one ordinary shuffle.

A Misra-Gries summary of ``k`` counters per task finds every digest that can hold more than 2/(k+1) of the rows. The
groups of these few digests are counted exactly and their winners broadcast (at most ``k`` rows), so a text that a third
of all rows share never meets in one task. The remaining digests are shuffled once and settled in a window.
"""

from collections import Counter

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import SPACES, by_place, fixed

#: Counters of a Misra-Gries summary, and so the most digests that are broadcast.
COUNTERS = 4096


def summarise(counts, more, counters):
    """Adds the counts ``more`` to the Misra-Gries summary ``counts``; at most ``counters`` entries are left.

    An entry's count is low by at most (rows seen) / (counters + 1).
    """
    for value, n in more.items():
        counts[value] = counts.get(value, 0) + n
    if len(counts) > counters:
        cut = sorted(counts.values(), reverse=True)[counters]
        for value in [v for v, n in counts.items() if n <= cut]:
            del counts[value]
        for value in counts:
            counts[value] -= cut
    return counts


def frequent(df, column, counters=COUNTERS):
    """Values of a binary column that may hold more than 2/(counters+1) of the rows: at most ``counters`` rows.

    Each task sends its summary's counts; those of one value are added up. A value with more than 2n/(k+1) of the n rows
    loses n/(k+1) at most and so stays above n/(k+1), which no more than k values can.
    """

    def task(batches):
        counts = {}
        for batch in batches:
            counts = summarise(counts, Counter(batch.column(0).to_pylist()), counters)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], [column, "low_count"]
            )

    least = df.count() / (counters + 1)
    sums = df.select(column).mapInArrow(task, f"{column} binary, low_count long")
    sums = sums.groupBy(column).agg(F.sum("low_count").alias("low_count"))
    return sums.where(F.col("low_count") > least).select(column)


def _digests(docs, id_col, text_col):
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).alias("n"),
        F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)).alias("digest"),
    )


def _order():
    # The longest first, then the smallest id; a null id comes last; of equal rows the first one written.
    return F.struct(
        (-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row")
    )


def _decide(docs, id_col, text_col, counters):
    rows = fixed(_digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    size, first = F.count(F.lit(1)), F.min(_order())
    hot = rows.join(F.broadcast(frequent(rows, "digest", counters)), "digest")
    winners = fixed(hot.groupBy("digest").agg(size.alias("group_size"), first.alias("first")).where("group_size > 1"))
    known = rows.join(F.broadcast(winners), "digest", "left")
    group = Window.partitionBy("digest")
    rest = known.where(F.col("first").isNull()).drop("group_size", "first")
    rest = rest.withColumns({"group_size": size.over(group), "first": first.over(group)})
    return known.where(F.col("first").isNotNull()).unionByName(rest)


def exact_dedup(docs, id_col="doc_id", text_col="text", counters=COUNTERS):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are without their ASCII white space. The one with the most code points stays, then the one
    with the smallest id. A null text is an empty one. A null id loses to any other; of rows that agree in id and text
    one stays. An empty table gives no rows; other columns are not looked at.
    """
    return _decide(docs, id_col, text_col, counters).select(
        "doc_id",
        F.col("first.id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@by_place
def drop_copies(docs, id_col="doc_id", text_col="text", counters=COUNTERS):
    """``docs`` without the rows that :func:`exact_dedup` drops, all columns as they are."""
    decided = _decide(docs, id_col, text_col, counters)
    twin = (F.col("doc_id").eqNullSafe(F.col("first.id"))) & (F.col("n") == -F.col("first.less"))
    # Rows that agree with the winner in id and length are the winner or repeat it; they are told apart below.
    kept = decided.where(twin).groupBy("digest", "doc_id", "n").agg(F.count(F.lit(1)).alias("twins"))
    kept = kept.select(*[F.col(c).alias(f"_kept_{c}") for c in kept.columns])
    digest = F.unhex(F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), SPACES, "").cast("binary"), 256))
    marked = docs.withColumn("_doc_digest", digest).join(
        kept,
        (F.col("_doc_digest") == F.col("_kept_digest"))
        & F.col(id_col).eqNullSafe(F.col("_kept_doc_id"))
        & (F.length(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_kept_n")),
    )
    once = marked.where("_kept_twins = 1").select(*docs.columns)
    repeated = marked.where("_kept_twins > 1").dropDuplicates([id_col, "_doc_digest"]).select(*docs.columns)
    return once.unionByName(repeated)
