"""Market index job."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import as_date
from ..operators.market_index import (
    affected_rows,
    compute_market_index,
    days_read,
    first_index_date,
    index_input,
    latest_features,
    recompute_index,
)
from ..schema import INDEX_DATE, MARKET_INDEX, MARKET_KEYS
from ..sources.tables import create_table, merge_newer, merge_table
from ..staging import staged
from .ingest import last_load

# Fixed value: index days a regular run computes again.
BACKFILL_DAYS = 3


def index_range(spark: SparkSession, tables, run_date, backfill_days=BACKFILL_DAYS):
    """First and last index date of a run: from the first possible day when there is no index yet."""
    run_date = as_date(run_date)
    if spark.catalog.tableExists(tables.index):
        return run_date - dt.timedelta(days=backfill_days - 1), run_date
    return first_index_date(spark.table(tables.listings)), run_date


def apply_changes(spark: SparkSession, index_table, listings: DataFrame, changes: DataFrame, run_date):
    """Recomputes and merges the index rows that changed (key, day) pairs have a part in; gives the set of their dates.

    A label that arrives however late thus enters the index. Only the listing days within the windows of those rows are
    read, and only the index dates among them are rewritten.
    """
    index = spark.table(index_table)
    start = index.agg(F.min(INDEX_DATE)).first()[0]
    if start is None:
        return set()
    with staged(affected_rows(changes, index, start, run_date)) as affected:
        days = days_read(affected)
        if not days:
            return set()
        merge_table(spark, index_table, recompute_index(listings, affected, days), [*MARKET_KEYS, INDEX_DATE])
        return {r[0] for r in affected.select(INDEX_DATE).distinct().collect()}


def _applied(spark, index_table):
    """The last load whose changes are in the index."""
    row = spark.sql(f"SHOW TBLPROPERTIES {index_table}").where("key = 'applied_load'").select("value").first()
    return 0 if row is None else int(row[0])


def refresh_market_index(spark: SparkSession, tables, run_date, *, backfill_days=BACKFILL_DAYS, publish=False):
    """The regular run, and after it whatever loads since the last one have changed further back.

    The number of the last load applied is kept with the index table and set after the merge: a run that breaks off is
    done over, with the same result.
    """
    seen = last_load(spark, tables)
    new = not spark.catalog.tableExists(tables.index)
    span, touched = build_market_index(spark, tables, run_date, backfill_days=backfill_days), set()
    if not new and seen:
        changes = spark.table(tables.changes).where((F.col("load") > _applied(spark, tables.index)) & (F.col("load") <= seen))
        touched = apply_changes(spark, tables.index, spark.table(tables.listings), changes.drop("load"), run_date)
    spark.sql(f"ALTER TABLE {tables.index} SET TBLPROPERTIES ('applied_load' = '{seen}')")
    if publish:
        publish_latest(spark, tables, _between(*span) | touched)
    return span


def build_market_index(spark: SparkSession, tables, run_date, *, backfill_days=BACKFILL_DAYS, publish=False):
    """Computes and merges the index for a run date. The date is part of the key, so only its partitions change."""
    start, end = index_range(spark, tables, run_date, backfill_days)
    listings = index_input(spark.table(tables.listings), start, end)
    create_table(spark, tables.index, MARKET_INDEX, partition_by=INDEX_DATE)
    merge_table(spark, tables.index, compute_market_index(listings, start, end), [*MARKET_KEYS, INDEX_DATE])
    if publish:
        publish_latest(spark, tables, _between(start, end))
    return start, end


def publish_latest(spark: SparkSession, tables, dates=None):
    """Brings the look-up table of every key's newest row up to date.

    The first time it is made from the whole index. Afterwards only the index rows of ``dates``, those a run has written,
    are read and merged where they are as new as what is published; without ``dates`` all are.
    """
    index = spark.table(tables.index)
    if not spark.catalog.tableExists(tables.latest_index):
        create_table(spark, tables.latest_index, MARKET_INDEX)
        dates = None
    rows = index if dates is None else index.where(F.col(INDEX_DATE).isin(sorted(dates)))
    merge_newer(spark, tables.latest_index, latest_features(rows).select(*MARKET_INDEX.names), MARKET_KEYS, INDEX_DATE)


def _between(start, end):
    return {start + dt.timedelta(days=k) for k in range((end - start).days + 1)}
