"""Ingestion: quality gate, quarantine and merge of one feed."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import as_date
from ..operators.market_index import changed_days
from ..operators.quality import enforce_gate, filter_valid, quarantine, validate_listings
from ..schema import LABEL, LISTING_CHANGES, LISTING_DATE, LISTING_ID, MARKET_KEYS, RAW_COLUMNS, RAW_LISTINGS
from ..sources.tables import create_table, merge_table, write_quarantine
from ..staging import staged

# Days of history a run loads, for a new and for an existing table; largest share of invalid rows.
FIRST_BACKFILL_DAYS = 365
BACKFILL_DAYS = 1
MAX_INVALID_FRACTION = 0.02


def feed_window(feed: DataFrame, run_date, table_existed, first_days=FIRST_BACKFILL_DAYS, days=BACKFILL_DAYS) -> DataFrame:
    """The part of a feed a run takes: a long stretch for a new table, the last days otherwise."""
    span = days if table_existed else first_days
    run_date = as_date(run_date)
    return feed.where(F.col(LISTING_DATE).between(run_date - dt.timedelta(days=span - 1), run_date))


def feed_digest(feed: DataFrame) -> str:
    """A name for a feed by its content, whatever the order of its rows."""
    # A map has no hash of its own; its text has one.
    cells = [F.to_json(c) if kind.startswith("map") else F.col(c) for c, kind in feed.dtypes]
    row = feed.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*cells).cast("decimal(38,0)")).alias("s")).first()
    return f"{row.n}-{row.s}"


def record_changes(spark: SparkSession, tables, incoming: DataFrame):
    """Notes the market keys and days that merging ``incoming`` changes, before it is merged; gives the load's number.

    Rows that are stored as they come change nothing. A load that breaks off and is repeated is noted again, which costs
    a recomputation and harms nothing.
    """
    create_table(spark, tables.changes, LISTING_CHANGES, partition_by="load")
    columns = [*MARKET_KEYS, LISTING_DATE, LABEL, "year", "mileage"]
    stored = spark.table(tables.listings).join(incoming.select(LISTING_ID), LISTING_ID, "left_semi")
    changes = changed_days(stored.select(*columns), incoming.select(*columns))
    load = last_load(spark, tables) + 1
    with staged(changes.withColumn("load", F.lit(load).cast("long"))) as noted:
        noted.select(*spark.table(tables.changes).columns).write.insertInto(tables.changes)
    return load


def last_load(spark: SparkSession, tables):
    """The number of the last load that changed something, from the names of partitions; 0 at first."""
    if not spark.catalog.tableExists(tables.changes):
        return 0
    names = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {tables.changes}").collect()]
    return max((int(n) for n in names if n.isdigit()), default=0)


def ingest(
    spark: SparkSession, feed: DataFrame, tables, run_date, *, max_invalid_fraction=MAX_INVALID_FRACTION, by_id=True,
    windowed=False, feed_id=None,
):
    """Lands a feed in the listings table and gives the quality report row. A failed gate writes nothing.

    The feed is read once: gate, merge and quarantine all see the same copy. ``windowed`` takes only the dates a run is
    due to load, for a feed that is a table with all history. ``feed_id`` names the feed in the quarantine, where a rerun
    replaces that feed's rows of the date and no other's; without it a digest of the content does.
    """
    existed = create_table(spark, tables.listings, RAW_LISTINGS, partition_by=LISTING_DATE)
    with staged(feed_window(feed, run_date, existed) if windowed else feed) as feed:
        report = enforce_gate(validate_listings(feed, as_of=run_date), max_invalid_fraction)
        valid = filter_valid(feed, as_of=run_date).select(*RAW_COLUMNS)
        record_changes(spark, tables, valid)
        merge_table(spark, tables.listings, valid, [LISTING_ID])
        held = quarantine(feed, by_id=by_id, as_of=run_date)
        write_quarantine(spark, tables.quarantine, held, run_date, feed_id or feed_digest(feed))
    return report
