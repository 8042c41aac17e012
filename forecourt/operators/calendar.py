"""Date columns, date windows and the time-based split."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import LISTING_DATE


def add_calendar_cols(df: DataFrame, date_col=LISTING_DATE) -> DataFrame:
    """Adds listing_year and listing_month as bigint."""
    return df.withColumns(
        {"listing_year": F.year(date_col).cast("long"), "listing_month": F.month(date_col).cast("long")}
    )


def date_window(df: DataFrame, run_date, lookback_days, date_col=LISTING_DATE) -> DataFrame:
    """The closed range of ``lookback_days`` days that ends with ``run_date``."""
    run_date = as_date(run_date)
    return df.where(F.col(date_col).between(run_date - dt.timedelta(days=lookback_days - 1), run_date))


def trailing_lookback(df: DataFrame, days, date_col=LISTING_DATE) -> DataFrame:
    """The last ``days`` days of the table, its latest date included. The latest date is a scalar subquery."""
    latest = df.agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) > F.date_sub(latest, days))


def holdout_cutoff(max_date, holdout_days):
    """First day of the holdout window."""
    if holdout_days < 1:
        raise ValueError("holdout_days must be at least 1")
    return as_date(max_date) - dt.timedelta(days=holdout_days - 1)


def label_split(df: DataFrame, holdout_days, date_col=LISTING_DATE) -> DataFrame:
    """Adds ``split``: 'holdout' for the last ``holdout_days`` days of the table, else 'train'."""
    if holdout_days < 1:
        raise ValueError("holdout_days must be at least 1")
    first_held_out = F.date_sub(df.agg(F.max(date_col)).scalar(), holdout_days - 1)
    return df.withColumn("split", F.when(F.col(date_col) < first_held_out, "train").otherwise("holdout"))


def time_based_split(df: DataFrame, holdout_days, date_col=LISTING_DATE):
    """``(train, holdout, cutoff)``: holdout is the last ``holdout_days`` days. Raises when either side is empty.

    The table's first and last date come back to the driver as one row, so that both sides are filters on a literal,
    which the scan can use to skip files.
    """
    span = df.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last")).first()
    if span["last"] is None:
        raise ValueError("time split of an empty table")
    cutoff = holdout_cutoff(span["last"], holdout_days)
    if as_date(span["first"]) >= cutoff:
        raise ValueError(f"time split at {cutoff} leaves no training rows; add history or shorten the holdout")
    return df.where(F.col(date_col) < cutoff), df.where(F.col(date_col) >= cutoff), cutoff


def as_date(value):
    """A ``date`` from a date or ISO text."""
    if isinstance(value, str):
        return dt.date.fromisoformat(value)
    return value.date() if isinstance(value, dt.datetime) else value
