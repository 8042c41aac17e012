"""Monitoring: label backfill, performance, drift and the retraining decision of one run date."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.one_row import beside
from ..operators.calendar import as_date, date_window
from ..operators.decisions import RetrainPolicy, days_since_training, decide_retraining
from ..operators.profile import drift_from_profile
from ..operators.psi import compute_drift, drift_summary
from ..operators.regression import monitor_metrics
from ..operators.upsert import backfill_labels
from ..schema import (
    DRIFT_CATEGORICAL,
    DRIFT_HISTORY,
    DRIFT_NUMERIC,
    LABEL,
    LISTING_DATE,
    LISTING_ID,
    MODEL_VERSION,
    PERFORMANCE_HISTORY,
    PREDICTION,
    RUN_DATE,
)
from ..sources.tables import create_table, merge_table, profile_name, replace_partitions
from ..staging import staged

# Fixed value: length of the monitoring window.
WINDOW_DAYS = 7


def champion_window(predictions: DataFrame, model_version, run_date, window_days=WINDOW_DAYS) -> DataFrame:
    """The champion's predictions of the monitoring window."""
    return date_window(predictions, run_date, window_days).where(F.col(MODEL_VERSION) == str(model_version))


def drift_of_window(baseline: DataFrame, window: DataFrame, policy=RetrainPolicy()) -> DataFrame:
    """Drift of the monitored columns and of the prediction."""
    return compute_drift(
        baseline,
        window,
        numeric_cols=DRIFT_NUMERIC,
        categorical_cols=DRIFT_CATEGORICAL,
        prediction_col=PREDICTION,
        threshold=policy.max_feature_psi,
    )


def stored_drift(spark: SparkSession, tables, window: DataFrame, policy=RetrainPolicy()):
    """Drift against the stored baseline: from its profile where it has one, else from its rows; None without a baseline."""
    if spark.catalog.tableExists(profile_name(tables.baseline)):
        return drift_from_profile(spark.table(profile_name(tables.baseline)), window, threshold=policy.max_feature_psi)
    if spark.catalog.tableExists(tables.baseline):
        return drift_of_window(spark.table(tables.baseline), window, policy)
    return None


def drift_rows(drift: DataFrame, run_date, model_version) -> DataFrame:
    """Rows for the drift history."""
    return drift.select(
        F.lit(as_date(run_date)).alias(RUN_DATE), F.lit(str(model_version)).alias(MODEL_VERSION), "feature", "psi", "drifted"
    )


def history_row(
    window: DataFrame, drift, versions: DataFrame, model_version, run_date, as_of, *,
    policy=RetrainPolicy(), window_days=WINDOW_DAYS, auto_retrain=False,
) -> DataFrame:
    """The row of the performance history: metrics, drift and the decision drawn from them.

    ``drift`` is None before a baseline exists. The three inputs are one row each.
    """
    if drift is None:
        summary = window.sparkSession.range(1).select(
            F.lit(None).cast("double").alias("max_feature_psi"),
            F.lit(None).cast("double").alias("prediction_psi"),
            F.array().cast("array<string>").alias("drifted_features"),
            F.lit(None).cast("long").alias("n_drifted"),
        )
    else:
        summary = drift_summary(drift)
    signals = beside(monitor_metrics(window), summary, days_since_training(versions, as_of))
    decided = decide_retraining(signals, policy, auto_retrain)
    run_date = as_date(run_date)
    known = {
        RUN_DATE: F.lit(run_date),
        "window_start": F.lit(run_date - dt.timedelta(days=window_days - 1)),
        MODEL_VERSION: F.lit(str(model_version)),
        "drifted_features": F.array_join("drifted_features", ","),
        "triggers": F.array_join("triggers", ","),
    }
    return decided.select(*[known.get(c, F.col(c)).alias(c) for c in PERFORMANCE_HISTORY.names])


def backfill(spark: SparkSession, tables):
    """Fills labels that have arrived. Only partitions with an open prediction that now has a label are rewritten."""
    predictions = spark.table(tables.predictions)
    labels = spark.table(tables.listings).where(F.col(LABEL).isNotNull()).select(LISTING_ID, LABEL)
    open_rows = predictions.where(F.col(LABEL).isNull() & F.col(LISTING_ID).isNotNull()).select(LISTING_ID, LISTING_DATE)
    # The labels that open rows wait for are few; both steps below use this copy.
    with staged(labels.join(open_rows.select(LISTING_ID).distinct(), LISTING_ID, "left_semi")) as labels:
        dates = [r[0] for r in open_rows.join(labels, LISTING_ID, "left_semi").select(LISTING_DATE).distinct().collect()]
        if dates:
            with staged(backfill_labels(predictions.where(F.col(LISTING_DATE).isin(dates)), labels)) as content:
                replace_partitions(spark, tables.predictions, content, LISTING_DATE, [], [LISTING_ID, MODEL_VERSION])


def monitor(
    spark: SparkSession, tables, model_version, run_date, versions: DataFrame, as_of, *,
    policy=RetrainPolicy(), window_days=WINDOW_DAYS, auto_retrain=False,
):
    """Runs the monitoring of a date and gives its history row; a rerun replaces the rows it wrote."""
    backfill(spark, tables)
    window = champion_window(spark.table(tables.predictions), model_version, run_date, window_days)
    drift = stored_drift(spark, tables, window, policy)
    if drift is not None:
        create_table(spark, tables.drift, DRIFT_HISTORY)
        merge_table(spark, tables.drift, drift_rows(drift, run_date, model_version), [RUN_DATE, "feature"])
    row = history_row(
        window, drift, versions, model_version, run_date, as_of,
        policy=policy, window_days=window_days, auto_retrain=auto_retrain,
    )
    create_table(spark, tables.performance, PERFORMANCE_HISTORY)
    with staged(row) as row:
        merge_table(spark, tables.performance, row, [RUN_DATE])
        return row.first()
