"""Batch scoring of the champion."""

from pyspark.sql import SparkSession

from ..operators.calendar import date_window
from ..operators.price_model import score_batch
from ..schema import LISTING_DATE, LISTING_ID, MODEL_VERSION, PREDICTION, PREDICTIONS, SCORED_AT
from ..sources.models import CHAMPION, load_model, resolve_alias, score_stored
from ..sources.tables import create_table, merge_table


def score(spark: SparkSession, tables, model, model_version, run_date, *, lookback_days=1, scored_at=None):
    """Scores the listings of the window ending with ``run_date``.

    A listing scored before by the same version gets a new prediction and time; its label and inputs stay.
    """
    if model is None:
        raise RuntimeError("there is no champion yet; train a model first")
    window = date_window(spark.table(tables.listings), run_date, lookback_days)
    _merge_scores(spark, tables, score_batch(model, window, spark.table(tables.index), model_version, scored_at))


def score_champion(spark: SparkSession, tables, root, run_date, *, lookback_days=1, scored_at=None, alias=CHAMPION):
    """Scores the listings of the window with the version an alias names in the model store ``root``; gives the version.

    The alias is resolved once. What the model looks up comes from its manifest.
    """
    version = resolve_alias(spark, root, alias)
    if version is None:
        raise RuntimeError(f"no model version is the {alias} yet; train and promote one first")
    window = date_window(spark.table(tables.listings), run_date, lookback_days)
    _merge_scores(spark, tables, score_stored(load_model(spark, root, version), window, scored_at))
    return version


def _merge_scores(spark, tables, scored):
    create_table(spark, tables.predictions, PREDICTIONS, partition_by=LISTING_DATE)
    merge_table(
        spark, tables.predictions, scored, [LISTING_ID, MODEL_VERSION], update_cols=[PREDICTION, SCORED_AT]
    )
