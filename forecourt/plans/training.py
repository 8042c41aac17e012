"""Training, validation and promotion of the price model."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.one_row import beside
from ..operators.asof import point_in_time_join
from ..operators.calendar import time_based_split, trailing_lookback
from ..operators.decisions import Thresholds, check_prediction_sanity, check_thresholds, combine, decide_promotion
from ..operators.model_input import cold_start_probe
from ..operators.price_model import TrainingParams, predict, train_model
from ..operators.profile import baseline_profile
from ..operators.quality import filter_valid
from ..operators.regression import prediction_sanity, regression_metrics
from ..schema import LABEL, LISTING_DATE, LISTING_ID, MODEL_VERSION, PREDICTION
from ..sources.tables import refresh_baseline
from ..staging import stage, staged

# History used for training and length of the holdout.
LOOKBACK_DAYS = 365
HOLDOUT_DAYS = 30
COLD_START_ROWS = 5


def training_sets(listings: DataFrame, index: DataFrame, *, lookback_days=LOOKBACK_DAYS, holdout_days=HOLDOUT_DAYS, as_of=None):
    """``(train, holdout, cutoff)``: valid listings of the look-back window with their market features.

    Pass a pinned snapshot of the listings, so that validation later sees the same holdout.
    """
    window = trailing_lookback(listings, lookback_days)
    # The last day counts whether its rows are valid or not.
    train, holdout, cutoff = time_based_split(window, holdout_days)
    train, holdout = filter_valid(train, as_of=as_of), filter_valid(holdout, as_of=as_of)
    return point_in_time_join(train, index), point_in_time_join(holdout, index), cutoff


def train(listings, index, params=TrainingParams(), **window):
    """``(model, holdout, cutoff)``."""
    train_df, holdout, cutoff = training_sets(listings, index, **window)
    return train_model(train_df, params), holdout, cutoff


def validate_model(model, holdout: DataFrame, index: DataFrame, thresholds=Thresholds()) -> DataFrame:
    """One row: metrics, sanity counts, cold-start counts, ``failures`` and ``passed``."""
    scored = stage(predict(model, holdout, keep=[LISTING_ID, LABEL]))
    probe = point_in_time_join(cold_start_probe(holdout, COLD_START_ROWS), index)
    cold = prediction_sanity(predict(model, probe, keep=[LISTING_ID]))
    cold_ok = (F.col("n_rows") == COLD_START_ROWS) & (F.col("non_finite") == 0) & (F.col("non_positive") == 0)
    text = "rows of a region without market history got no sane prediction"
    cold_failures = cold.select(F.array_compact(F.array(F.when(~cold_ok, F.lit(text)))).alias("cold_start_failures"))
    checked = beside(
        check_thresholds(regression_metrics(scored), thresholds),
        check_prediction_sanity(prediction_sanity(scored)).drop("n_rows"),
        cold_failures,
    )
    return combine(checked, "threshold_failures", "sanity_failures", "cold_start_failures")


def score_versions(models, holdout: DataFrame) -> DataFrame:
    """Label, prediction and version of the same rows for each version. ``models`` maps version to model."""
    scored = None
    for version, model in models.items():
        rows = predict(model, holdout, keep=[LABEL, LISTING_DATE]).withColumn(MODEL_VERSION, F.lit(str(version)))
        scored = rows if scored is None else scored.unionByName(rows)
    return scored.select(LABEL, PREDICTION, MODEL_VERSION)


def evaluate_versions(models, holdout: DataFrame) -> DataFrame:
    """Regression metrics per model version."""
    return regression_metrics(score_versions(models, holdout), by=[MODEL_VERSION])


def decide_on_scores(
    scored: DataFrame, challenger, champion=None, *, metric="mape", min_relative_improvement=0.0
) -> DataFrame:
    """The promotion decision on scored rows of both versions; a challenger with an insane prediction is never promoted."""
    decided = decide_promotion(
        regression_metrics(scored, by=[MODEL_VERSION]),
        challenger,
        champion,
        metric=metric,
        min_relative_improvement=min_relative_improvement,
    )
    own = scored.where(F.col(MODEL_VERSION) == str(challenger))
    sanity = check_prediction_sanity(prediction_sanity(own)).select("sanity_failures")
    sane = F.size("sanity_failures") == 0
    reason = F.when(sane, F.col("reason")).otherwise(F.array_join("sanity_failures", "; "))
    return beside(decided, sanity).withColumns({"promote": F.col("promote") & sane, "reason": reason}).drop("sanity_failures")


def promote(models, holdout, challenger, champion=None, **policy) -> DataFrame:
    """The promotion decision for a challenger on the evaluation window."""
    return decide_on_scores(stage(score_versions(models, holdout)), challenger, champion, **policy)


def evaluation_window(listings: DataFrame, index: DataFrame, *, holdout_days=HOLDOUT_DAYS, as_of=None) -> DataFrame:
    """Valid listings of the last ``holdout_days`` with their market features: what both versions are compared on."""
    return point_in_time_join(filter_valid(trailing_lookback(listings, holdout_days), as_of=as_of), index)


def promote_on_latest(spark, tables, models, challenger, champion=None, *, holdout_days=HOLDOUT_DAYS, as_of=None, **policy):
    """Decides on the latest rows and, if the challenger wins, renews the drift baseline from its scores of these rows.

    Returns the decision row.
    """
    rows = evaluation_window(spark.table(tables.listings), spark.table(tables.index), holdout_days=holdout_days, as_of=as_of)
    with staged(rows) as rows:
        decision = promote(models, rows, challenger, champion, **policy).first()
        if decision["promote"]:
            refresh_baseline(
                spark, tables.baseline, challenger,
                lambda: predict(models[challenger], rows).withColumn(MODEL_VERSION, F.lit(str(challenger))),
                profile=baseline_profile,
            )
    return decision
