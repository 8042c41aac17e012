"""Validation gates, promotion and retraining as expressions over one-row or per-version metric tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MODEL_VERSION
from .regression import HIGHER_IS_BETTER


@dataclass(frozen=True)
class Thresholds:
    """Defaults of the validation gate."""

    max_mape: float = 0.12
    max_mae: float = 2500.0
    min_r2: float = 0.90


@dataclass(frozen=True)
class RetrainPolicy:
    """Defaults of the retraining policy."""

    max_mape: float = 0.12
    min_labeled_rows: int = 200
    max_feature_psi: float = 0.25
    min_drifted_features: int = 1
    max_prediction_psi: float = 0.25
    min_rows_for_drift: int = 200
    cooldown_days: float = 3


def _known(c):
    return c.isNotNull() & ~F.isnan(c)


def _texts(*items):
    """The non-NULL texts as an array."""
    return F.array_compact(F.array(*items)).cast("array<string>")


def check_thresholds(metrics: DataFrame, thresholds=Thresholds()) -> DataFrame:
    """Adds ``threshold_failures`` to rows with mape, mae and r2. An unknown metric fails."""

    def failure(metric, ok, digits, sign, limit):
        c = F.col(metric)
        text = F.format_string(f"{metric} %.{digits}f {sign} {limit}", c)
        return F.when(~(_known(c) & ok), F.coalesce(text, F.lit(f"{metric} unknown")))

    t = thresholds
    return metrics.withColumn(
        "threshold_failures",
        _texts(
            failure("mape", F.col("mape") <= t.max_mape, 4, ">", t.max_mape),
            failure("mae", F.col("mae") <= t.max_mae, 2, ">", t.max_mae),
            failure("r2", F.col("r2") >= t.min_r2, 4, "<", t.min_r2),
        ),
    )


def check_prediction_sanity(counts: DataFrame) -> DataFrame:
    """Adds ``sanity_failures`` to the counts of :func:`~forecourt.operators.regression.prediction_sanity`."""
    return counts.withColumn(
        "sanity_failures",
        _texts(
            F.when(F.col("n_rows") == 0, F.lit("nothing was scored")),
            F.when(F.col("non_finite") > 0, F.format_string("%d predictions missing or not finite", "non_finite")),
            F.when(F.col("non_positive") > 0, F.format_string("%d predictions at or below zero", "non_positive")),
        ),
    )


def combine(checked: DataFrame, *failure_cols) -> DataFrame:
    """Adds ``failures`` (all lists, in order), ``failure_text`` and ``passed``."""
    failures = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in map(F.col, failure_cols)])
    return (
        checked.withColumn("failures", failures)
        .withColumn("failure_text", F.array_join("failures", "; "))
        .withColumn("passed", F.size("failures") == 0)
    )


def decide_promotion(
    metrics: DataFrame, challenger, champion=None, *, metric="mape", min_relative_improvement=0.0
) -> DataFrame:
    """One row: challenger, champion, both values, the required value, ``promote`` and ``reason``.

    ``metrics`` has one row per model version. Without a champion, or when it is the challenger itself, the challenger
    is promoted. Otherwise it has to reach the champion's value improved by the margin; a tie is enough, NaN is not.
    """
    if metric not in HIGHER_IS_BETTER:
        raise ValueError(f"versions cannot be compared by {metric}; known are {sorted(HIGHER_IS_BETTER)}")
    rival = None if champion is None or str(champion) == str(challenger) else str(champion)
    version = F.col(MODEL_VERSION)
    row = metrics.where(version.isin([str(challenger)] + ([rival] if rival else []))).agg(
        F.max(F.when(version == str(challenger), F.col(metric))).alias("challenger_value"),
        F.max(F.when(version == F.lit(rival), F.col(metric))).alias("champion_value"),
    )
    new, old = F.col("challenger_value"), F.col("champion_value")
    margin = F.abs(old) * min_relative_improvement
    required = old + margin if HIGHER_IS_BETTER[metric] else old - margin
    reached = new >= required if HIGHER_IS_BETTER[metric] else new <= required
    better = F.coalesce(_known(new) & _known(old) & reached, F.lit(False))
    verdict = F.when(better, "good enough").otherwise("not good enough")
    told = F.format_string(f"{metric} %.4f is %s: needed %.4f, champion has %.4f", new, verdict, required, old)
    return row.select(
        F.lit(str(challenger)).alias("challenger"),
        F.lit(rival).cast("string").alias("champion"),
        new,
        old,
        required.alias("required_value"),
        (better if rival else F.lit(True)).alias("promote"),
        (told if rival else F.lit("no other version to compare with")).alias("reason"),
    )


def days_since_training(versions: DataFrame, as_of, trained_at="trained_at") -> DataFrame:
    """One row with the days from the newest version of any status to ``as_of``; NULL when there is none."""
    now = F.lit(as_of).cast("timestamp")
    seconds = F.unix_micros(now) - F.unix_micros(F.max(F.col(trained_at).cast("timestamp")))
    return versions.agg((seconds / F.lit(86400.0 * 1e6)).alias("days_since_training"))


def decide_retraining(signals: DataFrame, policy=RetrainPolicy(), auto_retrain=False) -> DataFrame:
    """Adds triggers, alert_triggered, retrain_recommended, retrain_triggered and reason to rows of signals.

    Expected columns: labeled_rows, scored_rows, mape, max_feature_psi, prediction_psi, drifted_features (array),
    n_drifted, days_since_training. ``n_drifted`` is NULL where there is no baseline to compare with; a NULL
    ``days_since_training`` means never trained, so no cooldown applies. Every comparison is strict. A NaN error, from
    labelled rows without a finite prediction, counts as too large.
    """
    mape, labeled, scored = F.col("mape"), F.col("labeled_rows"), F.col("scored_rows")
    enough_labels = F.coalesce(labeled >= policy.min_labeled_rows, F.lit(False)) & mape.isNotNull()
    enough_rows = F.coalesce(scored >= policy.min_rows_for_drift, F.lit(False)) & F.col("n_drifted").isNotNull()
    slow = enough_labels & (F.isnan(mape) | (mape > policy.max_mape))
    shifted = enough_rows & (F.col("n_drifted") >= policy.min_drifted_features)
    psi = F.col("prediction_psi")
    moved = enough_rows & F.coalesce(_known(psi) & (psi > policy.max_prediction_psi), F.lit(False))
    days = F.col("days_since_training")
    cooling = F.coalesce(days < policy.cooldown_days, F.lit(False))
    alert = slow | shifted | moved

    performance = (
        F.when(~enough_labels, F.format_string(f"errors not judged with %d of {policy.min_labeled_rows} labels", labeled))
        .when(slow, F.format_string(f"mape %.4f is above {policy.max_mape}", mape))
        .otherwise(F.format_string("mape %.4f is fine", mape))
    )
    names = F.array_join("drifted_features", ", ")
    data = (
        F.when(~enough_rows, F.format_string(f"drift not judged with %d of {policy.min_rows_for_drift} scored rows", scored))
        .when(shifted, F.format_string(f"PSI above {policy.max_feature_psi} in %s", names))
        .otherwise(F.format_string("largest PSI %.3f is fine", "max_feature_psi"))
    )
    output = F.when(moved, F.format_string(f"PSI of predictions %.3f is above {policy.max_prediction_psi}", psi))
    waiting = F.when(
        alert & cooling,
        F.format_string(f"too soon: trained %.1f of {policy.cooldown_days} days ago", days),
    )
    triggers = _texts(
        F.when(slow, F.lit("performance")),
        F.when(shifted, F.lit("data_drift")),
        F.when(moved, F.lit("prediction_drift")),
    )
    return (
        signals.withColumn("triggers", triggers)
        .withColumn("alert_triggered", alert)
        .withColumn("retrain_recommended", alert & ~cooling)
        .withColumn("retrain_triggered", F.col("retrain_recommended") & F.lit(bool(auto_retrain)))
        .withColumn("reason", F.array_join(_texts(performance, data, output, waiting), "; "))
    )


def alert_count(history: DataFrame, as_of=None) -> DataFrame:
    """One row: ``alerts``, the history rows of the last day up to ``as_of`` that raised an alert."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return history.where(F.col("alert_triggered") & (F.col("run_date") >= F.date_sub(today, 1))).agg(
        F.count("*").alias("alerts")
    )
