"""The registered queries: every operator on the input views, each with the SQL that must give the same rows.

Averages, logarithms and PSI values are rounded to 6 digits on both sides, because engines add doubles in different
orders. Money is compared as stored.
"""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from . import oracle as sql
from .functions.request_features import NUMERIC_FEATURES, add_features
from .operators import decisions, market_index, model_input, profile, psi, quality, regression
from .operators.asof import point_in_time_join
from .operators.calendar import add_calendar_cols, date_window, label_split, time_based_split, trailing_lookback
from .operators.pooling import pooled_categories
from .operators.price_model import TrainingParams, evaluate_model, score_batch, train_model
from .operators.upsert import backfill_labels, upsert
from .plans.features import apply_changes
from .plans.monitoring import champion_window, drift_of_window, drift_rows, history_row
from .plans.training import decide_on_scores
from .schema import (
    CATEGORICAL,
    DRIFT_CATEGORICAL,
    DRIFT_NUMERIC,
    INDEX_DATE,
    LABEL,
    LISTING_DATE,
    LISTING_ID,
    MARKET_FEATURES,
    MARKET_INDEX,
    MARKET_KEYS,
    MODEL_VERSION,
    PERFORMANCE_HISTORY,
    PREDICTION,
    RAW_COLUMNS,
    RAW_LISTINGS,
    REQUEST_COLUMNS,
    RESCUED,
    RUN_DATE,
    SCORED_AT,
)
from .session import checkpoint_dir
from .sources.listings_csv import read_listings_csv
from .sources.models import load_model, market_lookup, resolve_alias, save_model, score_stored, set_alias
from .sources.tables import (
    clustered,
    create_like,
    create_table,
    latest_snapshot,
    merge_newer,
    merge_table,
    profile_name,
    read_snapshot,
    refresh_baseline,
    write_quarantine,
    write_snapshot,
)
from .sources.views import view
from .staging import read_once

AS_OF = sql.AS_OF
QUERIES = {}
ORACLES = {}


def query(oracle=None):
    """Registers a function of (spark, sf_dir) under its name, with its SQL."""

    def register(build):
        QUERIES[build.__name__] = build
        if oracle is not None:
            ORACLES[build.__name__] = oracle
        return build

    return register


def _rounded(df, *names, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else c for c in df.columns])


def _folder(spark):
    return f"{checkpoint_dir(spark)}/check-{uuid.uuid4().hex}"


def _once(spark, sf_dir, name, *columns, where="true"):
    """A view that the query reads several times, joined together once; of its rows and columns those that are needed."""
    return read_once(view(spark, sf_dir, name).where(where).select(*(columns or ["*"])))


def _year_index(listings):
    source = market_index.index_input(listings, sql.INDEX_START, sql.INDEX_END)
    return market_index.compute_market_index(source, sql.INDEX_START, sql.INDEX_END)


def _index(listings):
    """The index over the whole history: from the day after the first listing to the day of the last one."""
    first, last = listings.agg(F.min(LISTING_DATE), F.max(LISTING_DATE)).first()
    start = first + dt.timedelta(days=1)
    return market_index.compute_market_index(market_index.index_input(listings, start, last), start, last)


# --- market index and as-of join


@query(sql.MARKET_INDEX)
def market_index_year(spark, sf_dir):
    return _rounded(_year_index(view(spark, sf_dir, "listings")), *MARKET_FEATURES[1:])


@query(sql.FIRST_RUN)
def market_index_first_run(spark, sf_dir):
    listings = view(spark, sf_dir, "listings")
    start = market_index.first_index_date(listings)
    source = market_index.index_input(listings, start, sql.FIRST_RUN_DATE)
    return _rounded(market_index.compute_market_index(source, start, sql.FIRST_RUN_DATE), *MARKET_FEATURES[1:])


@query(sql.MARKET_INDEX)
def index_change_driven(spark, sf_dir):
    # The labels of one month's cars arrive after the index was built; what they touch is computed anew.
    listings = view(spark, sf_dir, "listings")
    late = F.col(LISTING_DATE).between(*[F.lit(d).cast("date") for d in sql.LATE_BETWEEN]) & (F.col("num_owners") == 6)
    early = listings.withColumn(LABEL, F.when(~late, F.col(LABEL)))
    name = f"index_{uuid.uuid4().hex}"
    create_table(spark, name, MARKET_INDEX, partition_by=INDEX_DATE)
    merge_table(spark, name, _year_index(early), [*MARKET_KEYS, INDEX_DATE])
    apply_changes(spark, name, listings, market_index.changed_days(early, listings), sql.INDEX_END)
    return _rounded(spark.table(name).select(*MARKET_INDEX.names), *MARKET_FEATURES[1:])


@query(sql.PIT_JOIN)
def pit_join(spark, sf_dir):
    listings = _once(spark, sf_dir, "listings", LISTING_ID, LISTING_DATE, *MARKET_KEYS, LABEL, "year", "mileage")
    joined = point_in_time_join(listings, _index(listings))
    kept = joined.select(LISTING_ID, LISTING_DATE, *MARKET_KEYS, LABEL, *[F.col(c).cast("double") for c in MARKET_FEATURES])
    return _rounded(kept, *MARKET_FEATURES[1:])


@query(sql.LATEST_FEATURES)
def latest_features(spark, sf_dir):
    newest = market_index.latest_features(_index(_once(spark, sf_dir, "listings", LISTING_DATE, *MARKET_KEYS, LABEL, "year", "mileage")))
    return _rounded(newest, *MARKET_FEATURES[1:])


# --- quality


@query(sql.DQ_REPORT)
def dq_report(spark, sf_dir):
    return quality.violation_counts(quality.validate_listings(view(spark, sf_dir, "listings_dirty"), as_of=AS_OF))


@query(sql.DQ_GATE)
def dq_gate(spark, sf_dir):
    report = quality.validate_listings(view(spark, sf_dir, "listings_dirty"), as_of=AS_OF)
    kept = quality.gate(report, 0.02).select("total_rows", "invalid_rows", "invalid_fraction", "passed")
    return _rounded(kept, "invalid_fraction")


@query(sql.DQ_VALID)
def dq_valid(spark, sf_dir):
    return quality.filter_valid(view(spark, sf_dir, "listings_dirty"), as_of=AS_OF)


@query(sql.DQ_QUARANTINE)
def dq_quarantine(spark, sf_dir):
    return quality.as_text(quality.quarantine(view(spark, sf_dir, "listings_dirty"), as_of=AS_OF))


@query(sql.QUARANTINE_APPEND)
def quarantine_append(spark, sf_dir):
    # Two feeds of one day, and a rerun of the first: neither replaces the other.
    held = quality.quarantine(view(spark, sf_dir, "listings_dirty"), as_of=AS_OF)
    early = F.col(LISTING_DATE) < F.lit(sql.PERIOD_START).cast("date")
    name = f"held_{uuid.uuid4().hex}"
    for feed_id, rows in (("early", held.where(early)), ("late", held.where(~early)), ("early", held.where(early))):
        write_quarantine(spark, name, rows, AS_OF, feed_id)
    return spark.table(name).select(*RAW_COLUMNS, "feed_id", F.col("ingest_date").cast("string").alias("ingest_date"))


@query(sql.DQ_MISSING_COLUMNS)
def dq_missing_columns(spark, sf_dir):
    path = _folder(spark)
    listings = view(spark, sf_dir, "listings").drop("region", LABEL).withColumn("note", F.lit("extra"))
    listings.select(*reversed(listings.columns)).write.option("header", True).csv(path)
    report = quality.gate(quality.validate_listings(read_listings_csv(spark, path), as_of=AS_OF), 0.02)
    missing = F.array_join("missing_columns", ",").alias("missing")
    return report.select("total_rows", "invalid_rows", "invalid_fraction", missing, "passed")


@query(sql.DQ_QUARANTINE_BY_ID)
def dq_quarantine_by_id(spark, sf_dir):
    # The feed holds every listing twice, as it is and with the damage of the dirty view, so ids do collide.
    feed = view(spark, sf_dir, "listings").unionByName(view(spark, sf_dir, "listings_dirty"))
    return quality.as_text(quality.quarantine(feed, by_id=True, as_of=AS_OF))


@query(sql.CSV_RESCUED)
def csv_rescued(spark, sf_dir):
    # Numbers and dates that are none: the rows are held back, with the text that came.
    listings, path = view(spark, sf_dir, "listings"), _folder(spark)
    text = {c: F.col(c).cast("string") for c in ("year", LABEL, LISTING_DATE)}
    spoilt = listings.withColumns(
        {
            "year": F.when(F.expr(sql.BAD_YEAR), F.concat(F.lit("MY "), text["year"])).otherwise(text["year"]),
            LABEL: F.when(F.expr(sql.BAD_PRICE), F.lit("on request")).otherwise(text[LABEL]),
        }
    )
    spoilt.write.option("header", True).csv(path)
    feed = read_listings_csv(spark, path, rescue=True)
    return quality.as_text(quality.quarantine(feed, as_of=AS_OF)).select(LISTING_ID, "year", LABEL, RESCUED)


# --- dates and splits


@query(sql.CALENDAR_COLS)
def calendar_cols(spark, sf_dir):
    listings = add_calendar_cols(view(spark, sf_dir, "listings"))
    return listings.select(LISTING_ID, LISTING_DATE, "listing_year", "listing_month")


@query(sql.DATE_WINDOW)
def date_window_year(spark, sf_dir):
    return date_window(view(spark, sf_dir, "listings"), sql.RUN_DATE, sql.WINDOW_DAYS)


@query(sql.TRAILING_LOOKBACK)
def trailing_lookback_year(spark, sf_dir):
    return trailing_lookback(view(spark, sf_dir, "listings"), 365)


@query(sql.HOLDOUT_SPLIT)
def holdout_split(spark, sf_dir):
    return label_split(view(spark, sf_dir, "listings"), 365).select(LISTING_ID, LISTING_DATE, "split")


# --- features and model input


@query(sql.MODEL_INPUT)
def model_input_contract(spark, sf_dir):
    listings = _once(spark, sf_dir, "listings")
    ready = model_input.to_model_input(point_in_time_join(listings, _index(listings)), keep=[LISTING_ID])
    return _rounded(ready, *MARKET_FEATURES[1:])


@query(sql.REQUEST_FEATURES)
def request_features(spark, sf_dir):
    dirty = add_calendar_cols(_once(spark, sf_dir, "listings_dirty"))
    joined = point_in_time_join(dirty, _index(_once(spark, sf_dir, "listings", LISTING_DATE, *MARKET_KEYS, LABEL, "year", "mileage")))
    return _rounded(add_features(joined, keep=[LISTING_ID], luxury_makes=sql.LUXURY), *NUMERIC_FEATURES)


@query(sql.TARGET_TRANSFORM)
def target_transform(spark, sf_dir):
    target = view(spark, sf_dir, "listings").select(LISTING_ID, model_input.log_target().alias("target"))
    return target.select(
        LISTING_ID,
        F.round("target", 6).alias("target"),
        F.round(model_input.from_log_target(F.col("target")), 4).alias("restored_price"),
    )


# --- metrics


@query(sql.METRICS_BY_VERSION)
def metrics_by_version(spark, sf_dir):
    metrics = regression.regression_metrics(view(spark, sf_dir, "predictions"), by=[MODEL_VERSION])
    return _rounded(metrics, "mae", "rmse", "mape", "r2")


@query(sql.METRICS_BAD_PREDICTION)
def metrics_bad_prediction(spark, sf_dir):
    # The second version gives no prediction for some labelled rows: its metrics are unknown and it isn't promoted.
    bad = (F.col(MODEL_VERSION) == "2") & (F.col("num_owners") == 6)
    scored = view(spark, sf_dir, "predictions").withColumn(PREDICTION, F.when(~bad, F.col(PREDICTION)))
    metrics = regression.regression_metrics(scored, by=[MODEL_VERSION])
    metrics = metrics.select(MODEL_VERSION, "n_rows", F.round(F.nanvl("mae", F.lit(None).cast("double")), 6).alias("mae"))
    decided = decide_on_scores(scored, "2", "1").select("promote")
    return metrics.withColumn("known", F.col("mae").isNotNull()).withColumn("promote", decided.scalar())


@query(sql.MONITOR_METRICS)
def monitor_metrics(spark, sf_dir):
    window = champion_window(view(spark, sf_dir, "predictions"), "1", sql.RUN_DATE, sql.WINDOW_DAYS)
    return _rounded(regression.monitor_metrics(window), "mae", "rmse", "mape")


@query(sql.SLICED_PROFILE)
def sliced_profile(spark, sf_dir):
    return _rounded(regression.sliced_profile(view(spark, sf_dir, "predictions")), "mae", "rmse", "mape")


@query(sql.PREDICTION_SANITY)
def prediction_sanity(spark, sf_dir):
    # Lowered by a constant, so that some predictions are not positive.
    lowered = view(spark, sf_dir, "predictions").withColumn(PREDICTION, F.col(PREDICTION) - sql.LOWERED_BY)
    counts = regression.prediction_sanity(lowered, by=[MODEL_VERSION])
    checked = decisions.combine(decisions.check_prediction_sanity(counts), "sanity_failures")
    return checked.select(MODEL_VERSION, "n_rows", "non_finite", "non_positive", "failure_text", "passed")


# --- drift


def _periods(df):
    before = F.col(LISTING_DATE) < F.lit(sql.PERIOD_START).cast("date")
    return df.where(before), df.where(~before)


@query(sql.NUMERIC_PSI)
def numeric_psi(spark, sf_dir):
    reference, current = _periods(view(spark, sf_dir, "listings"))
    return _rounded(psi.numeric_psi(reference, current, [*DRIFT_NUMERIC, LABEL]), "psi")


@query(sql.QUANTILE_EDGES)
def quantile_edges(spark, sf_dir):
    counts = psi.number_rows(*_periods(view(spark, sf_dir, "listings")), [*DRIFT_NUMERIC, LABEL])
    return psi.quantile_edges(counts).select("feature", F.posexplode("edges").alias("position", "edge"))


@query(sql.HISTOGRAM_SHARES)
def histogram_shares(spark, sf_dir):
    counts = psi.number_rows(*_periods(view(spark, sf_dir, "listings")), [*DRIFT_NUMERIC, LABEL])
    return psi.bin_counts(counts)


@query(sql.PSI_CONSTANT_REFERENCE)
def psi_constant_reference(spark, sf_dir):
    reference, current = _periods(view(spark, sf_dir, "listings"))
    reference = reference.withColumn("num_owners", F.lit(2))
    return _rounded(psi.numeric_psi(reference, current, ["num_owners"]), "psi")


@query(sql.PSI_TWO_EDGES)
def psi_two_edges(spark, sf_dir):
    rare = F.when((F.col("num_owners") == 6) & F.col("accident_history"), F.col("mileage")).otherwise(F.lit(0))
    reference, current = _periods(view(spark, sf_dir, "listings").withColumn("mileage", rare))
    return _rounded(psi.numeric_psi(reference, current, ["mileage"]), "psi")


@query(sql.CATEGORICAL_PSI)
def categorical_psi(spark, sf_dir):
    # One category is renamed in the current period: a new one appears and an old one disappears.
    reference, current = _periods(view(spark, sf_dir, "listings"))
    current = current.withColumn("body_type", F.when(F.col("body_type") == "wagon", "van").otherwise(F.col("body_type")))
    return _rounded(psi.categorical_psi(reference, current, DRIFT_CATEGORICAL), "psi")


@query(sql.CATEGORY_FREQUENCY)
def category_frequency(spark, sf_dir):
    return _rounded(psi.frequency(view(spark, sf_dir, "listings_dirty"), CATEGORICAL), "share")


def _champion_drift(spark, sf_dir):
    columns = [LISTING_DATE, MODEL_VERSION, PREDICTION, *DRIFT_NUMERIC, *DRIFT_CATEGORICAL]
    return drift_of_window(*_periods(_once(spark, sf_dir, "predictions", *columns, where=F.col(MODEL_VERSION) == "1")))


@query(sql.DRIFT_REPORT)
def drift_report(spark, sf_dir):
    return _rounded(drift_rows(_champion_drift(spark, sf_dir), sql.RUN_DATE, "1"), "psi")


@query(sql.DRIFT_SUMMARY)
def drift_summary(spark, sf_dir):
    summary = psi.drift_summary(_champion_drift(spark, sf_dir))
    names = F.array_join("drifted_features", ",").alias("drifted_features")
    return _rounded(
        summary.select("max_feature_psi", "prediction_psi", names, "n_drifted"), "max_feature_psi", "prediction_psi"
    )


_PROFILED = [LISTING_DATE, SCORED_AT, MODEL_VERSION, PREDICTION, *DRIFT_NUMERIC, *dict.fromkeys([*DRIFT_CATEGORICAL, *regression.SLICES])]


@query(sql.DRIFT_REPORT)
def profile_drift(spark, sf_dir):
    # The baseline is stored with its profile; the report reads the profile and the window alone. Each period is joined
    # where it is used, the window in the pass that counts it: a copy of both would be more writing than a second scan.
    baseline, later = _periods(view(spark, sf_dir, "predictions").where(F.col(MODEL_VERSION) == "1").select(*_PROFILED))
    name = f"baseline_{uuid.uuid4().hex}"
    refresh_baseline(spark, name, "1", lambda: baseline, path=_folder(spark), profile=profile.baseline_profile, in_place=True)
    drift = profile.drift_from_profile(spark.table(profile_name(name)), later)
    return _rounded(drift_rows(drift, sql.RUN_DATE, "1"), "psi")


@query(sql.SLICED_DRIFT)
def sliced_drift(spark, sf_dir):
    # The first model's predictions before the period starts, and all from then on.
    first, before = F.col(MODEL_VERSION) == "1", F.col(LISTING_DATE) < F.lit(sql.PERIOD_START).cast("date")
    baseline, later = _periods(_once(spark, sf_dir, "predictions", *_PROFILED, where=first | ~before))
    path = _folder(spark)
    profile.baseline_profile(baseline).write.parquet(path)
    return _rounded(profile.sliced_drift(spark.read.parquet(path), later), "psi_baseline", "psi_previous")


# --- upserts, backfill, snapshots, tables


@query(sql.UPSERT_ALL)
def upsert_all(spark, sf_dir):
    listings = view(spark, sf_dir, "listings")
    stored = listings.where(F.col(LISTING_DATE) < F.lit(sql.STORED_UNTIL).cast("date"))
    fresh = listings.where(F.col(LISTING_DATE) >= F.lit(sql.FRESH_FROM).cast("date"))
    return upsert(stored, fresh.withColumn(LABEL, F.col(LABEL) * 2), [LISTING_ID])


@query(sql.UPSERT_PARTIAL)
def upsert_partial(spark, sf_dir):
    predictions = view(spark, sf_dir, "predictions")
    stored = predictions.where(F.col(LISTING_DATE) < F.lit(sql.STORED_UNTIL).cast("date"))
    fresh = predictions.where(F.col(LISTING_DATE) >= F.lit(sql.FRESH_FROM).cast("date")).withColumns(
        {
            PREDICTION: F.col(PREDICTION) * 2,
            SCORED_AT: F.col(SCORED_AT) + F.expr("INTERVAL '1' DAY"),
            LABEL: F.lit(None).cast("double"),
        }
    )
    merged = upsert(stored, fresh, [LISTING_ID, MODEL_VERSION], update_cols=[PREDICTION, SCORED_AT])
    return merged.withColumn(SCORED_AT, F.col(SCORED_AT).cast("string"))


@query(sql.LABEL_BACKFILL)
def label_backfill(spark, sf_dir):
    filled = backfill_labels(view(spark, sf_dir, "predictions"), view(spark, sf_dir, "listings"))
    return filled.select(LISTING_ID, MODEL_VERSION, PREDICTION, LABEL)


@query(sql.SNAPSHOT_READ)
def snapshot_read(spark, sf_dir):
    root, listings = _folder(spark), view(spark, sf_dir, "listings")
    write_snapshot(listings.where(F.col(LISTING_DATE) < F.lit(sql.STORED_UNTIL).cast("date")), root, 1)
    pinned = latest_snapshot(spark, root)
    write_snapshot(listings, root, 2)
    return read_snapshot(spark, root, pinned)


@query(sql.LISTINGS)
def csv_source(spark, sf_dir):
    path = _folder(spark)
    # The header's names count, not their order.
    view(spark, sf_dir, "listings").select(*sorted(RAW_COLUMNS)).write.option("header", True).csv(path)
    return read_listings_csv(spark, path)


@query(sql.DATE_WINDOW)
def table_layout(spark, sf_dir):
    path = _folder(spark)
    clustered(view(spark, sf_dir, "listings"), LISTING_DATE, LISTING_ID).write.parquet(path)
    return date_window(spark.read.parquet(path), sql.RUN_DATE, sql.WINDOW_DAYS)


@query(sql.DATE_WINDOW)
def create_and_merge(spark, sf_dir):
    name, copy = f"made_{uuid.uuid4().hex}", f"like_{uuid.uuid4().hex}"
    rows = date_window(view(spark, sf_dir, "listings"), sql.RUN_DATE, sql.WINDOW_DAYS)
    create_table(spark, name, RAW_LISTINGS)
    merge_table(spark, name, rows.withColumn(LABEL, F.lit(0.0)), [LISTING_ID])
    create_like(spark.table(name), copy)
    for source in (spark.table(name), rows):
        merge_table(spark, copy, source, [LISTING_ID])
    return spark.table(copy)


@query(sql.FEATURE_MERGE)
def feature_merge(spark, sf_dir):
    name, index = f"index_{uuid.uuid4().hex}", _index(view(spark, sf_dir, "listings"))
    create_table(spark, name, MARKET_INDEX)
    later = index.where(F.col(INDEX_DATE) >= F.lit(sql.MERGED_FROM).cast("date"))
    for rows in (index, later.withColumn(MARKET_FEATURES[0], F.col(MARKET_FEATURES[0]) + 1)):
        merge_table(spark, name, rows, [*MARKET_KEYS, INDEX_DATE])
    return _rounded(spark.table(name), *MARKET_FEATURES[1:])


@query(sql.LATEST_FEATURES)
def publish_incremental(spark, sf_dir):
    # First half a history, then the rest, then a run for an old day once more, which must not set anything back.
    index, name = _index(view(spark, sf_dir, "listings")), f"latest_{uuid.uuid4().hex}"
    create_table(spark, name, MARKET_INDEX)
    day, cut = F.col(INDEX_DATE), F.lit(sql.MERGED_FROM).cast("date")
    for rows in (index.where(day < cut), index.where(day >= cut), index.where(day == cut)):
        newest = market_index.latest_features(rows).select(*MARKET_INDEX.names)
        merge_newer(spark, name, newest, MARKET_KEYS, INDEX_DATE)
    return _rounded(spark.table(name), *MARKET_FEATURES[1:])


@query(sql.HISTORY_MERGE)
def history_merge(spark, sf_dir):
    # A run and its rerun, which may retrain: one row stays, the later one.
    name = f"history_{uuid.uuid4().hex}"
    create_table(spark, name, PERFORMANCE_HISTORY)
    window, *read_by_both = _monitored(spark, sf_dir)
    monitored = (window, *[read_once(df) for df in read_by_both])
    for auto_retrain in (False, True):
        merge_table(spark, name, _history(monitored, auto_retrain), [RUN_DATE])
    return _rounded(spark.table(name).drop("reason"), "mae", "rmse", "mape", "max_feature_psi", "prediction_psi")


@query(sql.BASELINE_REFRESH)
def baseline_refresh(spark, sf_dir):
    # Each champion's rows are joined together by the refresh that stores them; a copy of all would be one more write.
    predictions, name = view(spark, sf_dir, "predictions"), f"baseline_{uuid.uuid4().hex}"
    for champion in ("1", "2", "2"):
        champion_rows = predictions.where(F.col(MODEL_VERSION) == champion)
        refresh_baseline(spark, name, champion, lambda rows=champion_rows: rows, path=_folder(spark))
    return spark.table(name).select(LISTING_ID, MODEL_VERSION, PREDICTION, LABEL)


@query(sql.RARE_POOLING)
def rare_pooling(spark, sf_dir):
    return pooled_categories(view(spark, sf_dir, "listings"), CATEGORICAL, sql.POOL_MIN_ROWS)


# --- decisions


def _metrics(spark, sf_dir):
    return regression.regression_metrics(view(spark, sf_dir, "predictions"), by=[MODEL_VERSION])


@query(sql.THRESHOLD_CHECKS)
def threshold_checks(spark, sf_dir):
    limits = decisions.Thresholds(max_mape=sql.MAX_MAPE, max_mae=sql.MAX_MAE, min_r2=sql.MIN_R2)
    checked = decisions.combine(decisions.check_thresholds(_metrics(spark, sf_dir), limits), "threshold_failures")
    return checked.select(MODEL_VERSION, F.size("failures").cast("long").alias("n_failures"), "passed")


@query(sql.PROMOTION_DECISION)
def promotion_decision(spark, sf_dir):
    decided = decisions.decide_promotion(_metrics(spark, sf_dir), "2", "1", min_relative_improvement=0.05)
    return _rounded(decided.drop("reason"), "challenger_value", "champion_value", "required_value")


@query(sql.PROMOTION_SAME_VERSION)
def promotion_same_version(spark, sf_dir):
    decided = decisions.decide_promotion(_metrics(spark, sf_dir), "2", "2")
    return _rounded(decided, "challenger_value", "champion_value", "required_value")


def _monitored(spark, sf_dir):
    """What a monitoring run judges: the champion's window, its drift and the versions."""
    columns = [LISTING_DATE, SCORED_AT, MODEL_VERSION, LABEL, PREDICTION, *DRIFT_NUMERIC, *DRIFT_CATEGORICAL]
    predictions = _once(spark, sf_dir, "predictions", *columns)
    champion = predictions.where(F.col(MODEL_VERSION) == "1")
    baseline = champion.where(F.col(LISTING_DATE) < F.lit(sql.PERIOD_START).cast("date"))
    window = champion_window(predictions, "1", sql.RUN_DATE, sql.WINDOW_DAYS)
    versions = predictions.groupBy(MODEL_VERSION).agg(F.min(SCORED_AT).alias("trained_at"))
    return window, drift_of_window(baseline, window), versions


def _history(monitored, auto_retrain=False):
    window, drift, versions = monitored
    return history_row(
        window, drift, versions, "1", sql.RUN_DATE, AS_OF, window_days=sql.WINDOW_DAYS, auto_retrain=auto_retrain
    )


@query(sql.RETRAIN_DECISION)
def retrain_decision(spark, sf_dir):
    decided = _history(_monitored(spark, sf_dir))
    return decided.select(RUN_DATE, "triggers", "alert_triggered", "retrain_recommended", "retrain_triggered")


@query(sql.HISTORY_ROW)
def history_row_of_run(spark, sf_dir):
    row = _history(_monitored(spark, sf_dir)).drop("reason")
    return _rounded(row, "mae", "rmse", "mape", "max_feature_psi", "prediction_psi")


@query(sql.ALERT_COUNT)
def alert_count(spark, sf_dir):
    # One history row per day: each day of the first model's predictions is a monitoring run of its own.
    days = view(spark, sf_dir, "predictions").where(F.col(MODEL_VERSION) == "1").groupBy(
        F.col(LISTING_DATE).alias(RUN_DATE)
    )
    signals = days.agg(
        F.count(LABEL).alias("labeled_rows"), F.count("*").alias("scored_rows"), *regression.error_metrics()
    ).withColumns(
        {
            "n_drifted": F.lit(None).cast("long"),
            "max_feature_psi": F.lit(None).cast("double"),
            "prediction_psi": F.lit(None).cast("double"),
            "drifted_features": F.array().cast("array<string>"),
            "days_since_training": F.lit(None).cast("double"),
        }
    )
    policy = decisions.RetrainPolicy(max_mape=sql.DAILY_MAX_MAPE, min_labeled_rows=sql.DAILY_MIN_ROWS)
    return decisions.alert_count(decisions.decide_retraining(signals, policy), sql.ALERTS_FROM)


# --- model

#: Fits of a session by input: the three queries below look at one model.
_FITS = {}
#: Larger steps and so fewer trees than the defaults, which are for millions of rows; all labelled rows take part.
FIT = TrainingParams(max_iter=60, learning_rate=0.2)


def _fit(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    priced = _once(spark, sf_dir, "listings_priced")
    index = read_once(_index(priced))
    train, holdout, _ = time_based_split(priced, sql.HOLDOUT_DAYS)
    holdout = quality.filter_valid(holdout, as_of=AS_OF)
    if key not in _FITS:
        _FITS[key] = train_model(point_in_time_join(quality.filter_valid(train, as_of=AS_OF), index), FIT)
    return _FITS[key], holdout, index


def _sane(prediction=PREDICTION):
    p = F.col(prediction)
    return (p.isNotNull() & ~F.isnan(p) & (p > 0) & (p < float("inf"))).alias("sane")


@query(sql.TRAIN_SCORE)
def train_score(spark, sf_dir):
    model, holdout, index = _fit(spark, sf_dir)
    scored = score_batch(model, holdout, index, "1", scored_at=AS_OF)
    return scored.select(LISTING_ID, LISTING_DATE, *REQUEST_COLUMNS, MODEL_VERSION, _sane())


@query(sql.STORED_MODEL_SCORE)
def stored_model_score(spark, sf_dir):
    # Saved with its look-ups, named champion, loaded in another session, and held against the live model.
    model, holdout, index = _fit(spark, sf_dir)
    root, other = _folder(spark), spark.newSession()
    write_snapshot(index, f"{root}/index", 1)
    save_model(spark, root, "7", model, [market_lookup(spark, f"{root}/index", snapshots=True)], params=FIT.to_dict())
    set_alias(spark, root, "7")
    # A later state of the features, which a pinned scoring must not see.
    write_snapshot(index.withColumn(MARKET_FEATURES[1], F.lit(0.0)), f"{root}/index", 2)
    stored = load_model(other, root, resolve_alias(other, root))
    _, again = time_based_split(_once(other, sf_dir, "listings_priced"), sql.HOLDOUT_DAYS)[:2]
    scored = score_stored(stored, quality.filter_valid(again, as_of=AS_OF), scored_at=AS_OF, pinned=True)
    scored.write.parquet(f"{root}/scored")
    live = score_batch(model, holdout, index, "7", scored_at=AS_OF).select(LISTING_ID, F.col(PREDICTION).alias("live"))
    same = F.col(PREDICTION).eqNullSafe(F.col("live")).alias("same")
    return spark.read.parquet(f"{root}/scored").join(live, LISTING_ID).select(LISTING_ID, LISTING_DATE, MODEL_VERSION, _sane(), same)


@query(sql.TRAIN_EVALUATE)
def train_evaluate(spark, sf_dir):
    model, holdout, index = _fit(spark, sf_dir)
    found = evaluate_model(model, point_in_time_join(holdout, index))
    return found.select("n_rows", (F.col("r2") > 0.85).alias("r2_ok"), (F.col("mape") < 0.15).alias("mape_ok"))


@query(sql.COLD_START_SCORE)
def cold_start_score(spark, sf_dir):
    model, holdout, index = _fit(spark, sf_dir)
    scored = score_batch(model, model_input.cold_start_probe(holdout), index, "1", scored_at=AS_OF)
    return scored.select(LISTING_ID, "region", _sane())
