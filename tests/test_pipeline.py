"""The jobs from end to end on a small generated market, with real tables."""

import datetime as dt
import math
import random

import pytest
from conftest import listing
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from forecourt.functions.request_features import add_features
from forecourt.operators.asof import point_in_time_join
from forecourt.operators.calendar import time_based_split
from forecourt.operators.decisions import RetrainPolicy, Thresholds
from forecourt.operators.market_index import compute_market_index
from forecourt.operators.model_input import to_model_input
from forecourt.operators.pooling import RARE, pooled_categories
from forecourt.operators.price_model import TrainingParams, evaluate_model, predict, train_model, vocabulary
from forecourt.plans.features import build_market_index, index_range
from forecourt.plans.ingest import feed_window, ingest
from forecourt.plans.monitoring import monitor
from forecourt.plans.names import Tables
from forecourt.plans.scoring import score
from forecourt.plans.training import promote, promote_on_latest, train, validate_model
from forecourt.sources.tables import refresh_baseline

END = dt.date(2026, 6, 30)
FAST = TrainingParams(max_iter=10, learning_rate=0.4, max_depth=4, min_rows_per_leaf=5, early_stopping=False)
BASE = {"Norvik": 28000, "Halden": 24500, "Ostra": 47000}


def market(n_days, per_day, end=END, factor=1.0, seed=1):
    rng = random.Random(seed)
    rows = []
    for back in range(n_days):
        day = end - dt.timedelta(days=back)
        for i in range(per_day):
            make, age, miles = rng.choice(list(BASE)), rng.randrange(8), rng.randrange(120000)
            price = BASE[make] * factor * math.exp(-0.1 * age - 2e-6 * miles) * rng.uniform(0.95, 1.05)
            rows.append(
                listing(f"{day}-{i}", day, make=make, year=day.year - age, mileage=miles, price=round(price, 2),
                        region=rng.choice(["north", "south"]), num_owners=1 + rng.randrange(3))
            )
    return rows


@pytest.fixture(scope="module")
def model_and_data(spark, tmp_path_factory):
    from pyspark.sql.types import StructField, StructType

    from forecourt.schema import RAW_LISTINGS

    schema = StructType([StructField(f.name, f.dataType, True) for f in RAW_LISTINGS.fields])
    path = str(tmp_path_factory.mktemp("market") / "rows")
    spark.createDataFrame(market(90, 20), schema).write.parquet(path)
    listings = spark.read.parquet(path)
    index = compute_market_index(listings, END - dt.timedelta(days=89), END)
    joined = point_in_time_join(listings, index)
    train_df, holdout, _ = time_based_split(joined, 21)
    return train_model(train_df, FAST), holdout, index


def test_the_model_learns_the_signal(model_and_data):
    model, holdout, _ = model_and_data
    row = evaluate_model(model, holdout).first()
    assert row.r2 > 0.85 and row.mape < 0.15 and row.n_rows == holdout.count()


def test_unseen_categories_score_and_the_model_survives_saving(model_and_data, tmp_path):
    model, holdout, _ = model_and_data
    unseen = holdout.limit(3).withColumn("make", F.lit("Unheard")).withColumn("model", F.lit("Of"))
    unseen = unseen.withColumn("market_avg_log_price_30d", F.lit(None).cast("double"))
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    first = sorted(r.predicted_price for r in predict(model, unseen).collect())
    second = sorted(r.predicted_price for r in predict(again, unseen).collect())
    assert first == second and len(first) == 3 and min(first) > 0


def test_early_stopping_holds_rows_back(make_listings):
    params = TrainingParams(max_iter=4, max_depth=2, learning_rate=0.5, validation_tol=0.5)
    model = train_model(make_listings(market(20, 10)), params)
    # A tolerance no step can reach stops the learner before its limit.
    assert model.stages[-1].getNumTrees < 4


def test_rare_categories_are_pooled(spark, make_listings):
    rows = [listing(i) for i in range(12)] + [listing(20 + i, make=f"rare{i}") for i in range(3)]
    df = make_listings(rows)
    pooled = {r.category: (r.n_values, r.n_rows) for r in pooled_categories(df, ["make"]).collect()}
    assert pooled == {"Norvik": (1, 12), RARE: (3, 3)}
    assert vocabulary(df)[0] == ["Norvik"]


def test_the_vocabulary_is_bounded(spark, model_and_data, make_listings):
    rows = [listing(f"{k}-{i}", make=f"make{k:03d}") for k in range(40) for i in range(10 + (k % 7))]
    df = make_listings(rows)
    counts = sorted(((-(10 + k % 7), f"make{k:03d}") for k in range(40)))
    assert vocabulary(df, max_categories=12)[0] == sorted(name for _, name in counts[:12])
    assert len(vocabulary(df)[0]) == 40
    # With two slots for eight text columns' categories the fit still finds the signal in the numbers.
    _, holdout, _ = model_and_data
    narrow = train_model(holdout, TrainingParams(max_iter=10, learning_rate=0.4, max_depth=4, min_rows_per_leaf=5, early_stopping=False, max_categories=2))
    width = len(narrow.transform(add_features(to_model_input(holdout.limit(1)))).first().features)
    assert width <= 2 * 15 + 8 * 3 and evaluate_model(narrow, holdout).first().r2 > 0.8


def test_validation_and_promotion(model_and_data):
    model, holdout, index = model_and_data
    checked = validate_model(model, holdout, index, Thresholds(max_mape=0.15, max_mae=5000.0, min_r2=0.85)).first()
    assert checked.passed and checked.failures == []
    strict = validate_model(model, holdout, index, Thresholds(max_mape=0.0001)).first()
    assert not strict.passed and strict.failures[0].startswith("mape ")
    decided = promote({"1": model, "2": model}, holdout, "2", "1").first()
    assert decided.promote and decided.challenger_value == decided.champion_value


def test_promotion_on_the_latest_rows_renews_the_baseline(spark, model_and_data, make_listings):
    model, _, index = model_and_data
    spark.sql("CREATE DATABASE IF NOT EXISTS latest")
    tables = Tables("latest")
    make_listings(market(12, 10, seed=9)).write.saveAsTable(tables.listings)
    index.write.saveAsTable(tables.index)
    decision = promote_on_latest(spark, tables, {"7": model}, "7", holdout_days=5, as_of=END)
    baseline = spark.table(tables.baseline)
    assert decision.promote and baseline.count() == 50 and {r[0] for r in baseline.select("model_version").collect()} == {"7"}


def test_daily_pipeline(spark, make_listings):
    spark.sql("CREATE DATABASE IF NOT EXISTS daily")
    tables = Tables("daily")
    feed = make_listings(
        market(24, 20) + [listing("bad", END, price=1.0), listing("old", END - dt.timedelta(days=400), price=5000.0)]
    )

    with pytest.raises(ValueError):
        ingest(spark, feed, tables, END, max_invalid_fraction=0.0)
    assert spark.table(tables.listings).count() == 0
    for _ in range(2):
        first_feed = feed_window(feed, END, table_existed=False)
        report = ingest(spark, first_feed, tables, END)
        assert report.invalid_rows == 1
        assert spark.table(tables.listings).count() == 480
        assert [r.listing_id for r in spark.table(tables.quarantine).collect()] == ["id-bad"]
    assert feed_window(feed, END, table_existed=True).count() == 21

    first_day = END - dt.timedelta(days=23)
    assert index_range(spark, tables, END) == (first_day + dt.timedelta(days=1), END)
    build_market_index(spark, tables, END, publish=True)
    n = spark.table(tables.index).count()
    assert n == 23 * spark.table(tables.latest_index).count()
    assert build_market_index(spark, tables, END) == (END - dt.timedelta(days=2), END)
    assert spark.table(tables.index).count() == n

    model, holdout, cutoff = train(
        spark.table(tables.listings), spark.table(tables.index), FAST, holdout_days=7, as_of=END
    )
    assert cutoff == END - dt.timedelta(days=6) and holdout.count() == 140
    with pytest.raises(RuntimeError):
        score(spark, tables, None, None, END)
    for hour in (1, 2):
        score(spark, tables, model, "1", END, lookback_days=4, scored_at=f"2026-07-01 0{hour}:00:00")
        predictions = spark.table(tables.predictions)
        assert predictions.count() == 80 and predictions.where("price IS NOT NULL").count() == 0
        assert {r[0].hour for r in predictions.select("scored_at").distinct().collect()} == {hour}

    versions = spark.createDataFrame([("1", dt.datetime(2026, 6, 1))], "model_version string, trained_at timestamp")
    policy = RetrainPolicy(min_labeled_rows=50, min_rows_for_drift=50)
    row = monitor(spark, tables, "1", END, versions, "2026-07-01", policy=policy)
    assert (row.labeled_rows, row.scored_rows, row.max_feature_psi) == (80, 80, None)
    assert spark.table(tables.predictions).where("price IS NULL").count() == 0

    # The baseline is another fleet: cars 30 years older, so the model year has drifted.
    older = spark.table(tables.predictions).withColumn("year", F.col("year") - 30)
    assert refresh_baseline(spark, tables.baseline, "1", lambda: older)
    for _ in range(2):
        row = monitor(spark, tables, "1", END, versions, "2026-07-01", policy=policy, auto_retrain=True)
        assert row.drifted_features == "year" and row.triggers.split(",")[-1] == "data_drift"
        assert row.alert_triggered and row.retrain_triggered
        assert spark.table(tables.performance).count() == 1
        assert spark.table(tables.drift).count() == 10
    assert spark.table(tables.drift).where("drifted").first().feature == "year"


def test_feeds_of_one_day_stand_side_by_side(spark, make_listings):
    spark.sql("CREATE DATABASE IF NOT EXISTS feeds")
    tables = Tables("feeds")
    first = make_listings(market(2, 60) + [listing("bad", END, price=1.0), listing("older", END - dt.timedelta(days=9))])
    for _ in range(2):
        ingest(spark, first, tables, END, windowed=True, max_invalid_fraction=0.1)

    def held():
        return sorted(r.listing_id for r in spark.table(tables.quarantine).collect())

    # The table is there by the second run, which takes the last day only; both runs see the same bad row.
    assert spark.table(tables.listings).count() == 121
    assert set(held()) == {"id-bad"}
    ingest(spark, make_listings(market(1, 60, seed=4) + [listing("worse", END, price=2.0)]), tables, END, feed_id="b")
    assert set(held()) == {"id-bad", "id-worse"}
    ingest(spark, make_listings(market(1, 20)), tables, END, feed_id="b")
    assert set(held()) == {"id-bad"}


def test_market_features_help_after_a_price_jump(spark, make_listings, tmp_path):
    path = str(tmp_path / "jump")
    later = END + dt.timedelta(days=62)
    make_listings(market(90, 15) + market(62, 15, end=later, factor=1.2, seed=2)).write.parquet(path)
    listings = spark.read.parquet(path)
    # The history itself rises slowly, so the model can learn what the market level means.
    days = F.date_diff("listing_date", F.lit(END - dt.timedelta(days=89)))
    wave = F.lit(1.0) + F.lit(0.25) * F.sin(days / 12)
    listings = listings.withColumn("price", F.col("price") * F.when(F.col("listing_date") <= END, wave).otherwise(1.0))
    joined = point_in_time_join(listings, compute_market_index(listings, END - dt.timedelta(days=89), later))
    train_df = joined.where(F.col("listing_date") <= END)
    test_df = joined.where(F.col("listing_date") > END + dt.timedelta(days=31))
    with_market = evaluate_model(train_model(train_df, FAST), test_df).first().mape
    blind = [c for c in joined.columns if not c.startswith("market_")]
    without = evaluate_model(train_model(train_df.select(blind), FAST), test_df.select(blind)).first().mape
    assert with_market < without
