"""Table layouts and column groups of the listing pricing pipeline.

Every table is described once, as a ``StructType``; the column groups the operators work with are plain name lists.
"""

from pyspark.sql import types as T

LISTING_ID = "listing_id"
LISTING_DATE = "listing_date"
LABEL = "price"
PREDICTION = "predicted_price"
MODEL_VERSION = "model_version"
SCORED_AT = "scored_at"
INDEX_DATE = "index_date"
RUN_DATE = "run_date"
#: Text of cells that did not fit their type, by column.
RESCUED = "rescued_text"

# Column names and category lists of the data contract.
CATEGORICAL = ["make", "model", "body_type", "fuel_type", "transmission", "drivetrain", "condition", "region"]
NUMERIC = ["year", "mileage", "engine_size_l", "num_owners", "accident_history"]
CALENDAR = ["listing_year", "listing_month"]
MARKET_KEYS = ["make", "model", "region"]
MARKET_FEATURES = [
    "market_listing_count_30d",
    "market_avg_log_price_30d",
    "market_avg_vehicle_age_30d",
    "market_avg_log_mileage_30d",
]
DRIFT_NUMERIC = ["year", "mileage", "engine_size_l", "num_owners"]
DRIFT_CATEGORICAL = ["make", "body_type", "fuel_type", "condition", "region"]
CONDITIONS = ["excellent", "good", "fair", "poor"]

RAW_COLUMNS = [LISTING_ID, LISTING_DATE, *CATEGORICAL, *NUMERIC, LABEL]
REQUEST_COLUMNS = [*CALENDAR, *CATEGORICAL, *NUMERIC]
MODEL_INPUT = [*REQUEST_COLUMNS, *MARKET_FEATURES]
PREDICTION_COLUMNS = [LISTING_ID, LISTING_DATE, *REQUEST_COLUMNS, PREDICTION, LABEL, MODEL_VERSION, SCORED_AT]
# Columns of the monitoring history.
PERFORMANCE_COLUMNS = [
    "run_date",
    "window_start",
    "model_version",
    "labeled_rows",
    "scored_rows",
    "mae",
    "rmse",
    "mape",
    "max_feature_psi",
    "prediction_psi",
    "drifted_features",
    "triggers",
    "alert_triggered",
    "retrain_recommended",
    "retrain_triggered",
    "reason",
]

_TYPES = {
    LISTING_DATE: T.DateType(),
    INDEX_DATE: T.DateType(),
    RUN_DATE: T.DateType(),
    "window_start": T.DateType(),
    "accident_history": T.BooleanType(),
    "drifted": T.BooleanType(),
    "alert_triggered": T.BooleanType(),
    "retrain_recommended": T.BooleanType(),
    "retrain_triggered": T.BooleanType(),
    SCORED_AT: T.TimestampType(),
}
_TYPES.update(
    dict.fromkeys(
        ["year", "mileage", "num_owners", *CALENDAR, MARKET_FEATURES[0], "labeled_rows", "scored_rows"], T.LongType()
    )
)
_TYPES.update(
    dict.fromkeys(
        ["engine_size_l", LABEL, PREDICTION, *MARKET_FEATURES[1:], "mae", "rmse", "mape", "psi", "max_feature_psi", "prediction_psi"],
        T.DoubleType(),
    )
)


# What the columns of the listings table and of the index mean, for readers of the catalog.
_NOTES = {
    LISTING_ID: "id of a listing, unique in the marketplace",
    LISTING_DATE: "day of the listing or sale",
    LABEL: "sale price in US dollars, what the model learns; unknown until the sale",
    INDEX_DATE: "day the trailing window ends before",
    MARKET_FEATURES[0]: "listings of the key in the 30 days before",
}


def layout(columns, required=(), notes=()):
    """A ``StructType`` for the named columns; a column without a listed type is text. ``notes`` names those with a comment."""
    return T.StructType(
        [T.StructField(c, _TYPES.get(c, T.StringType()), c not in required, {"comment": _NOTES[c]} if c in notes else None) for c in columns]
    )


RAW_LISTINGS = layout(RAW_COLUMNS, required=[LISTING_ID, LISTING_DATE], notes=[LISTING_ID, LISTING_DATE, LABEL])
MARKET_INDEX = layout(
    [*MARKET_KEYS, INDEX_DATE, *MARKET_FEATURES], required=[*MARKET_KEYS, INDEX_DATE], notes=[INDEX_DATE, MARKET_FEATURES[0]]
)
# Days whose listings changed, by the number of the load that changed them.
LISTING_CHANGES = T.StructType(
    [*[T.StructField(k, T.StringType()) for k in MARKET_KEYS], T.StructField("day", T.DateType()), T.StructField("load", T.LongType())]
)
PREDICTIONS = layout(PREDICTION_COLUMNS)
PERFORMANCE_HISTORY = layout(PERFORMANCE_COLUMNS)
DRIFT_HISTORY = layout([RUN_DATE, MODEL_VERSION, "feature", "psi", "drifted"])
