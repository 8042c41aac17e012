"""SQL texts that must give the same rows as the registered queries, and the parameters both sides share."""

from .functions.request_features import HIGH_MILEAGE_PER_YEAR, NEW_CAR_AGE
from .schema import (
    CATEGORICAL,
    DRIFT_CATEGORICAL,
    DRIFT_NUMERIC,
    MARKET_FEATURES,
    MODEL_INPUT,
    PREDICTION_COLUMNS,
    RAW_COLUMNS,
    REQUEST_COLUMNS,
)
from .sources.views import view_sql

AS_OF = "2001-11-04"
INDEX_START, INDEX_END = "1998-01-01", "1998-12-31"
FIRST_RUN_DATE = "2001-11-04"
LATE_BETWEEN = ("1998-03-01", "1998-03-31")
RUN_DATE, WINDOW_DAYS = "1998-12-31", 365
PERIOD_START = "1998-01-01"
STORED_UNTIL, FRESH_FROM = "1999-01-01", "1998-12-01"
LUXURY = ["Brand#11", "Brand#22", "Brand#33"]
LOWERED_BY = 5000.0
POOL_MIN_ROWS = 400
MAX_MAPE, MAX_MAE, MIN_R2 = 0.05, 2500.0, 0.90
DAILY_MAX_MAPE, DAILY_MIN_ROWS = 0.06137, 5
ALERTS_FROM = "1998-06-15"
HOLDOUT_DAYS = 365

_KEYS = "make, model, region"
_AVERAGES = MARKET_FEATURES[1:]


def _with(body, *views, **ctes):
    """A statement over the named views and further common table expressions, in order."""
    parts = [f"{v} AS MATERIALIZED ({view_sql(v)})" for v in ("listings", *[v for v in views if v != "listings"])]
    parts += [f"{name} AS MATERIALIZED ({text})" for name, text in ctes.items()]
    return f"WITH {', '.join(parts)} {body}"


def _round(*names, digits=6, prefix=""):
    return ", ".join(f"round({prefix}{c}, {digits}) AS {c}" for c in names)


def _listed(names):
    return ", ".join(f"'{n}'" for n in names)


LISTINGS = _with("SELECT * FROM listings")

# --- market index


def _index_ctes(start, end):
    """CTEs up to ``market_index`` for index dates between two SQL date expressions."""
    return {
        "bounds": f"SELECT {start} AS first_day, {end} AS last_day",
        "src": "SELECT * FROM listings, bounds WHERE price IS NOT NULL "
        "AND listing_date BETWEEN first_day - INTERVAL 30 DAY AND last_day",
        "daily": f"SELECT {_KEYS}, listing_date AS d, count(*) AS n, sum(ln(price)) AS sp, "
        "sum(greatest(year(listing_date) - year, 0)) AS sa, sum(ln(1 + mileage)) AS sm FROM src GROUP BY ALL",
        "spine": f"SELECT {_KEYS}, cast(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS date) "
        f"AS index_date FROM (SELECT DISTINCT {_KEYS}, first_day, last_day FROM src)",
        "dense": "SELECT s.make, s.model, s.region, s.index_date, d.n, d.sp, d.sa, d.sm FROM spine s LEFT JOIN daily d "
        "ON s.make = d.make AND s.model = d.model AND s.region = d.region AND s.index_date = d.d "
        "UNION ALL SELECT d.make, d.model, d.region, d.d, d.n, d.sp, d.sa, d.sm FROM daily d, bounds WHERE d.d < first_day",
        "windowed": f"SELECT {_KEYS}, index_date, sum(n) OVER w AS n, sum(sp) OVER w AS sp, sum(sa) OVER w AS sa, "
        f"sum(sm) OVER w AS sm FROM dense WINDOW w AS (PARTITION BY {_KEYS} ORDER BY index_date "
        "RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)",
        "market_index": f"SELECT {_KEYS}, index_date, cast(coalesce(n, 0) AS bigint) AS {MARKET_FEATURES[0]}, "
        f"sp / n AS {_AVERAGES[0]}, sa / n AS {_AVERAGES[1]}, sm / n AS {_AVERAGES[2]} "
        "FROM windowed, bounds WHERE index_date >= first_day",
    }


_YEAR_INDEX = _index_ctes(f"DATE '{INDEX_START}'", f"DATE '{INDEX_END}'")
_FULL_INDEX = _index_ctes("(SELECT min(listing_date) + 1 FROM listings)", "(SELECT max(listing_date) FROM listings)")
_INDEX_ROWS = f"SELECT {_KEYS}, index_date, {MARKET_FEATURES[0]}, {_round(*_AVERAGES)} FROM market_index"

MARKET_INDEX = _with(_INDEX_ROWS, **_YEAR_INDEX)
FIRST_RUN = _with(
    _INDEX_ROWS,
    **_index_ctes("(SELECT min(listing_date) + 1 FROM listings)", f"DATE '{FIRST_RUN_DATE}'"),
)


def _asof(left):
    features = ", ".join(f"i.{c}" for c in MARKET_FEATURES)
    return (
        f"SELECT l.*, {features} FROM {left} l ASOF LEFT JOIN market_index i ON l.make = i.make AND l.model = i.model "
        "AND l.region = i.region AND l.listing_date >= i.index_date"
    )


PIT_JOIN = _with(
    f"SELECT listing_id, listing_date, {_KEYS}, price, cast({MARKET_FEATURES[0]} AS double) AS {MARKET_FEATURES[0]}, "
    f"{_round(*_AVERAGES)} FROM joined",
    **_FULL_INDEX,
    joined=_asof("listings"),
)
LATEST_FEATURES = _with(
    f"SELECT {_KEYS}, index_date, {MARKET_FEATURES[0]}, {_round(*_AVERAGES)} FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY index_date DESC) AS rn FROM market_index) WHERE rn = 1",
    **_FULL_INDEX,
)
MERGED_FROM = "1998-07-01"
FEATURE_MERGE = _with(
    f"SELECT {_KEYS}, index_date, {MARKET_FEATURES[0]} + CASE WHEN index_date >= DATE '{MERGED_FROM}' THEN 1 ELSE 0 END "
    f"AS {MARKET_FEATURES[0]}, {_round(*_AVERAGES)} FROM market_index",
    **_FULL_INDEX,
)

# --- quality

_BROKEN = {
    "null_listing_id": "listing_id IS NULL",
    "year_out_of_range": f"NOT coalesce(year BETWEEN 1990 AND year(DATE '{AS_OF}') + 1, false)",
    "mileage_out_of_range": "NOT coalesce(mileage BETWEEN 0 AND 500000, false)",
    "num_owners_out_of_range": "NOT coalesce(num_owners BETWEEN 1 AND 20, false)",
    "unknown_condition": "NOT coalesce(lower(condition) IN ('excellent', 'good', 'fair', 'poor'), false)",
    "null_categorical": "make IS NULL OR model IS NULL OR body_type IS NULL OR fuel_type IS NULL",
    "price_out_of_range": "NOT coalesce(price BETWEEN 500 AND 500000, false)",
}
_INVALID = "(" + " OR ".join(f"({rule})" for rule in _BROKEN.values()) + ")"
_AS_TEXT = ", ".join(f"cast({c} AS varchar) AS {c}" for c in RAW_COLUMNS)

DQ_REPORT = _with(
    "SELECT rule, n_rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {rule}) AS n_rows FROM listings_dirty"
        for name, rule in _BROKEN.items()
    )
    + ") WHERE n_rows > 0",
    "listings_dirty",
)
DQ_GATE = _with(
    "SELECT total_rows, invalid_rows, round(invalid_rows / total_rows, 6) AS invalid_fraction, "
    "invalid_rows / total_rows <= 0.02 AS passed FROM (SELECT count(*) AS total_rows, "
    f"count(*) FILTER (WHERE {_INVALID}) AS invalid_rows FROM listings_dirty)",
    "listings_dirty",
)
DQ_VALID = _with(f"SELECT * FROM listings_dirty WHERE NOT {_INVALID}", "listings_dirty")
DQ_QUARANTINE = _with(f"SELECT {_AS_TEXT} FROM listings_dirty WHERE {_INVALID}", "listings_dirty")
DQ_QUARANTINE_BY_ID = _with(
    f"SELECT {_AS_TEXT} FROM feed ANTI JOIN accepted USING (listing_id)",
    "listings_dirty",
    feed="SELECT * FROM listings UNION ALL SELECT * FROM listings_dirty",
    accepted=f"SELECT DISTINCT listing_id FROM feed WHERE NOT {_INVALID} AND listing_id IS NOT NULL",
)
QUARANTINE_APPEND = _with(
    f"SELECT {_AS_TEXT}, CASE WHEN listing_date < DATE '{PERIOD_START}' THEN 'early' ELSE 'late' END AS feed_id, "
    f"'{AS_OF}' AS ingest_date FROM listings_dirty WHERE {_INVALID}",
    "listings_dirty",
)
DQ_MISSING_COLUMNS = _with(
    "SELECT count(*) AS total_rows, count(*) AS invalid_rows, 1::DOUBLE AS invalid_fraction, 'region,price' AS missing, "
    "false AS passed FROM listings"
)

BAD_YEAR, BAD_PRICE = "mileage % 10000 = 7500 AND num_owners > 4", "mileage % 10000 = 5000 AND num_owners = 2"
CSV_RESCUED = _with(
    "SELECT listing_id, cast(year AS varchar) AS year, cast(price AS varchar) AS price, CASE WHEN len(lost) > 0 THEN "
    f"'{{' || array_to_string(lost, ',') || '}}' END AS rescued_text FROM spoilt WHERE {_INVALID}",
    spoilt="SELECT * REPLACE (CASE WHEN NOT bad_year THEN year END AS year, CASE WHEN NOT bad_price THEN price END AS price), "
    "list_filter([CASE WHEN bad_year THEN '\"year\":\"MY ' || year || '\"' END, "
    "CASE WHEN bad_price THEN '\"price\":\"on request\"' END], lambda x: x IS NOT NULL) AS lost "
    f"FROM (SELECT *, {BAD_YEAR} AS bad_year, {BAD_PRICE} AS bad_price FROM listings)",
)

# --- dates and splits

CALENDAR_COLS = _with(
    "SELECT listing_id, listing_date, cast(year(listing_date) AS bigint) AS listing_year, "
    "cast(month(listing_date) AS bigint) AS listing_month FROM listings"
)
_IN_WINDOW = f"listing_date BETWEEN DATE '{RUN_DATE}' - {WINDOW_DAYS - 1} AND DATE '{RUN_DATE}'"
DATE_WINDOW = _with(f"SELECT * FROM listings WHERE {_IN_WINDOW}")
TRAILING_LOOKBACK = _with(
    "SELECT * FROM listings WHERE listing_date > (SELECT max(listing_date) FROM listings) - 365"
)
HOLDOUT_SPLIT = _with(
    "SELECT listing_id, listing_date, CASE WHEN listing_date < (SELECT max(listing_date) FROM listings) - 364 "
    "THEN 'train' ELSE 'holdout' END AS split FROM listings"
)

# --- features and model input

_CALENDAR = {
    "listing_year": "cast(year(listing_date) AS bigint)",
    "listing_month": "cast(month(listing_date) AS bigint)",
}
MODEL_INPUT_COLUMNS = ", ".join(
    f"{_CALENDAR[c]} AS {c}" if c in _CALENDAR else _round(c) if c in _AVERAGES
    else f"cast({c} AS double) AS {c}" if c == MARKET_FEATURES[0] else c
    for c in MODEL_INPUT
)
MODEL_INPUT = _with(f"SELECT listing_id, {MODEL_INPUT_COLUMNS} FROM joined", **_FULL_INDEX, joined=_asof("listings"))

_AGE = "CASE WHEN year(listing_date) - year < 0 THEN 0 ELSE year(listing_date) - year END"
_MILES = "CASE WHEN mileage < 0 THEN 0 ELSE mileage END"
_FEATURES = {
    "vehicle_age": "age",
    "mileage": "miles",
    "log_mileage": "ln(1 + miles)",
    "miles_per_year": "pace",
    "engine_size_l": "engine_size_l",
    "num_owners": "num_owners",
    "accident_history": "cast(accident_history AS integer)",
    "condition_score": "CASE lower(condition) WHEN 'excellent' THEN 4 WHEN 'good' THEN 3 WHEN 'fair' THEN 2 "
    "WHEN 'poor' THEN 1 END",
    "is_luxury": f"CASE WHEN make IN ({_listed(LUXURY)}) THEN 1 ELSE 0 END",
    "is_high_mileage": f"CASE WHEN pace > {HIGH_MILEAGE_PER_YEAR} THEN 1 ELSE 0 END",
    "listing_month": "month(listing_date)",
    **{c: c for c in MARKET_FEATURES},
}
REQUEST_FEATURES = _with(
    "SELECT listing_id, "
    + ", ".join(f"round(cast({e} AS double), 6) AS {c}" for c, e in _FEATURES.items())
    + ", "
    + ", ".join(f"coalesce({c}, 'None') AS {c}" for c in CATEGORICAL)
    + " FROM paced",
    "listings_dirty",
    **_FULL_INDEX,
    joined=_asof("listings_dirty"),
    aged=f"SELECT *, {_AGE} AS age, {_MILES} AS miles FROM joined",
    paced=f"SELECT *, miles / cast(CASE WHEN age > 0 THEN age ELSE {NEW_CAR_AGE} END AS double) AS pace FROM aged",
)
TARGET_TRANSFORM = _with(
    "SELECT listing_id, round(ln(1 + price), 6) AS target, round(exp(ln(1 + price)) - 1, 4) AS restored_price FROM listings"
)

# --- metrics

_ERRORS = {
    "mae": "avg(abs(predicted_price - price))",
    "rmse": "sqrt(avg(power(predicted_price - price, 2)))",
    "mape": "avg(abs((predicted_price - price) / nullif(price, 0)))",
}
_ERROR_COLUMNS = ", ".join(f"round({e}, 6) AS {c}" for c, e in _ERRORS.items())
_R2 = "1 - sum(power(price - predicted_price, 2)) / (var_pop(price) * count(*))"
_BY_VERSION = (
    "SELECT model_version, count(*) AS n_rows, "
    + ", ".join(f"{e} AS {c}" for c, e in {**_ERRORS, "r2": _R2}.items())
    + " FROM predictions WHERE price IS NOT NULL GROUP BY model_version"
)

METRICS_BY_VERSION = _with(
    f"SELECT model_version, n_rows, {_round('mae', 'rmse', 'mape', 'r2')} FROM metrics",
    "predictions",
    metrics=_BY_VERSION,
)
_BAD = "model_version = '2' AND num_owners = 6"
METRICS_BAD_PREDICTION = _with(
    "SELECT model_version, count(*) AS n_rows, CASE WHEN count(*) = count(p) THEN round(avg(abs(p - price)), 6) END AS mae, "
    "count(*) = count(p) AS known, false AS promote FROM spoilt WHERE price IS NOT NULL GROUP BY model_version",
    "predictions",
    spoilt=f"SELECT *, CASE WHEN {_BAD} THEN NULL ELSE predicted_price END AS p FROM predictions",
)
MONITOR_METRICS = _with(
    f"SELECT count(price) AS labeled_rows, count(*) AS scored_rows, {_ERROR_COLUMNS} FROM predictions "
    f"WHERE model_version = '1' AND {_IN_WINDOW}",
    "predictions",
)


def _profile_part(name):
    value, group = ("cast(NULL AS varchar)", "") if name == "all" else (name, f", {name}")
    return (
        f"SELECT cast(scored_at AS date) AS day, model_version, '{name}' AS slice_name, {value} AS slice_value, "
        f"count(*) AS n_rows, {_ERROR_COLUMNS} FROM predictions WHERE price IS NOT NULL "
        f"GROUP BY cast(scored_at AS date), model_version{group}"
    )


SLICED_PROFILE = _with(" UNION ALL ".join(map(_profile_part, ["all", "make", "body_type", "region"])), "predictions")
PREDICTION_SANITY = _with(
    "SELECT model_version, n_rows, 0::BIGINT AS non_finite, non_positive, CASE WHEN non_positive > 0 "
    "THEN concat(non_positive, ' predictions at or below zero') ELSE '' END AS failure_text, non_positive = 0 AS passed "
    "FROM (SELECT model_version, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE predicted_price - {LOWERED_BY} <= 0) AS non_positive FROM predictions GROUP BY 1)",
    "predictions",
)

# --- drift


def _numeric_ctes(pairs, columns):
    """CTEs up to ``binned`` (feature, bin, n_ref, n_cur); ``pairs`` is a relation with the columns and ``is_ref``."""
    stacked = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, cast({c} AS double) AS v, is_ref FROM {pairs} WHERE {c} IS NOT NULL" for c in columns
    )
    return {
        "vals": stacked,
        "ranked": "SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS rk, "
        "count(*) OVER (PARTITION BY feature) AS n FROM vals WHERE is_ref",
        "spots": "SELECT feature, (n - 1) * q AS p, floor((n - 1) * q) AS f, n FROM (SELECT DISTINCT feature, n FROM ranked), "
        "(SELECT CASE WHEN i = 10 THEN 1::DOUBLE ELSE i * 0.1::DOUBLE END AS q FROM range(11) t(i))",
        "ends": "SELECT s.feature, s.p - s.f AS w, a.v AS lo, b.v AS hi FROM spots s "
        "JOIN ranked a ON a.feature = s.feature AND a.rk = s.f "
        "JOIN ranked b ON b.feature = s.feature AND b.rk = least(s.f + 1, s.n - 1)",
        "edge_list": "SELECT DISTINCT feature, CASE WHEN lo = hi THEN lo WHEN w < 0.5 THEN lo + (hi - lo) * w "
        "ELSE hi - (hi - lo) * (1 - w) END AS edge FROM ends",
        "edges": "SELECT feature, edge, row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS position, "
        "count(*) OVER (PARTITION BY feature) AS n_edges FROM edge_list",
        "tallied": "SELECT feature, v, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur "
        "FROM vals GROUP BY ALL",
        "placed": "SELECT t.feature, t.v, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur, CASE WHEN max(n_edges) = 1 "
        "THEN cast(t.v <> max(edge) AS integer) "
        "ELSE count(*) FILTER (WHERE position BETWEEN 1 AND n_edges - 2 AND t.v >= edge) END AS bin "
        "FROM tallied t JOIN edges e ON e.feature = t.feature GROUP BY t.feature, t.v",
        "binned": "SELECT feature, cast(bin AS integer) AS bin, cast(sum(n_ref) AS bigint) AS n_ref, "
        "cast(sum(n_cur) AS bigint) AS n_cur FROM placed GROUP BY feature, bin",
    }


def _category_cte(pairs, columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, count(*) FILTER (WHERE is_ref) AS n_ref, "
        f"count(*) FILTER (WHERE NOT is_ref) AS n_cur FROM {pairs} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in columns
    )


def _psi_cte(counts):
    return (
        "SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM (SELECT feature, "
        "greatest(n_ref / sum(n_ref) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS r, "
        f"greatest(n_cur / sum(n_cur) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS c FROM {counts}) GROUP BY feature"
    )


_PSI_ROWS = f"SELECT feature, {_round('psi')} FROM psi_rows"
_IS_REF = f"listing_date < DATE '{PERIOD_START}'"
_LISTING_PAIR = {"pair": f"SELECT *, {_IS_REF} AS is_ref FROM listings"}
_NUMERIC_PAIR = {**_LISTING_PAIR, **_numeric_ctes("pair", [*DRIFT_NUMERIC, "price"])}

NUMERIC_PSI = _with(_PSI_ROWS, **_NUMERIC_PAIR, psi_rows=_psi_cte("binned"))
QUANTILE_EDGES = _with("SELECT feature, cast(position AS integer) AS position, edge FROM edges", **_NUMERIC_PAIR)
HISTOGRAM_SHARES = _with("SELECT feature, bin, n_ref, n_cur FROM binned", **_NUMERIC_PAIR)
PSI_CONSTANT_REFERENCE = _with(
    _PSI_ROWS,
    pair=f"SELECT CASE WHEN {_IS_REF} THEN 2 ELSE num_owners END AS num_owners, {_IS_REF} AS is_ref FROM listings",
    **_numeric_ctes("pair", ["num_owners"]),
    psi_rows=_psi_cte("binned"),
)
PSI_TWO_EDGES = _with(
    _PSI_ROWS,
    pair=f"SELECT CASE WHEN num_owners = 6 AND accident_history THEN mileage ELSE 0 END AS mileage, {_IS_REF} AS is_ref "
    "FROM listings",
    **_numeric_ctes("pair", ["mileage"]),
    psi_rows=_psi_cte("binned"),
)
CATEGORICAL_PSI = _with(
    _PSI_ROWS,
    pair="SELECT * REPLACE (CASE WHEN NOT is_ref AND body_type = 'wagon' THEN 'van' ELSE body_type END AS body_type) "
    f"FROM (SELECT *, {_IS_REF} AS is_ref FROM listings)",
    categories=_category_cte("pair", DRIFT_CATEGORICAL),
    psi_rows=_psi_cte("categories"),
)
CATEGORY_FREQUENCY = _with(
    "SELECT feature, value, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS share FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM listings_dirty WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORICAL
    )
    + ")",
    "listings_dirty",
)


def _drift_ctes(pair):
    return {
        "pair": pair,
        **_numeric_ctes("pair", [*DRIFT_NUMERIC, "predicted_price"]),
        "categories": _category_cte("pair", DRIFT_CATEGORICAL),
        "all_counts": "SELECT feature, n_ref, n_cur FROM binned UNION ALL SELECT feature, n_ref, n_cur FROM categories",
        "psi_rows": _psi_cte("all_counts"),
        "drift": "SELECT feature, psi, feature <> 'predicted_price' AND psi > 0.25 AS drifted FROM psi_rows",
        "summary": "SELECT coalesce(max(psi) FILTER (WHERE feature <> 'predicted_price'), 0) AS max_feature_psi, "
        "max(psi) FILTER (WHERE feature = 'predicted_price') AS prediction_psi, "
        "coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_features, "
        "count(*) FILTER (WHERE drifted) AS n_drifted FROM drift",
    }


_CHAMPION_DRIFT = _drift_ctes(f"SELECT *, {_IS_REF} AS is_ref FROM predictions WHERE model_version = '1'")
DRIFT_REPORT = _with(
    f"SELECT DATE '{RUN_DATE}' AS run_date, '1' AS model_version, feature, {_round('psi')}, drifted FROM drift",
    "predictions",
    **_CHAMPION_DRIFT,
)
DRIFT_SUMMARY = _with(
    f"SELECT {_round('max_feature_psi', 'prediction_psi')}, drifted_features, n_drifted FROM summary",
    "predictions",
    **_CHAMPION_DRIFT,
)

_DRIFT_VALUES = [*DRIFT_NUMERIC, "predicted_price"]
_SLICE_NAMES = ["make", "body_type", "region"]
_SLICE_KEYS = "slice_name, slice_value, feature"
_DAY_KEYS = f"day, model_version, {_SLICE_KEYS}"


def _sliced_rows():
    """Rows (is_ref, day, model_version, slices, feature, cell), one per known value."""
    kept = "is_ref, day, model_version, " + ", ".join(_SLICE_NAMES)
    bins = (
        "CASE WHEN len(es) = 1 THEN CASE WHEN v = es[1] THEN '0' ELSE '1' END "
        "ELSE cast(len(list_filter(es[2:len(es) - 1], lambda e: e <= v)) AS varchar) END"
    )
    numbers = [
        f"SELECT {kept}, feature, {bins} AS cell FROM (SELECT *, cast({c} AS double) AS v FROM pair WHERE {c} IS NOT NULL) "
        f"JOIN edge_lists ON feature = '{c}'"
        for c in _DRIFT_VALUES
    ]
    texts = [f"SELECT {kept}, '{c}', {c} FROM pair WHERE {c} IS NOT NULL" for c in DRIFT_CATEGORICAL]
    return " UNION ALL ".join(numbers + texts)


def _sliced_part(name):
    value = "cast(NULL AS varchar)" if name == "all" else name
    group = "" if name == "all" else f", {name}"
    return (
        "SELECT is_ref, CASE WHEN NOT is_ref THEN day END AS day, CASE WHEN NOT is_ref THEN model_version END AS model_version, "
        f"'{name}' AS slice_name, {value} AS slice_value, feature, cell, count(*) AS n FROM long_rows "
        f"GROUP BY is_ref, CASE WHEN NOT is_ref THEN day END, CASE WHEN NOT is_ref THEN model_version END, feature, cell{group}"
    )


def _sliced_psi(other, same):
    """PSI per day row against the cells of ``other`` that the condition picks."""
    keys = ", ".join(f"g.{k}" for k in _DAY_KEYS.split(", "))
    return (
        f"SELECT {_DAY_KEYS}, sum((c - r) * ln(c / r)) AS psi FROM (SELECT {_DAY_KEYS}, sum(r) OVER (PARTITION BY {_DAY_KEYS}) AS known, "
        f"greatest(r / sum(r) OVER (PARTITION BY {_DAY_KEYS}), 0.0001::DOUBLE) AS r, "
        f"greatest(c / sum(c) OVER (PARTITION BY {_DAY_KEYS}), 0.0001::DOUBLE) AS c FROM "
        f"(SELECT {_DAY_KEYS}, cell, sum(r) AS r, sum(c) AS c FROM (SELECT {keys}, o.cell, o.n AS r, 0 AS c FROM days g "
        f"JOIN {other} o ON {same} UNION ALL SELECT {_DAY_KEYS}, cell, 0, n FROM sliced WHERE NOT is_ref) "
        f"GROUP BY {_DAY_KEYS}, cell)) GROUP BY {_DAY_KEYS} HAVING min(known) > 0"
    )


_SAME_SLICE = " AND ".join(f"o.{k} IS NOT DISTINCT FROM g.{k}" for k in _SLICE_KEYS.split(", "))
SLICED_DRIFT = _with(
    f"SELECT d.day, d.model_version, d.slice_name, d.slice_value, d.feature, n_rows, round(b.psi, 6) AS psi_baseline, previous_day, "
    "CASE WHEN previous_day IS NOT NULL THEN round(p.psi, 6) END AS psi_previous, coalesce(b.psi > 0.25, false) AS drifted "
    "FROM days d "
    + " ".join(
        f"LEFT JOIN {t} {a} ON {a}.day = d.day AND {a}.model_version = d.model_version AND {a}.slice_name = d.slice_name "
        f"AND {a}.slice_value IS NOT DISTINCT FROM d.slice_value AND {a}.feature = d.feature"
        for t, a in (("to_baseline", "b"), ("to_previous", "p"))
    ),
    "predictions",
    pair=f"SELECT *, cast(scored_at AS date) AS day, {_IS_REF} AS is_ref FROM predictions "
    f"WHERE model_version = '1' OR NOT {_IS_REF}",
    **{k: v for k, v in _numeric_ctes("pair", _DRIFT_VALUES).items() if k in ("vals", "ranked", "spots", "ends", "edge_list")},
    edge_lists="SELECT feature, list(edge ORDER BY edge) AS es FROM edge_list GROUP BY feature",
    long_rows=_sliced_rows(),
    sliced=" UNION ALL ".join(map(_sliced_part, ["all", *_SLICE_NAMES])),
    days=f"SELECT *, lag(day) OVER (PARTITION BY model_version, {_SLICE_KEYS} ORDER BY day) AS previous_day FROM "
    f"(SELECT {_DAY_KEYS}, cast(sum(n) AS bigint) AS n_rows FROM sliced WHERE NOT is_ref GROUP BY {_DAY_KEYS})",
    base="SELECT * FROM sliced WHERE is_ref",
    later="SELECT * FROM sliced WHERE NOT is_ref",
    to_baseline=_sliced_psi("base", _SAME_SLICE),
    to_previous=_sliced_psi("later", f"{_SAME_SLICE} AND o.day = g.previous_day AND o.model_version = g.model_version"),
)

# --- upserts, backfill, snapshots

UPSERT_ALL = _with(
    "SELECT * FROM stored ANTI JOIN fresh USING (listing_id) UNION ALL SELECT * FROM fresh",
    stored=f"SELECT * FROM listings WHERE listing_date < DATE '{STORED_UNTIL}'",
    fresh=f"SELECT * REPLACE (price * 2 AS price) FROM listings WHERE listing_date >= DATE '{FRESH_FROM}'",
)


def _partial(column):
    if column == "predicted_price":
        return "coalesce(f.predicted_price, s.predicted_price) AS predicted_price"
    if column == "scored_at":
        return "cast(coalesce(f.scored_at, s.scored_at) AS varchar) AS scored_at"
    return f"s.{column}"


_FRESH_COLUMNS = ", ".join("cast(scored_at AS varchar) AS scored_at" if c == "scored_at" else c for c in PREDICTION_COLUMNS)
UPSERT_PARTIAL = _with(
    f"SELECT {', '.join(map(_partial, PREDICTION_COLUMNS))} FROM stored s LEFT JOIN fresh f "
    "ON s.listing_id = f.listing_id AND s.model_version = f.model_version "
    f"UNION ALL SELECT {_FRESH_COLUMNS} FROM fresh ANTI JOIN stored USING (listing_id, model_version)",
    "predictions",
    stored=f"SELECT * FROM predictions WHERE listing_date < DATE '{STORED_UNTIL}'",
    fresh="SELECT * REPLACE (predicted_price * 2 AS predicted_price, cast(NULL AS double) AS price, "
    f"scored_at + INTERVAL 1 DAY AS scored_at) FROM predictions WHERE listing_date >= DATE '{FRESH_FROM}'",
)
LABEL_BACKFILL = _with(
    "SELECT p.listing_id, p.model_version, p.predicted_price, coalesce(p.price, l.price) AS price "
    "FROM predictions p LEFT JOIN listings l ON l.listing_id = p.listing_id AND l.price IS NOT NULL",
    "predictions",
)
SNAPSHOT_READ = _with(f"SELECT * FROM listings WHERE listing_date < DATE '{STORED_UNTIL}'")
BASELINE_REFRESH = _with(
    "SELECT listing_id, model_version, predicted_price, price FROM predictions WHERE model_version = '2'", "predictions"
)
RARE_POOLING = _with(
    "SELECT feature, category, count(*) AS n_values, cast(sum(n) AS bigint) AS n_rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN count(*) >= {POOL_MIN_ROWS} THEN {c} ELSE '__rare__' END AS category, "
        f"count(*) AS n FROM listings WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORICAL
    )
    + ") GROUP BY feature, category"
)

# --- decisions

_FAILURES = (
    f"cast(mape > {MAX_MAPE} AS bigint) + cast(mae > {MAX_MAE} AS bigint) + cast(r2 < {MIN_R2} AS bigint)"
)
THRESHOLD_CHECKS = _with(
    f"SELECT model_version, {_FAILURES} AS n_failures, {_FAILURES} = 0 AS passed FROM metrics",
    "predictions",
    metrics=_BY_VERSION,
)
PROMOTION_DECISION = _with(
    f"SELECT challenger, champion, {_round('challenger_value', 'champion_value', 'required_value')}, "
    "challenger_value <= required_value AS promote FROM (SELECT '2' AS challenger, '1' AS champion, "
    "n.mape AS challenger_value, o.mape AS champion_value, o.mape - abs(o.mape) * 0.05 AS required_value "
    "FROM metrics n, metrics o WHERE n.model_version = '2' AND o.model_version = '1')",
    "predictions",
    metrics=_BY_VERSION,
)
PROMOTION_SAME_VERSION = _with(
    "SELECT '2' AS challenger, cast(NULL AS varchar) AS champion, round(mape, 6) AS challenger_value, "
    "cast(NULL AS double) AS champion_value, cast(NULL AS double) AS required_value, true AS promote, "
    "'no other version to compare with' AS reason FROM metrics WHERE model_version = '2'",
    "predictions",
    metrics=_BY_VERSION,
)
_HISTORY = {
    **_drift_ctes(
        f"SELECT *, {_IS_REF} AS is_ref FROM predictions WHERE model_version = '1' AND ({_IS_REF} OR {_IN_WINDOW})"
    ),
    "measured": "SELECT count(price) AS labeled_rows, count(*) AS scored_rows, "
    + ", ".join(f"{e} AS {c}" for c, e in _ERRORS.items())
    + f" FROM predictions WHERE model_version = '1' AND {_IN_WINDOW}",
    "aged": "SELECT date_diff('second', max(t), TIMESTAMP '" + AS_OF + "') / 86400 AS days FROM "
    "(SELECT min(scored_at) AS t FROM predictions GROUP BY model_version)",
    "flags": "SELECT *, labeled_rows >= 200 AND mape > 0.12 AS slow, scored_rows >= 200 AND n_drifted >= 1 AS shifted, "
    "scored_rows >= 200 AND prediction_psi > 0.25 AS moved, days < 3 AS cooling FROM measured, summary, aged",
    "decided": "SELECT *, concat_ws(',', CASE WHEN slow THEN 'performance' END, CASE WHEN shifted THEN 'data_drift' END, "
    "CASE WHEN moved THEN 'prediction_drift' END) AS triggers, slow OR shifted OR moved AS alert_triggered, "
    "(slow OR shifted OR moved) AND NOT cooling AS retrain_recommended, false AS retrain_triggered FROM flags",
}
RETRAIN_DECISION = _with(
    f"SELECT DATE '{RUN_DATE}' AS run_date, triggers, alert_triggered, retrain_recommended, retrain_triggered FROM decided",
    "predictions",
    **_HISTORY,
)
HISTORY_ROW = _with(
    f"SELECT DATE '{RUN_DATE}' AS run_date, DATE '{RUN_DATE}' - {WINDOW_DAYS - 1} AS window_start, '1' AS model_version, "
    f"labeled_rows, scored_rows, {_round('mae', 'rmse', 'mape', 'max_feature_psi', 'prediction_psi')}, drifted_features, "
    "triggers, alert_triggered, retrain_recommended, retrain_triggered FROM decided",
    "predictions",
    **_HISTORY,
)
HISTORY_MERGE = HISTORY_ROW.replace(
    "retrain_recommended, retrain_triggered FROM decided", "retrain_recommended, retrain_recommended AS retrain_triggered FROM decided"
)
ALERT_COUNT = _with(
    f"SELECT count(*) AS alerts FROM daily WHERE labeled_rows >= {DAILY_MIN_ROWS} AND mape > {DAILY_MAX_MAPE} "
    f"AND run_date >= DATE '{ALERTS_FROM}' - 1",
    "predictions",
    daily="SELECT listing_date AS run_date, count(price) AS labeled_rows, "
    f"{_ERRORS['mape']} AS mape FROM predictions WHERE model_version = '1' GROUP BY listing_date",
)

# --- model: what can be said without the model

_HELD_OUT = f"listing_date >= (SELECT max(listing_date) FROM listings_priced) - {HOLDOUT_DAYS - 1}"
_HELD_COLUMNS = ", ".join(f"{_CALENDAR[c]} AS {c}" if c in _CALENDAR else c for c in REQUEST_COLUMNS)
TRAIN_SCORE = _with(
    f"SELECT listing_id, listing_date, {_HELD_COLUMNS}, '1' AS model_version, true AS sane FROM listings_priced "
    f"WHERE NOT {_INVALID} AND {_HELD_OUT}",
    "listings_priced",
)
STORED_MODEL_SCORE = _with(
    "SELECT listing_id, listing_date, '7' AS model_version, true AS sane, true AS same FROM listings_priced "
    f"WHERE NOT {_INVALID} AND {_HELD_OUT}",
    "listings_priced",
)
TRAIN_EVALUATE = _with(
    f"SELECT count(*) AS n_rows, true AS r2_ok, true AS mape_ok FROM listings_priced WHERE NOT {_INVALID} AND {_HELD_OUT}",
    "listings_priced",
)
COLD_START_SCORE = _with(
    f"SELECT listing_id, '__unseen_region__' AS region, true AS sane FROM listings_priced WHERE NOT {_INVALID} AND {_HELD_OUT} "
    "ORDER BY listing_id LIMIT 5",
    "listings_priced",
)
