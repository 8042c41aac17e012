"""Stored profiles: histograms of a baseline's columns, whole and per slice, and drift measured against them.

A profile is one row per slice and column: the column's quantile edges over the whole baseline, and how many values fall in
each cell. Its size depends on the number of slices, columns and cells, not on the baseline's rows, so a monitoring run
reads its own window and the profile, never the baseline again. Counts of one profile's edges add up: cells of days, files
or slices can be summed in any order.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import number
from ..schema import DRIFT_CATEGORICAL, DRIFT_NUMERIC, MODEL_VERSION, PREDICTION, SCORED_AT
from ..staging import read_once
from .psi import BINS, DRIFT_THRESHOLD, SHARE_FLOOR, known_values, quantile_edges
from .regression import SLICES

ALL_ROWS = "all"
# Up to so many combinations of slice values, a baseline's rows are counted by all slices at once.
_COMBINATIONS = 10_000
#: Layout of a stored profile.
PROFILE = T.StructType(
    [
        T.StructField("slice_name", T.StringType()),
        T.StructField("slice_value", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("edges", T.ArrayType(T.DoubleType())),
        T.StructField("cells", T.MapType(T.StringType(), T.LongType())),
        T.StructField("total", T.LongType()),
    ]
)


def _numeric_cell(column, edges):
    """The bin of a number as text; a single edge parts the values equal to it from all others."""
    v = number(column)
    if len(edges) == 1:
        return F.when(v.isNotNull(), F.when(v == edges[0], "0").otherwise("1"))
    reached = F.when(v.isNull(), F.lit(None).cast("string"))
    for i in range(len(edges) - 2, 0, -1):
        reached = reached.when(v >= edges[i], str(i))
    return reached.otherwise("0")


def _text_cell(df, column):
    known = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        known = F.when(~F.isnan(column), known)
    return known.cast("string")


def cell_counts(df: DataFrame, edges, categorical, by=(), slices=(), combined=False) -> DataFrame:
    """``(*by, slice_name, slice_value, feature, cells, total)``: histograms of all columns, whole and per slice value.

    ``edges`` maps numeric columns to their ascending edges. One pass; counts are combined before the shuffle, whose
    groups are slices times columns times cells for each value of ``by``. With ``by`` the rows, by then slices and cells
    alone, are laid out in its ranges first: a task would otherwise hold every group of every day. ``combined`` counts the
    rows by all slices at once and adds those counts up per slice, so that a row is counted once instead of once for each
    slice column and the whole; the groups are then the combinations of slice values times columns times cells.
    """
    known = {c: _numeric_cell(c, e) for c, e in edges.items()} | {c: _text_cell(df, c) for c in categorical}
    places = [f"_slice_{k}" for k in range(len(slices))]
    cells = [cell.alias(f"_cell_{k}") for k, cell in enumerate(known.values())]
    narrow = df.select(*by, *[F.col(s).cast("string").alias(p) for p, s in zip(places, slices)], *cells)
    if by:
        # The hash parts one crowded day over several tasks.
        narrow = narrow.repartitionByRange(*by, F.xxhash64(*[c for c in narrow.columns if c not in by]))
    listed = F.posexplode(F.array(*[f"_cell_{k}" for k in range(len(known))])).alias("_place", "cell")
    rows = narrow.select(*by, *places, listed).where(F.col("cell").isNotNull())
    common, n = [*by, "_place", "cell"], F.count(F.lit(1))
    if slices:
        if combined:
            rows, n = rows.groupBy(*common, *places).agg(n.alias("n")), F.sum("n")
        sets = [[F.col(c) for c in [*common, *place]] for place in ([], *[[p] for p in places])]
        name, value = F.lit(ALL_ROWS), F.lit(None).cast("string")
        for place, s in zip(places, slices):
            name = F.when(F.grouping(place) == 0, F.lit(s)).otherwise(name)
            value = F.when(F.grouping(place) == 0, F.col(place)).otherwise(value)
        grouped = rows.groupingSets(sets, *[F.col(c) for c in [*common, *places]])
    else:
        name, value, grouped = F.lit(ALL_ROWS), F.lit(None).cast("string"), rows.groupBy(*common)
    feature = F.element_at(F.array(*[F.lit(c) for c in known]), F.col("_place") + 1)
    counts = grouped.agg(n.alias("n"), name.alias("slice_name"), value.alias("slice_value"))
    return counts.withColumn("feature", feature).groupBy(*by, "slice_name", "slice_value", "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("cells"), F.sum("n").alias("total")
    )


def baseline_profile(baseline: DataFrame, numeric=(*DRIFT_NUMERIC, PREDICTION), categorical=DRIFT_CATEGORICAL, slices=SLICES, bins=BINS) -> DataFrame:
    """The profile of a baseline. Its edges are exact quantiles; one row per numeric column reaches the driver."""
    baseline = read_once(baseline.select(*{*numeric, *categorical, *slices}))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    values = known_values(baseline, numeric, numeric=True).select("*", one.alias("n_ref"), none.alias("n_cur"))
    edges = {r.feature: list(r.edges) for r in quantile_edges(values, bins).collect()} if numeric else {}
    few = bool(slices) and baseline.select(*slices).distinct().count() <= _COMBINATIONS
    stored = cell_counts(baseline, edges, categorical, slices=slices, combined=few)
    none = F.lit(None).cast("array<double>")
    placed = none
    for c, e in edges.items():
        placed = F.when(F.col("feature") == c, F.array(*[F.lit(float(x)) for x in e])).otherwise(placed)
    return stored.select("slice_name", "slice_value", "feature", placed.alias("edges"), "cells", "total")


def stored_edges(profile: DataFrame):
    """``(edges, categorical)``: edges of the numeric columns of a profile, and its text columns; one row per column."""
    rows = profile.where(F.col("slice_name") == ALL_ROWS).select("feature", "edges").collect()
    return {r.feature: list(r.edges) for r in rows if r.edges is not None}, sorted(r.feature for r in rows if r.edges is None)


def psi_of_histograms(cells, total, other, other_total):
    """PSI of two histograms as maps; NULL where either is unknown. Shares below the floor are raised to it."""
    keys = F.array_sort(F.array_union(F.map_keys(cells), F.map_keys(other)))

    def share(histogram, n, key):
        return F.greatest(F.coalesce(F.element_at(histogram, key), F.lit(0)) / n, F.lit(SHARE_FLOOR))

    def added(so_far, key):
        r, c = share(cells, total, key), share(other, other_total, key)
        return so_far + (c - r) * F.log(c / r)

    return F.when((total > 0) & (other_total > 0), F.aggregate(keys, F.lit(0.0), added))


def _baseline(profile):
    return profile.select("slice_name", "slice_value", "feature", F.col("cells").alias("_cells"), F.col("total").alias("_total"))


def drift_from_profile(profile: DataFrame, window: DataFrame, *, prediction_col=PREDICTION, threshold=DRIFT_THRESHOLD) -> DataFrame:
    """What :func:`forecourt.operators.psi.compute_drift` gives for the baseline, from its profile and one pass over the window."""
    edges, categorical = stored_edges(profile)
    current = cell_counts(window, edges, categorical).select("feature", "cells", "total")
    known = _baseline(profile.where(F.col("slice_name") == ALL_ROWS)).select("feature", "_cells", "_total")
    psi = psi_of_histograms(F.col("_cells"), F.col("_total"), F.col("cells"), F.col("total"))
    is_prediction = F.col("feature") == prediction_col if prediction_col else F.lit(False)
    return known.join(current, "feature", "left").select(
        "feature",
        F.coalesce(psi, F.lit(float("nan"))).alias("psi"),
        is_prediction.alias("is_prediction"),
        (~is_prediction & F.coalesce(psi > threshold, F.lit(False))).alias("drifted"),
    )


def sliced_drift(profile: DataFrame, predictions: DataFrame, slices=SLICES, *, threshold=DRIFT_THRESHOLD) -> DataFrame:
    """Drift of every slice and day: against the same slice of the baseline, and against the day before.

    One row per scoring day, model version, slice and column: n_rows (known values), psi_baseline (NULL where the baseline
    lacks the slice), previous_day and psi_previous (NULL on the slice's first day), drifted. The day before is the last
    one on which the slice has values. All slices are counted in one pass; afterwards only histograms move.
    """
    edges, categorical = stored_edges(profile)
    rows = predictions.withColumn("day", F.to_date(SCORED_AT))
    keys = ["slice_name", "slice_value", "feature"]
    days = cell_counts(rows, edges, categorical, by=["day", MODEL_VERSION], slices=slices)
    w = Window.partitionBy(MODEL_VERSION, *keys).orderBy("day")
    days = days.select("*", *[F.lag(c).over(w).alias(f"previous_{c}") for c in ("day", "cells", "total")])
    base = _baseline(profile).select(*[F.col(k).alias(f"_{k}") for k in keys], "_cells", "_total")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    against = psi_of_histograms(F.col("_cells"), F.col("_total"), F.col("cells"), F.col("total"))
    before = psi_of_histograms(F.col("previous_cells"), F.col("previous_total"), F.col("cells"), F.col("total"))
    return days.join(base, same, "left").select(
        "day",
        MODEL_VERSION,
        *keys,
        F.col("total").alias("n_rows"),
        against.alias("psi_baseline"),
        "previous_day",
        before.alias("psi_previous"),
        F.coalesce(against > threshold, F.lit(False)).alias("drifted"),
    )
