"""Population stability index (PSI) of many columns at once.

Nothing is shuffled by value: every pass over a side ends in an aggregate whose groups are bounded (histogram cells, bins,
categories), so its partial counts leave a task as few rows, however many rows share a value.
"""

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number
from ..staging import read_once

# Floor of a share, default number of quantile bins, drift threshold.
SHARE_FLOOR = 1e-4
BINS = 10
DRIFT_THRESHOLD = 0.25

# Resolution of the histograms in front of the exact quantiles, and how often a part is divided once more.
_CELLS_PER_DECADE = 1000
_CELLS_PER_RANGE = 4096
_DIVISIONS = 3


def known_values(df: DataFrame, columns, numeric) -> DataFrame:
    """Rows ``(feature, value)``: one per known value of every named column, as double or as text. NaN is unknown."""
    types = dict(df.dtypes)

    def text(c):
        known = F.when(~F.isnan(c), F.col(c)) if types[c] in ("double", "float") else F.col(c)
        return known.cast("string")

    typed = df.select(*[(number(c) if numeric else text(c)).alias(c) for c in columns])
    return typed.unpivot([], list(columns), "feature", "value").where(F.col("value").isNotNull())


def value_counts(reference: DataFrame, current: DataFrame, columns, numeric) -> DataFrame:
    """``(feature, value, n_ref, n_cur)`` per distinct value of the columns, from one pass over each side, counted by itself."""
    one, none = F.count("*"), F.lit(0).cast("long")
    sides = [known_values(side, columns, numeric).groupBy("feature", "value") for side in (reference, current)]
    counts = sides[0].agg(one.alias("n_ref"), none.alias("n_cur")).unionByName(sides[1].agg(none.alias("n_ref"), one.alias("n_cur")))
    return counts.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def number_rows(reference: DataFrame, current: DataFrame, columns) -> DataFrame:
    """``(feature, value, n_ref, n_cur)`` per known value and row of numeric columns, for several passes.

    A side that is a plain scan is read in place; one that joins is computed once, its numeric columns alone.
    """
    reference, current = (read_once(side.select(*columns)) for side in (reference, current))
    return (
        known_values(reference, columns, numeric=True)
        .select("*", F.lit(1).cast("long").alias("n_ref"), F.lit(0).cast("long").alias("n_cur"))
        .unionByName(
            known_values(current, columns, numeric=True).select(
                "*", F.lit(0).cast("long").alias("n_ref"), F.lit(1).cast("long").alias("n_cur")
            )
        )
    )


def label_counts(reference: DataFrame, current: DataFrame, columns) -> DataFrame:
    """The counts of text columns."""
    return value_counts(reference, current, columns, numeric=False)


def frequency(df: DataFrame, columns) -> DataFrame:
    """``(feature, value, n, share)``: how often each known value of every column occurs."""
    counts = known_values(df, columns, numeric=False).groupBy("feature", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "value", "n", (F.col("n") / F.col("total")).alias("share")
    )


# Two cell numbers that never decrease with the value: the sign and then 1000 cells per power of ten; and equal parts of
# a cell's own range, or a single part where that range is empty or not finite.
_MAGNITUDE_CELL = f"""
    CASE WHEN value = 0 THEN 0L ELSE
        cast(signum(value) AS bigint) * floor((log10(least(abs(value), 1.7e308D)) + 325) * {_CELLS_PER_DECADE})
    END"""
_RANGE_PART = f"""
    CASE WHEN high > low AND high - low < double('infinity')
         THEN floor((value - low) / (high - low) * {_CELLS_PER_RANGE}) ELSE 0L END"""


def exact_quantiles(counts: DataFrame, probabilities) -> DataFrame:
    """Linearly interpolated quantiles of ``(feature, value, n)`` rows as ``(feature, quantiles)``, in the order given.

    Exact, yet no task ever holds the values of a feature, as ``percentile`` would: the wanted ranks are located with a
    histogram whose cells are 1/1000 of a decade wide, the few cells that hold a wanted rank are divided into equal parts
    of the range of their own values, those again, and only what remains is counted by value and put in order. The size
    of every histogram is bounded whatever the data. A part of a single value is settled and not looked into again, so
    that a pass reads on only for features that need it; at most two parts per feature and probability reach the driver.
    """
    probabilities = [float(q) for q in probabilities]
    wanted = "array({})".format(", ".join(f"{q!r}D" for q in probabilities))
    lower, upper = "floor((total - 1) * q)", "least(floor((total - 1) * q) + 1, total - 1)"
    ranks = f"array_distinct(flatten(transform({wanted}, q -> array({lower}, {upper}))))"
    ranks_here = F.expr(f"filter({ranks}, r -> r BETWEEN below AND below + n - 1)")

    def preceding(order, *by):
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    def holding(parts):
        named = parts.select("feature", "cell", "total", "below", "low", "high", ranks_here.alias("ranks"))
        return named.where(F.size("ranks") > 0).collect()

    size = [F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
    celled = counts.withColumn("cell", F.expr(_MAGNITUDE_CELL))
    coarse = celled.groupBy("feature", "cell").agg(*size).withColumns(
        {"total": F.sum("n").over(Window.partitionBy("feature")), "below": preceding("cell", "feature")}
    )
    totals, at, found = {}, {}, holding(coarse)
    for part in [_RANGE_PART] * _DIVISIONS + ["value"]:
        totals |= {p.feature: p.total for p in found}
        at |= {(p.feature, r): p.low + 0.0 for p in found if p.low == p.high for r in p.ranks}
        unsettled = [tuple(p)[:6] for p in found if p.low != p.high]
        if not unsettled:
            break
        layout = "feature string, cell long, total long, below long, low double, high double"
        parts = F.broadcast(counts.sparkSession.createDataFrame(unsettled, layout))
        inside = celled.where(F.col("feature").isin(sorted({p[0] for p in unsettled}))).join(parts, ["feature", "cell"])
        finer = inside.where("value BETWEEN low AND high").groupBy("feature", "cell", "total", "below", F.expr(part).alias("part")).agg(*size)
        start = F.col("below") + preceding("part", "feature", F.col("below"))
        found = holding(finer.withColumn("start", start).drop("below").withColumnRenamed("start", "below"))
    else:
        at |= {(p.feature, r): p.low + 0.0 for p in found for r in p.ranks}

    def between(feature, q):
        # Measured from the nearer end, as numpy does, so that both give the same double.
        last = totals[feature] - 1
        below = math.floor(last * q)
        a, b, w = at[feature, below], at[feature, min(below + 1, last)], last * q - below
        return a if a == b else a + (b - a) * w if w < 0.5 else b - (b - a) * (1 - w)

    rows = [(f, [between(f, q) for q in probabilities]) for f in sorted(totals)]
    return counts.sparkSession.createDataFrame(rows, "feature string, quantiles array<double>")


def quantile_edges(counts: DataFrame, bins=BINS) -> DataFrame:
    """``(feature, edges)``: the distinct reference quantiles 0, 1/bins, ..., 1 of every numeric feature, ascending."""
    reference = counts.where(F.col("n_ref") > 0).select("feature", "value", F.col("n_ref").alias("n"))
    quantiles = exact_quantiles(reference, [i * (1.0 / bins) for i in range(bins)] + [1.0])
    return quantiles.select("feature", F.array_sort(F.array_distinct("quantiles")).alias("edges"))


def bin_counts(counts: DataFrame, bins=BINS) -> DataFrame:
    """``(feature, bin, n_ref, n_cur)`` over the reference's quantile bins ``[edge, next edge)``, open at both ends.

    A reference with a single edge is constant: bin 0 then holds the values equal to it and bin 1 all others.
    """
    inner = [F.expr(f"IF({i} < size(edges) - 1, get(edges, {i}), NULL)").alias(f"_edge_{i}") for i in range(1, bins)]
    only = F.expr("IF(size(edges) = 1, get(edges, 0), NULL)").alias("_only")
    reached = " + ".join(["0"] + [f"IF(value >= _edge_{i}, 1, 0)" for i in range(1, bins)])
    place = F.expr(f"IF(_only IS NOT NULL, IF(value = _only, 0, 1), {reached})")
    # The edges are one row per column, a bound that does not depend on the data.
    edges = quantile_edges(counts, bins).select("feature", only, *inner)
    return (
        counts.join(F.broadcast(edges), "feature")
        .groupBy("feature", place.alias("bin"))
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )


def psi_of_cells(cells: DataFrame, totals: DataFrame, columns) -> DataFrame:
    """``(feature, psi)`` for every name in ``columns``, from rows ``(feature, n_ref, n_cur)`` per bin or category.

    NaN when a side has no values. Shares below the floor are raised to it and not rescaled. ``totals`` is one row per
    column, so it is joined without a shuffle and without a window over all categories.
    """
    ref = F.greatest(F.try_divide("n_ref", "t_ref"), F.lit(SHARE_FLOOR))
    cur = F.greatest(F.try_divide("n_cur", "t_cur"), F.lit(SHARE_FLOOR))
    summed = (
        cells.join(F.broadcast(totals), "feature")
        .where("t_ref > 0 AND t_cur > 0")
        .groupBy("feature")
        .agg(F.sum((cur - ref) * F.log(cur / ref)).alias("psi"))
    )
    names = cells.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    return names.join(F.broadcast(summed), "feature", "left").select(
        "feature", F.coalesce("psi", F.lit(float("nan"))).alias("psi")
    )


def side_totals(counts: DataFrame) -> DataFrame:
    """``(feature, t_ref, t_cur)``: known values per column and side."""
    return counts.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))


def numeric_psi(reference: DataFrame, current: DataFrame, columns, bins=BINS) -> DataFrame:
    """``(feature, psi)`` of the numeric columns."""
    binned = bin_counts(number_rows(reference, current, columns), bins)
    return psi_of_cells(binned, side_totals(binned), columns)


def categorical_psi(reference: DataFrame, current: DataFrame, columns) -> DataFrame:
    """``(feature, psi)`` of the text columns; a category only one side has counts as drift."""
    counts = label_counts(reference, current, columns)
    return psi_of_cells(counts, side_totals(counts), columns)


def compute_drift(
    reference: DataFrame,
    current: DataFrame,
    *,
    numeric_cols,
    categorical_cols,
    prediction_col=None,
    threshold=DRIFT_THRESHOLD,
) -> DataFrame:
    """``(feature, psi, is_prediction, drifted)``, one row per column.

    The prediction column has a row of its own and is never listed as a drifted feature.
    """
    numeric = [*numeric_cols, *([prediction_col] if prediction_col else [])]
    parts = []
    if numeric:
        binned = bin_counts(number_rows(reference, current, numeric)).drop("bin")
        parts.append((binned, side_totals(binned)))
    if categorical_cols:
        counts = label_counts(reference, current, categorical_cols)
        parts.append((counts.drop("value"), side_totals(counts)))
    cells, totals = (reduce(DataFrame.unionByName, frames) for frames in zip(*parts))
    of_prediction = F.col("feature") == prediction_col if prediction_col else F.lit(False)
    return (
        psi_of_cells(cells, totals, [*numeric, *categorical_cols])
        .withColumn("is_prediction", of_prediction)
        .withColumn("drifted", ~F.col("is_prediction") & ~F.isnan("psi") & (F.col("psi") > threshold))
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    """One row: max_feature_psi (0 if none is known), prediction_psi, drifted_features and their number."""
    known_feature = ~F.col("is_prediction") & ~F.isnan("psi")
    return drift.agg(
        F.coalesce(F.max(F.when(known_feature, F.col("psi"))), F.lit(0.0)).alias("max_feature_psi"),
        F.max(F.when(F.col("is_prediction"), F.col("psi"))).alias("prediction_psi"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("drifted_features"),
        F.count_if("drifted").alias("n_drifted"),
    )
