import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from forecourt.operators import profile as profiles
from forecourt.operators.profile import PROFILE, baseline_profile, cell_counts, drift_from_profile, sliced_drift
from forecourt.operators.psi import compute_drift
from forecourt.plans.monitoring import stored_drift
from forecourt.plans.names import Tables
from forecourt.sources import tables as sources
from forecourt.sources.tables import baseline_version, profile_name, refresh_baseline
from forecourt.staging import staged

NUMERIC, TEXT, SLICED = ["year", "mileage", "level", "predicted_price"], ["fuel_type", "region"], ["make", "region"]
SCHEMA = (
    "make string, region string, fuel_type string, year long, mileage double, level double, "
    "predicted_price double, model_version string, scored_at timestamp"
)


def rows(spark, n, seed, shift=0.0, days=6):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        when = dt.datetime(2026, 4, 1 + draw.choice([d for d in range(days) if d != 2]), draw.randrange(24))
        mileage = draw.choice([None, float("nan"), draw.gauss(shift, 1)]) if draw.random() < 0.2 else draw.gauss(shift, 1)
        make = draw.choice(["Norvik", "Aster", None] if shift else ["Norvik", "Aster", None, "Old"])
        out.append((
            make, draw.choice(["north", "south", None]), draw.choice(["diesel", "petrol", "hydrogen" if shift else "diesel"]),
            draw.randrange(2010, 2024), mileage, 3.5 if not shift or draw.random() < 0.9 else 4.0, draw.gauss(20000 + 3000 * shift, 4000),
            draw.choice("12"), when,
        ))
    return spark.createDataFrame(out, SCHEMA)


def as_pairs(drift):
    return {r.feature: (None if math.isnan(r.psi) else round(r.psi, 9), r.is_prediction, r.drifted) for r in drift.collect()}


def test_drift_from_the_profile_is_the_drift_from_the_rows(spark):
    baseline = rows(spark, 900, 1)
    profile = baseline_profile(baseline, NUMERIC, TEXT, SLICED).persist()
    assert profile.schema.simpleString() == PROFILE.simpleString()
    for window in (rows(spark, 400, 2, 0.7), baseline, rows(spark, 5, 3), baseline.limit(0), baseline.withColumn("mileage", F.lit(None).cast("double"))):
        direct = compute_drift(baseline, window, numeric_cols=NUMERIC[:-1], categorical_cols=TEXT, prediction_col=NUMERIC[-1])
        assert as_pairs(drift_from_profile(profile, window)) == as_pairs(direct)


def test_a_run_reads_the_profile_and_not_the_baseline(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS profiled")
    tables = Tables("profiled")
    window = rows(spark, 100, 5, 0.5)
    assert stored_drift(spark, tables, window) is None
    make = lambda df: baseline_profile(df, NUMERIC, TEXT, SLICED)
    try:
        assert refresh_baseline(spark, tables.baseline, "1", lambda: rows(spark, 300, 4).withColumn("model_version", F.lit("1")), profile=make)
        drift = stored_drift(spark, tables, window)
        names = [f for f in drift.inputFiles() if "drift_baseline" in f]
        assert names and all("drift_baseline_profile" in f for f in names)
        assert {r.feature for r in drift.collect()} == {*NUMERIC, *TEXT}
        # A new champion replaces both; without a profile none is left of the old baseline.
        assert refresh_baseline(spark, tables.baseline, "2", lambda: rows(spark, 50, 6).withColumn("model_version", F.lit("2")))
        assert baseline_version(spark, tables.baseline) == "2" and not spark.catalog.tableExists(profile_name(tables.baseline))
    finally:
        spark.sql("DROP DATABASE profiled CASCADE")


def brute_psi(a, b):
    total = 0.0
    for cell in {*a, *b}:
        r, c = max(a[cell] / sum(a.values()), 1e-4), max(b[cell] / sum(b.values()), 1e-4)
        total += (c - r) * math.log(c / r)
    return total


def test_sliced_drift_against_brute_force(spark):
    baseline, window = rows(spark, 500, 7), rows(spark, 600, 8, 0.6)
    profile = baseline_profile(baseline, NUMERIC, TEXT, SLICED).persist()
    edges = {r.feature: r.edges for r in profile.where("slice_name = 'all'").collect()}

    def cells(df, by_day):
        out = defaultdict(Counter)
        for r in df.collect():
            for f in [*NUMERIC, *TEXT]:
                v = r[f]
                if v is None or v != v:
                    continue
                if edges[f] is not None:
                    v = int(v != edges[f][0]) if len(edges[f]) == 1 else sum(v >= e for e in edges[f][1:-1])
                for s in ["all", *SLICED]:
                    key = (s, None if s == "all" else r[s], f)
                    out[(r.scored_at.date(), r.model_version, *key) if by_day else key][str(v)] += 1
        return out

    base, days = cells(baseline, False), cells(window, True)
    got = {tuple(r)[:5]: r for r in sliced_drift(profile, window, SLICED).collect()}
    assert set(got) == set(days)
    for key, now in days.items():
        r, earlier = got[key], [k[0] for k in days if k[1:] == key[1:] and k[0] < key[0]]
        assert r.n_rows == sum(now.values()) and r.previous_day == max(earlier, default=None)
        against = brute_psi(base[key[2:]], now) if key[2:] in base else None
        assert r.psi_baseline == (None if against is None else pytest.approx(against)) and r.drifted == (against is not None and against > 0.25)
        before = brute_psi(days[(max(earlier), *key[1:])], now) if earlier else None
        assert r.psi_previous == (None if before is None else pytest.approx(before))
    assert any(k[3] is None and k[2] == "make" for k in got) and any(r.psi_previous is None for r in got.values())


def test_few_combinations_of_slices_are_counted_together(spark, monkeypatch):
    # A row is then counted once; with many combinations, or without slices, the profile is the same.
    baseline = rows(spark, 400, 9)
    counted = []
    monkeypatch.setattr(profiles, "cell_counts", lambda *args, **more: counted.append(more["combined"]) or cell_counts(*args, **more))

    def made(slices):
        return sorted(map(str, baseline_profile(baseline, NUMERIC, TEXT, slices).withColumn("cells", F.array_sort(F.map_entries("cells"))).collect()))

    together, whole = made(SLICED), made([])
    edges = {r.feature: r.edges for r in baseline_profile(baseline, NUMERIC, TEXT, []).collect() if r.edges}
    plan = cell_counts(baseline, edges, TEXT, slices=SLICED, combined=True)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Expand"):]
    assert "Aggregate" in below and "Generate" in below[below.index("Aggregate"):]
    monkeypatch.setattr(profiles, "_COMBINATIONS", 1)
    assert made(SLICED) == together and set(whole) < set(together)
    assert counted == [True, False, False, False]


def test_a_first_baseline_is_written_in_place(spark, monkeypatch, tmp_path):
    # Rows that replace a table or its files are copied all the same, as they may be read from there.
    copied = []
    monkeypatch.setattr(sources, "staged", lambda df: copied.append(df) or staged(df))
    make = lambda df: baseline_profile(df, NUMERIC, TEXT, SLICED)
    scored = lambda version: rows(spark, 60, 3).withColumn("model_version", F.lit(version))
    name, path = "written_once", str(tmp_path / "baseline")
    try:
        assert refresh_baseline(spark, name, "1", lambda: scored("1"), path=path, profile=make, in_place=True) and not copied
        assert spark.table(name).count() == 60 and spark.table(profile_name(name)).where("slice_name = 'all'").count() == len([*NUMERIC, *TEXT])
        again = lambda: spark.table(name).withColumn("model_version", F.lit("2"))
        assert refresh_baseline(spark, name, "2", again, path=path, profile=make, in_place=True) and len(copied) == 1
        assert spark.table(name).where("model_version = '2'").count() == 60 and spark.catalog.tableExists(profile_name(name))
        # The table is gone, its files are not.
        spark.sql(f"DROP TABLE {name}")
        assert refresh_baseline(spark, name, "3", lambda: spark.read.parquet(path).withColumn("model_version", F.lit("3")), path=path, in_place=True)
        assert len(copied) == 2 and spark.table(name).where("model_version = '3'").count() == 60
    finally:
        for table in (name, profile_name(name)):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_slices_are_counted_in_one_pass(spark):
    profile = spark.createDataFrame(baseline_profile(rows(spark, 50, 1), NUMERIC, TEXT, SLICED).collect(), PROFILE)
    plan = sliced_drift(profile, rows(spark, 50, 2), SLICED)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Generate") == 1


def test_days_are_laid_out_before_their_groups_are_counted(spark):
    # Each task then holds the groups of a few days; one crowded day still goes to several tasks.
    profile = spark.createDataFrame(baseline_profile(rows(spark, 50, 1), NUMERIC, TEXT, SLICED).collect(), PROFILE)
    plan = sliced_drift(profile, rows(spark, 50, 2), SLICED)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate"):]
    assert "RepartitionByExpression" in below and "xxhash64" in below
