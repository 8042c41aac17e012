import datetime as dt
import random
import re

import pytest
from conftest import listing
from pyspark.sql import functions as F

from forecourt.operators.market_index import affected_rows, changed_days, compute_market_index, days_read, index_input, recompute_index
from forecourt.plans.features import refresh_market_index
from forecourt.plans.ingest import ingest, last_load
from forecourt.plans.names import Tables
from forecourt.schema import MARKET_FEATURES

START, END = dt.date(2025, 2, 3), dt.date(2025, 5, 20)


def cars(n, seed, first=dt.date(2025, 1, 4), days=136):
    draw = random.Random(seed)
    return [
        listing(f"{seed}-{k}", first + dt.timedelta(days=draw.randrange(days)), make=draw.choice(["Norvik", "Aster"]),
                region=draw.choice(["north", "south"]), mileage=draw.randrange(100000), year=2010 + draw.randrange(14), price=draw.uniform(4e3, 6e4))
        for k in range(n)
    ]


def as_rows(index):
    rows = {}
    for r in index.collect():
        key = (r.make, r.model, r.region, r.index_date)
        assert key not in rows
        rows[key] = tuple(None if r[c] is None else round(r[c], 9) for c in MARKET_FEATURES)
    return rows


def full(listings):
    return compute_market_index(index_input(listings, START, END), START, END)


def test_only_changed_places_are_named(make_listings):
    before = cars(60, 1)
    dearer, moved, gone = 3, 11, 20
    after = [list(r) for r in before]
    after[dearer][-1] *= 1.5
    after[moved][9] = "west"  # region
    del after[gone]
    key = lambda r: (r[2], r[3], r[9], r[1])
    want = {key(before[dearer]), key(before[moved]), key(after[moved]), key(before[gone])}
    got = changed_days(make_listings(before), make_listings([tuple(r) for r in after]))
    assert {tuple(r) for r in got.collect()} == want
    assert changed_days(make_listings(before), make_listings(before[::-1])).count() == 0


def test_recomputed_rows_are_those_of_a_rebuild(spark, make_listings):
    before = cars(150, 2)
    late = [listing("late", dt.date(2025, 3, 9), price=77000.0), listing("new", dt.date(2025, 4, 2), make="Unseen"), listing("x", dt.date(2024, 12, 1))]
    old, new = make_listings(before), make_listings(before[1:] + late)
    stored, want = full(old).persist(), as_rows(full(new))
    affected = affected_rows(changed_days(old, new), stored, START, END)
    days = days_read(affected)
    again = as_rows(recompute_index(new, affected, days))
    assert again == {k: want[k] for k in again} and any(k[0] == "Unseen" and v[0] == 0 for k, v in again.items())
    assert {**as_rows(stored), **again} == {**as_rows(stored), **want}
    narrow = affected_rows(changed_days(old, make_listings(before + late[:1])), stored, START, END)
    assert narrow.count() == 30 and days_read(narrow) == [dt.date(2025, 2, 8) + dt.timedelta(days=k) for k in range(59)]


def test_a_late_label_enters_the_index(spark, make_listings):
    spark.sql("CREATE DATABASE IF NOT EXISTS late")
    tables = Tables("late")
    try:
        first = cars(300, 5, dt.date(2025, 4, 1), 50)
        ingest(spark, make_listings(first), tables, END, max_invalid_fraction=1.0)
        assert last_load(spark, tables) == 1
        span = refresh_market_index(spark, tables, END)
        assert span[1] == END
        # A month later in the calendar than three days: a price is corrected, a listing is added, one is loaded again as it is.
        fixed = list(first[0])
        fixed[-1] *= 1.3
        ingest(spark, make_listings([tuple(fixed), first[1], listing("added", dt.date(2025, 4, 5), make="Rare")]), tables, END)
        changed = spark.table(tables.changes).where("load = 2")
        assert {(r.make, r.day) for r in changed.collect()} == {(fixed[2], fixed[1]), ("Rare", dt.date(2025, 4, 5))}
        assert refresh_market_index(spark, tables, END) == (END - dt.timedelta(days=2), END)
        listings = spark.table(tables.listings)
        start = span[0]
        want = as_rows(compute_market_index(index_input(listings, start, END), start, END))
        assert as_rows(spark.table(tables.index)) == want
        # Nothing new: nothing is computed again beyond the regular days.
        assert refresh_market_index(spark, tables, END)[0] == END - dt.timedelta(days=2) and as_rows(spark.table(tables.index)) == want
    finally:
        spark.sql("DROP DATABASE late CASCADE")


def test_only_touched_days_are_read(spark, make_listings, tmp_path):
    path = str(tmp_path / "cars")
    make_listings(cars(200, 7)).write.partitionBy("listing_date").parquet(path)
    listings = spark.read.parquet(path)
    changes = spark.createDataFrame([("Norvik", "Fjell", "north", dt.date(2025, 3, 1))], "make string, model string, region string, day date")
    affected = affected_rows(changes, full(listings), START, END)
    again = recompute_index(listings, affected, days_read(affected))
    again.collect()
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*listing_date#\d+ INSET 2025-01-31", plan), plan


@pytest.mark.parametrize("when", [dt.date(2024, 1, 1), END])
def test_changes_without_effect(spark, make_listings, when):
    index = full(make_listings(cars(40, 9)))
    changes = index.limit(1).select("make", "model", "region", F.lit(when).alias("day"))
    assert affected_rows(changes, index, START, END).count() == 0
