import datetime as dt
import os
import sys

import pytest
from pyspark.sql.types import StructField, StructType

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecourt.schema import RAW_LISTINGS  # noqa: E402
from forecourt.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def listing(i, day=dt.date(2026, 3, 17), **over):
    """One valid listing as a tuple in contract order."""
    row = {
        "listing_id": f"id-{i}",
        "listing_date": day,
        "make": "Norvik",
        "model": "Fjell",
        "body_type": "wagon",
        "fuel_type": "diesel",
        "transmission": "manual",
        "drivetrain": "fwd",
        "condition": "Fair",
        "region": "north",
        "year": 2021,
        "mileage": 31500,
        "engine_size_l": 1.8,
        "num_owners": 3,
        "accident_history": False,
        "price": 18400.0,
    }
    row.update(over)
    return tuple(row[c] for c in RAW_LISTINGS.names)


@pytest.fixture
def make_listings(spark):
    # Feeds may lack values, so the contract's NOT NULL is dropped here.
    nullable = StructType([StructField(f.name, f.dataType, True) for f in RAW_LISTINGS.fields])
    return lambda rows: spark.createDataFrame(rows, nullable)
