"""The input views of FIXTURES.md as SQL text over the base tables.

The same text serves Spark, over parquet files, and the SQL checks, over tables registered under their own names.
"""

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["lineitem", "part", "supplier", "nation", "region"]

LISTINGS = """
SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-',
              cast(l_quantity AS bigint), '-', cast(round(l_extendedprice * 100) AS bigint)) AS listing_id,
       cast(l_shipdate AS date) AS listing_date,
       p_brand AS make, p_type AS model,
       CASE p_size % 4 WHEN 0 THEN 'sedan' WHEN 1 THEN 'suv' WHEN 2 THEN 'truck' ELSE 'wagon' END AS body_type,
       CASE l_returnflag WHEN 'A' THEN 'gasoline' WHEN 'N' THEN 'hybrid' ELSE 'diesel' END AS fuel_type,
       CASE l_linestatus WHEN 'O' THEN 'automatic' ELSE 'manual' END AS transmission,
       CASE l_suppkey % 4 WHEN 0 THEN 'fwd' WHEN 1 THEN 'rwd' WHEN 2 THEN 'awd' ELSE '4wd' END AS drivetrain,
       CASE WHEN l_discount < 0.02 THEN 'excellent' WHEN l_discount < 0.06 THEN 'Good'
            WHEN l_discount < 0.09 THEN 'fair' WHEN l_discount < 0.0999 THEN 'poor' ELSE 'mint' END AS condition,
       r_name AS region,
       cast(year(l_shipdate) - (l_partkey % 8) AS bigint) AS year,
       cast(l_quantity AS bigint) * 10000 + (l_orderkey % 7) * 2500 AS mileage,
       cast(1.5 + (p_size % 8) * 0.5 AS double) AS engine_size_l,
       cast(1 + l_suppkey % 6 AS bigint) AS num_owners,
       (l_orderkey % 5 = 0) AS accident_history,
       l_extendedprice AS price
FROM {lineitem}
JOIN {part} ON p_partkey = l_partkey
JOIN {supplier} ON s_suppkey = l_suppkey
JOIN {nation} ON n_nationkey = s_nationkey
JOIN {region} ON r_regionkey = n_regionkey
"""

LISTINGS_DIRTY = """
SELECT CASE WHEN mileage % 10000 = 7500 AND num_owners = 6 THEN NULL ELSE listing_id END AS listing_id,
       listing_date,
       CASE WHEN mileage % 10000 = 5000 AND num_owners = 5 THEN NULL ELSE make END AS make,
       model, body_type, fuel_type, transmission, drivetrain, condition,
       CASE WHEN mileage % 10000 = 2500 AND num_owners = 4 THEN NULL ELSE region END AS region,
       year, mileage, engine_size_l,
       CASE WHEN mileage % 10000 = 0 AND num_owners = 3 THEN NULL ELSE num_owners END AS num_owners,
       accident_history,
       CASE WHEN mileage % 10000 = 5000 AND num_owners = 2 THEN NULL ELSE price END AS price
FROM {listings}
"""

PREDICTIONS = """
SELECT l.listing_id, l.listing_date,
       cast(year(l.listing_date) AS bigint) AS listing_year, cast(month(l.listing_date) AS bigint) AS listing_month,
       l.make, l.model, l.body_type, l.fuel_type, l.transmission, l.drivetrain, l.condition, l.region,
       l.year, l.mileage, l.engine_size_l, l.num_owners, l.accident_history,
       l.price * CASE v.model_version WHEN '1' THEN 1 + (l.num_owners - 3) * 0.04
                                      ELSE 1 + (l.num_owners - 3) * 0.03 END AS predicted_price,
       CASE WHEN l.mileage % 10000 = 2500 THEN NULL ELSE l.price END AS price,
       v.model_version,
       cast(l.listing_date AS timestamp) + INTERVAL '1' DAY AS scored_at
FROM {listings} l {versions}
"""

LISTINGS_PRICED = """
SELECT listing_id, listing_date, make, model, body_type, fuel_type, transmission, drivetrain, condition, region,
       year, mileage, engine_size_l, num_owners, accident_history,
       (20000 + 4000 * engine_size_l)
         * exp(-0.13 * (year(listing_date) - year)) * exp(-0.000001 * mileage)
         * CASE lower(condition) WHEN 'excellent' THEN 1.08 WHEN 'good' THEN 1.0 WHEN 'fair' THEN 0.88 ELSE 0.72 END
         * CASE WHEN accident_history THEN 0.85 ELSE 1.0 END
         * (1 - 0.03 * (num_owners - 1))
         * (0.95 + 0.1 * price / 105000) AS price
FROM {listings}
"""

# The two model versions of the predictions view: Spark repeats each row in place, plain SQL unnests a list.
_VERSIONS_SPARK = "LATERAL VIEW explode(array('1', '2')) v AS model_version"
_VERSIONS_SQL = ", unnest(['1', '2']) v(model_version)"

#: HotSpot leaves methods of more than 8000 bytes of code uncompiled. The views' expressions, with rules and features on top,
#: exceed that in one generated method per stage; beyond this limit Spark runs a stage operator by operator instead.
_METHOD_BYTES = ("spark.sql.codegen.hugeMethodLimit", "8000")

_DERIVED = {"listings_dirty": LISTINGS_DIRTY, "predictions": PREDICTIONS, "listings_priced": LISTINGS_PRICED}


def view_sql(name) -> str:
    """The text of a view in plain SQL; derived views read from ``listings``."""
    if name == "listings":
        return LISTINGS.format(**{t: t for t in BASE_TABLES})
    return _DERIVED[name].format(listings="listings", versions=_VERSIONS_SQL)


def view(spark: SparkSession, sf_dir, name) -> DataFrame:
    """An input view over the tables in ``sf_dir``, read in place by whatever uses it.

    The session's stages get a size limit that keeps what is built on the view compiled.
    """
    spark.conf.set(*_METHOD_BYTES)
    listings = LISTINGS.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in BASE_TABLES})
    if name == "listings":
        return spark.sql(listings)
    return spark.sql(_DERIVED[name].format(listings=f"({listings})", versions=_VERSIONS_SPARK))
