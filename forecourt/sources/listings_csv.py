"""Listing feeds as CSV files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_LISTINGS, RESCUED


def read_listings_csv(spark: SparkSession, path, rescue=False) -> DataFrame:
    """A feed with a header line: contract columns in contract order and type, then any others as text.

    Columns are matched by the names in the header, in any order. An absent one stays absent, which the quality gate
    reports; a cell that does not fit its type becomes NULL, which the quality rules report. No type is inferred, which
    would cost a pass and could differ from feed to feed.

    With ``rescue`` the text of such cells is kept in a map by column name, NULL in rows without any: it goes through the
    gate with its row and into the quarantine, where a bad feed can be read as it came.
    """
    text = spark.read.option("header", True).option("inferSchema", False).csv(path)
    known = [f for f in RAW_LISTINGS.fields if f.name in text.columns]
    others = [c for c in text.columns if c not in RAW_LISTINGS.names]
    cells = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in known]
    if not rescue:
        return text.select(*cells, *others)
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text")))
        for f in known
        if f.dataType.simpleString() != "string"
    ]
    kept = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<struct<k:string,v:string>>")
    rescued = F.when(F.size(kept) > 0, F.map_from_entries(kept)).cast("map<string,string>")
    return text.select(*cells, *others, rescued.alias(RESCUED))
