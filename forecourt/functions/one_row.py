"""Putting one-row results side by side."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(one_row: DataFrame, *others: DataFrame) -> DataFrame:
    """``one_row`` with the columns of other one-row frames, each brought in as a scalar subquery."""
    for other in others:
        columns = one_row.columns
        row = other.select(F.struct(*other.columns)).scalar()
        one_row = one_row.select(*columns, row.alias("_other")).select(*columns, "_other.*")
    return one_row
