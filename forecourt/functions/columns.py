"""Small column helpers that pin down null and NaN behaviour.

Source frames mark a missing number with NaN, and there a comparison with it is false. Spark orders NaN above every
number, so NaN is turned into NULL wherever a number enters an expression.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c) -> Column:
    """``c`` as a double; text that is no number, and NaN, become NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def holds(condition: Column) -> Column:
    """A condition as a plain true/false: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def floor_at_zero(c: Column) -> Column:
    """Negative values become 0 while NULL stays NULL (``greatest`` would skip the NULL)."""
    return F.when(c < 0, F.lit(0).cast("double")).otherwise(c)


def years_between(listed_year: Column, built_year: Column) -> Column:
    """Vehicle age in whole years, 0 for a model year after the listing."""
    return floor_at_zero(listed_year - built_year)


def all_known(columns) -> Column:
    """True where none of the named columns is NULL."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


def fail_unless(ok: Column, message) -> Column:
    """TRUE where ``ok`` holds; anything else stops the query with ``message``."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
