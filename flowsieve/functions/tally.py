"""Conditional counts over rows, or over rows that already stand for several.

Evaluation tables only look at a few columns with few values. Grouped once by those columns, any
number of scored rows becomes a table of some hundred weighted rows, and every evaluation
operator gives the same result on it when told the weight column.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def tally(condition: Column, weight: str | None = None) -> Column:
    """Rows that meet a condition."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0))


def size(weight: str | None = None) -> Column:
    """All rows."""
    if weight is None:
        return F.count(F.lit(1))
    return F.coalesce(F.sum(weight), F.lit(0))
