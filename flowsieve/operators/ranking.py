"""Orderings and top-k reports. Every order ends in a unique column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, *order) -> DataFrame:
    """A table of types in order, with each row's ``place``. One row per type or label: small."""
    place = F.row_number().over(Window.orderBy(*order))
    return df.withColumn("place", place).orderBy("place")


def by_missed(by_type: DataFrame) -> DataFrame:
    return numbered(by_type, F.desc("missed"), F.asc("attack_type"))


def by_recall(by_type: DataFrame, recall: str = "hybrid_recall") -> DataFrame:
    return numbered(by_type, F.asc(recall), F.asc("attack_type"))


def by_total(by_type: DataFrame, descending: bool = True) -> DataFrame:
    total = F.desc("total") if descending else F.asc("total")
    return numbered(by_type, total, F.asc("attack_type"))


def top(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows of an order, numbered. The numbering window sees at most n rows."""
    return df.orderBy(*order).limit(n).withColumn(
        "place", F.row_number().over(Window.orderBy(*order))
    )


def most_missed(by_type: DataFrame, n: int = 10) -> DataFrame:
    return top(by_type, [F.desc("missed"), F.asc("attack_type")], n)


def hardest_types(
    by_type: DataFrame, recall: str = "hybrid_recall", min_total: int = 10, n: int = 10
) -> DataFrame:
    """Lowest recall among types with enough samples."""
    enough = by_type.filter(F.col("total") >= min_total)
    return top(enough, [F.asc(recall), F.asc("attack_type")], n)


def best_types(
    by_type: DataFrame, recall: str = "hybrid_recall", min_total: int = 10, n: int = 10
) -> DataFrame:
    enough = by_type.filter(F.col("total") >= min_total)
    return top(enough, [F.desc(recall), F.asc("attack_type")], n)


def largest_differences(differences: DataFrame, n: int = 10) -> DataFrame:
    """Features whose means differ most, for one attack type."""
    return top(differences, [F.desc("abs_difference"), F.asc("feature")], n)


def preview(df: DataFrame, order: list, n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)
