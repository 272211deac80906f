"""Counts, shares and data-quality tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.ratios import safe_ratio
from flowsieve.functions.tally import size
from flowsieve.schema import DECISIONS, NORMAL_LABEL


def literal_rows(df: DataFrame, column: str, values: list) -> DataFrame:
    """The listed values as a one-column frame."""
    listed = F.array(*[F.lit(value) for value in values])
    return df.sparkSession.range(0, 1, 1, 1).select(F.explode(listed).alias(column))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("samples"))
        .orderBy(F.desc("samples"), F.asc(column))
    )


def add_share(counts: DataFrame, samples: str, name: str, digits: int | None = None) -> DataFrame:
    """Percentage of the column total; the total is a scalar subquery over the counts."""
    total = counts.agg(F.sum(samples)).scalar()
    share = safe_ratio(F.col(samples), total) * 100
    return counts.withColumn(name, share if digits is None else F.round(share, digits))


def value_shares(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("samples"))
    return (
        add_share(counts, "samples", "percentage", digits)
        .select(column, "percentage")
        .orderBy(F.desc("percentage"), F.asc(column))
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of exact distinct counts.

    Values are made distinct per column before counting, so a frequent value costs one row.
    """
    named = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("v")) for c in columns]
    values = df.select(F.inline(F.array(*named))).distinct()
    return values.agg(
        *[
            F.count_if((F.col("name") == c) & F.col("v").isNotNull()).alias(f"distinct_{c}")
            for c in columns
        ]
    )


def null_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Total number of nulls over all columns, in one pass."""
    columns = columns or df.columns
    per_row = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint").alias("missing_values"))


def quality_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count, column count, nulls and both target classes in one row."""
    columns = columns or df.columns
    per_row = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(columns)).cast("bigint").alias("column_count"),
        F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint").alias("missing_values"),
        F.count_if(F.col("target") == 0).alias("target_normal"),
        F.count_if(F.col("target") == 1).alias("target_attack"),
    )


def normal_attack_counts(df: DataFrame) -> DataFrame:
    normal = F.col("label").eqNullSafe(NORMAL_LABEL)
    return df.agg(
        F.count_if(normal).alias("normal_count"), F.count_if(~normal).alias("attack_count")
    )


def decision_distribution(
    df: DataFrame, decision: str = "decision", weight: str | None = None
) -> DataFrame:
    """Count and percentage of all three decisions, zero classes kept."""
    counts = df.groupBy(F.col(decision).alias("decision")).agg(size(weight).alias("samples"))
    listed = literal_rows(df, "decision", DECISIONS).join(counts, "decision", "left")
    return add_share(listed.fillna(0, ["samples"]), "samples", "percentage")


def listed_label_counts(train: DataFrame, test: DataFrame, labels: list[str]) -> DataFrame:
    """Train and test rows of each listed label, zero where a label does not occur."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return (
            df.filter(F.col("label").isin(labels))
            .groupBy("label")
            .agg(F.count(F.lit(1)).alias(name))
        )

    return (
        literal_rows(train, "label", labels)
        .join(side(train, "train_count"), "label", "left")
        .join(side(test, "test_count"), "label", "left")
        .fillna(0, ["train_count", "test_count"])
    )
