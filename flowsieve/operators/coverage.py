"""Attack-type sets of two splits and how far one covers the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.ratios import safe_ratio
from flowsieve.operators.ranking import numbered
from flowsieve.functions.tally import size
from flowsieve.schema import NORMAL_LABEL


def attack_types(df: DataFrame) -> DataFrame:
    """Distinct labels of the attack rows."""
    return df.filter(F.col("target") == 1).select("label").distinct()


def shared_types(train: DataFrame, test: DataFrame) -> DataFrame:
    return attack_types(train).intersect(attack_types(test))


def test_only_types(train: DataFrame, test: DataFrame) -> DataFrame:
    return attack_types(test).subtract(attack_types(train))


def train_only_types(train: DataFrame, test: DataFrame) -> DataFrame:
    return attack_types(train).subtract(attack_types(test))


def rows_of_types(df: DataFrame, types: DataFrame) -> DataFrame:
    """Attack rows whose label is in a type set. The set is one row per type, so adaptive
    execution broadcasts it by its measured size and otherwise splits hot labels."""
    return df.filter(F.col("target") == 1).join(types.select("label"), "label", "left_semi")


def attack_counts(df: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    return (
        df.filter(F.col("label") != NORMAL_LABEL)
        .groupBy("label")
        .agg(size(weight).alias(name))
    )


def joined_counts(train: DataFrame, test: DataFrame, weight: str | None = None) -> DataFrame:
    """Train and test rows per attack type. Both sides are counted first, so the outer join
    only sees one row per type."""
    return (
        attack_counts(train, "train_count", weight)
        .join(attack_counts(test, "test_count", weight), "label", "full")
        .fillna(0, ["train_count", "test_count"])
    )


def with_coverage(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "seen_in_training": F.col("train_count") > 0,
            "test_only": (F.col("train_count") == 0) & (F.col("test_count") > 0),
        }
    )


def with_percentages(counts: DataFrame) -> DataFrame:
    """Each type's share of the attacks of its split."""
    train_total = counts.agg(F.sum("train_count")).scalar()
    test_total = counts.agg(F.sum("test_count")).scalar()
    return counts.withColumns(
        {
            "train_percentage": safe_ratio(F.col("train_count"), train_total) * 100,
            "test_percentage": safe_ratio(F.col("test_count"), test_total) * 100,
        }
    )


def attack_distribution(
    train: DataFrame, test: DataFrame, weight: str | None = None
) -> DataFrame:
    """The distribution report: counts, coverage flags, shares; most frequent in test first."""
    report = joined_counts(train, test, weight).transform(with_coverage).transform(with_percentages)
    return numbered(report, F.desc("test_count"), F.asc("label"))


def coverage_summary(counts: DataFrame) -> DataFrame:
    """Number of types in total, shared, and on one side only."""
    in_train, in_test = F.col("train_count") > 0, F.col("test_count") > 0
    return counts.agg(
        F.count(F.lit(1)).alias("total_types"),
        F.count_if(in_train & in_test).alias("shared_types"),
        F.count_if(~in_train & in_test).alias("test_only_types"),
        F.count_if(in_train & ~in_test).alias("train_only_types"),
    )


def type_listing(train: DataFrame, test: DataFrame) -> DataFrame:
    """Name and count of every member of the train, test, test-only and train-only sets."""
    in_train, in_test = F.col("train_count") > 0, F.col("test_count") > 0

    def entry(name: str, member, samples: str):
        return F.when(member, F.struct(F.lit(name).alias("listing"), F.col(samples).alias("samples")))

    entries = F.array_compact(
        F.array(
            entry("train", in_train, "train_count"),
            entry("test", in_test, "test_count"),
            entry("test_only", in_test & ~in_train, "test_count"),
            entry("train_only", in_train & ~in_test, "train_count"),
        )
    )
    members = joined_counts(train, test).select("label", F.inline(entries))
    return numbered(members.select("listing", "label", "samples"), "listing", "label")


def tag_group(
    by_label: DataFrame,
    train_types: DataFrame,
    shared: str = "shared",
    unseen: str = "test_only",
    label: str = "label",
) -> DataFrame:
    """Add ``group``: whether each label occurs among the training attack types."""
    known = train_types.select(F.col("label").alias("__known")).distinct()
    return (
        by_label.join(known, F.col(label) == F.col("__known"), "left")
        .withColumn("group", F.when(F.col("__known").isNotNull(), shared).otherwise(unseen))
        .drop("__known")
    )
