"""Numeric feature profiles: summaries, shifts, box-plot statistics and histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.operators.order_statistics import exact_quantiles, feature_quantiles, kept_rows
from flowsieve.operators.order_statistics import long_values as long_features
from flowsieve.schema import NORMAL_LABEL, NUMERIC


def _moments(df: DataFrame, features: list[str], keys: list[str], parts: dict) -> DataFrame:
    """Per-column aggregates in one scan, turned into one row per (group, feature) afterwards."""
    wide = df.groupBy(*keys).agg(
        *[
            function(F.col(name).cast("double")).alias(f"{name}|{part}")
            for name in features
            for part, function in parts.items()
        ]
    )
    rows = [
        F.struct(
            F.lit(name).alias("feature"),
            *[F.col(f"`{name}|{part}`").alias(part) for part in parts],
        )
        for name in features
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def feature_summary(
    df: DataFrame, features: list[str] = NUMERIC, keys: tuple = ("label", "split"), digits: int = 3
) -> DataFrame:
    """Mean, sample deviation, minimum, median and maximum per group and feature."""
    keys = list(keys)
    parts = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    # One row per group and feature, stored because it is also asked which features vary: the others
    # have their one value as median and need not be unpivoted and counted.
    moments = kept_rows(_moments(df, features, keys, parts), "moments")
    # As many names at most as are asked for. NaN sorts above all numbers.
    varying = {r["feature"] for r in moments.filter("min < max").select("feature").distinct().collect()}
    alone = F.when((F.col("min") == F.col("max")) & ~F.isnan("min"), F.col("min"))
    if varying:
        medians = feature_quantiles(df, keys, [f for f in features if f in varying], {"median": 0.5})
        named = medians.select(*[F.col(c).alias(f"_{c}") for c in (*keys, "feature")], "median")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "feature")])
        joined = moments.join(named, same, "left").withColumn("median", F.coalesce("median", alone))
    else:
        joined = moments.withColumn("median", alone)
    return joined.select(
        *keys,
        "feature",
        *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "median", "max")],
    )


def mean_differences(
    df: DataFrame, attacks: list[str], features: list[str] = NUMERIC
) -> DataFrame:
    """Feature means of normal rows and of each listed attack, with their differences."""
    means = _moments(
        df.filter(F.col("label").isin(NORMAL_LABEL, *attacks)), features, ["label"], {"mean": F.avg}
    )
    normal = means.filter(F.col("label") == NORMAL_LABEL).select(
        "feature", F.col("mean").alias("normal_mean")
    )
    attack = means.filter(F.col("label") != NORMAL_LABEL).select(
        "label", "feature", F.col("mean").alias("attack_mean")
    )
    return (
        attack.join(normal, "feature")
        .withColumn("difference", F.col("attack_mean") - F.col("normal_mean"))
        .withColumn("abs_difference", F.abs("difference"))
    )


def _mean_and_median(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    means = _moments(df, features, [key], {"mean": F.avg})
    medians = feature_quantiles(df, [key], features, {"median": 0.5}, fixed_groups=True)
    return means.join(medians, [key, "feature"], "left").select(key, "feature", "mean", "median")


def normal_versus_attack(df: DataFrame, attack: str, features: list[str]) -> DataFrame:
    """Mean and median per feature of normal rows and of one attack type."""
    chosen = df.filter(F.col("label").isin(NORMAL_LABEL, attack))
    return _mean_and_median(chosen, "label", features)


def feature_shift(
    train: DataFrame, test: DataFrame, attack: str, features: list[str]
) -> DataFrame:
    """Mean and median per feature of one attack type in training and in test data."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("label") == attack).select(
            F.lit(name).alias("split"), *features
        )

    return _mean_and_median(side(train, "train").unionByName(side(test, "test")), "split", features)


def box_statistics(df: DataFrame, attack: str, features: list[str]) -> DataFrame:
    """Quartiles and whiskers (the extreme values within 1.5 interquartile ranges) of normal rows
    and of one attack type."""
    chosen = df.filter(F.col("label").isin(NORMAL_LABEL, attack))
    keys = ["label", "feature"]
    boxes = feature_quantiles(
        chosen, ["label"], features, {"q1": 0.25, "median": 0.5, "q3": 0.75}, fixed_groups=True
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    value = F.col("value")
    # Two populations times the listed features: a fixed, known number of rows.
    return (
        long_features(chosen, features, ["label"])
        .filter(value.isNotNull() & ~F.isnan(value))
        .join(F.broadcast(boxes), keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(value >= F.col("q1") - reach, value)).alias("low"),
            F.max(F.when(value <= F.col("q3") + reach, value)).alias("high"),
        )
        .select(
            *keys,
            "q1",
            "median",
            "q3",
            F.least("low", "q1").alias("whisker_low"),
            F.greatest("high", "q3").alias("whisker_high"),
        )
    )


def histogram(df: DataFrame, attack: str, features: list[str], bins: int = 50) -> DataFrame:
    """Equal-width histogram of normal rows and of one attack type, each over its own range.

    The last bin includes the maximum; a population with a single value gets a range of width one
    around it. Every bin has a row with its edges, empty ones too; a feature without any value has
    none.
    """
    chosen = df.filter(F.col("label").isin(NORMAL_LABEL, attack))
    keys = ["label", "feature"]
    ends = _moments(chosen, features, ["label"], {"low": F.min, "high": F.max})
    single = F.col("low") == F.col("high")
    ends = ends.select(
        *keys,
        F.when(single, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(single, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    position = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    # Two populations times the listed features: a fixed, known number of rows.
    counted = (
        long_features(chosen, features, ["label"])
        .filter(F.col("value").isNotNull())
        .join(F.broadcast(ends), keys)
        .groupBy(*keys, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("samples"))
    )
    every = ends.filter("low IS NOT NULL").withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    )
    edge = lambda k: F.col("low") + (F.col("high") - F.col("low")) * k / bins
    return every.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        edge(F.col("bin")).alias("bin_low"),
        edge(F.col("bin") + 1).alias("bin_high"),
        F.coalesce("samples", F.lit(0).cast("bigint")).alias("samples"),
    )


def score_statistics(df: DataFrame, score: str = "if_score") -> DataFrame:
    """Minimum, maximum, mean and exact median of a score, in one row."""
    scored = df.select(F.lit("all").alias("population"), F.col(score).alias("value"))
    median = exact_quantiles(scored, ["population"], "value", {"median_score": 0.5}, True)
    spread = scored.groupBy("population").agg(
        F.min("value").alias("min_score"),
        F.max("value").alias("max_score"),
        F.avg("value").alias("mean_score"),
    )
    return spread.join(median, "population").select(
        "min_score", "max_score", "mean_score", "median_score"
    )
