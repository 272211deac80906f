"""Exact order statistics of groups of any size.

A group may hold most of a very large table, so its values are never gathered in one task, sorted or
shuffled. Quantiles are found by radix selection: a value's order is that of a 64-bit number, and each
round counts the values of every open bracket by 16 bits of it, from the highest in which the bracket's
values differ. Counting is one aggregate with partial combination, so what is shuffled are counts; the
values of the digit that holds a wanted rank become the next round's bracket, until they are the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.session import scratch_path

DIGIT_BITS = 16
_MANTISSA = 52


def long_values(df: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """One row per (row, feature): the keys, ``feature`` and ``value``."""
    pairs = [
        F.struct(F.lit(name).alias("feature"), F.col(f"`{name}`").cast("double").alias("value"))
        for name in features
    ]
    return df.select(*keys, F.inline(F.array(*pairs)))


def with_order_code(rows: DataFrame, value: str = "value") -> DataFrame:
    """Rows with ``code``, a signed 64-bit number with the order of the double column ``value``:
    exponent and mantissa of its magnitude, as the double's own bits hold them, with its sign. Zeros
    are one value, and nulls have its code; NaN has none.

    Steps that are used more than once are columns of their own, so that each is computed once a row.
    """
    size, power, exponent = F.abs(value), F.col("_power"), F.col("_exponent")
    # The logarithm may be off by one next to a power of two, which the comparisons mend.
    mended = F.col("_guess") - F.when(power > size, 1).when(size >= power * 2, -1).otherwise(0)
    unit = F.when(exponent == F.col("_guess"), power).otherwise(F.pow(F.lit(2.0), exponent))
    fraction = size / unit - 1
    normal = (exponent + 1023) * F.lit(1 << _MANTISSA) + (fraction * float(1 << _MANTISSA)).cast("bigint")
    code = (
        F.when(size == 0, F.lit(0).cast("bigint"))
        .when(size == float("inf"), F.lit(2047 << _MANTISSA))
        # Below the normal range a double is a whole multiple of 2^-1074.
        .when(size < 2.0**-1022, (size * 2.0**537 * 2.0**537).cast("bigint"))
        .otherwise(normal)
    )
    staged = (
        rows.withColumn("_guess", F.least(F.floor(F.log2(size)), F.lit(1023)))
        .withColumn("_power", F.pow(F.lit(2.0), F.col("_guess")))
        .withColumn("_exponent", mended)
        .withColumn("_code", code)
    )
    signed = F.when(F.col(value) < 0, -F.col("_code")).otherwise(F.col("_code"))
    # Never null, or joins would test all of the above for null below the steps, without their sharing.
    return staged.withColumn("code", F.coalesce(signed, F.lit(0).cast("bigint"))).drop("_guess", "_power", "_exponent", "_code")


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _located(counted: DataFrame, groups: list[str], ranks: DataFrame | None, ends: Column | None) -> DataFrame:
    """The digit that holds each wanted rank: groups, ``rank_name``, ``rank`` within it and its bracket,
    from ``low`` (in order ``base``) to ``high`` (``top``).

    ``counted`` has at most 2^16 digits a group, so the windows are small whatever the data.
    """
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
    if ranks is None:
        wanted = placed.withColumn("total", F.sum("n").over(whole)).select("*", F.inline(ends))
    else:
        asked = ranks.select(*[F.col(c).alias(f"_{c}") for c in groups], "rank_name", "rank")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups])
        wanted = placed.join(asked, same).drop(*[f"_{c}" for c in groups])
    inside = (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("n"))
    kept = [c for c in groups if c != "base"]
    extra = ["total"] if ranks is None else []
    found = wanted.filter(inside).select(
        *kept, "rank_name", (F.col("rank") - F.col("below")).alias("rank"), "low", "high", *extra
    )
    lows = with_order_code(found, "low").withColumnRenamed("code", "base")
    return with_order_code(lows, "high").withColumnRenamed("code", "top")


def _digits(values: DataFrame, groups: list[str]) -> DataFrame:
    return values.groupBy(*groups, "digit").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def kept_rows(frame: DataFrame, name: str) -> DataFrame:
    """A small table, a row per group or wanted rank, written to the shared folder: what is above it is
    not computed again."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def feature_quantiles(
    df: DataFrame,
    keys: list[str],
    features: list[str],
    probabilities: dict[str, float],
    fixed_groups: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles per group and feature, one column per named probability.

    Four rounds at most, fewer where values agree in their highest bits, each one pass over the features
    that still have an open bracket. Nulls and
    NaN are left out, and a feature of a group without other values has no row. With
    ``fixed_groups`` the caller vouches that the number of groups is set by its arguments and not by
    the data, so the open brackets (a row per group, feature and rank) may be broadcast; otherwise
    adaptive execution decides by their measured size.
    """
    groups = [*keys, "feature"]

    def coded(names: list[str]) -> DataFrame:
        rows = long_values(df, names, keys).filter(F.col("value").isNotNull() & ~F.isnan("value"))
        return with_order_code(rows)

    ends = []
    for name, probability in probabilities.items():
        position = (F.col("total") - 1) * F.lit(float(probability))
        for end, function in (("lo", F.floor), ("hi", F.ceil)):
            ends.append(F.struct(F.lit(f"{name}.{end}").alias("rank_name"), (function(position) + 1).alias("rank")))
    first = F.shiftright("code", 64 - DIGIT_BITS)
    found = kept_rows(_located(_digits(coded(features).withColumn("digit", first), groups), groups, None, F.array(*ends)), "digits")
    totals = found.select(*groups, "total").distinct()
    done, open_ = [found.filter("low = high").drop("total")], found.filter("low < high").drop("total")
    while names := open_.agg(F.collect_set("feature").alias("names")).first()["names"]:
        # The highest of the bits in which the codes of a bracket differ, and the 15 below it. A bracket
        # of the first round spans less than 2^48, so three more rounds settle any.
        lower = F.greatest(F.floor(F.log2(F.col("top") - F.col("base"))) - (DIGIT_BITS - 1), F.lit(0)).cast("int")
        brackets = open_.select(
            *[F.col(c).alias(f"_{c}") for c in groups], "base", "top", lower.alias("_lower"),
            F.shiftright("base", 64 - DIGIT_BITS).alias("_prefix"),
        ).distinct()
        brackets = F.broadcast(brackets) if fixed_groups else brackets
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups])
        within = (first == F.col("_prefix")) & F.col("code").between(F.col("base"), F.col("top"))
        inside = coded(names).join(brackets, same & within)
        digit = F.call_function("shiftright", F.col("code") - F.col("base"), F.col("_lower"))
        counted = _digits(inside.withColumn("digit", digit), [*groups, "base"])
        found = kept_rows(_located(counted, [*groups, "base"], open_, None), "digits")
        done.append(found.filter("low = high"))
        open_ = found.filter("low < high")
    located = reduce(DataFrame.unionByName, done)

    def at(rank_name: str) -> Column:
        return F.max(F.when(F.col("rank_name") == rank_name, F.col("low")))

    columns = []
    for name in probabilities:
        columns += [at(f"{name}.lo").alias(f"{name}_lo"), at(f"{name}.hi").alias(f"{name}_hi")]
    table = located.groupBy(*groups).agg(*columns)
    sizes = totals.select(*[F.col(c).alias(f"_{c}") for c in groups], "total")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups])
    results = []
    for name, probability in probabilities.items():
        position = (F.col("total") - 1) * F.lit(float(probability))
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        results.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return table.join(sizes, same).select(*groups, *results)


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    fixed_groups: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles of one column per group, one column per named probability."""
    return feature_quantiles(df, keys, [value], probabilities, fixed_groups).drop("feature")


def lowest_key_cut(df: DataFrame, by: str, key: str, quota) -> DataFrame:
    """The key of the last of the lowest ``quota`` rows of each group.

    ``key`` is a unique hexadecimal digest, so its first four digits split every group into
    65,536 even slices; only the slice holding the cut is ranked. ``quota`` is a column over the
    group size ``n``. Groups with a quota below one have no row.
    """
    sliced = df.select(by, key, F.substring(key, 1, 4).alias("slice"))
    whole = Window.partitionBy(by)
    before = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cut_slice = (
        sliced.groupBy(by, "slice")
        .agg(F.count(F.lit(1)).alias("inside"))
        .withColumn("below", F.coalesce(F.sum("inside").over(before), F.lit(0)))
        .withColumn("n", F.sum("inside").over(whole))
        .withColumn("quota", quota)
        .filter((F.col("quota") > F.col("below")) & (F.col("quota") <= F.col("below") + F.col("inside")))
        .select(by, "slice", (F.col("quota") - F.col("below")).alias("position"))
    )
    ordered = Window.partitionBy(by).orderBy(key)
    return (
        sliced.join(F.broadcast(cut_slice), [by, "slice"])
        .withColumn("place", F.row_number().over(ordered))
        .filter(F.col("place") == F.col("position"))
        .select(by, F.col(key).alias("cut_key"))
    )
