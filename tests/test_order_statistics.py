"""Exact ranks and cuts against brute force, with one group and one value far larger than others."""

import hashlib
import random
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.ml.sampling import stratified_flag, stratified_split
from flowsieve.operators import profile
from flowsieve.operators.order_statistics import _digits, exact_quantiles, feature_quantiles, with_order_code


@pytest.fixture(scope="module")
def skewed(spark):
    draw = random.Random(3)
    rows = [("hot", draw.choice([0.0, 0.0, draw.gauss(0, 1e6), draw.random()])) for _ in range(4000)]
    rows += [("even", float(v)) for v in (4, 1, 3, 2)]
    rows += [("one", -7.5), ("gaps", 1.0), ("gaps", None), ("gaps", float("nan")), ("gaps", 2.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(6).persist()
    values = {}
    for g, v in rows:
        if v is not None and v == v:
            values.setdefault(g, []).append(v)
    return frame, values


def test_quantiles_equal_brute_force(skewed):
    frame, values = skewed
    wanted = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q9": 0.9, "highest": 1.0}
    got = {r["g"]: r for r in exact_quantiles(frame, ["g"], "v", wanted).collect()}
    assert set(got) == set(values)
    for g, members in values.items():
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(float(np.quantile(members, p)), rel=1e-12)
        assert got[g]["median"] == pytest.approx(statistics.median(members), rel=1e-12)


def test_fixed_groups_give_the_same(skewed):
    frame, _ = skewed
    plain = exact_quantiles(frame, ["g"], "v", {"m": 0.3}).orderBy("g").collect()
    fixed = exact_quantiles(frame, ["g"], "v", {"m": 0.3}, fixed_groups=True)
    assert fixed.orderBy("g").collect() == plain


def test_split_is_exact_seeded_and_independent_of_partitions(spark):
    rows = [(f"id{i}", int(i % 10 < 3)) for i in range(5003)]
    frame = spark.createDataFrame(rows, "flow_id string, target int")
    chosen = {
        r["flow_id"]
        for r in stratified_flag(frame.repartition(9), seed=5).filter("is_validation").collect()
    }
    expected = set()
    for label in (0, 1):
        ids = [i for i, t in rows if t == label]
        ids.sort(key=lambda i: hashlib.md5(f"5|{i}".encode()).hexdigest())
        expected.update(ids[: int(len(ids) * 0.2 + 0.5)])
    assert chosen == expected
    training, validation = stratified_split(frame, seed=5)
    assert validation.count() == len(expected)
    assert training.count() + validation.count() == len(rows)


def test_split_of_a_tiny_class_keeps_every_row(spark):
    frame = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1)], "flow_id string, target int")
    flags = stratified_flag(frame)
    assert flags.count() == 3 and flags.filter("is_validation").count() == 0


def test_summary_of_one_row_has_no_deviation(spark):
    frame = spark.createDataFrame([("x", "train", 2.0)], "label string, split string, duration double")
    row = profile.feature_summary(frame, ["duration"]).first()
    assert (row["mean"], row["std"], row["min"], row["median"], row["max"]) == (2.0, None, 2.0, 2.0, 2.0)


def test_feature_summary_of_varying_and_constant_features(spark):
    nan = float("nan")
    rows = [
        ("a", 1.0, 7.0, nan, None), ("a", 2.0, 7.0, nan, None), ("a", 9.0, None, nan, None),
        ("b", 4.0, 7.0, 3.0, None), ("b", None, 7.0, nan, None), (None, 5.0, 8.0, 1.0, None), (None, 6.0, 8.0, 2.0, None),
    ]
    frame = spark.createDataFrame(rows, "label string, v double, c double, n double, z double")
    got = {
        (r["label"], r["feature"]): r["median"]
        for r in profile.feature_summary(frame, ["v", "c", "n", "z"], ("label",)).collect()
    }
    assert got == {
        ("a", "v"): 2.0, ("a", "c"): 7.0, ("a", "n"): None, ("a", "z"): None,
        ("b", "v"): 4.0, ("b", "c"): 7.0, ("b", "n"): 3.0, ("b", "z"): None,
        (None, "v"): 5.5, (None, "c"): 8.0, (None, "n"): 1.5, (None, "z"): None,
    }
    constant = profile.feature_summary(frame.filter("label = 'a'"), ["c", "z"], ("label",))
    assert {(r["feature"], r["median"]) for r in constant.collect()} == {("c", 7.0), ("z", None)}


def test_histogram_matches_numpy(spark):
    draw = random.Random(1)
    rows = [("normal", draw.gauss(0, 1)) for _ in range(500)] + [("a", 5.0)] * 7
    frame = spark.createDataFrame(rows, "label string, v double")
    got = {(r["label"], r["bin"]): r["samples"] for r in profile.histogram(frame, "a", ["v"]).collect()}
    for label in ("normal", "a"):
        heights, _ = np.histogram([v for g, v in rows if g == label], bins=50)
        for number, height in enumerate(heights):
            assert got.get((label, number), 0) == height


def test_box_whiskers(spark):
    rows = [("normal", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("a", 1.0)]
    frame = spark.createDataFrame(rows, "label string, v double")
    got = {r["label"]: r for r in profile.box_statistics(frame, "a", ["v"]).collect()}
    assert (got["normal"]["whisker_low"], got["normal"]["whisker_high"]) == (1.0, 5.0)
    assert got["normal"]["median"] == 3.5 and got["a"]["whisker_high"] == 1.0


def test_values_are_counted_and_neither_ordered_nor_gathered(spark, skewed):
    """Only counts of digits are shuffled: no value is a grouping, ordering or partitioning key."""
    frame, _ = skewed
    values = with_order_code(profile.long_features(frame, ["v"], ["g"]))
    counted = _digits(values.withColumn("digit", F.shiftright("code", 48)), ["g", "feature"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan
    assert re.search(r"partial_count", plan) and "percentile" not in plan and "collect_list" not in plan
    assert all("value" not in keys for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan))


def test_codes_have_the_order_of_doubles(spark):
    draw = np.random.default_rng(11)
    bits = draw.integers(0, 2**63, 20_000, dtype=np.int64)
    values = bits.view(np.float64)
    values = values[np.isfinite(values)].tolist()
    powers = [2.0**k for k in range(-1074, 1024)]
    near = [np.nextafter(p, 0.0) for p in powers] + [np.nextafter(p, np.inf) for p in powers[:-1]]
    values += powers + [float(v) for v in near] + [0.0, float("inf"), 5e-324, 2.2250738585072014e-308, 0.1, 0.2, 0.3]
    values += [-v for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for v, code in with_order_code(frame, "v").select("v", "code").collect():
        own = int(np.abs(np.float64(v)).view(np.int64))
        assert code == (-own if v < 0 else own)


def test_one_group_of_a_million_distinct_values(spark):
    n = 1_000_000
    frame = spark.range(n).select(
        F.lit(None).cast("string").alias("g"),
        (F.pmod(F.col("id") * 7919, F.lit(n)).cast("double") / 1024 - 300).alias("v"),
        F.lit(2.5).alias("w"),
    )
    got = {r["feature"]: r for r in feature_quantiles(frame, ["g"], ["v", "w"], {"m": 0.5, "q": 0.999}).collect()}
    assert set(got) == {"v", "w"} and got["v"]["g"] is None
    assert got["v"]["m"] == (n - 1) / 2 / 1024 - 300 and got["w"]["q"] == 2.5
    assert got["v"]["q"] == pytest.approx((n - 1) * 0.999 / 1024 - 300, rel=1e-12)


def test_quantiles_of_nothing(spark):
    frame = spark.createDataFrame([("a", None), ("b", float("nan"))], "g string, v double")
    assert feature_quantiles(frame, ["g"], ["v"], {"m": 0.5}).count() == 0
