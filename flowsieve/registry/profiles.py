"""Queries over counts, coverage and numeric profiles."""

from pyspark.sql import functions as F

from flowsieve.operators import counts, coverage, profile, ranking
from flowsieve.registry.core import (
    only,
    over_flows,
    query,
    ratio,
    test_decisions,
    test_flows,
    train_flows,
)
from flowsieve.schema import FEATURES, NUMERIC
from flowsieve.sources.tables import flows

ATTACK = "brand#22"
ATTACKS = ["brand#22", "brand#33", "brand#44"]
MEASURED = ["duration", "src_bytes", "dst_bytes", "count", "serror_rate", "same_srv_rate"]


def _counts_sql(column: str, table: str) -> str:
    return over_flows(f"SELECT {column}, count(*) AS samples FROM {table} GROUP BY {column}")


@query(_counts_sql("label", "train"))
def label_counts(spark, sf_dir):
    return counts.value_counts(train_flows(spark, sf_dir), "label")


@query(_counts_sql("target", "train"))
def target_counts(spark, sf_dir):
    return counts.value_counts(train_flows(spark, sf_dir), "target")


@query(_counts_sql("protocol_type", "train"))
def protocol_counts(spark, sf_dir):
    return counts.value_counts(train_flows(spark, sf_dir), "protocol_type")


@query(_counts_sql("flag", "train"))
def flag_counts(spark, sf_dir):
    return counts.value_counts(train_flows(spark, sf_dir), "flag")


@query(_counts_sql("decision", "decided"))
def decision_counts(spark, sf_dir):
    return counts.value_counts(test_decisions(spark, sf_dir), "decision")


@query(
    over_flows(
        """SELECT label, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM train) * 100, 2)
  AS percentage
FROM train GROUP BY label"""
    )
)
def label_shares(spark, sf_dir):
    return counts.value_shares(train_flows(spark, sf_dir), "label")


@query(
    over_flows(
        """SELECT count(DISTINCT label) AS distinct_label, count(DISTINCT service)
  AS distinct_service FROM train"""
    )
)
def distinct_value_counts(spark, sf_dir):
    return counts.distinct_counts(train_flows(spark, sf_dir), ["label", "service"])


def _with_gaps(frame):
    """The flows with some services and byte counts missing."""
    return frame.withColumns(
        {
            "service": F.when(F.col("count") <= 45, F.col("service")),
            "src_bytes": F.when(F.col("src_bytes") >= 2000, F.col("src_bytes")),
        }
    )


_MISSING = """CAST(count(*) FILTER (WHERE "count" > 45)
    + count(*) FILTER (WHERE src_bytes < 2000) AS BIGINT) AS missing_values"""


@query(over_flows(f"SELECT {_MISSING} FROM train"))
def total_null_count(spark, sf_dir):
    return counts.null_count(_with_gaps(train_flows(spark, sf_dir)), [*FEATURES, "label"])


@query(
    over_flows(
        f"""SELECT count(*) AS row_count, CAST(43 AS BIGINT) AS column_count, {_MISSING},
  count(*) FILTER (WHERE target = 0) AS target_normal,
  count(*) FILTER (WHERE target = 1) AS target_attack
FROM train"""
    )
)
def quality_table(spark, sf_dir):
    gaps = _with_gaps(train_flows(spark, sf_dir))
    return counts.quality_table(only(gaps, *FEATURES, "label", "target"))


@query(
    over_flows(
        """SELECT count(*) FILTER (WHERE label = 'normal') AS normal_count,
  count(*) FILTER (WHERE label <> 'normal') AS attack_count FROM train"""
    )
)
def normal_attack_counts(spark, sf_dir):
    return counts.normal_attack_counts(train_flows(spark, sf_dir))


@query(
    over_flows(
        """SELECT a.label, count(*) FILTER (WHERE split = 'train') AS train_count,
  count(*) FILTER (WHERE split = 'test') AS test_count
FROM (VALUES ('brand#22'), ('brand#15'), ('brand#11'), ('brand#99')) a(label)
LEFT JOIN flows f ON a.label = f.label GROUP BY a.label"""
    )
)
def listed_label_counts(spark, sf_dir):
    return counts.listed_label_counts(
        train_flows(spark, sf_dir),
        test_flows(spark, sf_dir),
        ["brand#22", "brand#15", "brand#11", "brand#99"],
    )


_TYPES = """types AS (
  SELECT label, count(*) FILTER (WHERE split = 'train') AS train_count,
    count(*) FILTER (WHERE split = 'test') AS test_count
  FROM flows WHERE label <> 'normal' GROUP BY label
)"""


@query(over_flows("SELECT * FROM types", _TYPES))
def attack_count_join(spark, sf_dir):
    return coverage.joined_counts(train_flows(spark, sf_dir), test_flows(spark, sf_dir))


@query(
    over_flows(
        f"""SELECT label, train_count, test_count, train_count > 0 AS seen_in_training,
  train_count = 0 AND test_count > 0 AS test_only,
  {ratio("train_count", "(SELECT sum(train_count) FROM types)")} * 100 AS train_percentage,
  {ratio("test_count", "(SELECT sum(test_count) FROM types)")} * 100 AS test_percentage,
  CAST(row_number() OVER (ORDER BY test_count DESC, label) AS INTEGER) AS place
FROM types""",
        _TYPES,
    )
)
def attack_distribution(spark, sf_dir):
    return coverage.attack_distribution(train_flows(spark, sf_dir), test_flows(spark, sf_dir))


@query(
    over_flows(
        """SELECT count(*) AS total_types,
  count(*) FILTER (WHERE train_count > 0 AND test_count > 0) AS shared_types,
  count(*) FILTER (WHERE train_count = 0 AND test_count > 0) AS test_only_types,
  count(*) FILTER (WHERE train_count > 0 AND test_count = 0) AS train_only_types
FROM types""",
        _TYPES,
    )
)
def coverage_summary(spark, sf_dir):
    return coverage.coverage_summary(
        coverage.joined_counts(train_flows(spark, sf_dir), test_flows(spark, sf_dir))
    )


@query(over_flows("SELECT DISTINCT label FROM train WHERE target = 1"))
def attack_type_set(spark, sf_dir):
    return coverage.attack_types(train_flows(spark, sf_dir))


@query(over_flows("SELECT label FROM types WHERE train_count > 0 AND test_count > 0", _TYPES))
def shared_type_set(spark, sf_dir):
    return coverage.shared_types(train_flows(spark, sf_dir), test_flows(spark, sf_dir))


@query(over_flows("SELECT label FROM types WHERE train_count = 0 AND test_count > 0", _TYPES))
def test_only_type_set(spark, sf_dir):
    return coverage.test_only_types(train_flows(spark, sf_dir), test_flows(spark, sf_dir))


@query(over_flows("SELECT label FROM types WHERE train_count > 0 AND test_count = 0", _TYPES))
def train_only_type_set(spark, sf_dir):
    return coverage.train_only_types(train_flows(spark, sf_dir), test_flows(spark, sf_dir))


@query(
    over_flows(
        """SELECT label, CASE WHEN train_count > 0 THEN 'shared' ELSE 'test_only' END AS "group"
FROM types WHERE test_count > 0""",
        _TYPES,
    )
)
def type_groups(spark, sf_dir):
    return coverage.tag_group(
        coverage.attack_types(test_flows(spark, sf_dir)),
        coverage.attack_types(train_flows(spark, sf_dir)),
    )


@query(
    over_flows(
        """SELECT *, CAST(row_number() OVER (ORDER BY listing, label) AS INTEGER) AS place FROM (
SELECT 'train' AS listing, label, train_count AS samples FROM types
  WHERE train_count > 0
UNION ALL SELECT 'test', label, test_count FROM types WHERE test_count > 0
UNION ALL SELECT 'test_only', label, test_count FROM types
  WHERE test_count > 0 AND train_count = 0
UNION ALL SELECT 'train_only', label, train_count FROM types
  WHERE train_count > 0 AND test_count = 0)""",
        _TYPES,
    )
)
def type_listing(spark, sf_dir):
    return coverage.type_listing(train_flows(spark, sf_dir), test_flows(spark, sf_dir))


@query(
    over_flows(
        """SELECT flow_id, label FROM test
WHERE target = 1 AND label IN (SELECT label FROM types WHERE train_count > 0)""",
        _TYPES,
    )
)
def shared_attack_rows(spark, sf_dir):
    train, test = train_flows(spark, sf_dir), test_flows(spark, sf_dir)
    rows = only(test, "flow_id", "label", "target")
    return only(
        coverage.rows_of_types(rows, coverage.shared_types(train, test)), "flow_id", "label"
    )


def _long_sql(features: list[str], keys: str, table: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {keys}, '{name}' AS feature, CAST(\"{name}\" AS DOUBLE) AS value FROM {table}"
        for name in features
    )


@query(
    over_flows(
        """SELECT label, split, feature, round(avg(value), 3) AS mean,
  round(stddev_samp(value), 3) AS std, round(min(value), 3) AS "min",
  round(median(value), 3) AS median, round(max(value), 3) AS "max"
FROM long GROUP BY label, split, feature""",
        f"long AS ({_long_sql(NUMERIC, 'label, split', 'flows')})",
    )
)
def feature_summary(spark, sf_dir):
    return profile.feature_summary(flows(spark, sf_dir))


_MEANS = f"""long AS ({_long_sql(NUMERIC, "label", "train")}),
means AS (SELECT label, feature, avg(value) AS mean FROM long GROUP BY label, feature),
differences AS (
  SELECT a.label, a.feature, n.mean AS normal_mean, a.mean AS attack_mean,
    a.mean - n.mean AS difference, abs(a.mean - n.mean) AS abs_difference
  FROM means a JOIN means n ON a.feature = n.feature AND n.label = 'normal'
  WHERE a.label IN ('brand#22', 'brand#33', 'brand#44')
)"""
_DIFFERENCE_COLUMNS = ("normal_mean", "attack_mean", "difference", "abs_difference")


def _rounded(frame, columns, digits):
    return frame.withColumns({c: F.round(c, digits) for c in columns})


@query(
    over_flows(
        "SELECT label, feature, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in _DIFFERENCE_COLUMNS)
        + " FROM differences",
        _MEANS,
    )
)
def mean_differences(spark, sf_dir):
    table = profile.mean_differences(train_flows(spark, sf_dir), ATTACKS)
    return _rounded(table, _DIFFERENCE_COLUMNS, 6)


@query(
    over_flows(
        "SELECT label, feature, "
        + ", ".join(f"round({c}, 3) AS {c}" for c in _DIFFERENCE_COLUMNS)
        + """, CAST(row_number() OVER (ORDER BY abs_difference DESC, feature) AS INTEGER) AS place
FROM differences WHERE label = 'brand#22' QUALIFY place <= 10""",
        _MEANS,
    )
)
def largest_mean_differences(spark, sf_dir):
    table = profile.mean_differences(train_flows(spark, sf_dir), [ATTACK])
    return _rounded(ranking.largest_differences(table), _DIFFERENCE_COLUMNS, 3)


@query(
    over_flows(
        """SELECT label, feature, round(avg(value), 6) AS mean, round(median(value), 6) AS median
FROM long WHERE label IN ('normal', 'brand#22') GROUP BY label, feature""",
        f"long AS ({_long_sql(MEASURED, 'label', 'train')})",
    )
)
def normal_versus_attack(spark, sf_dir):
    table = profile.normal_versus_attack(train_flows(spark, sf_dir), ATTACK, MEASURED)
    return _rounded(table, ("mean", "median"), 6)


@query(
    over_flows(
        """SELECT split, feature, round(avg(value), 6) AS mean, round(median(value), 6) AS median
FROM long WHERE label = 'brand#22' GROUP BY split, feature""",
        f"long AS ({_long_sql(MEASURED, 'label, split', 'flows')})",
    )
)
def feature_shift(spark, sf_dir):
    table = profile.feature_shift(
        train_flows(spark, sf_dir), test_flows(spark, sf_dir), ATTACK, MEASURED
    )
    return _rounded(table, ("mean", "median"), 6)


@query(
    over_flows(
        """SELECT label, feature, round(q1, 6) AS q1, round(median, 6) AS median,
  round(q3, 6) AS q3,
  round(least(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)), q1), 6) AS whisker_low,
  round(greatest(max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)), q3), 6)
    AS whisker_high
FROM long JOIN boxes USING (label, feature) GROUP BY label, feature, q1, median, q3""",
        f"long AS ({_long_sql(MEASURED, 'label', 'train')})",
        """boxes AS (
  SELECT label, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS q3
  FROM long WHERE label IN ('normal', 'brand#22') GROUP BY label, feature
)""",
    )
)
def box_statistics(spark, sf_dir):
    table = profile.box_statistics(train_flows(spark, sf_dir), ATTACK, MEASURED)
    return _rounded(table, ("q1", "median", "q3", "whisker_low", "whisker_high"), 6)


@query(
    over_flows(
        """SELECT label, feature, CAST(bin AS INTEGER) AS bin, coalesce(samples, 0) AS samples,
  round(low + (high - low) * bin / 50, 6) AS bin_low,
  round(low + (high - low) * (bin + 1) / 50, 6) AS bin_high
FROM ends CROSS JOIN (SELECT unnest(range(50)) AS bin) LEFT JOIN (
  SELECT label, feature, least(floor((value - low) / (high - low) * 50), 49) AS bin,
    count(*) AS samples
  FROM long JOIN ends USING (label, feature) GROUP BY ALL
) USING (label, feature, bin)""",
        f"long AS ({_long_sql(MEASURED, 'label', 'test')})",
        """ends AS (
  SELECT label, feature,
    CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS low,
    CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS high
  FROM long WHERE label IN ('normal', 'brand#22') GROUP BY label, feature
)""",
    )
)
def feature_histograms(spark, sf_dir):
    bins = profile.histogram(test_flows(spark, sf_dir), ATTACK, MEASURED)
    return _rounded(bins, ("bin_low", "bin_high"), 6)


@query(
    over_flows(
        """SELECT min(if_score) AS min_score, max(if_score) AS max_score,
  round(avg(if_score), 6) AS mean_score, round(median(if_score), 6) AS median_score FROM test"""
    )
)
def score_statistics(spark, sf_dir):
    table = profile.score_statistics(test_flows(spark, sf_dir))
    return _rounded(table, ("mean_score", "median_score"), 6)
