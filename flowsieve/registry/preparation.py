"""Queries over record files, preparation and row-level filters."""

from pyspark.sql import functions as F

from flowsieve.functions import checks
from flowsieve.functions.decisions import with_decision
from flowsieve.operators import evaluation, prepare
from flowsieve.registry.core import (
    FEATURE_LIST,
    cells,
    decided,
    only,
    over_flows,
    query,
    test_decisions,
    test_flows,
    train_flows,
)
from flowsieve.schema import CATEGORICAL, FEATURES, IF_THRESHOLD, RF_THRESHOLD
from flowsieve.session import scratch_path
from flowsieve.sources.flow_files import (
    read_flows,
    read_raw_flows,
    write_errors,
    write_flows,
    write_scored,
)
from flowsieve.sources.tables import flows, raw_records, read_table


def _padded(frame):
    """The records with different white space around every text field."""
    return frame.withColumns(
        {name: F.concat(F.lit(" \t"), F.col(name), F.lit("  ")) for name in prepare.TEXT_COLUMNS}
    )


def _write_raw(frame, path):
    raw_records(frame).write.option("header", False).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


@query(over_flows(f"SELECT {FEATURE_LIST}, label, 21 AS difficulty FROM flows"))
def raw_flow_scan(spark, sf_dir):
    path = scratch_path(spark, "raw")
    _write_raw(flows(spark, sf_dir), path)
    return read_raw_flows(spark, path)


@query(over_flows(f"SELECT {FEATURE_LIST}, label, target FROM flows"))
def prepared_flow_scan(spark, sf_dir):
    raw, prepared = scratch_path(spark, "raw"), scratch_path(spark, "prepared")
    _write_raw(_padded(flows(spark, sf_dir)), raw)
    write_flows(prepare.prepare_flows(read_raw_flows(spark, raw)), prepared)
    return read_flows(spark, prepared)


@query(over_flows(f"SELECT {FEATURE_LIST}, label, target FROM flows"))
def prepared_csv_scan(spark, sf_dir):
    """A prepared CSV copy without flow_id, its columns in another order."""
    path = scratch_path(spark, "prepared-csv")
    rows = flows(spark, sf_dir).select("target", "label", *reversed(FEATURES))
    rows.write.option("header", True).csv(path)
    return only(read_flows(spark, path, "csv"), *FEATURES, "label", "target")


@query(over_flows("SELECT flow_id, protocol_type, service, flag, label FROM flows"))
def whitespace_strip(spark, sf_dir):
    stripped = prepare.strip_text(_padded(flows(spark, sf_dir)))
    return only(stripped, "flow_id", *CATEGORICAL, "label")


@query(over_flows("SELECT flow_id, label, target FROM flows"))
def binary_target(spark, sf_dir):
    return prepare.with_target(only(flows(spark, sf_dir), "flow_id", "label"))


@query(over_flows(f"SELECT {FEATURE_LIST}, label FROM flows"))
def metadata_drop(spark, sf_dir):
    return prepare.drop_metadata(raw_records(flows(spark, sf_dir)))


@query(over_flows(f"SELECT flow_id, {FEATURE_LIST} FROM flows"))
def feature_projection(spark, sf_dir):
    shuffled = flows(spark, sf_dir).select("flow_id", "label", *reversed(FEATURES))
    return checks.align_columns(shuffled, keep=("flow_id",))


def _records(frame):
    """JSON bodies of which some lack a field and some hold text where a number belongs."""
    whole = F.to_json(
        F.struct(
            *[
                F.when(F.col("count") <= 45, F.col(c)).alias(c) if c == "service" else F.col(c)
                for c in FEATURES
            ]
        )
    )
    broken = F.regexp_replace(whole, '"src_bytes":[^,]*', '"src_bytes":"many"')
    body = F.when(F.col("src_bytes") < 2000, broken).otherwise(whole)
    return frame.select("flow_id", body.alias("body"))


@query(
    over_flows(
        """SELECT flow_id, "count" <= 45 AND src_bytes >= 2000 AS accepted,
  concat_ws(',', CASE WHEN "count" > 45 THEN 'service' END,
    CASE WHEN src_bytes < 2000 THEN 'src_bytes' END) AS invalid_fields
FROM flows"""
    )
)
def typed_record_check(spark, sf_dir):
    checked = checks.check_records(_records(flows(spark, sf_dir)))
    return checked.select(
        "flow_id", "accepted", F.concat_ws(",", "invalid_fields").alias("invalid_fields")
    )


@query(
    over_flows(
        f"""SELECT flow_id, {FEATURE_LIST} FROM flows
WHERE "count" <= 45 AND src_bytes >= 2000"""
    )
)
def accepted_record_rows(spark, sf_dir):
    checked = checks.check_records(_records(flows(spark, sf_dir)))
    return checks.accepted_flows(checked, keep=("flow_id",))


@query(over_flows(f"SELECT flow_id, {FEATURE_LIST} FROM flows"))
def batch_request_rows(spark, sf_dir):
    requests = flows(spark, sf_dir).select(
        "flow_id", F.array(F.struct(*FEATURES)).alias("samples")
    )
    return checks.explode_batch(requests)


@query(
    """SELECT md5(concat_ws('|', md5(concat_ws(chr(1), l_returnflag, l_linestatus,
    CAST(l_linenumber AS VARCHAR))),
    CAST(row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber
      ORDER BY l_orderkey) - 1 AS VARCHAR))) AS flow_id,
  l_returnflag, l_linestatus, l_linenumber
FROM lineitem"""
)
def content_flow_ids(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    return prepare.with_flow_id(only(lines, "l_returnflag", "l_linestatus", "l_linenumber"))


@query(over_flows("SELECT flow_id, label FROM flows WHERE label IN ('normal', 'brand#22')"))
def population_filter(spark, sf_dir):
    return only(
        flows(spark, sf_dir).filter(F.col("label").isin("normal", "brand#22")), "flow_id", "label"
    )


@query(over_flows("SELECT flow_id FROM train WHERE target = 0"))
def normal_training_rows(spark, sf_dir):
    return only(train_flows(spark, sf_dir).filter(F.col("target") == 0), "flow_id")


def _late_predictions(spark, sf_dir):
    """Decisions that lack the longest flows and have some of the training split instead."""
    return (
        decided(flows(spark, sf_dir))
        .filter(
            (F.col("split") == "test") & (F.col("duration") <= 45)
            | (F.col("split") == "train") & (F.col("duration") > 45)
        )
        .select("flow_id", "decision")
    )


_LATE = """late AS (
  SELECT flow_id,
    CASE WHEN rf_probability >= 0.4::DOUBLE THEN 'ATTACK'
      WHEN if_score <= -0.1::DOUBLE THEN 'SUSPICIOUS' ELSE 'NORMAL' END AS decision
  FROM flows
  WHERE (split = 'test' AND duration <= 45) OR (split = 'train' AND duration > 45)
)"""


@query(
    over_flows(
        """SELECT
  count(*) FILTER (WHERE t.flow_id IS NOT NULL AND l.flow_id IS NOT NULL) AS matched,
  count(*) FILTER (WHERE l.flow_id IS NULL) AS flows_only,
  count(*) FILTER (WHERE t.flow_id IS NULL) AS predictions_only,
  CAST(0 AS BIGINT) AS repeated_flows, CAST(0 AS BIGINT) AS repeated_predictions
FROM test t FULL JOIN late l ON t.flow_id = l.flow_id""",
        _LATE,
    )
)
def prediction_alignment(spark, sf_dir):
    return prepare.alignment_report(test_flows(spark, sf_dir), _late_predictions(spark, sf_dir))


@query(
    over_flows(
        """SELECT count(*) FILTER (WHERE f IS NOT NULL AND p IS NOT NULL) AS matched,
  count(*) FILTER (WHERE p IS NULL) AS flows_only,
  count(*) FILTER (WHERE f IS NULL) AS predictions_only,
  count(*) FILTER (WHERE f > 1) AS repeated_flows,
  count(*) FILTER (WHERE p > 1) AS repeated_predictions
FROM (SELECT flow_id, CASE WHEN target = 1 THEN 2 ELSE 1 END AS f FROM test) a
FULL JOIN (SELECT flow_id, CASE WHEN decision = 'ATTACK' THEN 3 ELSE 1 END AS p FROM late) b
  ON a.flow_id = b.flow_id""",
        _LATE,
    )
)
def alignment_with_duplicates(spark, sf_dir):
    """Attacks stand twice among the flows, and predicted attacks three times among the others."""
    rows = only(test_flows(spark, sf_dir), "flow_id", "target")
    late = _late_predictions(spark, sf_dir)
    attacks = late.filter("decision = 'ATTACK'")
    return prepare.alignment_report(
        rows.unionByName(rows.filter("target = 1")),
        late.unionByName(attacks).unionByName(attacks),
    )


@query(
    over_flows(
        """SELECT flow_id, CASE WHEN p >= 0.4::DOUBLE THEN 'ATTACK' WHEN p IS NULL OR s IS NULL THEN NULL
    WHEN s <= -0.1::DOUBLE THEN 'SUSPICIOUS' ELSE 'NORMAL' END AS decision
FROM (SELECT flow_id, CASE WHEN duration % 5 <> 0 THEN rf_probability END AS p,
  CASE WHEN duration % 7 <> 0 THEN if_score END AS s FROM test)"""
    )
)
def decisions_with_gaps(spark, sf_dir):
    """Rows that a model could not score stay undecided unless the classifier settles them."""
    return with_decision(_with_gaps(spark, sf_dir), RF_THRESHOLD, IF_THRESHOLD).select(
        "flow_id", "decision"
    )


@query(
    over_flows(
        f"SELECT {cells('coalesce(p >= 0.4::DOUBLE, false)')} FROM "
        "(SELECT target, CASE WHEN duration % 5 <> 0 THEN rf_probability END AS p FROM test)"
    )
)
def confusion_with_gaps(spark, sf_dir):
    """Confusion counts in which a missing score is not flagged."""
    rows = with_decision(_with_gaps(spark, sf_dir), RF_THRESHOLD, IF_THRESHOLD)
    return evaluation.confusion_counts(rows, "target", "rf_prediction")


def _with_gaps(spark, sf_dir):
    scored = only(test_flows(spark, sf_dir), "flow_id", "target", "duration", "rf_probability", "if_score")
    return scored.withColumns(
        {
            "rf_probability": F.when(F.col("duration") % 5 != 0, F.col("rf_probability")),
            "if_score": F.when(F.col("duration") % 7 != 0, F.col("if_score")),
        }
    )


@query(
    over_flows(
        """SELECT t.flow_id, label, target, decision
FROM test t JOIN late l ON t.flow_id = l.flow_id""",
        _LATE,
    )
)
def aligned_predictions(spark, sf_dir):
    rows = only(test_flows(spark, sf_dir), "flow_id", "label", "target")
    return prepare.attach_predictions(rows, _late_predictions(spark, sf_dir))


@query(over_flows("SELECT flow_id, target = hybrid_prediction AS correct FROM decided"))
def correctness_flag(spark, sf_dir):
    marked = evaluation.with_correctness(
        test_decisions(spark, sf_dir), "target", "hybrid_prediction"
    )
    return only(marked, "flow_id", "correct")


_ERROR_COLUMNS = (
    "flow_id", "label", "target", "hybrid_prediction", "decision", "rf_prediction", "if_anomaly"
)


@query(
    over_flows(
        f"SELECT {', '.join(_ERROR_COLUMNS)} FROM decided WHERE target <> hybrid_prediction"
    )
)
def error_rows(spark, sf_dir):
    errors = evaluation.error_rows(test_decisions(spark, sf_dir), "target", "hybrid_prediction")
    return only(errors, *_ERROR_COLUMNS)


@query(
    over_flows(
        f"SELECT {', '.join(_ERROR_COLUMNS)} FROM decided WHERE target <> hybrid_prediction"
    )
)
def stored_error_rows(spark, sf_dir):
    path = scratch_path(spark, "errors")
    errors = evaluation.error_rows(test_decisions(spark, sf_dir), "target", "hybrid_prediction")
    write_errors(only(errors, *_ERROR_COLUMNS), path)
    return spark.read.parquet(path)


@query(over_flows("SELECT flow_id, label FROM decided WHERE target = 1 AND NOT rf_prediction"))
def false_negative_rows(spark, sf_dir):
    missed = evaluation.false_negatives(test_decisions(spark, sf_dir), "target", "rf_prediction")
    return only(missed, "flow_id", "label")


_SCORED = ("flow_id", "label", "target", "decision", "rf_probability", "rf_prediction",
           "if_score", "if_anomaly")


@query(over_flows(f"SELECT {', '.join(_SCORED)} FROM decided"))
def stored_scored_rows(spark, sf_dir):
    path = scratch_path(spark, "scored")
    write_scored(only(test_decisions(spark, sf_dir), *_SCORED), path)
    return only(spark.read.parquet(path), *_SCORED)


_ABSENT = ["service", "land", "dst_host_rerror_rate"]


@query(
    over_flows(
        f"SELECT unnest({_ABSENT!r}) AS missing, count(*) AS flows FROM test"
    )
)
def missing_features(spark, sf_dir):
    """The features that the presence check names on flows without some columns, and the flows that
    cannot be scored for it."""
    frame = test_flows(spark, sf_dir).drop(*_ABSENT)
    try:
        checks.require_columns(frame)
        named = []
    except ValueError as error:
        named = str(error).partition(": ")[2].split(", ")
    rows = frame.agg(F.count(F.lit(1)).alias("flows"))
    return rows.select(F.explode(F.array(*[F.lit(n) for n in named])).alias("missing"), "flows")


_NUMBERS = [name for name in FEATURES if name not in ("protocol_type", "service", "flag")]


@query(
    over_flows(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS feature, CAST(min(\"{name}\") AS DOUBLE) AS low, CAST(max(\"{name}\") AS DOUBLE) AS high FROM flows"
            for name in _NUMBERS
        )
    )
)
def numeric_feature_ranges(spark, sf_dir):
    """The features that are not categories, each with its range."""
    names = checks.numeric_columns(FEATURES)
    frame = flows(spark, sf_dir)
    ends = frame.agg(
        *[F.min(n).cast("double").alias(f"{n}|low") for n in names],
        *[F.max(n).cast("double").alias(f"{n}|high") for n in names],
    )
    rows = [
        F.struct(F.lit(n).alias("feature"), F.col(f"`{n}|low`").alias("low"), F.col(f"`{n}|high`").alias("high"))
        for n in names
    ]
    return ends.select(F.inline(F.array(*rows)))


@query(
    over_flows(
        """SELECT 'label' AS chosen, label AS value, count(*) AS samples FROM test GROUP BY label
UNION ALL
SELECT 'target', CAST(target AS VARCHAR), count(*) FROM test GROUP BY target"""
    )
)
def chosen_column_counts(spark, sf_dir):
    """Value counts of the first candidate column a frame has, with the label and without it."""
    candidates = ["attack_type", "label", "target"]
    frame = test_flows(spark, sf_dir)
    counted = []
    for rows in (frame, frame.drop("label")):
        name = checks.first_present(rows, candidates)
        counted.append(
            rows.groupBy(F.lit(name).alias("chosen"), F.col(name).cast("string").alias("value")).agg(
                F.count(F.lit(1)).alias("samples")
            )
        )
    return counted[0].unionByName(counted[1])
