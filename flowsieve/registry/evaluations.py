"""Queries over confusion counts, detection tables, sweeps and reports."""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.cuts import anomaly_cut
from flowsieve.ml.sampling import stratified_flag
from flowsieve.operators import coverage, detection, evaluation, ranking, reports, sweeps
from flowsieve.operators.counts import decision_distribution as distribution
from flowsieve.plans.evaluation import (
    MODELS,
    SHORT_MODELS,
    final_type_and_group_tables,
    result_tables,
    tables_of_rows,
    write_result_tables,
)
from flowsieve.registry.core import (
    cells,
    metric_list,
    metrics,
    only,
    over_flows,
    query,
    ratio,
    test_decisions,
    test_flows,
    train_flows,
)
from flowsieve.schema import (
    ANOMALY_CUTS,
    HYBRID_CUTS,
    IF_THRESHOLD,
    PROBABILITY_CUTS,
    RESULT_SCHEMAS,
    RF_THRESHOLD,
)
from flowsieve.session import scratch_path
from flowsieve.sources.results import (
    metrics_document,
    read_result,
    shape_result,
    write_metrics_json,
    write_report_text,
    write_result,
)
from flowsieve.sources.tables import read_table

HYBRID = "hybrid_prediction"
_HYBRID_CELLS = f"SELECT {cells('hybrid_prediction = 1')} FROM decided"


@query(
    over_flows(
        f"""SELECT 'NORMAL' AS true_class, tn AS predicted_normal, fp AS predicted_attack
FROM ({_HYBRID_CELLS})
UNION ALL SELECT 'ATTACK', fn, tp FROM ({_HYBRID_CELLS})"""
    )
)
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(test_decisions(spark, sf_dir), "target", HYBRID)


@query(over_flows(_HYBRID_CELLS))
def confusion_counts(spark, sf_dir):
    return evaluation.confusion_counts(test_decisions(spark, sf_dir), "target", HYBRID)


@query(over_flows(f"SELECT tn, fp, fn, tp, {metric_list()} FROM ({_HYBRID_CELLS})"))
def binary_metrics(spark, sf_dir):
    return evaluation.binary_metrics(test_decisions(spark, sf_dir), "target", HYBRID)


_N = metrics("tp", "fn", "fp", "tn")
_A = metrics()


def _report_row(position, section, values, support):
    p, r, f = values
    return (
        f"SELECT {position} AS position, '{section}' AS section, {p} AS precision, "
        f"{r} AS recall, {f} AS f1_score, {support} AS support FROM c"
    )


_NAMES = ("precision", "recall", "f1")
_REPORT = "\nUNION ALL ".join(
    [
        _report_row(1, "NORMAL", [_N[n] for n in _NAMES], "tn + fp"),
        _report_row(2, "ATTACK", [_A[n] for n in _NAMES], "fn + tp"),
        _report_row(3, "accuracy", [_A["accuracy"]] * 3, "tn + fp + fn + tp"),
        _report_row(4, "macro avg", [f"({_N[n]} + {_A[n]}) / 2" for n in _NAMES],
                    "tn + fp + fn + tp"),
        _report_row(
            5,
            "weighted avg",
            [f"({_N[n]} * (tn + fp) + {_A[n]} * (fn + tp)) / (tn + fp + fn + tp)" for n in _NAMES],
            "tn + fp + fn + tp",
        ),
    ]
)


@query(over_flows(_REPORT, f"c AS ({_HYBRID_CELLS})"))
def classification_report(spark, sf_dir):
    return evaluation.classification_report(test_decisions(spark, sf_dir), "target", HYBRID)


@query(
    over_flows(
        f"""SELECT 'hybrid' AS model, 'flows' AS dataset, {_A["accuracy"]} AS accuracy,
  {_N["precision"]} AS normal_precision, {_N["recall"]} AS normal_recall,
  {_N["f1"]} AS normal_f1, {_A["precision"]} AS attack_precision,
  {_A["recall"]} AS attack_recall, {_A["f1"]} AS attack_f1, tn, fp, fn, tp
FROM ({_HYBRID_CELLS})"""
    )
)
def stored_metrics_document(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    table = evaluation.class_metrics(test_decisions(spark, sf_dir), "target", HYBRID)
    document = metrics_document(table, "hybrid", "flows")
    write_metrics_json(document, path)
    stored = spark.read.schema(document.schema).json(path)
    matrix = F.col("confusion_matrix")
    return stored.select(
        "model",
        "dataset",
        "accuracy",
        *[
            F.col(f"{kind}.{name}").alias(f"{kind}_{alias}")
            for kind in ("normal", "attack")
            for name, alias in (("precision", "precision"), ("recall", "recall"), ("f1_score", "f1"))
        ],
        matrix[0][0].alias("tn"),
        matrix[0][1].alias("fp"),
        matrix[1][0].alias("fn"),
        matrix[1][1].alias("tp"),
    )


@query(
    over_flows(
        """SELECT 0 AS line_no, printf('%12s  %9s %9s %9s %9s', '', 'precision', 'recall',
  'f1-score', 'support') AS value
UNION ALL SELECT 1, '' UNION ALL SELECT 4, ''
UNION ALL SELECT CASE position WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE position + 2 END,
  CASE WHEN section = 'accuracy'
    THEN printf('%12s  %9s %9s %9.2f %9d', section, '', '', f1_score, support)
    ELSE printf('%12s  %9.2f %9.2f %9.2f %9d', section, precision, recall, f1_score, support) END
FROM report""",
        f"c AS ({_HYBRID_CELLS})",
        f"report AS ({_REPORT})",
    )
)
def report_text_lines(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = evaluation.classification_report(test_decisions(spark, sf_dir), "target", HYBRID)
    write_report_text(report, path)
    text = spark.read.text(path, wholetext=True).filter("value <> ''")
    lines = F.split(F.regexp_replace("value", "\\n$", ""), "\n")
    return text.select(F.posexplode(lines).alias("line_no", "value"))


def _by_type(columns: str, where: str = "target = 1", table: str = "decided") -> str:
    return f"""SELECT label AS attack_type, count(*) AS total, {columns}
FROM {table} WHERE {where} GROUP BY label"""


def _detected(name: str, predicted: str) -> str:
    fired = f"count(*) FILTER (WHERE {predicted})"
    prefix = f"{name}_" if name else ""
    return (
        f"{fired} AS {prefix}detected, count(*) - {fired} AS {prefix}missed, "
        f"CAST({fired} AS DOUBLE) / count(*) AS {prefix}recall"
    )


_SUSPICIOUS = "count(*) FILTER (WHERE decision = 'SUSPICIOUS') AS suspicious"
_PAIR = f"{_detected('rf', 'rf_prediction')}, {_detected('if', 'if_anomaly')}"
_TRIO = f"{_PAIR}, {_detected('hybrid', 'hybrid_prediction = 1')}, {_SUSPICIOUS}"
_SEEN = "seen AS (SELECT DISTINCT label FROM train WHERE target = 1)"
_GROUP = """CASE WHEN attack_type IN (SELECT label FROM seen) THEN 'shared'
  ELSE 'test_only' END AS "group\""""


@query(over_flows(_by_type(_detected("", "rf_prediction"))))
def detection_by_type(spark, sf_dir):
    return detection.detection_by_type(test_decisions(spark, sf_dir), {"": "rf_prediction"})


@query(over_flows(f"SELECT *, {_GROUP} FROM ({_by_type(_PAIR, 'true')})", _SEEN))
def two_model_detection(spark, sf_dir):
    return detection.grouped_detection_by_type(
        test_decisions(spark, sf_dir),
        train_flows(spark, sf_dir),
        {"rf": "rf_prediction", "if": "if_anomaly"},
        include_normal=True,
    )


@query(over_flows(f"SELECT *, {_GROUP} FROM ({_by_type(_TRIO)})", _SEEN))
def three_model_detection(spark, sf_dir):
    return detection.grouped_detection_by_type(
        test_decisions(spark, sf_dir), train_flows(spark, sf_dir), SHORT_MODELS, "decision"
    )


_FINAL = _by_type(f"{_detected('', 'hybrid_prediction = 1')}, {_SUSPICIOUS}")


@query(
    over_flows(
        "SELECT *, CAST(row_number() OVER (ORDER BY total DESC, attack_type) AS INTEGER) AS place "
        f"FROM ({_FINAL})"
    )
)
def final_detection_by_type(spark, sf_dir):
    by_type, _ = final_type_and_group_tables(
        train_flows(spark, sf_dir), test_decisions(spark, sf_dir)
    )
    return ranking.by_total(by_type)


def _within(spark, sf_dir, group, predicted):
    return detection.detection_in_group(
        test_decisions(spark, sf_dir), train_flows(spark, sf_dir), group, predicted
    )


@query(
    over_flows(
        _by_type(
            _detected("", "rf_prediction"), "target = 1 AND label IN (SELECT label FROM seen)"
        ),
        _SEEN,
    )
)
def shared_detection(spark, sf_dir):
    return _within(spark, sf_dir, "shared", "rf_prediction")


@query(
    over_flows(
        _by_type(
            _detected("", "rf_prediction"), "target = 1 AND label NOT IN (SELECT label FROM seen)"
        ),
        _SEEN,
    )
)
def test_only_detection(spark, sf_dir):
    return detection.detection_within(
        test_decisions(spark, sf_dir),
        coverage.test_only_types(train_flows(spark, sf_dir), test_flows(spark, sf_dir)),
        "rf_prediction",
    )


@query(
    over_flows(
        _by_type(
            _detected("", "-if_score >= -0.1::DOUBLE"),
            "target = 1 AND label IN (SELECT label FROM seen)",
        ),
        _SEEN,
    )
)
def anomaly_shared_detection(spark, sf_dir):
    flagged = anomaly_cut("if_score", IF_THRESHOLD, "anomaly")
    return _within(spark, sf_dir, "shared", flagged)


def _group_sql(models: dict[str, str], suspicious: bool = False, names=("SHARED", "TEST_ONLY")):
    """Group metrics from the tagged attack rows."""
    columns = []
    for name, predicted in models.items():
        prefix = f"{name}_" if name else ""
        tp = f"count(t.flow_id) FILTER (WHERE {predicted})"
        fn = f"(count(t.flow_id) - {tp})"
        columns += [
            f"{tp} AS {prefix}detected",
            f"{fn} AS {prefix}missed",
            f"{ratio(tp, tp)} AS {prefix}precision",
            f"{ratio(tp, 'count(t.flow_id)')} AS {prefix}recall",
            f"{ratio(f'(2 * {tp})', f'(2 * {tp} + {fn})')} AS {prefix}f1",
        ]
    if suspicious:
        columns.append("count(t.flow_id) FILTER (WHERE decision = 'SUSPICIOUS') AS suspicious")
    return over_flows(
        f"""SELECT g.grp AS "group", count(t.flow_id) AS samples, {", ".join(columns)}
FROM (VALUES ('{names[0]}'), ('{names[1]}')) g(grp)
LEFT JOIN (
  SELECT *, CASE WHEN label IN (SELECT label FROM seen) THEN '{names[0]}' ELSE '{names[1]}' END
    AS grp
  FROM decided WHERE target = 1
) t ON g.grp = t.grp GROUP BY g.grp""",
        _SEEN,
    )


@query(_group_sql({"": "rf_prediction"}))
def group_metrics(spark, sf_dir):
    return detection.detection_by_group(
        test_decisions(spark, sf_dir), train_flows(spark, sf_dir), {"": "rf_prediction"}
    )


@query(_group_sql({"": "-if_score >= -0.1::DOUBLE"}))
def anomaly_group_metrics(spark, sf_dir):
    flagged = anomaly_cut("if_score", IF_THRESHOLD, "anomaly")
    return detection.detection_by_group(
        test_decisions(spark, sf_dir), train_flows(spark, sf_dir), {"": flagged}
    )


@query(
    _group_sql(
        {"rf": "rf_prediction", "if": "if_anomaly", "hybrid": "hybrid_prediction = 1"},
        names=("shared_attacks", "test_only_attacks"),
    )
)
def model_group_metrics(spark, sf_dir):
    return detection.detection_by_group(
        test_decisions(spark, sf_dir),
        train_flows(spark, sf_dir),
        SHORT_MODELS,
        names=("shared_attacks", "test_only_attacks"),
    )


@query(_group_sql({"": "hybrid_prediction = 1"}, suspicious=True))
def final_group_detection(spark, sf_dir):
    _, by_group = final_type_and_group_tables(
        train_flows(spark, sf_dir), test_decisions(spark, sf_dir)
    )
    return by_group


def _agreement_sql(a: str, b: str, table: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE NOT {a} AND NOT {b}) AS both_normal,
  count(*) FILTER (WHERE {a} AND {b}) AS both_attack,
  count(*) FILTER (WHERE {a} AND NOT {b}) AS first_only,
  count(*) FILTER (WHERE NOT {a} AND {b}) AS second_only
FROM {table}"""


@query(over_flows(_agreement_sql("rf_prediction", "if_anomaly", "decided")))
def model_agreement(spark, sf_dir):
    return evaluation.model_agreement(
        test_decisions(spark, sf_dir), "rf_prediction", "if_anomaly"
    )


@query(_agreement_sql("(quality = 1)", "(toxic = 1)", "labels"))
def label_agreement(spark, sf_dir):
    return evaluation.model_agreement(read_table(spark, sf_dir, "labels"), "quality", "toxic")


@query(
    over_flows(
        f"""SELECT d.decision, count(t.flow_id) AS samples,
  {ratio("count(t.flow_id)", "(SELECT count(*) FROM decided)")} * 100 AS percentage
FROM (VALUES ('NORMAL'), ('ATTACK'), ('SUSPICIOUS')) d(decision)
LEFT JOIN decided t ON d.decision = t.decision GROUP BY d.decision"""
    )
)
def decision_distribution(spark, sf_dir):
    return distribution(test_decisions(spark, sf_dir))


@query(
    over_flows(
        """SELECT CASE target WHEN 0 THEN 'NORMAL' ELSE 'ATTACK' END AS true_class,
  count(*) FILTER (WHERE decision = 'NORMAL') AS normal,
  count(*) FILTER (WHERE decision = 'ATTACK') AS attack,
  count(*) FILTER (WHERE decision = 'SUSPICIOUS') AS suspicious
FROM decided GROUP BY target"""
    )
)
def decisions_by_class(spark, sf_dir):
    return evaluation.decisions_by_class(test_decisions(spark, sf_dir))


@query(
    over_flows(
        f"""SELECT *, {ratio("suspicious_attacks", "suspicious_total")} AS suspicious_attack_rate
FROM (SELECT count(*) AS suspicious_total,
  count(*) FILTER (WHERE target = 1) AS suspicious_attacks,
  count(*) FILTER (WHERE target = 0) AS suspicious_normals
  FROM decided WHERE decision = 'SUSPICIOUS')"""
    )
)
def suspicious_quality(spark, sf_dir):
    return evaluation.suspicious_quality(test_decisions(spark, sf_dir))


_SPLIT = """ranked AS (
  SELECT flow_id, target, rf_probability,
    row_number() OVER (PARTITION BY target ORDER BY md5('42|' || flow_id)) AS place,
    count(*) OVER (PARTITION BY target) AS n
  FROM train
),
validation AS (
  SELECT * FROM ranked WHERE place <= CAST(round(n * 0.2::DOUBLE) AS BIGINT)
)"""


def _validation_rows(spark, sf_dir):
    rows = only(train_flows(spark, sf_dir), "flow_id", "target", "rf_probability")
    return stratified_flag(rows).filter("is_validation")


@query(
    over_flows(
        """SELECT flow_id, target, place <= CAST(round(n * 0.2::DOUBLE) AS BIGINT)
  AS is_validation FROM ranked""",
        _SPLIT,
    )
)
def stratified_split(spark, sf_dir):
    return stratified_flag(only(train_flows(spark, sf_dir), "flow_id", "target"))


def _sweep_sql(cuts: list[float], test: str, table: str) -> str:
    values = ", ".join(f"({cut}::DOUBLE)" for cut in cuts)
    return f"""SELECT threshold, tn, fp, fn, tp, {metric_list(skip=("accuracy",))}
FROM (SELECT threshold, {cells(test)} FROM (VALUES {values}) v(threshold), {table}
  GROUP BY threshold)"""


_PROBABILITY_SWEEP = _sweep_sql(PROBABILITY_CUTS, "rf_probability >= threshold", "validation")
_ANOMALY_SWEEP = _sweep_sql(ANOMALY_CUTS, "-if_score >= threshold", "test")
_BEST = "ORDER BY f1 DESC, threshold LIMIT 1"


@query(over_flows(_PROBABILITY_SWEEP, _SPLIT))
def probability_sweep(spark, sf_dir):
    return sweeps.probability_sweep(_validation_rows(spark, sf_dir))


@query(over_flows(_ANOMALY_SWEEP))
def anomaly_sweep(spark, sf_dir):
    return sweeps.anomaly_sweep(test_flows(spark, sf_dir))


_HYBRID_VALUES = ", ".join(f"({cut}::DOUBLE)" for cut in HYBRID_CUTS)
_HYBRID_SWEEP = f"""SELECT if_threshold, {metric_list()},
  {ratio("shared_tp", "shared_n")} AS shared_recall,
  {ratio("unseen_tp", "unseen_n")} AS test_only_recall,
  suspicious_attacks + suspicious_normals AS suspicious_total,
  suspicious_attacks, suspicious_normals
FROM (
  SELECT if_threshold, {cells("rf OR anomaly")},
    count(*) FILTER (WHERE target = 1 AND shared AND (rf OR anomaly)) AS shared_tp,
    count(*) FILTER (WHERE target = 1 AND shared) AS shared_n,
    count(*) FILTER (WHERE target = 1 AND NOT shared AND (rf OR anomaly)) AS unseen_tp,
    count(*) FILTER (WHERE target = 1 AND NOT shared) AS unseen_n,
    count(*) FILTER (WHERE target = 1 AND NOT rf AND anomaly) AS suspicious_attacks,
    count(*) FILTER (WHERE target = 0 AND NOT rf AND anomaly) AS suspicious_normals
  FROM (
    SELECT target, if_threshold, rf_prediction AS rf, -if_score >= if_threshold AS anomaly,
      label IN (SELECT label FROM seen) AS shared
    FROM decided, (VALUES {_HYBRID_VALUES}) v(if_threshold)
  ) GROUP BY if_threshold
)"""


@query(over_flows(_HYBRID_SWEEP, _SEEN))
def hybrid_sweep(spark, sf_dir):
    return sweeps.hybrid_sweep(
        test_flows(spark, sf_dir), train_flows(spark, sf_dir), RF_THRESHOLD
    )


@query(over_flows(f"SELECT * FROM ({_PROBABILITY_SWEEP}) {_BEST}", _SPLIT))
def best_probability_threshold(spark, sf_dir):
    return sweeps.best_threshold(sweeps.probability_sweep(_validation_rows(spark, sf_dir)))


@query(
    over_flows(
        f"SELECT * FROM ({_HYBRID_SWEEP}) ORDER BY f1 DESC, if_threshold LIMIT 1", _SEEN
    )
)
def best_hybrid_threshold(spark, sf_dir):
    table = sweeps.hybrid_sweep(
        test_flows(spark, sf_dir), train_flows(spark, sf_dir), RF_THRESHOLD
    )
    return sweeps.best_threshold(table, "if_threshold")


def _at_best(sweep: str, test: str) -> str:
    return f"""SELECT threshold, tn, fp, fn, tp, {metric_list()}
FROM (SELECT threshold, {cells(test)}
  FROM test, (SELECT threshold FROM ({sweep}) {_BEST}) b GROUP BY threshold)"""


@query(over_flows(_at_best(_PROBABILITY_SWEEP, "rf_probability >= threshold"), _SPLIT))
def test_at_best_probability(spark, sf_dir):
    sweep = sweeps.probability_sweep(_validation_rows(spark, sf_dir))
    return sweeps.evaluate_at_best(sweep, test_flows(spark, sf_dir))


@query(over_flows(_at_best(_ANOMALY_SWEEP, "-if_score >= threshold")))
def test_at_best_anomaly(spark, sf_dir):
    test = test_flows(spark, sf_dir)
    return sweeps.evaluate_at_best(
        sweeps.anomaly_sweep(test), test, "if_score", orientation="anomaly"
    )


def _model_row(name: str, predicted: str, threshold: str) -> str:
    return f"""SELECT '{name}' AS model, CAST({threshold} AS DOUBLE) AS threshold, {metric_list()}
FROM (SELECT {cells(predicted)} FROM decided)"""


_COMPARISON = "\nUNION ALL ".join(
    [
        _model_row("Random Forest", "rf_prediction", "0.4"),
        _model_row("Isolation Forest", "if_anomaly", "-0.1"),
        _model_row("Hybrid IDS", "hybrid_prediction = 1", "NULL"),
    ]
)


def _comparison(spark, sf_dir):
    return evaluation.model_comparison(
        test_decisions(spark, sf_dir),
        "target",
        MODELS,
        {"Random Forest": RF_THRESHOLD, "Isolation Forest": IF_THRESHOLD},
    )


@query(over_flows(_COMPARISON))
def model_comparison(spark, sf_dir):
    return _comparison(spark, sf_dir)


_ANALYSIS = f"""SELECT {_A["accuracy"]} AS accuracy, {_A["precision"]} AS attack_precision,
  {_A["recall"]} AS attack_recall, {_A["f1"]} AS attack_f1, total_samples, normal_samples,
  attack_samples, normal_decisions, attack_decisions, suspicious_decisions,
  suspicious_true_attacks, suspicious_true_normals
FROM (SELECT {cells("hybrid_prediction = 1")}, count(*) AS total_samples,
  count(*) FILTER (WHERE target = 0) AS normal_samples,
  count(*) FILTER (WHERE target = 1) AS attack_samples,
  count(*) FILTER (WHERE decision = 'NORMAL') AS normal_decisions,
  count(*) FILTER (WHERE decision = 'ATTACK') AS attack_decisions,
  count(*) FILTER (WHERE decision = 'SUSPICIOUS') AS suspicious_decisions,
  count(*) FILTER (WHERE decision = 'SUSPICIOUS' AND target = 1) AS suspicious_true_attacks,
  count(*) FILTER (WHERE decision = 'SUSPICIOUS' AND target = 0) AS suspicious_true_normals
FROM decided)"""


@query(over_flows(_ANALYSIS))
def final_analysis(spark, sf_dir):
    return reports.final_analysis(test_decisions(spark, sf_dir))


@query(
    over_flows(
        f"""SELECT accuracy, attack_precision AS precision, attack_recall AS recall,
  attack_f1 AS f1, normal_decisions AS normal, attack_decisions AS attack,
  suspicious_decisions AS suspicious FROM ({_ANALYSIS})"""
    )
)
def final_validation(spark, sf_dir):
    return reports.final_validation(test_decisions(spark, sf_dir))


@query(
    over_flows(
        f"""SELECT model, accuracy, precision, recall, f1 FROM ({_COMPARISON})
WHERE model <> 'Hybrid IDS'
UNION ALL SELECT 'Final Hybrid IDS', accuracy, attack_precision, attack_recall, attack_f1
FROM ({_ANALYSIS})"""
    )
)
def stored_performance_summary(spark, sf_dir):
    root = scratch_path(spark, "results")
    test = test_decisions(spark, sf_dir)
    write_result(_comparison(spark, sf_dir), root, "rf_vs_if_model_comparison")
    write_result(reports.final_analysis(test), root, "final_ids_analysis")
    return reports.performance_summary(
        read_result(spark, root, "rf_vs_if_model_comparison"),
        read_result(spark, root, "final_ids_analysis"),
    )


@query(
    over_flows(
        """SELECT label, train_count, test_count, train_count > 0 AS seen_in_training,
  train_count = 0 AND test_count > 0 AS test_only,
  CAST(train_count AS DOUBLE) / sum(train_count) OVER () * 100 AS train_percentage,
  CAST(test_count AS DOUBLE) / sum(test_count) OVER () * 100 AS test_percentage
FROM (
  SELECT label, count(*) FILTER (WHERE split = 'train') AS train_count,
    count(*) FILTER (WHERE split = 'test') AS test_count
  FROM flows WHERE label <> 'normal' GROUP BY label)"""
    )
)
def stored_distribution_report(spark, sf_dir):
    root = scratch_path(spark, "results")
    table = coverage.attack_distribution(train_flows(spark, sf_dir), test_flows(spark, sf_dir))
    write_result(table, root, "attack_distribution_report", [F.desc("test_count"), "label"])
    return read_result(spark, root, "attack_distribution_report")


@query(over_flows("SELECT count(*) AS missed_attacks FROM decided WHERE target = 1 AND NOT rf_prediction"))
def missed_attacks(spark, sf_dir):
    return evaluation.missed_attacks(test_decisions(spark, sf_dir), "target", "rf_prediction")


def _entry(position: int, section: str, name: str, column: str, ratio_value: bool) -> str:
    value = f"printf('%.4f', {column})" if ratio_value else f"CAST({column} AS VARCHAR)"
    return (
        f"SELECT {position} AS position, '{section}' AS section, '{name}' AS name, "
        f"{value} AS value FROM a"
    )


@query(
    over_flows(
        "\nUNION ALL ".join(
            [
                _entry(1, "performance", "Accuracy", "accuracy", True),
                _entry(2, "performance", "Attack Precision", "attack_precision", True),
                _entry(3, "performance", "Attack Recall", "attack_recall", True),
                _entry(4, "performance", "Attack F1", "attack_f1", True),
                _entry(5, "performance", "Total samples", "total_samples", False),
                _entry(6, "performance", "Normal samples", "normal_samples", False),
                _entry(7, "performance", "Attack samples", "attack_samples", False),
                _entry(8, "decisions", "NORMAL", "normal_decisions", False),
                _entry(9, "decisions", "ATTACK", "attack_decisions", False),
                _entry(10, "decisions", "SUSPICIOUS", "suspicious_decisions", False),
                _entry(11, "decisions", "Suspicious true attacks", "suspicious_true_attacks", False),
                _entry(12, "decisions", "Suspicious true normals", "suspicious_true_normals", False),
            ]
        ),
        f"a AS ({_ANALYSIS})",
    )
)
def report_entries(spark, sf_dir):
    return reports.report_entries(reports.final_analysis(test_decisions(spark, sf_dir)))


_TYPED = _by_type(_detected("", "rf_prediction"))


def _in_order(body: str, order: str) -> str:
    return f"""SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place
FROM ({body})"""


@query(over_flows(_in_order(_TYPED, "missed DESC, attack_type")))
def types_by_missed(spark, sf_dir):
    return ranking.by_missed(
        detection.detection_by_type(test_decisions(spark, sf_dir), {"": "rf_prediction"})
    )


def _placed(body: str, order: str, where: str = "true", n: int = 10) -> str:
    return f"""SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place
FROM ({body}) WHERE {where} QUALIFY place <= {n}"""


@query(over_flows(_placed(_TYPED, "missed DESC, attack_type")))
def most_missed_types(spark, sf_dir):
    return ranking.most_missed(
        detection.detection_by_type(test_decisions(spark, sf_dir), {"": "rf_prediction"})
    )


_THREE = _by_type(_TRIO)


def _three_models(spark, sf_dir):
    return detection.detection_by_type(test_decisions(spark, sf_dir), SHORT_MODELS, "decision")


@query(over_flows(_placed(_THREE, "hybrid_recall, attack_type", "total >= 10")))
def hardest_types(spark, sf_dir):
    return ranking.hardest_types(_three_models(spark, sf_dir))


@query(over_flows(_placed(_THREE, "hybrid_recall DESC, attack_type", "total >= 10")))
def best_types(spark, sf_dir):
    return ranking.best_types(_three_models(spark, sf_dir))


@query(over_flows(_in_order(_THREE, "hybrid_recall, attack_type")))
def types_by_recall(spark, sf_dir):
    return ranking.by_recall(_three_models(spark, sf_dir))


@query(
    over_flows(
        """SELECT flow_id, decision, rf_probability, if_score FROM decided
ORDER BY flow_id LIMIT 10"""
    )
)
def result_preview(spark, sf_dir):
    rows = only(test_decisions(spark, sf_dir), "flow_id", "decision", "rf_probability", "if_score")
    return ranking.preview(rows, [F.asc("flow_id")])


@query(
    "SELECT unnest(["
    + ", ".join(f"'{name}'" for name in sorted(set(RESULT_SCHEMAS) - {"final_performance_summary"}))
    + "]) AS table_name, true AS has_rows, CAST(0 AS BIGINT) AS differing"
)
def stored_result_tables(spark, sf_dir):
    """Every result table as the job computes it from folded counts, stores it and reads it back,
    beside the same table computed from the rows themselves."""
    root = scratch_path(spark, "results")
    train, test = train_flows(spark, sf_dir), test_decisions(spark, sf_dir)
    write_result_tables(result_tables(train, test, RF_THRESHOLD, IF_THRESHOLD), root)
    rows = tables_of_rows(train, test, test, RF_THRESHOLD, IF_THRESHOLD)
    reports_ = []
    for name, table in rows.items():
        read, own = read_result(spark, root, name), shape_result(table, name)
        rounded = [
            F.round(c, 9).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in read.dtypes
        ]
        read, own = read.select(*rounded), own.select(*rounded)
        differing = read.exceptAll(own).unionByName(own.exceptAll(read))
        reports_.append(
            differing.agg(F.count(F.lit(1)).alias("differing")).join(
                # One row on either side.
                F.broadcast(read.agg((F.count(F.lit(1)) > 0).alias("has_rows")))
            ).select(F.lit(name).alias("table_name"), "has_rows", "differing")
        )
    return functools.reduce(DataFrame.unionByName, reports_)
