import pytest
from pyspark.sql import functions as F

from flowsieve.functions.decisions import with_decision
from flowsieve.functions import cuts, decisions
from flowsieve.operators import alerts, counts, detection, evaluation, ranking, reports, sweeps
from flowsieve.plans.evaluation import result_tables, write_result_tables
from flowsieve.registry.core import decided
from flowsieve.schema import RESULT_SCHEMAS
from flowsieve.sources.results import read_result


@pytest.fixture(scope="module")
def scored(some_flows):
    return decided(some_flows.filter("split = 'test'")).persist()


@pytest.fixture(scope="module")
def train(some_flows):
    return some_flows.filter("split = 'train'")


def test_cuts_are_inclusive_and_ignore_nan(spark):
    frame = spark.createDataFrame([(0.4,), (0.39,), (float("nan"),)], "s double")
    picked = frame.select(
        cuts.probability_cut("s", 0.4).alias("p"),
        cuts.anomaly_cut(-F.col("s"), -0.4).alias("d"),
        cuts.anomaly_cut("s", -0.4, "anomaly").alias("a"),
    ).collect()
    assert [r["p"] for r in picked] == [True, False, False]
    assert [r["d"] for r in picked] == [True, False, False]
    assert [r["a"] for r in picked] == [True, True, False]
    with pytest.raises(ValueError):
        cuts.anomaly_cut("s", 0.1, "raw")


def test_orientation_is_the_negated_cut(spark, scored):
    flips = scored.filter(
        cuts.anomaly_cut("if_score", 0.1, "anomaly") != cuts.anomaly_cut("if_score", -0.1)
    )
    assert flips.count() == 0


def test_attack_wins_over_suspicious(spark):
    frame = spark.createDataFrame(
        [(True, True), (True, False), (False, True), (False, False)], "rf boolean, a boolean"
    )
    rows = frame.select(
        decisions.hybrid_decision("rf", "a").alias("d"), decisions.decision_code("rf", "a").alias("c")
    ).withColumn("n", decisions.decision_name("c")).withColumn("p", decisions.is_positive("d"))
    got = [tuple(r) for r in rows.collect()]
    assert got == [
        ("ATTACK", 1, "ATTACK", 1), ("ATTACK", 1, "ATTACK", 1),
        ("SUSPICIOUS", 2, "SUSPICIOUS", 1), ("NORMAL", 0, "NORMAL", 0),
    ]


def test_empty_input_gives_zeros(scored, train):
    nothing = scored.filter("false")
    row = evaluation.binary_metrics(nothing, "target", "hybrid_prediction").first()
    assert all(row[c] == 0 for c in row.asDict())
    assert alerts.decision_statistics(nothing).first().asDict() == {
        "total_flows": 0, "attacks": 0, "normal": 0, "suspicious": 0, "attack_rate": 0.0,
    }
    assert counts.decision_distribution(nothing).agg(F.sum("samples")).first()[0] == 0
    groups = detection.detection_by_group(nothing, train, {"": "rf_prediction"}).collect()
    assert sorted(g["group"] for g in groups) == ["SHARED", "TEST_ONLY"]
    assert all(g["samples"] == 0 and g["recall"] == 0.0 for g in groups)


def test_sums_agree(scored, train):
    total = scored.count()
    cells = evaluation.model_agreement(scored, "rf_prediction", "if_anomaly").first()
    assert sum(cells) == total
    assert counts.decision_distribution(scored).agg(F.sum("samples")).first()[0] == total
    by_type = detection.detection_by_type(scored, {"": "rf_prediction"})
    assert by_type.filter("detected + missed <> total").count() == 0
    attacks = scored.filter("target = 1").count()
    assert by_type.agg(F.sum("total")).first()[0] == attacks
    groups = detection.detection_by_group(scored, train, {"": "rf_prediction"}).collect()
    assert sum(g["samples"] for g in groups) == attacks
    for g in groups:
        assert g["precision"] in (0.0, 1.0)
        assert g["f1"] == pytest.approx(2 * g["recall"] / (1 + g["recall"]))


def test_normal_is_an_unseen_type_when_kept(scored, train):
    table = detection.grouped_detection_by_type(
        scored, train, {"rf": "rf_prediction"}, include_normal=True
    )
    assert table.filter("attack_type = 'normal'").first()["group"] == "test_only"


def test_sweep_positives_fall_as_the_cut_rises(scored):
    for table in (sweeps.probability_sweep(scored), sweeps.anomaly_sweep(scored)):
        rows = table.orderBy("threshold").collect()
        positives = [r["tp"] + r["fp"] for r in rows]
        assert positives == sorted(positives, reverse=True)
        assert {sum((r["tn"], r["fp"], r["fn"], r["tp"])) for r in rows} == {scored.count()}


def test_sweep_row_equals_the_single_evaluation(scored, train):
    row = sweeps.hybrid_sweep(scored, train, 0.4).filter("if_threshold = 0.1").first()
    single = evaluation.binary_metrics(scored, "target", "hybrid_prediction").first()
    for name in ("accuracy", "precision", "recall", "f1"):
        assert row[name] == pytest.approx(single[name], abs=1e-12)


def test_first_best_threshold_wins(spark):
    table = spark.createDataFrame(
        [(0.3, 0.9), (0.1, 0.8), (0.2, 0.9)], "threshold double, f1 double"
    )
    assert sweeps.best_threshold(table).first()["threshold"] == 0.2


def test_ties_are_broken_by_name(spark):
    table = spark.createDataFrame(
        [("b", 20, 5, 0.5), ("a", 20, 5, 0.5), ("c", 9, 9, 0.0)],
        "attack_type string, total int, missed int, hybrid_recall double",
    )
    names = lambda df: [r["attack_type"] for r in df.orderBy("place").collect()]
    assert names(ranking.most_missed(table, 2)) == ["c", "a"]
    assert names(ranking.hardest_types(table)) == ["a", "b"]
    assert names(ranking.best_types(table)) == ["a", "b"]


def test_page_arguments(spark, scored):
    rows = alerts.alert_rows(scored, F.col("seen_at"))
    for limit, offset in ((0, 0), (501, 0), (50, -1)):
        with pytest.raises(ValueError):
            alerts.alert_page(rows, limit, offset)
    first = [r["flow_id"] for r in alerts.alert_page(rows, 30, 0).collect()]
    second = [r["flow_id"] for r in alerts.alert_page(rows, 30, 30).collect()]
    both = [r["flow_id"] for r in alerts.alert_page(rows, 60, 0).collect()]
    assert first + second == both
    assert alerts.filter_alerts(rows, "normal").count() == 0
    assert alerts.alert_page(rows, 500, 10**6).count() == 0


def test_pages_are_slices_of_the_whole_order(scored):
    rows = alerts.alert_rows(scored, F.col("seen_at")).repartition(5).persist()
    order = [F.desc("created_at"), F.desc("id"), F.desc("flow_id")]
    whole = rows.orderBy(*order).collect()
    for at in (0, 3, 333, len(whole) - 10, len(whole)):
        page = alerts.alert_page(rows, 40, at)
        assert page.drop("place").collect() == whole[at : at + 40]
        assert [r.place for r in page.collect()] == list(range(at + 1, min(at + 40, len(whole)) + 1))
    attacks = [r for r in whole if r.decision == "ATTACK"]
    assert alerts.alert_page(rows, 40, 100, "attack").drop("place").collect() == attacks[100:140]


def test_page_of_alerts_that_are_not_stored(scored):
    """The alert time is then the time of the query."""
    assert alerts.alert_page(alerts.alert_rows(scored), 50, 200).count() == 50


def test_missing_scores(spark):
    rows = [(1, None, 0.1), (1, 0.9, None), (0, 0.1, None), (0, 0.1, -0.5), (1, 0.1, 0.1)]
    frame = spark.createDataFrame(rows, "target int, rf_probability double, if_score double")
    decided = with_decision(frame, 0.4, -0.1)
    assert [r.decision for r in decided.collect()] == [None, "ATTACK", None, "SUSPICIOUS", "NORMAL"]
    counts = evaluation.confusion_counts(decided, "target", "rf_prediction").first()
    assert (counts.tn, counts.fp, counts.fn, counts.tp) == (2, 0, 2, 1)


def test_all_result_tables_are_stored(spark, scored, train, tmp_path):
    tables = result_tables(train, scored, 0.4, -0.1)
    assert set(tables) == set(RESULT_SCHEMAS) - {"final_performance_summary"}
    write_result_tables(tables, str(tmp_path))
    for name in RESULT_SCHEMAS:
        assert read_result(spark, str(tmp_path), name).count() > 0
    stored = read_result(spark, str(tmp_path), "hybrid_threshold_experiment")
    assert stored.orderBy("if_threshold").collect() == (
        tables["hybrid_threshold_experiment"].orderBy("if_threshold").collect()
    )
    summary = read_result(spark, str(tmp_path), "final_performance_summary").collect()
    assert [r["model"] for r in summary] == ["Random Forest", "Isolation Forest", "Final Hybrid IDS"]


def test_summary_of_what_exists(spark, scored):
    analysis = reports.final_analysis(scored)
    assert reports.performance_summary(None, None) is None
    assert reports.performance_summary(None, analysis).count() == 1


def test_folded_rows_give_the_same_tables(scored, train):
    from flowsieve.plans.evaluation import (
        SHORT_MODELS,
        WEIGHT,
        final_type_and_group_tables,
        label_counts,
        outcome_counts,
    )

    folded, seen = outcome_counts(scored), label_counts(train)
    assert folded.count() < 200 < scored.count()

    def same(plain, weighted):
        assert plain.dtypes == weighted.dtypes
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, weighted.collect()))

    args = ("target", "hybrid_prediction")
    for operator in (
        evaluation.binary_metrics,
        evaluation.confusion_matrix,
        evaluation.class_metrics,
        evaluation.classification_report,
        evaluation.missed_attacks,
    ):
        same(operator(scored, *args), operator(folded, *args, weight=WEIGHT))
    for operator in (
        evaluation.decisions_by_class,
        evaluation.suspicious_quality,
        counts.decision_distribution,
        reports.final_analysis,
        reports.final_validation,
    ):
        same(operator(scored), operator(folded, weight=WEIGHT))
    pair = ("rf_prediction", "if_anomaly")
    same(evaluation.model_agreement(scored, *pair), evaluation.model_agreement(folded, *pair, WEIGHT))
    for plain, weighted in zip(
        final_type_and_group_tables(train, scored),
        final_type_and_group_tables(seen, folded, WEIGHT),
        strict=True,
    ):
        same(plain, weighted)
    same(
        detection.grouped_detection_by_type(scored, train, SHORT_MODELS, "decision", True),
        detection.grouped_detection_by_type(folded, seen, SHORT_MODELS, "decision", True, WEIGHT),
    )
