"""The evaluation job: every result table from one scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.decisions import is_positive
from flowsieve.ml.bundle import Detector
from flowsieve.operators import coverage, detection, evaluation, reports, sweeps
from flowsieve.operators.counts import decision_distribution
from flowsieve.schema import HYBRID_CUTS
from flowsieve.session import scratch_path
from flowsieve.sources.flow_files import write_scored
from flowsieve.sources.results import read_result, write_result

MODELS = {
    "Random Forest": "rf_prediction",
    "Isolation Forest": "if_anomaly",
    "Hybrid IDS": "hybrid_prediction",
}
SHORT_MODELS = {"rf": "rf_prediction", "if": "if_anomaly", "hybrid": "hybrid_prediction"}
WEIGHT = "flows"


def with_hybrid_prediction(scored: DataFrame) -> DataFrame:
    return scored.withColumn("hybrid_prediction", is_positive("decision"))


def outcome_counts(scored: DataFrame) -> DataFrame:
    """The scored rows folded to one row per label, class and outcome, weighted by ``flows``."""
    return with_hybrid_prediction(
        scored.groupBy("label", "target", "rf_prediction", "if_anomaly", "decision").agg(
            F.count(F.lit(1)).alias(WEIGHT)
        )
    )


def label_counts(train: DataFrame) -> DataFrame:
    """The training rows folded to one row per label, weighted by ``flows``."""
    return train.groupBy("label", "target").agg(F.count(F.lit(1)).alias(WEIGHT))


def stored(table: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that it is computed once."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def validation_tables(detector: Detector, test: DataFrame, path: str) -> dict[str, DataFrame]:
    """Score the test rows once, store them, and derive the validation tables from their
    outcome counts."""
    write_scored(detector.score(test), path)
    outcomes = stored(outcome_counts(test.sparkSession.read.parquet(path)), "outcomes")
    hybrid = ("target", "hybrid_prediction", WEIGHT)
    return {
        "summary": reports.final_validation(outcomes, weight=WEIGHT),
        "confusion": evaluation.confusion_matrix(outcomes, *hybrid),
        "report": evaluation.classification_report(outcomes, *hybrid),
        "distribution": decision_distribution(outcomes, weight=WEIGHT),
        "by_class": evaluation.decisions_by_class(outcomes, weight=WEIGHT),
    }


def result_tables(
    train: DataFrame,
    scored: DataFrame,
    rf_threshold: float,
    if_threshold: float,
    cuts: list[float] = HYBRID_CUTS,
) -> dict[str, DataFrame]:
    """All stored result tables but the combined summary.

    The training labels and the scored rows are each folded once into a small stored table, from
    which every result but the threshold experiment is computed; that one takes a second scan of
    the scores.
    """
    seen = stored(label_counts(train), "labels")
    outcomes = stored(outcome_counts(scored), "outcomes")
    return tables_of_rows(seen, outcomes, scored, rf_threshold, if_threshold, cuts, WEIGHT)


def tables_of_rows(
    seen: DataFrame,
    outcomes: DataFrame,
    scored: DataFrame,
    rf_threshold: float,
    if_threshold: float,
    cuts: list[float] = HYBRID_CUTS,
    weight: str | None = None,
) -> dict[str, DataFrame]:
    """The result tables of training rows and scored rows, each counted ``weight`` times or once."""
    pair = {"rf": "rf_prediction", "if": "if_anomaly"}
    two = {name: MODELS[name] for name in ("Random Forest", "Isolation Forest")}
    cut_of = {"Random Forest": rf_threshold, "Isolation Forest": if_threshold}
    by_group = detection.detection_by_group(outcomes, seen, SHORT_MODELS, weight=weight)

    final = final_type_and_group_tables(seen, outcomes, weight)

    def within(group: str, predicted: str) -> DataFrame:
        return detection.detection_in_group(outcomes, seen, group, predicted, weight)

    return {
        "attack_distribution_report": coverage.attack_distribution(seen, outcomes, weight),
        "shared_attack_evaluation": within("shared", "rf_prediction"),
        "unseen_attack_evaluation": within("test_only", "rf_prediction"),
        "anomaly_shared_attack_evaluation": within("shared", "if_anomaly"),
        "anomaly_unseen_attack_evaluation": within("test_only", "if_anomaly"),
        "rf_vs_if_model_comparison": evaluation.model_comparison(
            outcomes, "target", two, cut_of, weight
        ),
        "rf_vs_if_group_comparison": detection.detection_by_group(
            outcomes, seen, pair, names=("shared_attacks", "test_only_attacks"), weight=weight
        ),
        "rf_vs_if_attack_comparison": detection.grouped_detection_by_type(
            outcomes, seen, pair, include_normal=True, weight=weight
        ),
        "hybrid_attack_analysis": detection.grouped_detection_by_type(
            outcomes, seen, SHORT_MODELS, "decision", weight=weight
        ),
        "hybrid_group_comparison": by_group,
        "hybrid_threshold_experiment": sweeps.hybrid_sweep(scored, seen, rf_threshold, cuts),
        "final_model_comparison": evaluation.model_comparison(
            outcomes, "target", MODELS, weight=weight
        ),
        "final_hybrid_attack_analysis": detection.detection_by_type(
            outcomes, SHORT_MODELS, "decision", weight=weight
        ),
        "final_hybrid_group_comparison": by_group,
        "final_ids_analysis": reports.final_analysis(outcomes, weight=weight),
        "final_ids_attack_type_analysis": final[0],
        "final_ids_group_analysis": final[1],
        "final_ids_validation": reports.final_validation(outcomes, weight=weight),
    }


def write_result_tables(tables: dict[str, DataFrame], root: str, fmt: str = "csv") -> None:
    """Store every table and then the summary combined from the stored ones."""
    for name, table in tables.items():
        write_result(table, root, name, fmt=fmt)
    spark = next(iter(tables.values())).sparkSession
    summary = reports.performance_summary(
        read_result(spark, root, "rf_vs_if_model_comparison", fmt),
        read_result(spark, root, "final_ids_analysis", fmt),
    )
    write_result(summary, root, "final_performance_summary", fmt=fmt)


def final_type_and_group_tables(
    train: DataFrame, scored: DataFrame, weight: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per-type and per-group detection of the final decisions, on the label column."""
    rows = with_hybrid_prediction(scored)
    models = {"": F.col("hybrid_prediction")}
    by_type = detection.detection_by_type(rows, models, "decision", weight=weight)
    by_group = detection.detection_by_group(rows, train, models, "decision", weight=weight)
    return by_type, by_group
