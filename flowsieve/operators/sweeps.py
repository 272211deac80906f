"""Threshold experiments: all cuts are counted in one scan of the scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions import ratios
from flowsieve.functions.cuts import anomaly_cut, probability_cut
from flowsieve.operators.coverage import attack_types, tag_group
from flowsieve.operators.evaluation import binary_metrics, confusion_columns, metric_columns
from flowsieve.schema import ANOMALY_CUTS, HYBRID_CUTS, PROBABILITY_CUTS

_CELLS = ("tn", "fp", "fn", "tp")


def _sweep(df: DataFrame, truth: str, cuts: list[float], test) -> DataFrame:
    aggregates = []
    for number, cut in enumerate(cuts):
        aggregates += confusion_columns(truth, test(cut), f"c{number}_")
    rows = []
    for number, cut in enumerate(cuts):
        cells = [f"c{number}_{cell}" for cell in _CELLS]
        counts = [F.col(c).alias(cell) for c, cell in zip(cells, _CELLS, strict=True)]
        rows.append(
            F.struct(
                F.lit(float(cut)).alias("threshold"), *counts, *metric_columns(*cells)[1:]
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def probability_sweep(
    df: DataFrame,
    cuts: list[float] = PROBABILITY_CUTS,
    score: str = "rf_probability",
    truth: str = "target",
) -> DataFrame:
    """Precision, recall, f1 and confusion counts for each probability cut.

    Pass validation rows when the winning cut is to be used on test rows.
    """
    return _sweep(df, truth, cuts, lambda cut: probability_cut(score, cut))


def anomaly_sweep(
    df: DataFrame,
    cuts: list[float] = ANOMALY_CUTS,
    score: str = "if_score",
    truth: str = "target",
    orientation: str = "anomaly",
) -> DataFrame:
    return _sweep(df, truth, cuts, lambda cut: anomaly_cut(score, cut, orientation))


def hybrid_sweep(
    df: DataFrame,
    train: DataFrame,
    rf_threshold: float,
    cuts: list[float] = HYBRID_CUTS,
    orientation: str = "anomaly",
) -> DataFrame:
    """Overall metrics, recall on shared and test-only types, and suspicious counts for each
    anomaly cut at a fixed probability cut."""
    actual = F.col("target") == 1
    supervised = probability_cut("rf_probability", rf_threshold)
    aggregates = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(actual).alias("attacks"),
        F.count_if(actual & supervised).alias("rf_attacks"),
        F.count_if(~actual & supervised).alias("rf_normals"),
    ]
    for number, cut in enumerate(cuts):
        suspicious = ~supervised & anomaly_cut("if_score", cut, orientation)
        aggregates += [
            F.count_if(actual & suspicious).alias(f"c{number}_attacks"),
            F.count_if(~actual & suspicious).alias(f"c{number}_normals"),
        ]
    by_label = df.groupBy("label").agg(*aggregates)
    tagged = tag_group(by_label, attack_types(train))
    shared, unseen = F.col("group") == "shared", F.col("group") == "test_only"

    def total(column, member=None):
        value = F.col(column) if member is None else F.when(member, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0))

    sums = []
    for column in ("rows", "attacks", "rf_attacks", "rf_normals"):
        sums.append(total(column).alias(column))
    for column in ("attacks", "rf_attacks"):
        sums.append(total(column, shared).alias(f"shared_{column}"))
        sums.append(total(column, unseen).alias(f"unseen_{column}"))
    for number in range(len(cuts)):
        sums.append(total(f"c{number}_attacks").alias(f"c{number}_attacks"))
        sums.append(total(f"c{number}_normals").alias(f"c{number}_normals"))
        sums.append(total(f"c{number}_attacks", shared).alias(f"c{number}_shared"))
        sums.append(total(f"c{number}_attacks", unseen).alias(f"c{number}_unseen"))
    rows = []
    for number, cut in enumerate(cuts):
        tp = F.col("rf_attacks") + F.col(f"c{number}_attacks")
        fp = F.col("rf_normals") + F.col(f"c{number}_normals")
        fn = F.col("attacks") - tp
        tn = F.col("rows") - F.col("attacks") - fp
        shared_tp = F.col("shared_rf_attacks") + F.col(f"c{number}_shared")
        unseen_tp = F.col("unseen_rf_attacks") + F.col(f"c{number}_unseen")
        rows.append(
            F.struct(
                F.lit(float(cut)).alias("if_threshold"),
                *metric_columns(tn, fp, fn, tp),
                ratios.safe_ratio(shared_tp, F.col("shared_attacks")).alias("shared_recall"),
                ratios.safe_ratio(unseen_tp, F.col("unseen_attacks")).alias("test_only_recall"),
                (F.col(f"c{number}_attacks") + F.col(f"c{number}_normals")).alias(
                    "suspicious_total"
                ),
                F.col(f"c{number}_attacks").alias("suspicious_attacks"),
                F.col(f"c{number}_normals").alias("suspicious_normals"),
            )
        )
    return tagged.agg(*sums).select(F.inline(F.array(*rows)))


def best_threshold(sweep: DataFrame, threshold: str = "threshold") -> DataFrame:
    """The row with the highest f1; the lowest threshold wins a tie."""
    return sweep.orderBy(F.desc("f1"), F.asc(threshold)).limit(1)


def evaluate_at_best(
    sweep: DataFrame,
    test: DataFrame,
    score: str = "rf_probability",
    truth: str = "target",
    orientation: str | None = None,
) -> DataFrame:
    """Apply the winning cut of a sweep to test rows. The cut is a scalar subquery, so nothing is
    collected in between. Without an orientation the score is a probability."""
    cut = best_threshold(sweep).select("threshold").scalar()
    if orientation is None:
        predicted = probability_cut(score, cut)
    else:
        predicted = anomaly_cut(score, cut, orientation)
    flagged = test.select(truth, predicted.alias("predicted"))
    metrics = binary_metrics(flagged, truth, "predicted")
    return metrics.select(cut.alias("threshold"), *metrics.columns)
