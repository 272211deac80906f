"""Confusion counts and the metrics built on them. Every table is one scan and one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.functions import ratios
from flowsieve.functions.decisions import class_name
from flowsieve.functions.tally import size, tally
from flowsieve.operators.counts import literal_rows
from flowsieve.schema import DECISIONS


def _positive(column: Column) -> Column:
    """Truth of a 0/1 or boolean prediction."""
    return column.cast("int") == 1


def confusion_columns(
    truth: str, predicted: Column | str, prefix: str = "", weight: str | None = None
) -> list[Column]:
    """The four aggregate columns tn, fp, fn, tp.

    A row without a prediction is not flagged, as a score that is missing passes no cut; a row
    without a truth is in no cell.
    """
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    actual = _positive(F.col(truth))
    flagged = F.coalesce(_positive(predicted), F.lit(False))
    return [
        tally(~actual & ~flagged, weight).alias(f"{prefix}tn"),
        tally(~actual & flagged, weight).alias(f"{prefix}fp"),
        tally(actual & ~flagged, weight).alias(f"{prefix}fn"),
        tally(actual & flagged, weight).alias(f"{prefix}tp"),
    ]


def metric_columns(tn="tn", fp="fp", fn="fn", tp="tp") -> list[Column]:
    return [
        ratios.accuracy(tn, fp, fn, tp).alias("accuracy"),
        ratios.precision(fp, tp).alias("precision"),
        ratios.recall(fn, tp).alias("recall"),
        ratios.f1(fp, fn, tp).alias("f1"),
    ]


def confusion_counts(
    df: DataFrame, truth: str, predicted: Column | str, weight: str | None = None
) -> DataFrame:
    return df.agg(*confusion_columns(truth, predicted, weight=weight))


def binary_metrics(
    df: DataFrame, truth: str, predicted: Column | str, weight: str | None = None
) -> DataFrame:
    """tn, fp, fn, tp, accuracy, precision, recall and f1 in one row."""
    return confusion_counts(df, truth, predicted, weight).select(
        "tn", "fp", "fn", "tp", *metric_columns()
    )


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """The same metrics from stored counts."""
    return counts.select("*", *metric_columns())


def confusion_matrix(
    df: DataFrame, truth: str, predicted: Column | str, weight: str | None = None
) -> DataFrame:
    """Two rows (true class) by two columns (predicted class), zeros kept."""
    rows = F.array(
        F.struct(
            F.lit("NORMAL").alias("true_class"),
            F.col("tn").alias("predicted_normal"),
            F.col("fp").alias("predicted_attack"),
        ),
        F.struct(
            F.lit("ATTACK").alias("true_class"),
            F.col("fn").alias("predicted_normal"),
            F.col("tp").alias("predicted_attack"),
        ),
    )
    return confusion_counts(df, truth, predicted, weight).select(F.inline(rows))


def class_metrics(
    df: DataFrame, truth: str, predicted: Column | str, weight: str | None = None
) -> DataFrame:
    """Confusion counts, accuracy and precision / recall / f1 of both classes in one row."""
    return confusion_counts(df, truth, predicted, weight).select(
        "tn",
        "fp",
        "fn",
        "tp",
        ratios.accuracy("tn", "fp", "fn", "tp").alias("accuracy"),
        ratios.precision("fn", "tn").alias("normal_precision"),
        ratios.recall("fp", "tn").alias("normal_recall"),
        ratios.f1("fn", "fp", "tn").alias("normal_f1"),
        ratios.precision("fp", "tp").alias("attack_precision"),
        ratios.recall("fn", "tp").alias("attack_recall"),
        ratios.f1("fp", "fn", "tp").alias("attack_f1"),
    )


def classification_report(
    df: DataFrame, truth: str, predicted: Column | str, weight: str | None = None
) -> DataFrame:
    """Both classes, accuracy, macro and weighted averages, in print order by ``position``."""
    normal_support, attack_support = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    support = normal_support + attack_support
    names = ("precision", "recall", "f1")

    def entry(position, section, values, samples):
        scores = [
            value.alias(alias)
            for value, alias in zip(values, ("precision", "recall", "f1_score"), strict=True)
        ]
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(section).alias("section"),
            *scores,
            samples.alias("support"),
        )

    normal = [F.col(f"normal_{n}") for n in names]
    attack = [F.col(f"attack_{n}") for n in names]
    macro = [(a + b) / 2 for a, b in zip(normal, attack, strict=True)]
    weighted = [
        ratios.safe_ratio(a * normal_support + b * attack_support, support)
        for a, b in zip(normal, attack, strict=True)
    ]
    rows = F.array(
        entry(1, "NORMAL", normal, normal_support),
        entry(2, "ATTACK", attack, attack_support),
        entry(3, "accuracy", [F.col("accuracy")] * 3, support),
        entry(4, "macro avg", macro, support),
        entry(5, "weighted avg", weighted, support),
    )
    return class_metrics(df, truth, predicted, weight).select(F.inline(rows))


def model_comparison(
    df: DataFrame,
    truth: str,
    models: dict[str, Column | str],
    thresholds: dict[str, float] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row of metrics per named prediction column, all from one aggregate."""
    aggregates = []
    for number, predicted in enumerate(models.values()):
        aggregates += confusion_columns(truth, predicted, f"m{number}_", weight)
    entries = []
    for number, name in enumerate(models):
        cells = [f"m{number}_{cell}" for cell in ("tn", "fp", "fn", "tp")]
        threshold = []
        if thresholds is not None:
            value = thresholds.get(name)
            threshold = [F.lit(value).cast("double").alias("threshold")]
        entries.append(
            F.struct(F.lit(name).alias("model"), *threshold, *metric_columns(*cells))
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def model_agreement(
    df: DataFrame, first: str, second: str, weight: str | None = None
) -> DataFrame:
    """Where two detectors agree and where only one of them fires."""
    a, b = _positive(F.col(first)), _positive(F.col(second))
    return df.agg(
        tally(~a & ~b, weight).alias("both_normal"),
        tally(a & b, weight).alias("both_attack"),
        tally(a & ~b, weight).alias("first_only"),
        tally(~a & b, weight).alias("second_only"),
    )


def decisions_by_class(
    df: DataFrame, truth: str = "target", decision: str = "decision", weight: str | None = None
) -> DataFrame:
    """True class by decision, every cell present."""
    counted = (
        df.groupBy(class_name(truth).alias("true_class"))
        .pivot(decision, DECISIONS)
        .agg(size(weight))
    )
    return (
        literal_rows(df, "true_class", ["NORMAL", "ATTACK"])
        .join(counted, "true_class", "left")
        .fillna(0, DECISIONS)
        .select("true_class", *[F.col(name).alias(name.lower()) for name in DECISIONS])
    )


def suspicious_quality(
    df: DataFrame, truth: str = "target", decision: str = "decision", weight: str | None = None
) -> DataFrame:
    """How many suspicious rows really are attacks."""
    suspicious = F.col(decision) == "SUSPICIOUS"
    counts = df.agg(
        tally(suspicious, weight).alias("suspicious_total"),
        tally(suspicious & (F.col(truth) == 1), weight).alias("suspicious_attacks"),
        tally(suspicious & (F.col(truth) == 0), weight).alias("suspicious_normals"),
    )
    return counts.withColumn(
        "suspicious_attack_rate", ratios.safe_ratio("suspicious_attacks", "suspicious_total")
    )


def missed_attacks(
    df: DataFrame, truth: str, predicted: Column | str, weight: str | None = None
) -> DataFrame:
    return confusion_counts(df, truth, predicted, weight).select(F.col("fn").alias("missed_attacks"))


def with_correctness(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.withColumn("correct", F.col(truth) == F.col(predicted).cast("int"))


def error_rows(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """False positives and false negatives with all their columns."""
    return df.filter(F.col(truth) != F.col(predicted).cast("int"))


def false_negatives(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.filter((F.col(truth) == 1) & (F.col(predicted).cast("int") == 0))
