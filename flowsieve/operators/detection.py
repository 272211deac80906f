"""Detection by attack type and by group of types (seen in training or not).

Rows are first reduced to one row per label; groups and type sets are joined to that small table,
never to the flows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.functions import ratios
from flowsieve.functions.checks import first_present
from flowsieve.functions.tally import size, tally
from flowsieve.operators.counts import literal_rows
from flowsieve.operators.coverage import attack_types, tag_group

LABEL_COLUMNS = ["attack_type", "label", "attack"]


def label_column(df: DataFrame) -> str | None:
    """The column that names the attack type."""
    return first_present(df, LABEL_COLUMNS)


def _fires(predicted: Column | str) -> Column:
    return (F.col(predicted) if isinstance(predicted, str) else predicted).cast("int") == 1


def detection_by_type(
    df: DataFrame,
    models: dict[str, Column | str],
    decision: str | None = None,
    include_normal: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Rows, detections, misses and recall per label for each model.

    With one model named ``""`` the columns carry no prefix. ``include_normal`` keeps every label
    of the input; otherwise only attack rows count.
    """
    rows = df if include_normal else df.filter(F.col("target") == 1)
    aggregates = [size(weight).alias("total")]
    for name, predicted in models.items():
        aggregates.append(tally(_fires(predicted), weight).alias(_named(name, "detected")))
    if decision:
        aggregates.append(tally(F.col(decision) == "SUSPICIOUS", weight).alias("suspicious"))
    table = rows.groupBy(F.col(label_column(df)).alias("attack_type")).agg(*aggregates)
    columns = [F.col("attack_type"), F.col("total")]
    for name in models:
        detected = F.col(_named(name, "detected"))
        columns += [
            detected,
            (F.col("total") - detected).alias(_named(name, "missed")),
            ratios.safe_ratio(detected, F.col("total")).alias(_named(name, "recall")),
        ]
    if decision:
        columns.append(F.col("suspicious"))
    return table.select(*columns)


def _named(model: str, measure: str) -> str:
    return f"{model}_{measure}" if model else measure


def grouped_detection_by_type(
    df: DataFrame,
    train: DataFrame,
    models: dict[str, Column | str],
    decision: str | None = None,
    include_normal: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """``detection_by_type`` with each label tagged shared / test_only. ``normal`` is no training
    attack type, so when kept it is tagged test_only."""
    table = detection_by_type(df, models, decision, include_normal, weight)
    return tag_group(table, attack_types(train), label="attack_type")


def detection_within(
    df: DataFrame, types: DataFrame, predicted: Column | str, weight: str | None = None
) -> DataFrame:
    """Per-type detection restricted to a set of types."""
    wanted = types.select(F.col("label").alias("attack_type"))
    table = detection_by_type(df, {"": predicted}, weight=weight)
    return table.join(wanted, "attack_type", "left_semi")


def detection_in_group(
    df: DataFrame,
    train: DataFrame,
    group: str,
    predicted: Column | str,
    weight: str | None = None,
) -> DataFrame:
    """Per-type detection of the ``shared`` or of the ``test_only`` types. Each input is read
    once: the types of the test side are the rows of the table itself."""
    table = grouped_detection_by_type(df, train, {"": predicted}, weight=weight)
    return table.filter(F.col("group") == group).drop("group")


def detection_by_group(
    df: DataFrame,
    train: DataFrame,
    models: dict[str, Column | str],
    decision: str | None = None,
    names: tuple[str, str] = ("SHARED", "TEST_ONLY"),
    weight: str | None = None,
) -> DataFrame:
    """Samples, detections, misses, precision, recall and f1 of the shared and the test-only
    attack types, one row per group even when a group is empty.

    Only attack rows are counted, so precision is 1 whenever anything is detected.
    """
    table = detection_by_type(df, models, decision, weight=weight)
    by_type = tag_group(table, attack_types(train), *names, label="attack_type")
    sums = [F.sum("total").alias("samples")]
    sums += [F.sum(_named(m, "detected")).alias(_named(m, "detected")) for m in models]
    sums += [F.sum("suspicious").alias("suspicious")] if decision else []
    totals = by_type.groupBy("group").agg(*sums)
    measured = [c for c in totals.columns if c != "group"]
    table = literal_rows(df, "group", list(names)).join(totals, "group", "left").fillna(0, measured)
    columns = [F.col("group"), F.col("samples")]
    for model in models:
        detected = F.col(_named(model, "detected"))
        missed = F.col("samples") - detected
        columns += [
            detected,
            missed.alias(_named(model, "missed")),
            ratios.precision(F.lit(0), detected).alias(_named(model, "precision")),
            ratios.recall(missed, detected).alias(_named(model, "recall")),
            ratios.f1(F.lit(0), missed, detected).alias(_named(model, "f1")),
        ]
    if decision:
        columns.append(F.col("suspicious"))
    return table.select(*columns)
