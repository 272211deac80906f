"""Stored result tables and report files. All of them are small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.functions.checks import require_columns
from flowsieve.schema import RESULT_SCHEMAS
from flowsieve.sources.flow_files import read_if_exists


def _columns(name: str) -> list[str]:
    return [part.split()[0] for part in RESULT_SCHEMAS[name].split(", ")]


def shape_result(df: DataFrame, name: str) -> DataFrame:
    """Column order and names of the stored table."""
    return require_columns(df, _columns(name)).select(*_columns(name))


def write_result(
    df: DataFrame, root: str, name: str, order_by: list | None = None, fmt: str = "csv"
) -> str:
    """Write one result table as a single file; only the finished rows move to one task."""
    single = shape_result(df, name).repartition(1)
    if order_by:
        single = single.sortWithinPartitions(*order_by)
    path = f"{root.rstrip('/')}/{name}"
    writer = single.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def read_result(
    spark: SparkSession, root: str, name: str, fmt: str = "csv"
) -> DataFrame | None:
    return read_if_exists(spark, f"{root.rstrip('/')}/{name}", fmt, RESULT_SCHEMAS[name])


def metrics_document(metrics: DataFrame, model: str, dataset: str) -> DataFrame:
    """One nested record: accuracy, both classes' metrics and the 2x2 matrix.

    ``metrics`` holds one row with tn, fp, fn, tp and the per-class ratio columns.
    """

    def block(prefix: str):
        return F.struct(
            F.col(f"{prefix}_precision").alias("precision"),
            F.col(f"{prefix}_recall").alias("recall"),
            F.col(f"{prefix}_f1").alias("f1_score"),
        )

    return metrics.select(
        F.lit(model).alias("model"),
        F.lit(dataset).alias("dataset"),
        "accuracy",
        block("normal").alias("normal"),
        block("attack").alias("attack"),
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"),
    )


def write_metrics_json(document: DataFrame, path: str) -> None:
    document.repartition(1).write.mode("overwrite").json(path)


def report_lines(report: DataFrame) -> DataFrame:
    """Text lines of a classification report, numbered in print order."""
    number = "%12s  %9.2f %9.2f %9.2f %9d"
    line = F.when(
        F.col("section") == "accuracy",
        F.format_string(
            "%12s  %9s %9s %9.2f %9d",
            "section", F.lit(""), F.lit(""), F.col("f1_score"), F.col("support"),
        ),
    ).otherwise(F.format_string(number, "section", "precision", "recall", "f1_score", "support"))
    header = F.format_string(
        "%12s  %9s %9s %9s %9s",
        F.lit(""), F.lit("precision"), F.lit("recall"), F.lit("f1-score"), F.lit("support"),
    )
    position = F.col("position")
    return report.select(
        F.inline(
            F.when(
                position == 1,
                F.array(
                    F.struct(F.lit(0).alias("line_no"), header.alias("value")),
                    F.struct(F.lit(1).alias("line_no"), F.lit("").alias("value")),
                    F.struct(F.lit(2).alias("line_no"), line.alias("value")),
                ),
            )
            .when(
                position == 3,
                F.array(
                    F.struct(F.lit(4).alias("line_no"), F.lit("").alias("value")),
                    F.struct(F.lit(5).alias("line_no"), line.alias("value")),
                ),
            )
            .otherwise(
                F.array(
                    F.struct(
                        F.when(position == 2, 3).otherwise(position + 2).alias("line_no"),
                        line.alias("value"),
                    )
                )
            )
        )
    )


def write_report_text(report: DataFrame, path: str) -> None:
    (
        report_lines(report)
        .repartition(1)
        .sortWithinPartitions("line_no")
        .select("value")
        .write.mode("overwrite")
        .text(path)
    )
