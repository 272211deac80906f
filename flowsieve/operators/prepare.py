"""From raw records to prepared flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.text import strip_whitespace
from flowsieve.schema import CATEGORICAL, NORMAL_LABEL

TEXT_COLUMNS = [*CATEGORICAL, "label"]
# Copies of one record are numbered in blocks, so that no task has to number a hot record alone.
COPY_BLOCK = 10_000


def strip_text(df: DataFrame, columns: list[str] = TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({name: strip_whitespace(name) for name in columns})


def with_target(df: DataFrame) -> DataFrame:
    """1 for any label but ``normal``; like the comparison it stands for, null counts as attack."""
    return df.withColumn("target", (~F.col("label").eqNullSafe(NORMAL_LABEL)).cast("int"))


def drop_metadata(df: DataFrame, columns: tuple = ("difficulty",)) -> DataFrame:
    return df.drop(*columns)


def prepare_flows(raw: DataFrame) -> DataFrame:
    return raw.transform(strip_text).transform(with_target).transform(drop_metadata)


def with_flow_id(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Give every row an id made of its content and its number among identical rows.

    Identical rows are interchangeable, so they are counted (a partial aggregate folds the copies
    before the shuffle) and written out again with numbers 0..n-1, block by block, so that the
    copies of one record spread over tasks. The ids do not depend on file order, partitioning or
    retries.
    """
    columns = columns or df.columns
    left_out = [name for name in df.columns if name not in columns]
    if left_out:
        raise ValueError("Rows that agree in the given columns may differ in: " + ", ".join(left_out))
    text = [
        F.coalesce(F.col(name).cast("string"), F.lit("\u0000")) for name in columns
    ]
    counted = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("content_id", F.md5(F.concat_ws("\u0001", *text)))
    )
    blocks = counted.withColumn(
        "first",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPY_BLOCK))),
    ).hint("rebalance")
    last = F.least(F.col("first") + COPY_BLOCK, F.col("copies")) - 1
    numbered = blocks.select(
        *columns, "content_id", F.explode(F.sequence(F.col("first"), last)).alias("copy")
    )
    return numbered.select(
        F.md5(F.concat_ws("|", "content_id", F.col("copy").cast("string"))).alias("flow_id"),
        *columns,
    )


def attach_predictions(
    flows: DataFrame, predictions: DataFrame, key: str = "flow_id"
) -> DataFrame:
    """Predictions matched to their rows by key."""
    return flows.join(predictions, key)


def alignment_report(flows: DataFrame, predictions: DataFrame, key: str = "flow_id") -> DataFrame:
    """How many keys match, how many are on one side only, and how many a side has more than once.

    Each side is counted per key first, so repeated keys do not multiply. A null key matches none.
    """
    left = flows.groupBy(key).agg(F.count(F.lit(1)).alias("in_flows"))
    right = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("in_predictions"))
    flow_side = F.col("in_flows").isNotNull()
    prediction_side = F.col("in_predictions").isNotNull()
    return left.join(right, key, "full").agg(
        F.count_if(flow_side & prediction_side).alias("matched"),
        F.count_if(flow_side & ~prediction_side).alias("flows_only"),
        F.count_if(~flow_side & prediction_side).alias("predictions_only"),
        F.count_if(F.col("in_flows") > 1).alias("repeated_flows"),
        F.count_if(F.col("in_predictions") > 1).alias("repeated_predictions"),
    )


def require_aligned(flows: DataFrame, predictions: DataFrame, key: str = "flow_id") -> DataFrame:
    """The matched rows; raises if either side has keys without a partner or more than once. Runs a
    job."""
    report = alignment_report(flows, predictions, key).first()
    if report["flows_only"] or report["predictions_only"]:
        raise ValueError(
            f"Predictions do not match the flows: {report['flows_only']} flows and "
            f"{report['predictions_only']} predictions have no partner."
        )
    if report["repeated_flows"] or report["repeated_predictions"]:
        raise ValueError(
            f"Keys occur more than once: {report['repeated_flows']} of the flows and "
            f"{report['repeated_predictions']} of the predictions."
        )
    return attach_predictions(flows, predictions, key)
