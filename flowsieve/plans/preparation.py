"""The preparation job: raw record files to stored prepared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsieve.operators.counts import quality_table
from flowsieve.operators.prepare import prepare_flows, with_flow_id
from flowsieve.sources.flow_files import read_flows, read_raw_flows, write_prepared


def prepare_files(
    spark: SparkSession, train_path: str, test_path: str, root: str
) -> dict[str, DataFrame]:
    """Read, prepare, give ids, store both splits and read them back."""
    train = with_flow_id(prepare_flows(read_raw_flows(spark, train_path)))
    test = with_flow_id(prepare_flows(read_raw_flows(spark, test_path)))
    paths = write_prepared(train, test, root)
    return {name: read_flows(spark, path) for name, path in paths.items()}


def quality_report(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: quality_table(table) for name, table in tables.items()}
