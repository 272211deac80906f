"""Flow files: headerless raw records and prepared tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from flowsieve.functions.checks import require_columns
from flowsieve.schema import FEATURES, PREPARED_SCHEMA, RAW_SCHEMA


def read_raw_flows(
    spark: SparkSession, path: str | list[str], mode: str = "FAILFAST"
) -> DataFrame:
    """Headerless comma-separated records, 43 columns, strings kept as written."""
    return (
        spark.read.schema(RAW_SCHEMA)
        .option("header", False)
        .option("mode", mode)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_flows(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: StructType = PREPARED_SCHEMA,
) -> DataFrame:
    """A prepared flow table, with or without ``flow_id``, its columns in any order.

    A CSV copy is read by the names of its header line; a field that is not of the schema's type
    stops the read. Other formats carry types, which must be the schema's.
    """
    if fmt == "csv":
        frame = read_csv_by_header(spark, path, schema)
    else:
        frame = spark.read.format(fmt).load(path)
        wrong = [
            f"{field.name} is {frame.schema[field.name].dataType.simpleString()}"
            for field in schema.fields
            if field.name in frame.columns and frame.schema[field.name].dataType != field.dataType
        ]
        if wrong:
            raise ValueError("Unexpected column types: " + ", ".join(wrong))
    return require_columns(frame, [*FEATURES, "label", "target"])


def read_csv_by_header(
    spark: SparkSession, path: str | list[str], schema: StructType
) -> DataFrame:
    """CSV files with a header line: each column gets the type the schema has for its name, columns
    the schema does not know stay text."""
    names = spark.read.option("header", True).csv(path).columns
    known = {field.name: field.dataType for field in schema.fields}
    typed = StructType([StructField(name, known.get(name, StringType())) for name in names])
    return spark.read.schema(typed).option("header", True).option("mode", "FAILFAST").csv(path)


def read_if_exists(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame | None:
    """The stored table, or None where nothing was stored."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_flows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_prepared(train: DataFrame, test: DataFrame, root: str) -> dict[str, str]:
    """Store both prepared splits; returns their paths."""
    paths = {"train": f"{root}/train", "test": f"{root}/test"}
    write_flows(train, paths["train"])
    write_flows(test, paths["test"])
    return paths


def write_scored(scored: DataFrame, path: str) -> None:
    """Row-level results, one folder per decision so that readers can prune."""
    scored.write.mode("overwrite").partitionBy("decision").parquet(path)


def write_errors(errors: DataFrame, path: str) -> None:
    errors.write.mode("overwrite").parquet(path)
