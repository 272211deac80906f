"""A ``flows`` table derived from the order-line tables (lineitem and part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.schema import FEATURES, FLOW_FIELDS, NORMAL_LABEL

ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flows_from_lines(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Map order lines (batch or streaming) and their parts to scored, labelled flows.

    Row-local apart from the part lookup, whose join strategy is left to the optimizer: both
    sides grow with the data, so neither is hinted.
    """
    normal = F.col("l_quantity") <= 25
    derived = {
        "duration": F.col("l_quantity"),
        "protocol_type": F.col("l_returnflag"),
        "service": F.col("p_type"),
        "flag": F.col("l_linestatus"),
        "src_bytes": F.col("l_extendedprice"),
        "dst_bytes": F.col("p_retailprice"),
        "count": F.col("p_size"),
        "serror_rate": F.col("l_discount") * 10,
        "same_srv_rate": F.col("l_tax") * 10,
    }
    features = [
        derived.get(name, F.lit(0)).cast(kind).alias(name) for name, kind in FLOW_FIELDS
    ]
    flow_id = F.md5(
        F.concat_ws(
            "|",
            *[F.col(name).cast("string") for name in ROW_KEY],
            F.col("l_quantity").cast("bigint").cast("string"),
            F.col("l_shipdate").cast("date").cast("string"),
        )
    )
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        flow_id.alias("flow_id"),
        *features,
        F.when(normal, NORMAL_LABEL).otherwise(F.lower("p_brand")).alias("label"),
        F.when(normal, 0).otherwise(1).alias("target"),
        (F.col("l_quantity") / F.lit(50.0) * F.lit(0.7) + F.col("l_discount") * F.lit(3)).alias(
            "rf_probability"
        ),
        (F.lit(0.2) - F.col("p_size") / F.lit(100.0) - F.col("l_tax")).alias("if_score"),
        # Each split has attack types of its own, so that both kinds of novelty occur.
        F.when(~normal & F.col("p_brand").endswith("5"), "test")
        .when(~normal & F.col("p_brand").endswith("1"), "train")
        .when(F.col("l_shipdate") < F.lit("2000-01-01").cast("date"), "train")
        .otherwise("test")
        .alias("split"),
        F.col("l_shipdate").cast("timestamp").alias("seen_at"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_from_lines(
        read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")
    )


def split_of(frame: DataFrame, name: str) -> DataFrame:
    return frame.filter(F.col("split") == name)


def raw_records(frame: DataFrame) -> DataFrame:
    """The 43 raw columns: features, label and a difficulty mark."""
    return frame.select(*FEATURES, "label", F.lit(21).alias("difficulty"))
