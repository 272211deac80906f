"""Continuous scoring and alerting with Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from flowsieve.functions.checks import accepted_flows, check_records, rejected_records
from flowsieve.ml.bundle import Detector
from flowsieve.ml.features import rebalanced
from flowsieve.operators.alerts import alert_rows, decision_statistics
from flowsieve.sources.alert_table import append_alerts
from flowsieve.sources.flow_files import read_if_exists

STATISTICS_SCHEMA = (
    "total_flows bigint, attacks bigint, normal bigint, suspicious bigint, attack_rate double, "
    "updated_at timestamp, batch_id bigint, writer_id string, slot int"
)
# What start_scoring stores of rejected records.
REJECT_SCHEMA = "flow_id string, body string, invalid_fields array<string>, batch_id bigint"
_WRITER_SCHEMA = StructType([StructField("value", StringType())])


def stream_files(
    spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", **options
) -> DataFrame:
    """Files arriving in a folder, with a fixed schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(folder)


def stream_records(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest"
) -> DataFrame:
    """JSON flow records from a Kafka topic (needs Spark's Kafka package on the cluster).

    ``flow_id`` is the record's position in the topic, which a replay does not change.
    """
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    position = F.concat_ws(
        "-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")
    )
    return records.select(position.alias("flow_id"), F.col("value").cast("string").alias("body"))


def score_records(records: DataFrame, detector: Detector) -> DataFrame:
    """Typed check of JSON records, then scoring of the accepted ones. Stateless."""
    return detector.score(accepted_flows(check_records(records), keep=("flow_id",)))


def start_scoring(
    records: DataFrame, detector: Detector, scored: str, rejected: str, checkpoint: str
) -> StreamingQuery:
    """Store the scored records of every micro-batch in one table and the rejected ones in another.

    Both are partitioned by batch, and a replayed batch replaces itself. The batch is spread over all
    tasks, however few files it came in, and kept while its two parts are written. The available input
    is processed and the query ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = rebalanced(batch).persist()
        try:
            for rows, path in (
                (score_records(batch, detector), scored),
                (rejected_records(check_records(batch)), rejected),
            ):
                _replace(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, "batch_id")
        finally:
            batch.unpersist()

    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(availableNow=True).start()


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write the partitions the rows belong to in place of what they held."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partitions
    ).parquet(path)


def stream_writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, kept in its checkpoint: a restart finds it again, a new checkpoint gets
    a new one."""
    path = f"{checkpoint.rstrip('/')}/writer"
    stored = read_if_exists(spark, path, "text", _WRITER_SCHEMA)
    found = stored.first() if stored is not None else None
    if found is None:
        own = spark.createDataFrame([(uuid.uuid4().hex,)], _WRITER_SCHEMA)
        own.coalesce(1).write.mode("overwrite").text(path)
        found = spark.read.schema(_WRITER_SCHEMA).text(path).first()
    return found["value"]


def start_alerting(
    decided: DataFrame,
    table: str,
    checkpoint: str,
    interval: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Append the alerts of every micro-batch to the alert table.

    Streams over the same flows that share a ``ledger`` alert each flow once.

    The alert time is fixed before the sink, so a replayed batch carries the time of its first
    attempt, lands in the same partition and replaces itself.
    """
    alerts = alert_rows(decided)
    writer_id = stream_writer_id(decided.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_alerts(batch, table, writer_id, batch_id, ledger)

    writer = alerts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def start_statistics(
    decided: DataFrame,
    table: str,
    checkpoint: str,
    interval: str | None = "10 seconds",
) -> StreamingQuery:
    """Keep the decision statistics current.

    A writer has two slots and its batches take them in turn, so the table stays as small as its
    writers are few and a reader always finds a finished row. Without an interval the available
    input is processed and the query ends.
    """
    statistics = decision_statistics(decided)
    writer_id = stream_writer_id(decided.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        row = batch.select(
            "*",
            F.current_timestamp().alias("updated_at"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(writer_id).alias("writer_id"),
            F.lit(batch_id % 2).cast("int").alias("slot"),
        )
        _replace(row.coalesce(1), table, "writer_id", "slot")

    writer = (
        statistics.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def latest_statistics(spark: SparkSession, table: str) -> DataFrame:
    """The newest statistics row; zeros where nothing was stored yet."""
    figures = ["total_flows", "attacks", "normal", "suspicious", "attack_rate"]
    stored = read_if_exists(spark, table, schema=STATISTICS_SCHEMA)
    if stored is None:
        stored = spark.createDataFrame([], STATISTICS_SCHEMA)
    order = F.struct("updated_at", "batch_id", "writer_id")
    newest = stored.agg(*[F.max_by(F.col(name), order).alias(name) for name in figures])
    return newest.na.fill(0)
