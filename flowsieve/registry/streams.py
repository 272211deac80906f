"""Queries over streams of several files: detector scoring, rejects, statistics across a restart, and
alerts of two streams over the same flows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowsieve.functions.checks import accepted_flows, check_records
from flowsieve.plans.training import train_detector
from flowsieve.registry.alerting import _ALERTS, _STATISTICS, _WITHOUT_TIME
from flowsieve.registry.core import only, over_flows, query, test_decisions, test_flows, train_flows
from flowsieve.schema import FEATURES, SCORE_FIELDS, STREAMED_SCHEMA
from flowsieve.session import scratch_path
from flowsieve.sources.alert_table import create_alert_table, create_key_ledger, read_alerts
from flowsieve.sources.tables import read_table
from flowsieve.streaming.scoring import (
    REJECT_SCHEMA,
    latest_statistics,
    start_alerting,
    start_scoring,
    start_statistics,
    stream_files,
)

# Batches of a stream.
BATCHES = 4
# As many order lines go to one file; about a third of them are test flows.
FILE_LINES = 150_000
RECORDS = StructType([StructField("flow_id", StringType()), StructField("body", StringType())])
_RESULTS = [name for name, _ in SCORE_FIELDS]


def _bodies(spark, sf_dir) -> DataFrame:
    """JSON records of all test flows, as clients send them. Those of even ``count`` that end in 6
    lack a field, those that end in 8 have two wrong ones, and those of a ``count`` that ends in 3
    are cut off."""
    flows = test_flows(spark, sf_dir)
    last = F.col("count") % 10
    sent = F.struct(
        *[
            F.when(last == 8, F.lit(None)).otherwise(F.col(c)).alias(c) if c == "duration"
            else F.when(last == 8, "many").otherwise(F.col(c).cast("string")).alias(c) if c == "land"
            else F.when(last != 6, F.col(c)).alias(c) if c == "service"
            else F.col(c)
            for c in FEATURES
        ]
    )
    body = F.to_json(sent)
    # Numbers that travel as text would be of the wrong type in every record.
    body = F.regexp_replace(body, r'"land":"(\d[^"]*)"', r'"land":$1')
    return flows.select("flow_id", F.when(last == 3, F.substring(body, 1, 40)).otherwise(body).alias("body"))


def _arrive(frame: DataFrame, folder: str, lines: int, batches: int = BATCHES) -> None:
    """Add a frame made of ``lines`` order lines to a folder as a multiple of ``batches`` files, dealt by
    flow. A file is written by one task, so their number grows with the lines."""
    files = batches * max(1, math.ceil(lines / (BATCHES * FILE_LINES)))
    frame.repartition(files, "flow_id").write.mode("append").parquet(folder)


def _lines(spark, sf_dir) -> int:
    """Order lines of the table; its files tell, no column is read."""
    return read_table(spark, sf_dir, "lineitem").count()


def _stream(spark, folder: str, schema: StructType, batches: int = BATCHES) -> DataFrame:
    """The folder's files as a stream that takes them in ``batches`` even shares."""
    files = len(spark.read.schema(schema).parquet(folder).inputFiles())
    return stream_files(spark, folder, schema, maxFilesPerTrigger=max(1, math.ceil(files / batches)))


def _small_detector(spark, sf_dir):
    return train_detector(train_flows(spark, sf_dir), 10, 25, max_depth=6)


def _scored_stream(spark, sf_dir):
    """All records through the scoring stream in ``BATCHES`` batches: paths of its two tables, the detector
    and the folder of the records."""
    folder, scored, rejected = (scratch_path(spark, n) for n in ("records", "scored", "rejected"))
    _arrive(_bodies(spark, sf_dir), folder, _lines(spark, sf_dir))
    detector = _small_detector(spark, sf_dir)
    records = _stream(spark, folder, RECORDS)
    start_scoring(records, detector, scored, rejected, scratch_path(spark, "progress")).awaitTermination()
    return scored, rejected, detector, folder


_REJECTED = """rejected AS (
  SELECT flow_id, CASE "count" % 10 WHEN 6 THEN 'service' WHEN 8 THEN 'duration,land' ELSE 'cut' END AS invalid
  FROM test WHERE "count" % 10 IN (3, 6, 8)
)"""


@query(
    over_flows(
        """SELECT flow_id, true AS as_in_batch FROM test
WHERE flow_id NOT IN (SELECT flow_id FROM rejected)""",
        _REJECTED,
    )
)
def streamed_detector_rows(spark, sf_dir):
    """Every accepted record of a stream of several batches, and whether the stored results are those
    of batch scoring. A record that is stored twice or not at all gives a row too many or too few."""
    scored, _, detector, folder = _scored_stream(spark, sf_dir)
    streamed = spark.read.schema(STREAMED_SCHEMA).parquet(scored)
    records = spark.read.schema(RECORDS).parquet(folder)
    batch = detector.score(accepted_flows(check_records(records), keep=("flow_id",)))
    ours = streamed.select("flow_id", F.struct(*_RESULTS).alias("streamed"))
    theirs = batch.select("flow_id", F.struct(*_RESULTS).alias("batch"))
    return ours.join(theirs, "flow_id", "full").select(
        "flow_id", F.col("streamed").eqNullSafe(F.col("batch")).alias("as_in_batch")
    )


@query(over_flows("SELECT flow_id, invalid FROM rejected", _REJECTED))
def streamed_rejects(spark, sf_dir):
    """Every rejected record of the stream with its bad fields; one that is cut off has them all wrong
    from the cut on."""
    _, rejected, _, _ = _scored_stream(spark, sf_dir)
    stored = spark.read.schema(REJECT_SCHEMA).parquet(rejected)
    whole = F.col("body").endswith("}")
    return stored.select(
        "flow_id", F.when(whole, F.array_join("invalid_fields", ",")).otherwise("cut").alias("invalid")
    )


def _decided_files(spark, sf_dir, folder: str, parts: range) -> None:
    """The test flows' decisions of some of ``BATCHES`` parts, which a stream takes a batch each."""
    rows = test_decisions(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("flow_id"), F.lit(BATCHES)))
    _arrive(rows.filter(F.col("part").between(parts[0], parts[-1])).drop("part"), folder, _lines(spark, sf_dir), len(parts))


@query(over_flows(_STATISTICS.format(table="decided")))
def restarted_statistics(spark, sf_dir):
    """Statistics of a stream that stops after two of four batches and goes on from its checkpoint: the
    first two are counted from the state store, not read again."""
    folder, table, progress = (scratch_path(spark, n) for n in ("decided", "statistics", "progress"))
    schema = test_decisions(spark, sf_dir).schema
    for parts in (range(0, 2), range(2, 4)):
        _decided_files(spark, sf_dir, folder, parts)
        rows = _stream(spark, folder, schema, parts.stop)
        start_statistics(rows, table, progress, interval=None).awaitTermination()
    return latest_statistics(spark, table)


@query(over_flows("SELECT decision, count(*) AS flows FROM decided GROUP BY decision"))
def running_statistics(spark, sf_dir):
    """Statistics after every batch of a running input: they grow from batch to batch, and the last ones
    count every flow."""
    folder, table, progress = (scratch_path(spark, n) for n in ("decided", "statistics", "progress"))
    _decided_files(spark, sf_dir, folder, range(BATCHES))
    rows = _stream(spark, folder, test_decisions(spark, sf_dir).schema)
    start_statistics(rows, table, progress, interval=None).awaitTermination()
    last = latest_statistics(spark, table)
    kinds = {"ATTACK": "attacks", "NORMAL": "normal", "SUSPICIOUS": "suspicious"}
    pairs = [F.struct(F.lit(k).alias("decision"), F.col(c).alias("flows")) for k, c in kinds.items()]
    return last.select(F.inline(F.array(*pairs))).filter("flows > 0")


@query(over_flows(f"SELECT {', '.join(_WITHOUT_TIME)} FROM alerts", _ALERTS))
def alerts_of_two_streams(spark, sf_dir):
    """Two streams over the same flows, one of them started again: one alert a flow."""
    folder, table, ledger = (scratch_path(spark, n) for n in ("decided", "alerts", "alert-keys"))
    create_alert_table(spark, table)
    create_key_ledger(spark, ledger)
    schema = test_decisions(spark, sf_dir).schema
    first, second = (scratch_path(spark, "progress") for _ in range(2))
    for parts, streams in ((range(0, 2), (first,)), (range(2, 4), (second, first))):
        _decided_files(spark, sf_dir, folder, parts)
        for progress in streams:
            rows = _stream(spark, folder, schema, parts.stop)
            start_alerting(rows, table, progress, ledger=ledger).awaitTermination()
    return only(read_alerts(spark, table), *_WITHOUT_TIME)


