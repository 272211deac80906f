"""The stored alert table: Parquet files partitioned by month, writer and writing batch.

Beside the alerts, in a folder readers of the table do not see, every append keeps an index: how many
alerts of each decision it added to each day. A page is located in the index and reads the partitions
and row groups of its days only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.operators.alerts import filter_alerts, newest_places
from flowsieve.schema import ALERT_SCHEMA
from flowsieve.sources.flow_files import read_if_exists

PARTITIONS = ["alert_month", "writer_id", "batch_id"]
INDEX_PARTITIONS = ["writer_id", "batch_id"]
_WRITER_FIELDS = [T.StructField("writer_id", T.StringType()), T.StructField("batch_id", T.LongType())]
TABLE_SCHEMA = T.StructType([*ALERT_SCHEMA.fields, T.StructField("alert_month", T.DateType()), *_WRITER_FIELDS])
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("alert_date", T.DateType()),
        T.StructField("decision", T.StringType()),
        T.StructField("alerts", T.LongType()),
        *_WRITER_FIELDS,
    ]
)
LEDGER_SCHEMA = "flow_id string, bucket int, writer_id string, batch_id bigint"
LEDGER_PARTITIONS = ["bucket", "writer_id", "batch_id"]
BUCKETS = 16
# A micro-batch of at most this many keys is sent to the ledger; a larger one meets it by a shuffle.
SENT_KEYS = 500_000


def _index_path(path: str) -> str:
    """Names that begin with an underscore are not part of a table."""
    return f"{path.rstrip('/')}/_counts"


def _create(spark: SparkSession, path: str, schema, partitions: list[str]) -> None:
    if read_if_exists(spark, path, schema=schema) is None:
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").partitionBy(*partitions).parquet(path)


def create_alert_table(spark: SparkSession, path: str) -> None:
    """Create an empty table unless there is one."""
    _create(spark, path, TABLE_SCHEMA, PARTITIONS)


def create_key_ledger(spark: SparkSession, path: str) -> None:
    """Create an empty ledger of alerted flows unless there is one."""
    _create(spark, path, LEDGER_SCHEMA, LEDGER_PARTITIONS)


def _replace(rows: DataFrame, path: str, partitions: list[str]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def append_alerts(
    alerts: DataFrame, path: str, writer_id: str, batch_id: int, ledger: str | None = None
) -> None:
    """Add one batch of one writer's alerts. Writing the same batch again replaces it.

    A writer is a stream (known by its checkpoint) or one run of a batch job; writers never touch
    each other's alerts, whatever their batch numbers. With a ``ledger`` that several writers share,
    flows that another batch has alerted already are left out (see ``claimed``).
    """
    if not writer_id:
        raise ValueError("writer_id must not be empty")
    if ledger:
        alerts = claimed(alerts, ledger, writer_id, batch_id)
    dated = alerts.withColumn("alert_month", F.trunc(F.to_date("created_at"), "month"))
    # Few files a month; one with very many alerts is split over several tasks.
    _replace(_marked(dated.hint("rebalance", "alert_month"), writer_id, batch_id), path, PARTITIONS)
    spark = alerts.sparkSession
    own = spark.read.schema(TABLE_SCHEMA).parquet(path).filter(
        (F.col("writer_id") == writer_id) & (F.col("batch_id") == batch_id)
    )
    counts = own.groupBy(F.to_date("created_at").alias("alert_date"), "decision").agg(F.count(F.lit(1)).alias("alerts"))
    _replace(_marked(counts, writer_id, batch_id).coalesce(1), _index_path(path), INDEX_PARTITIONS)


def _marked(rows: DataFrame, writer_id: str, batch_id: int) -> DataFrame:
    return rows.withColumn("writer_id", F.lit(writer_id)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def claimed(alerts: DataFrame, ledger: str, writer_id: str, batch_id: int) -> DataFrame:
    """The alerts of flows that no other batch of any writer has claimed; they are claimed for this
    one.

    A flow that comes twice in the batch is alerted once. A replayed batch finds its own claims and
    keeps them, so what a failed attempt claimed is written by the next. Batches of two writers
    that look at the same moment may both claim a flow; ``unique_alerts`` folds such pairs.
    """
    spark = alerts.sparkSession
    one = alerts.dropDuplicates(["flow_id"])
    kept = one.persist()
    try:
        own = (F.col("writer_id") == writer_id) & (F.col("batch_id") == batch_id)
        others = spark.read.schema(LEDGER_SCHEMA).parquet(ledger).filter(~own).select("flow_id")
        keys = kept.select("flow_id")
        keys = F.broadcast(keys) if keys.count() <= SENT_KEYS else keys
        taken = others.join(keys, "flow_id", "left_semi").distinct()
        bucket = F.pmod(F.xxhash64("flow_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
        free = kept.join(taken, "flow_id", "left_anti").select("flow_id", bucket)
        _replace(_marked(free.hint("rebalance", "bucket"), writer_id, batch_id), ledger, LEDGER_PARTITIONS)
    finally:
        kept.unpersist()
    mine = spark.read.schema(LEDGER_SCHEMA).parquet(ledger).filter(own).select("flow_id")
    return one.join(mine, "flow_id", "left_semi").select(*alerts.columns)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(path).select(*ALERT_SCHEMA.names)


def unique_alerts(alerts: DataFrame) -> DataFrame:
    """The earliest alert of each flow."""
    row = F.struct(*ALERT_SCHEMA.names)
    return alerts.groupBy("flow_id").agg(F.min_by(row, F.struct("created_at", "decision", "rf_probability", "if_score")).alias("row")).select("row.*")


def alert_index(spark: SparkSession, path: str) -> DataFrame:
    """Alerts of each decision that each batch added to each day."""
    stored = read_if_exists(spark, _index_path(path), schema=INDEX_SCHEMA)
    return spark.createDataFrame([], INDEX_SCHEMA) if stored is None else stored


def stored_alert_count(spark: SparkSession, path: str, decision: str | None = None) -> DataFrame:
    """Number of stored alerts, from the index alone."""
    found = filter_alerts(alert_index(spark, path), decision)
    return found.agg(F.coalesce(F.sum("alerts"), F.lit(0).cast("bigint")).alias("count"))


def stored_alert_page(
    spark: SparkSession, path: str, limit: int = 50, offset: int = 0, decision: str | None = None
) -> DataFrame:
    """A page of the stored table, newest alerts first, with each one's ``place`` among all, from 1.

    The index tells which days the page lies in, ``limit`` at most; the scan reads the partitions of
    their months and, of these, the row groups of the days, and the page is found in them as in
    ``operators.alerts.alert_page``.
    """
    by_day = filter_alerts(alert_index(spark, path), decision).groupBy("alert_date").agg(F.sum("alerts").alias("n"))
    # One row a day, in falling order: what the index of a table of any size folds to.
    days, before, wanted, first = by_day.orderBy(F.desc("alert_date")), 0, [], 0
    for day in days.toLocalIterator():
        if before >= offset + limit:
            break
        if before + day["n"] > offset:
            first = before if not wanted else first
            wanted.append((day["alert_date"], day["n"]))
        before += day["n"]
    rows = spark.read.schema(TABLE_SCHEMA).parquet(path)
    if wanted:
        low, high = wanted[-1][0], wanted[0][0]
        months = F.col("alert_month").between(F.lit(low.replace(day=1)), F.lit(high.replace(day=1)))
        next_day = F.date_add(F.lit(high), 1).cast("timestamp")
        rows = rows.filter(months & (F.col("created_at") >= F.lit(low).cast("timestamp")) & (F.col("created_at") < next_day))
    rows = filter_alerts(rows, decision)
    return newest_places(rows.select(*ALERT_SCHEMA.names), limit, offset, first, sum(n for _, n in wanted))
