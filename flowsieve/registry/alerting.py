"""Queries over alerts and over the streaming jobs that write them."""

from pyspark.sql import functions as F

from flowsieve.operators import alerts
from flowsieve.registry.core import decided, only, over_flows, query, test_decisions
from flowsieve.session import scratch_path
from flowsieve.sources.alert_table import (
    alert_index,
    append_alerts,
    create_alert_table,
    read_alerts,
    stored_alert_count,
    stored_alert_page,
)
from flowsieve.sources.tables import flows_from_lines, read_table, split_of
from flowsieve.streaming.scoring import (
    latest_statistics,
    start_alerting,
    start_statistics,
    stream_files,
)

_ALERTS = """alerts AS (
  SELECT CAST('0x' || substr(md5(flow_id), 1, 15) AS BIGINT) AS id, decision, rf_probability,
    if_score, rf_prediction, if_anomaly, seen_at AS created_at, flow_id
  FROM decided WHERE decision <> 'NORMAL'
)"""
_WITHOUT_TIME = (
    "id", "decision", "rf_probability", "if_score", "rf_prediction", "if_anomaly", "flow_id"
)


def _alerts(spark, sf_dir):
    return alerts.alert_rows(test_decisions(spark, sf_dir), F.col("seen_at"))


def _stored(spark, sf_dir):
    """The alerts in a table; its path."""
    path = scratch_path(spark, "alerts")
    append_alerts(_alerts(spark, sf_dir), path, "run-1", 0)
    return path


@query(over_flows("SELECT * FROM alerts", _ALERTS))
def alert_rows(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query(over_flows(f"SELECT {', '.join(_WITHOUT_TIME)} FROM alerts", _ALERTS))
def stored_alerts(spark, sf_dir):
    path = scratch_path(spark, "alerts")
    create_alert_table(spark, path)
    new = alerts.alert_rows(test_decisions(spark, sf_dir))
    append_alerts(new, path, "run-1", 0)
    append_alerts(new, path, "run-1", 0)
    return only(read_alerts(spark, path), *_WITHOUT_TIME)


@query(over_flows(f"SELECT {', '.join(_WITHOUT_TIME)} FROM alerts", _ALERTS))
def appended_alerts(spark, sf_dir):
    """Two writers append different alerts of the same days, and one writes its batch again."""
    path = scratch_path(spark, "alerts")
    create_alert_table(spark, path)
    new = alerts.alert_rows(test_decisions(spark, sf_dir))
    attacks, others = new.filter("decision = 'ATTACK'"), new.filter("decision <> 'ATTACK'")
    append_alerts(attacks, path, "run-1", 0)
    append_alerts(others, path, "run-2", 0)
    append_alerts(attacks, path, "run-1", 0)
    return only(read_alerts(spark, path), *_WITHOUT_TIME)


@query(over_flows("SELECT * FROM alerts WHERE decision = 'SUSPICIOUS'", _ALERTS))
def filtered_alerts(spark, sf_dir):
    return alerts.filter_alerts(_alerts(spark, sf_dir), "suspicious")


@query(over_flows('SELECT count(*) AS "count" FROM alerts WHERE decision = \'ATTACK\'', _ALERTS))
def alert_count(spark, sf_dir):
    return alerts.alert_count(_alerts(spark, sf_dir), "attack")


@query(
    over_flows(
        """SELECT *, row_number() OVER (ORDER BY created_at DESC, id DESC, flow_id DESC) AS place
FROM alerts QUALIFY place BETWEEN 101 AND 150""",
        _ALERTS,
    )
)
def alert_page(spark, sf_dir):
    """A page of the stored table: located in its index, read from the days it lies in."""
    return stored_alert_page(spark, _stored(spark, sf_dir), limit=50, offset=100)


@query(
    over_flows(
        """SELECT *, row_number() OVER (ORDER BY created_at DESC, id DESC, flow_id DESC) AS place
FROM alerts QUALIFY place BETWEEN 10501 AND 10550""",
        _ALERTS,
    )
)
def deep_alert_page(spark, sf_dir):
    """A page far from the newest alert, of alerts that are not stored."""
    return alerts.alert_page(_alerts(spark, sf_dir), limit=50, offset=10_500)


@query(
    over_flows(
        """SELECT * FROM (
  SELECT *, row_number() OVER (ORDER BY created_at DESC, id DESC, flow_id DESC) AS place
  FROM alerts WHERE decision = 'SUSPICIOUS')
WHERE place > (SELECT count(*) FROM alerts WHERE decision = 'SUSPICIOUS') - 60""",
        _ALERTS,
    )
)
def last_stored_alerts(spark, sf_dir):
    """The stored table's last page of one decision, whose place is read from the index."""
    path = _stored(spark, sf_dir)
    n = stored_alert_count(spark, path, "suspicious").first()["count"]
    return stored_alert_page(spark, path, limit=60, offset=max(0, n - 60), decision="suspicious")


@query(over_flows("SELECT decision, count(*) AS alerts FROM alerts GROUP BY decision", _ALERTS))
def stored_alert_counts(spark, sf_dir):
    """Alerts of each decision by the table's index."""
    index = alert_index(spark, _stored(spark, sf_dir))
    return index.groupBy("decision").agg(F.sum("alerts").alias("alerts"))


_STATISTICS = """SELECT total_flows, attacks, normal, suspicious,
  round(coalesce(CAST(attacks AS DOUBLE) / nullif(total_flows, 0), 0.0) * 100, 2) AS attack_rate
FROM (SELECT count(*) AS total_flows, count(*) FILTER (WHERE decision = 'ATTACK') AS attacks,
  count(*) FILTER (WHERE decision = 'NORMAL') AS normal,
  count(*) FILTER (WHERE decision = 'SUSPICIOUS') AS suspicious FROM {table})"""


@query(over_flows(_STATISTICS.format(table="alerts"), _ALERTS))
def alert_statistics(spark, sf_dir):
    return alerts.decision_statistics(_alerts(spark, sf_dir))


@query(over_flows(_STATISTICS.format(table="decided")))
def flow_statistics(spark, sf_dir):
    return alerts.decision_statistics(test_decisions(spark, sf_dir))


def _arriving(spark, sf_dir):
    """Decisions on the order lines read as a file stream and joined to the stored parts."""
    lines = stream_files(
        spark,
        sf_dir,
        read_table(spark, sf_dir, "lineitem").schema,
        pathGlobFilter="lineitem.parquet",
    )
    return decided(split_of(flows_from_lines(lines, read_table(spark, sf_dir, "part")), "test"))


@query(over_flows("SELECT flow_id, rf_probability, if_score, decision FROM decided"))
def streamed_decisions(spark, sf_dir):
    table = scratch_path(spark, "decisions")
    rows = only(_arriving(spark, sf_dir), "flow_id", "rf_probability", "if_score", "decision")
    writer = rows.writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(spark, "progress")
    )
    writer.trigger(availableNow=True).start(table).awaitTermination()
    return spark.read.schema(rows.schema).parquet(table)


@query(over_flows(f"SELECT {', '.join(_WITHOUT_TIME)} FROM alerts", _ALERTS))
def streamed_alerts(spark, sf_dir):
    table = scratch_path(spark, "alerts")
    create_alert_table(spark, table)
    start_alerting(
        _arriving(spark, sf_dir), table, scratch_path(spark, "progress")
    ).awaitTermination()
    return only(read_alerts(spark, table), *_WITHOUT_TIME)


@query(
    """SELECT CAST(0 AS BIGINT) AS total_flows, CAST(0 AS BIGINT) AS attacks,
  CAST(0 AS BIGINT) AS normal, CAST(0 AS BIGINT) AS suspicious, 0.0::DOUBLE AS attack_rate"""
)
def statistics_of_nothing(spark, sf_dir):
    """Statistics before anything of the flows was stored."""
    table = scratch_path(spark, "statistics")
    start_statistics(
        _arriving(spark, sf_dir).filter("flow_id IS NULL"),
        table, scratch_path(spark, "progress"), interval=None,
    ).awaitTermination()
    return latest_statistics(spark, table)


@query(over_flows(_STATISTICS.format(table="decided")))
def streamed_statistics(spark, sf_dir):
    table = scratch_path(spark, "statistics")
    start_statistics(
        _arriving(spark, sf_dir), table, scratch_path(spark, "progress"), interval=None
    ).awaitTermination()
    return latest_statistics(spark, table)
