import pytest
from pyspark.sql import functions as F

from flowsieve.operators import alerts
from flowsieve.operators.alerts import alert_rows, decision_statistics
from flowsieve.plans.training import train_detector
from flowsieve.registry.core import decided, train_flows
from flowsieve.schema import FEATURES, STREAMED_SCHEMA
from flowsieve.sources.alert_table import (
    append_alerts,
    claimed,
    create_alert_table,
    create_key_ledger,
    read_alerts,
    stored_alert_count,
    stored_alert_page,
    unique_alerts,
)
from flowsieve.streaming.scoring import (
    REJECT_SCHEMA,
    latest_statistics,
    start_alerting,
    start_scoring,
    start_statistics,
    stream_files,
)


def test_table_is_created_once(spark, some_flows, tmp_path):
    path = str(tmp_path / "alerts")
    create_alert_table(spark, path)
    assert read_alerts(spark, path).count() == 0
    rows = alert_rows(decided(some_flows))
    append_alerts(rows, path, "a", 1)
    create_alert_table(spark, path)
    expected = rows.count()
    assert read_alerts(spark, path).count() == expected
    append_alerts(rows, path, "a", 1)
    assert read_alerts(spark, path).count() == expected
    append_alerts(rows.limit(3), path, "a", 2)
    append_alerts(rows.limit(2), path, "b", 1)
    assert read_alerts(spark, path).count() == expected + 5
    with pytest.raises(ValueError):
        append_alerts(rows, path, "", 0)


def test_normal_rows_raise_no_alert(some_flows):
    rows = alert_rows(decided(some_flows))
    assert rows.filter("decision = 'NORMAL'").count() == 0
    assert rows.filter("id < 0 or id is null or created_at is null").count() == 0
    assert rows.select("id").distinct().count() == rows.count()


def _arrivals(spark, some_flows, folder):
    decided(some_flows).select(
        "flow_id", "decision", "rf_probability", "rf_prediction", "if_score", "if_anomaly"
    ).repartition(4).write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    return stream_files(spark, folder, schema, maxFilesPerTrigger=1)


def test_streamed_alerts_survive_a_restart(spark, some_flows, tmp_path):
    stream = _arrivals(spark, some_flows, str(tmp_path / "in"))
    table, progress = str(tmp_path / "alerts"), str(tmp_path / "progress")
    create_alert_table(spark, table)
    start_alerting(stream, table, progress).awaitTermination()
    expected = alert_rows(decided(some_flows)).count()
    stored = read_alerts(spark, table)
    assert stored.count() == expected
    assert stored.select("created_at").distinct().count() == 4
    times = {r[0] for r in stored.select("created_at").distinct().collect()}
    # Forget that the last batch was committed: it runs again and replaces itself.
    commits = sorted((tmp_path / "progress" / "commits").glob("[0-9]*"))
    last = commits[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    start_alerting(stream, table, progress).awaitTermination()
    again = read_alerts(spark, table)
    assert again.count() == expected
    assert {r[0] for r in again.select("created_at").distinct().collect()} == times


def test_statistics_follow_the_stream(spark, some_flows, tmp_path):
    stream = _arrivals(spark, some_flows, str(tmp_path / "in"))
    table = str(tmp_path / "statistics")
    start_statistics(stream, table, str(tmp_path / "progress"), interval=None).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    assert latest_statistics(spark, table).collect() == (
        decision_statistics(decided(some_flows)).collect()
    )
    assert latest_statistics(spark, table).select(F.col("attack_rate") > 0).first()[0]


def _forget_last_commit(progress):
    """Forget that the last batch was committed: it runs again."""
    last = sorted((progress / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)


@pytest.fixture(scope="module")
def detector(spark, sf_dir):
    return train_detector(train_flows(spark, sf_dir), 3, 5, max_depth=3)


def test_scoring_stream_stores_each_record_once(spark, some_flows, detector, tmp_path):
    good = some_flows.limit(40).select("flow_id", F.to_json(F.struct(*FEATURES)).alias("body"))
    bad = spark.createDataFrame(
        [("b1", "{"), ("b2", None), ("b3", '{"duration": 1}'), ("b4", "[]"), ("b5", "")], "flow_id string, body string"
    )
    folder = str(tmp_path / "in")
    for part in (good.filter("flow_id < '8'"), good.filter("flow_id >= '8'"), bad):
        part.coalesce(1).write.mode("append").parquet(folder)
    scored, rejected, progress = (str(tmp_path / n) for n in ("scored", "rejected", "progress"))

    def run():
        records = stream_files(spark, folder, good.schema, maxFilesPerTrigger=1)
        query = start_scoring(records, detector, scored, rejected, progress)
        query.awaitTermination()
        rows = spark.read.schema(STREAMED_SCHEMA).parquet(scored).drop("batch_id")
        faults = spark.read.schema(REJECT_SCHEMA).parquet(rejected)
        return query, sorted(rows.collect()), sorted((r.flow_id, tuple(r.invalid_fields)) for r in faults.collect())

    query, rows, faults = run()
    assert query.lastProgress["batchId"] >= 2
    batch = detector.score(some_flows.limit(40).select("flow_id", *FEATURES))
    assert rows == sorted(batch.select(*STREAMED_SCHEMA.names[:-1]).collect())
    assert [f for f, _ in faults] == ["b1", "b2", "b3", "b4", "b5"]
    assert dict(faults)["b3"] == tuple(FEATURES[1:])
    # The last batch runs again and replaces itself in both tables.
    _forget_last_commit(tmp_path / "progress")
    assert run()[1:] == (rows, faults)


def test_statistics_go_on_from_the_state_after_a_restart(spark, some_flows, tmp_path):
    rows = decided(some_flows).select("flow_id", "decision")
    folder, table, progress = (str(tmp_path / n) for n in ("in", "statistics", "progress"))
    counts = []
    for low, high in (("0", "4"), ("4", "8"), ("8", "g")):
        rows.filter(F.col("flow_id").between(low, high)).coalesce(2).write.mode("append").parquet(folder)
        stream = stream_files(spark, folder, rows.schema, maxFilesPerTrigger=1)
        query = start_statistics(stream, table, progress, interval=None)
        query.awaitTermination()
        # The last run has only seen its own files: what came before is in the state store.
        assert sum(p["numInputRows"] for p in query.recentProgress) < rows.count() or not counts
        counts.append(latest_statistics(spark, table).first()["total_flows"])
    assert counts == sorted(counts) and counts[-1] == rows.count()
    assert latest_statistics(spark, table).collect() == decision_statistics(rows).collect()


def test_writers_with_one_ledger_alert_a_flow_once(spark, some_flows, tmp_path):
    path, ledger = str(tmp_path / "alerts"), str(tmp_path / "keys")
    create_alert_table(spark, path)
    create_key_ledger(spark, ledger)
    rows = alert_rows(decided(some_flows)).persist()
    half = rows.filter("flow_id < '8'")
    append_alerts(half, path, "a", 0, ledger)
    append_alerts(half, path, "a", 0, ledger)
    append_alerts(rows.unionByName(rows.limit(20)), path, "b", 0, ledger)
    append_alerts(rows, path, "a", 1, ledger)
    stored = read_alerts(spark, path)
    assert stored.count() == rows.count() == stored.select("flow_id").distinct().count()
    by_writer = {r[0]: r[1] for r in spark.read.parquet(path).groupBy("writer_id").count().collect()}
    assert by_writer == {"a": half.count(), "b": rows.count() - half.count()}
    # A batch that claimed its flows and failed before it wrote them writes them when it runs again.
    more = rows.limit(5).withColumn("flow_id", F.concat(F.lit("new"), "flow_id"))
    claimed(more, ledger, "a", 2)
    append_alerts(more, path, "b", 1, ledger)
    append_alerts(more, path, "a", 2, ledger)
    assert read_alerts(spark, path).filter("flow_id like 'new%'").count() == 5
    assert spark.read.parquet(path).filter("flow_id like 'new%' and writer_id = 'b'").count() == 0
    assert unique_alerts(rows.unionByName(rows)).exceptAll(rows).count() == 0


@pytest.mark.parametrize("ranked", [7, 100_000])
def test_stored_pages_are_slices_of_the_whole_order(spark, some_flows, tmp_path, monkeypatch, ranked):
    monkeypatch.setattr(alerts, "RANKED", ranked)
    path = str(tmp_path / "alerts")
    seen = F.timestamp_seconds(F.pmod(F.xxhash64("flow_id"), F.lit(9)) * 86_400 * 20 + F.pmod(F.crc32("flow_id"), F.lit(3)))
    rows = alert_rows(decided(some_flows), seen).persist()
    append_alerts(rows.filter("flow_id < '5'"), path, "a", 0)
    append_alerts(rows.filter("flow_id >= '5'"), path, "b", 0)
    whole = sorted(rows.collect(), key=lambda r: (r.created_at, r.id, r.flow_id), reverse=True)
    for offset in (0, 3, len(whole) // 2, len(whole) - 4, len(whole)):
        page = stored_alert_page(spark, path, 30, offset)
        assert page.drop("place").collect() == whole[offset : offset + 30]
        assert [r.place for r in page.collect()] == list(range(offset + 1, min(offset + 30, len(whole)) + 1))
    chosen = [r for r in whole if r.decision == "SUSPICIOUS"]
    assert stored_alert_page(spark, path, 20, 10, "suspicious").drop("place").collect() == chosen[10:30]
    assert stored_alert_count(spark, path, "suspicious").first()["count"] == len(chosen)
    plan = stored_alert_page(spark, path, 30, 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(alert_month" in plan
    assert "GreaterThanOrEqual(created_at" in plan


def test_pages_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "alerts")
    create_alert_table(spark, path)
    assert stored_alert_page(spark, path).count() == 0
    assert stored_alert_count(spark, path).first()["count"] == 0
