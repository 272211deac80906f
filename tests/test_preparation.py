import json

import pytest
from pyspark.sql import functions as F

from flowsieve.functions import checks
from flowsieve.functions.text import contains_ignore_case, strip_whitespace
from flowsieve.operators import prepare
from flowsieve.plans.preparation import prepare_files, quality_report
from flowsieve.schema import FEATURES, FLOW_FIELDS, NUMERIC
from flowsieve.session import clear_scratch, scratch_path, shared_folder, work_folder
from flowsieve.sources.flow_files import read_flows, read_if_exists, read_raw_flows
from flowsieve.sources.results import read_result, write_result

# The sample flow record of the service tests; every other number is zero.
SAMPLE = {name: 0 for name, _ in FLOW_FIELDS} | {
    "protocol_type": "tcp", "service": "private", "flag": "REJ", "count": 229, "srv_count": 10,
    "rerror_rate": 1.0, "srv_rerror_rate": 1.0, "same_srv_rate": 0.04, "diff_srv_rate": 0.06,
    "dst_host_count": 255, "dst_host_srv_count": 10, "dst_host_same_srv_rate": 0.04,
    "dst_host_diff_srv_rate": 0.06, "dst_host_rerror_rate": 1.0, "dst_host_srv_rerror_rate": 1.0,
}


def test_feature_lists():
    assert len(FEATURES) == 41 and len(NUMERIC) == 38
    assert checks.numeric_columns(FEATURES) == NUMERIC


@pytest.mark.parametrize("text", ["  tcp", "tcp\n", "\t tcp \r\n", " tcp ", "\x1ftcp", "t cp "])
def test_strip_is_python_strip(spark, text):
    frame = spark.createDataFrame([(text,)], "t string").select(strip_whitespace("t").alias("t"))
    assert frame.first()["t"] == text.strip()


def test_missing_columns_are_all_named(spark):
    frame = spark.createDataFrame([(1,)], "duration int")
    with pytest.raises(ValueError) as error:
        checks.require_columns(frame, ["duration", "service", "flag"])
    assert str(error.value) == "Missing required features: service, flag"


def test_first_present(spark):
    frame = spark.createDataFrame([(1, 2)], "f1 int, recall int")
    assert checks.first_present(frame, ["attack_f1", "f1"]) == "f1"
    assert checks.first_present(frame, ["nothing"]) is None


def test_substring_match_treats_null_as_no_match(spark):
    frame = spark.createDataFrame([("The RANDOM forest",), (None,), ("svm",)], "model string")
    rows = frame.select(contains_ignore_case("model", "Random Forest").alias("m")).collect()
    assert [row["m"] for row in rows] == [True, False, False]


def test_records(spark):
    missing = {k: v for k, v in SAMPLE.items() if k not in ("service", "hot")}
    bodies = [
        ("good", json.dumps(SAMPLE)),
        ("missing", json.dumps(missing)),
        ("typed", json.dumps(SAMPLE | {"src_bytes": "many"})),
        ("fraction", json.dumps(SAMPLE | {"count": 1.5})),
        ("null", json.dumps(SAMPLE | {"flag": None})),
        ("nan", json.dumps(SAMPLE).replace('"duration": 0', '"duration": "NaN"')),
        ("text", "not a record"),
        ("absent", None),
        ("extra", json.dumps(SAMPLE | {"unknown": 1})),
    ]
    checked = checks.check_records(spark.createDataFrame(bodies, "flow_id string, body string"))
    got = {r["flow_id"]: (r["accepted"], r["invalid_fields"]) for r in checked.collect()}
    assert got["good"] == (True, []) and got["extra"] == (True, [])
    assert got["missing"] == (False, ["service", "hot"])
    assert got["typed"] == (False, ["src_bytes"])
    assert got["fraction"] == (False, ["count"])
    assert got["null"] == (False, ["flag"])
    assert got["nan"] == (False, ["duration"])
    assert got["text"][0] is False and got["absent"][0] is False
    flows = checks.accepted_flows(checked, keep=("flow_id",))
    assert flows.columns == ["flow_id", *FEATURES]
    assert {r["flow_id"] for r in flows.collect()} == {"good", "extra"}
    assert checks.rejected_records(checked).count() == 7


def test_flow_ids_number_identical_rows(spark, monkeypatch):
    monkeypatch.setattr(prepare, "COPY_BLOCK", 4)
    rows = [("a", 1.0)] * 11 + [("b", None)] * 4 + [("c", 2.0)]
    frame = spark.createDataFrame(rows, "k string, v double")
    ids = prepare.with_flow_id(frame)
    again = prepare.with_flow_id(frame.repartition(7))
    assert ids.count() == 16 and ids.select("flow_id").distinct().count() == 16
    assert sorted(map(tuple, ids.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    assert ids.groupBy("k").count().orderBy("k").collect() == [("a", 11), ("b", 4), ("c", 1)]


def test_flow_ids_tell_null_from_text(spark):
    frame = spark.createDataFrame([(None, "x"), ("", "x"), ("x", None), ("x", "")], "a string, b string")
    assert prepare.with_flow_id(frame).select("flow_id").distinct().count() == 4


def test_target_of_missing_label_is_attack(spark):
    frame = spark.createDataFrame([("normal",), ("neptune",), (None,)], "label string")
    assert [r["target"] for r in prepare.with_target(frame).collect()] == [0, 1, 1]


def test_alignment_guard(spark):
    flows = spark.createDataFrame([("1", 0), ("2", 1)], "flow_id string, target int")
    good = spark.createDataFrame([("2", "ATTACK"), ("1", "NORMAL")], "flow_id string, decision string")
    joined = prepare.require_aligned(flows, good)
    assert {(r["flow_id"], r["decision"]) for r in joined.collect()} == {("1", "NORMAL"), ("2", "ATTACK")}
    with pytest.raises(ValueError):
        prepare.require_aligned(flows, good.filter("flow_id = '1'"))


def test_preparation_job(spark, tmp_path):
    def line(service, label):
        values = [SAMPLE[c] for c in FEATURES]
        values[2] = service
        return ",".join(str(v) for v in [*values, label, 21])

    (tmp_path / "train.txt").write_text("\n".join([line(" http", "normal "), line("ftp", "neptune")] * 2))
    (tmp_path / "test.txt").write_text(line("smtp\t", "\tmailbomb"))
    raw = read_raw_flows(spark, str(tmp_path / "train.txt"))
    assert len(raw.columns) == 43 and raw.first()["service"] == " http"
    tables = prepare_files(
        spark, str(tmp_path / "train.txt"), str(tmp_path / "test.txt"), str(tmp_path / "out")
    )
    rows = tables["train"].select("service", "label", "target").distinct().collect()
    assert {tuple(r) for r in rows} == {("http", "normal", 0), ("ftp", "neptune", 1)}
    assert tables["train"].select("flow_id").distinct().count() == 4
    quality = quality_report(tables)["train"].first()
    assert (quality["row_count"], quality["target_normal"], quality["missing_values"]) == (4, 2, 0)


def test_bad_raw_line_is_an_error(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("1,tcp,http\n")
    with pytest.raises(Exception):
        read_raw_flows(spark, str(tmp_path / "bad.txt")).collect()


def test_missing_results_are_none(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None
    assert read_result(spark, str(tmp_path), "final_ids_validation") is None


def test_result_round_trip(spark, tmp_path):
    table = spark.createDataFrame(
        [(0.1, 0.2, 0.3, 0.4, 1, 2, 3)],
        "accuracy double, precision double, recall double, f1 double, normal bigint, "
        "attack bigint, suspicious bigint",
    )
    for fmt in ("csv", "parquet"):
        write_result(table, str(tmp_path / fmt), "final_ids_validation", fmt=fmt)
        stored = read_result(spark, str(tmp_path / fmt), "final_ids_validation", fmt)
        assert stored.collect() == table.collect()
    with pytest.raises(ValueError):
        write_result(table.drop("f1"), str(tmp_path), "final_ids_validation")


def test_batch_requests(spark):
    frame = spark.createDataFrame(
        [("r", [(1, "a"), (2, "b")])], "request string, samples array<struct<count:int,flag:string>>"
    )
    rows = checks.explode_batch(frame).collect()
    assert [tuple(r) for r in rows] == [("r", 1, "a"), ("r", 2, "b")]
    assert frame.filter(F.size("samples") > 5).transform(checks.explode_batch).count() == 0


def test_guard_reports_repeated_keys(spark):
    flows = spark.createDataFrame([("a",), ("a",), ("b",)], "flow_id string")
    predictions = spark.createDataFrame([("a", 1), ("b", 0), ("b", 1)], "flow_id string, predicted int")
    with pytest.raises(ValueError, match="more than once: 1 of the flows and 1 of"):
        prepare.require_aligned(flows, predictions)
    assert prepare.require_aligned(flows.distinct(), predictions.limit(2)).count() == 2


def test_csv_is_read_by_its_header(spark, some_flows, tmp_path):
    rows = some_flows.select("target", "label", *reversed(FEATURES)).limit(50)
    rows.coalesce(1).write.option("header", True).csv(str(tmp_path / "good"))
    read = read_flows(spark, str(tmp_path / "good"), "csv")
    assert read.select(rows.columns).exceptAll(rows).count() == 0 and read.count() == rows.count()
    rows.withColumn("duration", F.lit("soon")).write.option("header", True).csv(str(tmp_path / "bad"))
    with pytest.raises(Exception):
        read_flows(spark, str(tmp_path / "bad"), "csv").collect()
    rows.withColumn("duration", F.lit("1")).write.parquet(str(tmp_path / "typed"))
    with pytest.raises(ValueError, match="duration is string"):
        read_flows(spark, str(tmp_path / "typed"))


def test_ids_need_every_column(spark):
    with pytest.raises(ValueError):
        prepare.with_flow_id(spark.range(3).withColumn("x", F.lit(1)), ["id"])


def test_work_folder_is_removed(spark):
    with work_folder(spark, "test-job") as path:
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert read_if_exists(spark, path) is None


def test_scratch_of_an_application_is_cleared(spark, tmp_path, monkeypatch):
    other = f"{shared_folder(spark)}/kept"
    spark.range(3).write.parquet(other)
    monkeypatch.setattr("flowsieve.session.shared_folder", lambda _: str(tmp_path))
    paths = [scratch_path(spark, "table") for _ in range(2)]
    for path in paths:
        spark.range(2).write.parquet(path)
    assert paths[0] != paths[1] and spark.read.parquet(paths[1]).count() == 2
    clear_scratch(spark)
    assert all(read_if_exists(spark, path) is None for path in paths)
    assert spark.read.parquet(other).count() == 3
