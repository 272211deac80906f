"""Published counts must give the published ratios.

Fixed values: counts and ratios of the published result tables.
"""

import pytest
from pyspark.sql import functions as F

from flowsieve.operators import coverage, detection, evaluation, reports

CLOSE = 1e-12
# model, tn, fp, fn, tp, accuracy, precision, recall, f1
MODELS = [
    ("Random Forest", 9438, 273, 4201, 8632,
     0.8015436479772888, 0.9693430656934306, 0.672640847814229, 0.7941852976354771),
    ("Isolation Forest", 9699, 12, 11086, 1747,
     0.5077182398864443, 0.9931779420125071, 0.13613340606249513, 0.23944627192982457),
]
# label, train rows, test rows
TYPES = [
    ("neptune", 41214, 4657), ("guess_passwd", 53, 1231), ("mscan", 0, 996),
    ("warezmaster", 20, 944), ("apache2", 0, 737), ("satan", 3633, 735),
    ("processtable", 0, 685), ("smurf", 2646, 665), ("back", 956, 359),
    ("snmpguess", 0, 331), ("saint", 0, 319), ("mailbomb", 0, 293),
    ("snmpgetattack", 0, 178), ("portsweep", 2931, 157), ("ipsweep", 3599, 141),
    ("httptunnel", 0, 133), ("nmap", 1493, 73), ("pod", 201, 41),
    ("buffer_overflow", 30, 20), ("multihop", 7, 18), ("named", 0, 17), ("ps", 0, 15),
    ("sendmail", 0, 14), ("xterm", 0, 13), ("rootkit", 10, 13), ("teardrop", 892, 12),
    ("xlock", 0, 9), ("land", 18, 7), ("xsnoop", 0, 4), ("ftp_write", 8, 3),
    ("loadmodule", 9, 2), ("phf", 4, 2), ("worm", 0, 2), ("sqlattack", 0, 2),
    ("perl", 3, 2), ("udpstorm", 0, 2), ("imap", 11, 1), ("spy", 2, 0),
    ("warezclient", 890, 0),
]
# group, samples, detected by the random forest, isolation forest and hybrid; their recall and f1
GROUPS = [
    ("SHARED", 9083, 7117, 1441, 7118,
     0.7835516899702741, 0.1586480237806892, 0.7836617857536057,
     0.878641975308642, 0.27385024705435196, 0.8787111906672428),
    ("TEST_ONLY", 3750, 1515, 306, 1521,
     0.404, 0.0816, 0.4056,
     0.5754985754985755, 0.15088757396449703, 0.5771200910643142),
]


def test_metrics_from_published_counts(spark):
    counts = spark.createDataFrame(
        [row[:5] for row in MODELS], "model string, tn bigint, fp bigint, fn bigint, tp bigint"
    )
    got = {row["model"]: row for row in evaluation.metrics_from_counts(counts).collect()}
    for model, *_, accuracy, precision, recall, f1 in MODELS:
        row = got[model]
        assert row["accuracy"] == pytest.approx(accuracy, abs=CLOSE)
        assert row["precision"] == pytest.approx(precision, abs=CLOSE)
        assert row["recall"] == pytest.approx(recall, abs=CLOSE)
        assert row["f1"] == pytest.approx(f1, abs=CLOSE)


def test_distribution_and_coverage_from_published_counts(spark):
    counts = spark.createDataFrame(
        TYPES, "label string, train_count bigint, test_count bigint"
    )
    report = counts.transform(coverage.with_coverage).transform(coverage.with_percentages)
    rows = {row["label"]: row for row in report.collect()}
    assert rows["neptune"]["train_percentage"] == pytest.approx(70.29507078287565, abs=1e-9)
    assert rows["guess_passwd"]["test_percentage"] == pytest.approx(9.592456946933686, abs=1e-9)
    assert rows["mscan"]["test_only"] and not rows["mscan"]["seen_in_training"]
    assert rows["spy"]["seen_in_training"] and not rows["spy"]["test_only"]
    assert coverage.coverage_summary(counts).first().asDict() == {
        "total_types": 39, "shared_types": 20, "test_only_types": 17, "train_only_types": 2,
    }


def test_groups_from_published_counts(spark):
    """Rebuild flows with the published group counts and evaluate them."""
    rows = []
    for group, samples, rf, iso, hybrid, *_ in GROUPS:
        label = "old" if group == "SHARED" else "new"
        # The hybrid finds what the forest finds plus the rows only the anomaly detector finds.
        only_iso = hybrid - rf
        rows.append((label, True, True, iso - only_iso))
        rows.append((label, True, False, rf - (iso - only_iso)))
        rows.append((label, False, True, only_iso))
        rows.append((label, False, False, samples - hybrid))
    spans = spark.createDataFrame(rows, "label string, rf boolean, iso boolean, n int")
    flows = (
        spans.filter("n > 0")
        .select("label", "rf", "iso", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .withColumn("target", F.lit(1))
        .withColumn("hybrid", F.col("rf") | F.col("iso"))
    )
    train = spark.createDataFrame([("old", 1), ("normal", 0)], "label string, target int")
    table = detection.detection_by_group(
        flows, train, {"rf": "rf", "if": "iso", "hybrid": "hybrid"}
    )
    got = {row["group"]: row for row in table.collect()}
    for group, samples, _, _, _, *ratios in GROUPS:
        row = got[group]
        assert row["samples"] == samples
        names = ["rf_recall", "if_recall", "hybrid_recall", "rf_f1", "if_f1", "hybrid_f1"]
        for name, value in zip(names, ratios, strict=True):
            assert row[name] == pytest.approx(value, abs=CLOSE)


def test_final_summaries_from_published_counts(spark):
    """13,606 NORMAL, 8,933 ATTACK, 5 SUSPICIOUS (all attacks), 285 false positives."""
    spans = spark.createDataFrame(
        [(0, "NORMAL", 9426), (0, "ATTACK", 285), (1, "NORMAL", 4180), (1, "ATTACK", 8648),
         (1, "SUSPICIOUS", 5)],
        "target int, decision string, n int",
    )
    rows = spans.select("target", "decision", F.explode(F.sequence(F.lit(1), F.col("n"))))
    analysis = reports.final_analysis(rows).first()
    assert analysis["accuracy"] == pytest.approx(0.8019428672817601, abs=CLOSE)
    assert analysis["attack_precision"] == pytest.approx(0.9681136719624077, abs=CLOSE)
    assert analysis["attack_recall"] == pytest.approx(0.6742772539546482, abs=CLOSE)
    assert analysis["attack_f1"] == pytest.approx(0.7949106609710165, abs=CLOSE)
    assert analysis["suspicious_true_attacks"] == 5
    validation = reports.final_validation(rows).first()
    assert (validation["normal"], validation["attack"], validation["suspicious"]) == (
        13606, 8933, 5,
    )


def test_report_of_the_published_baseline(spark):
    """TN 8991, FP 720, FN 4832, TP 8001."""
    spans = spark.createDataFrame(
        [(0, 0, 8991), (0, 1, 720), (1, 0, 4832), (1, 1, 8001)],
        "target int, predicted int, n int",
    )
    rows = spans.select("target", "predicted", F.explode(F.sequence(F.lit(1), F.col("n"))))
    table = evaluation.class_metrics(rows, "target", "predicted").first()
    assert table["accuracy"] == pytest.approx(0.7537260468417317, abs=CLOSE)
    assert table["normal_precision"] == pytest.approx(0.6504376763365406, abs=CLOSE)
    assert table["normal_f1"] == pytest.approx(0.7640860032293703, abs=CLOSE)
    assert table["attack_recall"] == pytest.approx(0.6234707394997273, abs=CLOSE)
    assert table["attack_f1"] == pytest.approx(0.7424144010392503, abs=CLOSE)

    from flowsieve.sources.results import report_lines

    report = evaluation.classification_report(rows, "target", "predicted")
    lines = [r["value"] for r in report_lines(report).orderBy("line_no").collect()]
    assert lines == [
        "              precision    recall  f1-score   support",
        "",
        "      NORMAL       0.65      0.93      0.76      9711",
        "      ATTACK       0.92      0.62      0.74     12833",
        "",
        "    accuracy                           0.75     22544",
        "   macro avg       0.78      0.77      0.75     22544",
        "weighted avg       0.80      0.75      0.75     22544",
    ]
