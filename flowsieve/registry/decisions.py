"""Queries over threshold tests and decision columns."""

from pyspark.sql import functions as F

from flowsieve.functions import cuts, decisions
from flowsieve.operators.alerts import with_alert_flag
from flowsieve.operators.reports import model_rows
from flowsieve.operators.evaluation import model_comparison
from flowsieve.plans.evaluation import MODELS
from flowsieve.registry.core import (
    cells,
    metric_list,
    only,
    over_flows,
    query,
    test_decisions,
    test_flows,
)
from flowsieve.schema import IF_THRESHOLD, RF_THRESHOLD


@query(over_flows("SELECT flow_id, rf_probability, rf_prediction FROM decided"))
def probability_cut(spark, sf_dir):
    return test_flows(spark, sf_dir).select(
        "flow_id",
        "rf_probability",
        cuts.probability_cut("rf_probability", RF_THRESHOLD).alias("rf_prediction"),
    )


@query(over_flows("SELECT flow_id, if_score, if_anomaly FROM decided"))
def anomaly_cut_on_decision_score(spark, sf_dir):
    return test_flows(spark, sf_dir).select(
        "flow_id", "if_score", cuts.anomaly_cut("if_score", IF_THRESHOLD).alias("if_anomaly")
    )


@query(over_flows("SELECT flow_id, if_score, -if_score >= -0.1::DOUBLE AS if_anomaly FROM test"))
def anomaly_cut_on_negated_score(spark, sf_dir):
    return test_flows(spark, sf_dir).select(
        "flow_id",
        "if_score",
        cuts.anomaly_cut("if_score", IF_THRESHOLD, "anomaly").alias("if_anomaly"),
    )


@query(over_flows("SELECT flow_id, if_score < 0 AS if_anomaly FROM test"))
def native_anomaly_label(spark, sf_dir):
    return test_flows(spark, sf_dir).select(
        "flow_id", cuts.native_anomaly("if_score").alias("if_anomaly")
    )


@query(over_flows("SELECT flow_id, rf_prediction, if_anomaly, decision FROM decided"))
def hybrid_decision(spark, sf_dir):
    return only(
        test_decisions(spark, sf_dir), "flow_id", "rf_prediction", "if_anomaly", "decision"
    )


@query(
    over_flows(
        """SELECT flow_id, decision AS name,
  CASE decision WHEN 'NORMAL' THEN 0 WHEN 'ATTACK' THEN 1 ELSE 2 END AS code
FROM decided"""
    )
)
def decision_codes(spark, sf_dir):
    coded = test_decisions(spark, sf_dir).select(
        "flow_id", decisions.decision_code("rf_prediction", "if_anomaly").alias("code")
    )
    return coded.withColumn("name", decisions.decision_name("code"))


@query(over_flows("SELECT flow_id, hybrid_prediction AS positive FROM decided"))
def decision_positive(spark, sf_dir):
    return test_decisions(spark, sf_dir).select(
        "flow_id", decisions.is_positive("decision").alias("positive")
    )


@query(
    over_flows(
        """SELECT flow_id, CASE target WHEN 0 THEN 'NORMAL' ELSE 'ATTACK' END AS class_name
FROM test"""
    )
)
def class_names(spark, sf_dir):
    return test_flows(spark, sf_dir).select(
        "flow_id", decisions.class_name("target").alias("class_name")
    )


@query(over_flows("SELECT flow_id, decision <> 'NORMAL' AS alert_created FROM decided"))
def alert_flag(spark, sf_dir):
    return only(with_alert_flag(test_decisions(spark, sf_dir)), "flow_id", "alert_created")


@query(
    over_flows(
        f"""SELECT 'Random Forest' AS model, {metric_list()}
FROM (SELECT {cells("rf_prediction")} FROM decided)
UNION ALL SELECT 'Isolation Forest', {metric_list()}
FROM (SELECT {cells("if_anomaly")} FROM decided)"""
    )
)
def model_name_match(spark, sf_dir):
    compared = model_comparison(test_decisions(spark, sf_dir), "target", MODELS)
    return model_rows(compared, "FOREST")
