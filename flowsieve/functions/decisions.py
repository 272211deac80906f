"""Decision columns: combining two detectors and mapping between codes and names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowsieve.functions.cuts import anomaly_cut, probability_cut
from flowsieve.schema import ALERT_DECISIONS, DECISIONS


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hybrid_decision(supervised: Column | str, anomalous: Column | str) -> Column:
    """ATTACK if the classifier says so, else SUSPICIOUS if anomalous, else NORMAL.

    Null where a missing opinion leaves that open: without the classifier's always, without the
    other one's unless the classifier says attack.
    """
    first, second = _c(supervised), _c(anomalous)
    return F.when(first, "ATTACK").when(~first & second, "SUSPICIOUS").when(~first & ~second, "NORMAL")


def decision_code(supervised: Column | str, anomalous: Column | str) -> Column:
    """The same rule as an integer: 1 attack, 2 suspicious, 0 normal."""
    first, second = _c(supervised), _c(anomalous)
    return F.when(first, 1).when(~first & second, 2).when(~first & ~second, 0)


def decision_name(code: Column | str) -> Column:
    """Name of a decision code."""
    pairs = [F.lit(item) for pair in enumerate(DECISIONS) for item in pair]
    return F.try_element_at(F.create_map(*pairs), _c(code))


def is_positive(decision: Column | str) -> Column:
    """1 for the two alerting decisions, 0 otherwise."""
    return _c(decision).isin(ALERT_DECISIONS).cast("int")


def class_name(target: Column | str) -> Column:
    """NORMAL / ATTACK for a 0/1 class code; other codes give null."""
    return F.when(_c(target) == 0, "NORMAL").when(_c(target) == 1, "ATTACK")


def with_decision(
    scored,
    rf_threshold,
    if_threshold,
    orientation: str = "decision",
    probability: str = "rf_probability",
    score: str = "if_score",
):
    """Append rf_prediction, if_anomaly and decision to a frame holding the two scores."""
    return (
        scored.withColumn("rf_prediction", probability_cut(probability, rf_threshold))
        .withColumn("if_anomaly", anomaly_cut(score, if_threshold, orientation))
        .withColumn("decision", hybrid_decision("rf_prediction", "if_anomaly"))
    )
