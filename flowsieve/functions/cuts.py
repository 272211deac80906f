"""Threshold tests on score columns. Every cut is inclusive and a NaN score never passes."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(float(value))


def probability_cut(score: Column | str, threshold) -> Column:
    """``score >= threshold``; the threshold is a number or a column."""
    score = F.col(score) if isinstance(score, str) else score
    return (score >= _as_column(threshold)) & ~F.isnan(score)


def anomaly_cut(score: Column | str, threshold, orientation: str = "decision") -> Column:
    """Anomaly test on an isolation score (higher = more normal).

    ``decision`` compares the score itself (``score <= t``); ``anomaly`` compares the negated
    score (``-score >= t``). The same number means opposite sides of zero in the two, so the
    caller has to say which one it holds: cut ``t`` in one equals cut ``-t`` in the other.
    """
    score = F.col(score) if isinstance(score, str) else score
    if orientation == "decision":
        return score <= _as_column(threshold)
    if orientation == "anomaly":
        return (-score >= _as_column(threshold)) & ~F.isnan(score)
    raise ValueError(f"orientation must be 'decision' or 'anomaly', not {orientation!r}")


def native_anomaly(score: Column | str) -> Column:
    """The isolation forest's own label: anomalous below zero."""
    return (F.col(score) if isinstance(score, str) else score) < F.lit(0.0)
