"""Alerts: rows of non-normal decisions, their pages and their statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.functions.ratios import safe_ratio
from flowsieve.schema import ALERT_DECISIONS, ALERT_SCHEMA

MAX_PAGE = 500
# As many alerts as one task ranks.
RANKED = 100_000


def with_alert_flag(scored: DataFrame) -> DataFrame:
    """Mark the rows that raise an alert."""
    return scored.withColumn("alert_created", F.col("decision").isin(ALERT_DECISIONS))


def alert_rows(scored: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One alert per non-normal decision.

    ``id`` is 60 bits of the digest of the flow id, so a repeated run gives the same ids without
    a counter; ``flow_id`` stays in the row as the unique key. The time defaults to now.
    """
    alert_id = F.conv(F.substring(F.md5("flow_id"), 1, 15), 16, 10).cast("bigint")
    time = F.current_timestamp() if created_at is None else created_at
    return (
        scored.filter(F.col("decision").isin(ALERT_DECISIONS))
        .withColumn("id", alert_id)
        .withColumn("created_at", time)
        .select(*ALERT_SCHEMA.names)
    )


def filter_alerts(alerts: DataFrame, decision: str | None = None) -> DataFrame:
    return alerts.filter(F.col("decision") == decision.upper()) if decision else alerts


def alert_count(alerts: DataFrame, decision: str | None = None) -> DataFrame:
    return filter_alerts(alerts, decision).agg(F.count(F.lit(1)).alias("count"))


def alert_page(
    alerts: DataFrame, limit: int = 50, offset: int = 0, decision: str | None = None
) -> DataFrame:
    """Newest alerts first, with each one's ``place`` among all, from 1. The order is total, so pages
    neither overlap nor leave gaps."""
    rows = filter_alerts(alerts, decision)
    return newest_places(rows, limit, offset, 0, rows.count())


def newest_places(rows: DataFrame, limit: int, offset: int, before: int, total: int) -> DataFrame:
    """The page of ``rows``, which are ``total`` alerts in falling order behind ``before`` others.

    Time and id are 64-bit numbers. Alerts are counted by the leading 16 bits of the time, those of
    the digits the page reaches into by the next 16 bits, and so on through the id, until so few are
    left that a task ranks them; the cost does not depend on the offset.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    lowest = F.lit(-(1 << 63)).cast("bigint")
    codes = [F.coalesce(F.unix_micros(F.col("created_at").cast("timestamp")), lowest), F.coalesce("id", lowest)]
    digits = [F.shiftright(code, shift) for code in codes for shift in (48, 32, 16, 0)]
    last = min(offset + limit, before + total)
    parts = _parts(rows, digits, offset, last, before, total) if offset < last else []
    places = reduce(DataFrame.unionByName, parts) if parts else rows.filter("false").withColumn("place", F.lit(0))
    return places.withColumn("place", F.col("place").cast("bigint")).orderBy("place")


def _parts(rows: DataFrame, digits: list[Column], first: int, last: int, before: int, total: int) -> list[DataFrame]:
    """Places ``first`` to ``last`` of ``rows``, as frames of few rows each."""
    if total <= RANKED or not digits:
        inside = F.row_number().over(Window.orderBy(F.desc("created_at"), F.desc("id"), F.desc("flow_id")))
        placed = rows.withColumn("place", F.lit(before) + inside)
        return [placed.filter(F.col("place").between(first + 1, last))]
    counts = rows.groupBy(digits[0].alias("digit")).agg(F.count(F.lit(1)).alias("n"))
    # At most 2^16 digits; those the page lies in are as few as its alerts.
    newer = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("digit")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = counts.withColumn("above", newer + before).filter(
        (F.col("above") < last) & (F.col("above") + F.col("n") > first)
    )
    found, small = [], []
    for row in reached.orderBy("above").collect():
        if row["n"] > RANKED:
            inside = rows.filter(digits[0] == row["digit"])
            found += _parts(inside, digits[1:], first, min(last, row["above"] + row["n"]), row["above"], row["n"])
        else:
            small.append(row)
    # Neighbouring small digits are ranked together.
    for group in _neighbours(small):
        inside = rows.filter(digits[0].between(group[-1]["digit"], group[0]["digit"]))
        n = sum(r["n"] for r in group)
        found += _parts(inside, [], first, last, group[0]["above"], n)
    return found


def _neighbours(found: list) -> list[list]:
    """Runs of rows that follow each other without a gap, of at most ``RANKED`` alerts together."""
    runs: list[list] = []
    for row in found:
        run = runs[-1] if runs else []
        if run and run[-1]["above"] + run[-1]["n"] == row["above"] and sum(r["n"] for r in run) + row["n"] <= RANKED:
            run.append(row)
        else:
            runs.append([row])
    return runs


def decision_statistics(decided: DataFrame) -> DataFrame:
    """Totals per decision and the attack rate in percent.

    The input says what is counted: on stored alerts ``total_flows`` is the number of alerts and
    ``normal`` is zero; on all scored flows it is the number of flows.
    """
    made = F.col("decision")
    counts = decided.agg(
        F.count(F.lit(1)).alias("total_flows"),
        F.count_if(made == "ATTACK").alias("attacks"),
        F.count_if(made == "NORMAL").alias("normal"),
        F.count_if(made == "SUSPICIOUS").alias("suspicious"),
    )
    return counts.withColumn(
        "attack_rate", F.round(safe_ratio("attacks", "total_flows") * 100, 2)
    )
