"""Registration of queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.functions.decisions import is_positive, with_decision
from flowsieve.schema import FLOW_FIELDS, IF_THRESHOLD, RF_THRESHOLD
from flowsieve.sources.tables import flows, split_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL where SQL can express it."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def train_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_of(flows(spark, sf_dir), "train")


def test_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_of(flows(spark, sf_dir), "test")


def decided(frame: DataFrame) -> DataFrame:
    """Flows with the decisions of the final configuration and the hybrid 0/1 prediction."""
    return with_decision(frame, RF_THRESHOLD, IF_THRESHOLD).withColumn(
        "hybrid_prediction", is_positive("decision")
    )


def test_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(test_flows(spark, sf_dir))


def only(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.select(*[F.col(c) for c in columns])


_DERIVED = {
    "duration": "l_quantity",
    "protocol_type": "l_returnflag",
    "service": "p_type",
    "flag": "l_linestatus",
    "src_bytes": "l_extendedprice",
    "dst_bytes": "p_retailprice",
    "count": "p_size",
    "serror_rate": "l_discount * 10",
    "same_srv_rate": "l_tax * 10",
}
_SQL_TYPES = {"double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR"}
_FEATURES = ",\n    ".join(
    f'CAST({_DERIVED.get(name, "0")} AS {_SQL_TYPES[kind]}) AS "{name}"'
    for name, kind in FLOW_FIELDS
)
FEATURE_LIST = ", ".join(f'"{name}"' for name, _ in FLOW_FIELDS)

_FLOWS = f"""
WITH flows AS (
  SELECT
    md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
      CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
      CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
    )) AS flow_id,
    {_FEATURES},
    CASE WHEN l_quantity <= 25 THEN 'normal' ELSE lower(p_brand) END AS label,
    CASE WHEN l_quantity <= 25 THEN 0 ELSE 1 END AS target,
    l_quantity / 50.0 * 0.7 + l_discount * 3 AS rf_probability,
    0.2 - p_size / 100.0 - l_tax AS if_score,
    CASE WHEN l_quantity > 25 AND p_brand LIKE '%5' THEN 'test'
      WHEN l_quantity > 25 AND p_brand LIKE '%1' THEN 'train'
      WHEN l_shipdate < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split,
    l_shipdate AS seen_at
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
train AS (SELECT * FROM flows WHERE split = 'train'),
test AS (SELECT * FROM flows WHERE split = 'test'),
decided AS (
  SELECT *,
    CASE WHEN rf_prediction THEN 'ATTACK' WHEN if_anomaly THEN 'SUSPICIOUS' ELSE 'NORMAL' END
      AS decision,
    CASE WHEN rf_prediction OR if_anomaly THEN 1 ELSE 0 END AS hybrid_prediction
  FROM (
    SELECT *, rf_probability >= 0.4::DOUBLE AS rf_prediction,
      if_score <= -0.1::DOUBLE AS if_anomaly
    FROM test
  )
)"""


def over_flows(body: str, *ctes: str) -> str:
    """A statement over the flows, train, test and decided tables."""
    extra = "".join(f",\n{cte}" for cte in ctes)
    return f"{_FLOWS}{extra}\n{body}"


def ratio(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), 0.0)"


def metrics(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, str]:
    return {
        "accuracy": ratio(f"({tn} + {tp})", f"({tn} + {fp} + {fn} + {tp})"),
        "precision": ratio(tp, f"({tp} + {fp})"),
        "recall": ratio(tp, f"({tp} + {fn})"),
        "f1": ratio(f"(2 * {tp})", f"(2 * {tp} + {fp} + {fn})"),
    }


def metric_list(tn="tn", fp="fp", fn="fn", tp="tp", skip: tuple = ()) -> str:
    parts = metrics(tn, fp, fn, tp).items()
    return ", ".join(f'{sql} AS "{name}"' for name, sql in parts if name not in skip)


def cells(predicted: str, truth: str = "target = 1") -> str:
    return (
        f"count(*) FILTER (WHERE NOT ({truth}) AND NOT ({predicted})) AS tn, "
        f"count(*) FILTER (WHERE NOT ({truth}) AND ({predicted})) AS fp, "
        f"count(*) FILTER (WHERE ({truth}) AND NOT ({predicted})) AS fn, "
        f"count(*) FILTER (WHERE ({truth}) AND ({predicted})) AS tp"
    )
