"""Plan-time column checks and the typed check of JSON flow records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.schema import CATEGORICAL, FEATURES, FLOW_SCHEMA

_CORRUPT = "_corrupt_record"


def require_columns(df: DataFrame, required: list[str] = FEATURES) -> DataFrame:
    """Return the frame unchanged, or name every missing column in one error."""
    present = set(df.columns)
    missing = [name for name in required if name not in present]
    if missing:
        raise ValueError("Missing required features: " + ", ".join(missing))
    return df


def align_columns(df: DataFrame, columns: list[str] = FEATURES, keep: tuple = ()) -> DataFrame:
    """Canonical column order by name, after the presence check."""
    return require_columns(df, columns).select(*keep, *columns)


def numeric_columns(features: list[str], categorical: list[str] = CATEGORICAL) -> list[str]:
    return [name for name in features if name not in categorical]


def first_present(df: DataFrame, candidates: list[str]) -> str | None:
    """First candidate the frame has, or None."""
    return next((name for name in candidates if name in df.columns), None)


def check_records(df: DataFrame, body: str = "body") -> DataFrame:
    """Parse a JSON column into the 41 typed fields and list what is wrong with each record.

    Adds ``flow`` (the parsed struct), ``invalid_fields`` (names that are absent, null, NaN or
    of the wrong type) and ``accepted``.
    """
    with_corrupt = T.StructType([*FLOW_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    record = F.from_json(
        body, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    # A generator's output is computed once per row; a plain column would be parsed again for
    # every field that reads it.
    parsed = df.select("*", F.explode(F.array(record)).alias("flow"))
    problems = []
    for field in FLOW_SCHEMA.fields:
        value = F.col("flow").getField(field.name)
        bad = value.isNull()
        if isinstance(field.dataType, T.DoubleType):
            bad = bad | F.isnan(value)
        problems.append(F.when(bad, field.name))
    return parsed.withColumn(
        "invalid_fields", F.array_compact(F.array(*problems))
    ).withColumn(
        "accepted",
        F.col("flow").isNotNull()
        & F.col("flow").getField(_CORRUPT).isNull()
        & (F.size("invalid_fields") == 0),
    )


def accepted_flows(checked: DataFrame, keep: tuple = ()) -> DataFrame:
    """The typed columns of the accepted records."""
    return checked.filter("accepted").select(
        *keep, *[F.col("flow").getField(name).alias(name) for name in FEATURES]
    )


def rejected_records(checked: DataFrame) -> DataFrame:
    """Rejected records with their raw text and the offending fields."""
    return checked.filter("not accepted").drop("flow", "accepted")


def explode_batch(df: DataFrame, samples: str = "samples") -> DataFrame:
    """One row per flow of a batch request that carries an array of flow structs."""
    require_columns(df, [samples])
    others = [name for name in df.columns if name != samples]
    return df.select(*others, F.inline(samples))


