"""Exact deduplication with a heavy-hitter split.

Texts are compared by a SHA-256 digest of the normalised text. One pass of Misra-Gries summaries
(bounded counters per task, merged) proposes every digest that may exceed ``n / (counters + 1)``
rows; a second pass counts the proposals exactly. The verified winners, at most ``counters`` rows,
are broadcast, and their rows are settled where they lie, without any shuffle. What remains has no
group above that share and takes the ordinary shuffle by digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import SPACE, row_struct, stored, unpacked

COUNTERS = 512
OUTPUT = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """White-space runs become one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def trimmed(counts: dict, counters: int) -> dict:
    """Misra-Gries reduction: subtract the (counters + 1)-th largest count, keep what is positive."""
    if len(counts) <= counters:
        return counts
    cut = np.partition(np.fromiter(counts.values(), np.int64), -counters - 1)[-counters - 1]
    return {digest: n - int(cut) for digest, n in counts.items() if n > cut}


def _summaries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            found = batch.column(0).value_counts()
            for digest, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counts[digest] = counts.get(digest, 0) + n
            counts = trimmed(counts, counters)
        if rows:
            # The row without a digest carries the number of rows seen.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *counts], pa.string()),
                    pa.array([rows, *counts.values()], pa.int64()),
                ],
                ["digest", "n"],
            )

    return summarise


def frequent(digests: DataFrame, column: str, counters: int = COUNTERS) -> tuple[list[str], int]:
    """Digests that may hold more than rows / (counters + 1) rows, and the number of rows.

    At most ``counters`` digests come back, whatever the input: the summaries of all tasks are
    added up in Spark and reduced to the ``counters + 1`` largest before they reach the driver.
    """
    summaries = digests.select(F.col(column)).mapInArrow(
        _summaries(counters), "digest string, n bigint"
    )
    merged = stored(summaries.groupBy("digest").agg(F.sum("n").alias("n")), "summaries")
    rows = merged.filter("digest IS NULL").agg(F.sum("n")).first()[0] or 0
    top = (
        merged.filter("digest IS NOT NULL")
        .orderBy(F.desc("n"), "digest")
        .limit(counters + 1)
        .collect()
    )
    return list(trimmed({r["digest"]: r["n"] for r in top}, counters)), rows


def heavy_groups(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified winners: text_sha256, keep_id, group_size; at most ``counters`` rows.

    ``digests`` has doc_id and text_sha256 and should be a stored table: it is read twice.
    """
    spark = digests.sparkSession
    candidates, rows = frequent(digests, "text_sha256", counters)
    proposed = spark.createDataFrame([(c,) for c in candidates], "text_sha256 string")
    return (
        digests.join(F.broadcast(proposed), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > rows / (counters + 1))
    )


def _split(docs: DataFrame, text: str, counters: int, digest: str | None):
    """Packed rows of heavy groups (with keep_id and group_size, never shuffled) and the others."""
    own = F.col(f"`{digest}`") if digest else text_digest(F.col(f"`{text}`"))
    rows = docs.select(row_struct(docs), own.alias("text_sha256"), F.col("doc_id").alias("_id"))
    narrow = docs.select(F.col("doc_id"), own.alias("text_sha256"))
    heavy = stored(
        heavy_groups(narrow if digest else stored(narrow, "digests"), counters), "heavy"
    )
    settled = rows.join(F.broadcast(heavy), "text_sha256")
    rest = rows.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    return settled, rest


def _place() -> Column:
    order = Window.partitionBy("text_sha256").orderBy(F.asc_nulls_last("_id"))
    return F.row_number().over(order)


def _bears() -> Column:
    return F.col("_id").eqNullSafe(F.col("keep_id"))


def mark_duplicates(
    docs: DataFrame, text: str = "text", counters: int = COUNTERS, digest: str | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` with keep_id, group_size, kept and text_sha256.

    Rows are equal when their normalised texts are; null counts as empty. ``keep_id`` is the
    smallest doc_id of the group (null only if the group has no other), and exactly one row with
    it stays, also where rows repeat a doc_id. An input column with an output's name is replaced.
    An empty table gives an empty table. ``digest`` names a column that already holds the digest;
    without it the digests are computed once and stored beside doc_id for the two counting passes.
    """
    settled, rest = _split(docs, text, counters, digest)
    group = Window.partitionBy("text_sha256")
    rest = rest.select(
        "_row",
        "text_sha256",
        F.min("_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        (_place() == 1).alias("kept"),
    )
    # Only the rows that bear the smallest id of a heavy group meet, to leave exactly one.
    others = settled.filter(~_bears()).withColumn("kept", F.lit(False))
    bearers = settled.filter(_bears()).withColumn("kept", _place() == 1)
    parts = [
        part.select(*unpacked(part, docs.columns, OUTPUT), *OUTPUT)
        for part in (rest, others, bearers)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def drop_duplicates(docs: DataFrame, text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with the input's columns; nulls and repeats as in mark_duplicates.

    Each task keeps one row of a digest before the shuffle, so copies do not travel.
    """
    settled, rest = _split(docs, text, counters, None)
    first = rest.withColumn("_place", _place()).filter("_place = 1").select("_row")
    bearers = settled.filter(_bears()).withColumn("_place", _place()).filter("_place = 1").select("_row")
    return first.unionByName(bearers).select("_row.*")
