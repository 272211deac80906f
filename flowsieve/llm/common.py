"""What the corpus operators share: tables, stored intermediates, fixed text rules, memory of workers."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.session import scratch_path
from flowsieve.sources.tables import read_table

__all__ = [
    "SPACE", "held_out", "read_table", "release_memory", "row_struct", "small_side", "small_batches",
    "stored", "unpacked", "word_count",
]

# Fixed: the white space of the text contracts, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, and a lost executor
    costs a read instead of the lineage above it."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words (runs without white space); null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents no model may learn from; never null."""
    key = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % 5 == 0


def row_struct(frame: DataFrame, name: str = "_row") -> Column:
    """The whole input row as one column, so that no name of its own can clash with a helper."""
    return F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias(name)


def unpacked(frame: DataFrame, columns: list[str], replaced: list[str], name: str = "_row"):
    """Select the packed input columns, without those an operator's own columns replace."""
    taken = {c.lower() for c in replaced}
    return [
        F.col(name).getField(c).alias(c) for c in columns if c.lower() not in taken
    ]


# A broadcast side has at most this many narrow rows (some tens of MB in memory).
BROADCAST_ROWS = 500_000


def small_side(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``frame``, a stored table of a few numbers a row, marked for broadcast if it was counted
    to be small; otherwise unmarked, and the join shuffles both sides."""
    return F.broadcast(frame) if frame.count() <= rows else frame


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(frame: DataFrame, rows: int = 1000) -> DataFrame:
    """``frame``, whose texts are to be handed to Python workers, with the session's default Arrow
    batches made smaller: both sides hold a batch of whole texts. A setting of the user's own stays."""
    session = frame.sparkSession
    if session.conf.get(_BATCH_ROWS) == "10000":
        session.conf.set(_BATCH_ROWS, str(rows))
    return frame


def release_memory() -> None:
    """Give what a finished task has freed back to the system: the worker goes on to other tasks, and
    its executor's memory is shared with others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library keeps its own ways
