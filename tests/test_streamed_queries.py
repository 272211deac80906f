"""The files and batches that the streamed queries are made of."""

from pyspark.sql import functions as F

from flowsieve.registry import streams
from flowsieve.session import scratch_path


def _arrived(spark, lines, batches=streams.BATCHES):
    folder = scratch_path(spark, "arrived")
    frame = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("flow_id"), F.lit("{}").alias("body"))
    streams._arrive(frame, folder, lines, batches)
    return folder


def _sizes(spark, folder):
    stored = spark.read.schema(streams.RECORDS).parquet(folder)
    return [row["count"] for row in stored.groupBy(F.input_file_name()).count().collect()]


def test_files_grow_in_number_with_the_lines(spark):
    few = _sizes(spark, _arrived(spark, 100))
    many = _sizes(spark, _arrived(spark, 10 * streams.BATCHES * streams.FILE_LINES))
    assert sum(few) == sum(many) == 4000
    assert len(few) == streams.BATCHES
    assert len(many) == 10 * streams.BATCHES
    # Even shares: no task writes far more than the others.
    assert max(few) < 1.2 * 1000 and max(many) < 1.6 * 100


def test_a_stream_takes_all_files_in_its_batches(spark):
    folder = _arrived(spark, 10 * streams.BATCHES * streams.FILE_LINES)
    seen = []
    query = (
        streams._stream(spark, folder, streams.RECORDS)
        .writeStream.option("checkpointLocation", scratch_path(spark, "progress"))
        .foreachBatch(lambda batch, _: seen.append(batch.count()))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert len(seen) == streams.BATCHES and sum(seen) == 4000
