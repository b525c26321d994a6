"""Running least-squares line over a stream of ``"x y"`` messages
(SRC10, STM1-STM5, SNK6).

The same column expressions as the batch fit, applied to a streaming
DataFrame: Structured Streaming keeps the partial ``regr_*`` state in its
state store and re-emits the whole (one-row) result each trigger
(``complete`` mode).  Which stream to read is an argument; Kafka needs its
connector jar on the classpath, files work everywhere.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import checkpoint_root


def read_stream(spark: SparkSession, source: str, fmt: str = "text", schema=None,
                servers: str | None = None, max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """A stream of messages with a ``value string`` column (SRC10, STM5).

    ``fmt='kafka'``: ``source`` is the topic, ``servers`` the bootstrap list.
    Otherwise ``source`` is a folder, or one file, read as a file stream of ``fmt``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("subscribe", source)
        if servers:
            reader = reader.option("kafka.bootstrap.servers", servers)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A plain path must be a folder here; a pattern (of which the path itself is
    # the only match) may also be a file.
    plain = not any(c in source for c in "*?[{")
    return reader.load(f"{source[:-1]}[{source[-1]}]" if plain and source[-1:].isalnum() else source)


def parse_points(messages: DataFrame, col: str = "value") -> DataFrame:
    """``"x y"`` -> ``x double, y double`` (STM1).  A message that is not two
    numbers gives NULLs and is dropped."""
    parts = F.split(F.trim(F.col(col)), r"\s+")
    pts = messages.select(F.get(parts, 0).try_cast("double").alias("x"),
                          F.get(parts, 1).try_cast("double").alias("y"))
    return pts.filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def running_fit(points: DataFrame) -> DataFrame:
    """Global running aggregate: count, slope, intercept (STM2, STM3).
    One point, or all x equal, gives NULL slope and intercept."""
    return points.agg(F.count(F.lit(1)).alias("n"),
                      F.regr_slope("y", "x").alias("slope"),
                      F.regr_intercept("y", "x").alias("intercept"))


def run_to_console(result: DataFrame, seconds: float = 600,
                   checkpoint: str | None = None) -> None:
    """Print the running result to the console each trigger, in complete
    mode, for a bounded time (SNK6, STM4)."""
    spark = result.sparkSession
    checkpoint = checkpoint or os.path.join(checkpoint_root(spark), "streams",
                                            f"console_{uuid.uuid4().hex[:8]}")
    q = result.writeStream.outputMode("complete").format("console") \
        .option("checkpointLocation", checkpoint).start()
    try:
        q.awaitTermination(seconds)
    finally:
        if q.isActive:
            q.stop()


def run_to_table(spark: SparkSession, result: DataFrame, name: str | None = None,
                 available_now: bool = True, timeout: float | None = None,
                 checkpoint: str | None = None) -> DataFrame:
    """Run a streaming aggregate in ``complete`` mode into an in-memory
    table and return that table (SNK6, STM4).

    ``available_now``: process all that is there and stop (tests, batch
    re-runs); a ``timeout`` in seconds that passes before the end raises
    ``TimeoutError``, because the table would hold part of the input.
    Otherwise run until ``timeout`` seconds have passed, which must be given;
    the table then is the running result.  The checkpoint lives under the
    shared checkpoint folder, so a restarted query resumes from its
    committed offsets and state.
    """
    if not available_now and timeout is None:
        raise ValueError("a stream without an end needs a timeout")
    name = name or f"stream_{uuid.uuid4().hex[:8]}"
    checkpoint = checkpoint or os.path.join(checkpoint_root(spark), "streams", name)
    writer = result.writeStream.outputMode("complete").format("memory").queryName(name) \
        .option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    q = writer.start()
    try:
        ended = q.awaitTermination(timeout) if timeout is not None else q.awaitTermination() is None
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if available_now and not ended:
        raise TimeoutError(f"the stream had not read all its input after {timeout} seconds")
    return spark.table(name)


def run_to_folder(result: DataFrame, folder: str, checkpoint: str, after_write=None) -> None:
    """Run a streaming aggregate in ``complete`` mode to the end of what is there, and write the
    whole result of each micro-batch to ``folder/batch=<id>`` (STM2).

    A batch's folder is overwritten, so a batch that is run again after a failure leaves one
    copy.  A later call with the same ``checkpoint`` goes on where the last one stopped: finished batches
    are not read again, and the state is that of the last one.  ``after_write(id)`` runs after a
    batch's rows are written and before it counts as finished; what it raises stops the stream and is raised here.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={number}")
        if after_write is not None:
            after_write(number)

    q = result.writeStream.outputMode("complete").trigger(availableNow=True) \
        .option("checkpointLocation", checkpoint).foreachBatch(write).start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()


def latest_result(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The result of the last micro-batch that :func:`run_to_folder` wrote."""
    written = spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/batch=*")
    last = written.agg(F.max("batch")).first()[0]
    return written.filter(F.col("batch") == F.lit(last)).drop("batch")
