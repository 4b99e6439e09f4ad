"""Structured Streaming over growing folders of events."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from corpusloom.operators.records import last_k


def growing(spark: SparkSession, folder: str, schema: T.StructType, names: str = "*.parquet", files: int = 16) -> DataFrame:
    """The rows of the Parquet files of ``folder`` whose names match, as they arrive, ``files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", names).parquet(folder)


def windowed(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts and sums of each event type by window; rows later than ``late`` are dropped, which bounds the state."""
    bounded = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return bounded.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def working_folder(spark: SparkSession) -> str:
    """A new folder that all executors share; of this machine only where none is named and the master is local, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="stream-")
    return f"{shared}/{uuid.uuid4().hex}"


def drain(stream: DataFrame, folder: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Runs a stream over all that is there. The checkpoint in ``folder`` lets a later call go on from there."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    query = (writer.foreachBatch(each) if each else writer.format("parquet").option("path", f"{folder}/rows")).start()
    query.awaitTermination()


def sliding(events: DataFrame, width: str, step: str, late: str = "1 day") -> DataFrame:
    """Counts by window of ``width``, one each ``step``."""
    bounded = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return bounded.groupBy(F.window("ts", width, step).alias("w")).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, key: str, gap: str, late: str = "1 day") -> DataFrame:
    """Counts by session of each ``key``: events less than ``gap`` apart."""
    bounded = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return bounded.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))


def told(events: DataFrame, which: Column, late: str) -> DataFrame:
    """The rows of a stream for which ``which`` is true, with their lateness bounded."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).filter(which)


def within(left: DataFrame, right: DataFrame, same: Column, at: str, seen: str, span: str) -> DataFrame:
    """Rows of two streams that are the ``same`` and of which the right one was seen in the ``span`` up to the left one's time.

    The span and both streams' lateness bound what is held of either.
    """
    near = (F.col(seen) >= F.col(at) - F.expr(f"INTERVAL {span}")) & (F.col(seen) <= F.col(at))
    return left.join(right, same & near)


def within_or_alone(left: DataFrame, right: DataFrame, same: Column, at: str, seen: str, span: str) -> DataFrame:
    """As ``within``, and the left rows that have no such right one, with nulls, once: when the watermark of both streams has passed
    all that could still come."""
    near = (F.col(seen) >= F.col(at) - F.expr(f"INTERVAL {span}")) & (F.col(seen) <= F.col(at))
    return left.join(right, same & near, "leftOuter")


def without_repeats(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    """The first row of each key; a key is held for ``late``, by event time, after its first row, and a later one counts as new."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def keep_last(stream: DataFrame, keys: list[str], order: list[str], k: int, folder: str, keep: Column | None = None) -> DataFrame:
    """The last ``k`` rows of each key of all that a stream has brought so far; at most ``k`` a key are held.

    With ``keep``, rows for which it isn't true leave the state once they are the last: keys that are done are given up.

    Each batch writes the state anew under its own number, from that of the batch before, so a batch that runs again
    after a failure gives the same. Older states are removed: two are held, whatever the number of batches.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = batch
        if number:
            rows = rows.unionByName(session.read.schema(stream.schema).parquet(f"{folder}/state-{number - 1}"))
        last = last_k(rows, keys, [F.desc(c) for c in order], k)
        (last if keep is None else last.filter(keep)).write.mode("overwrite").parquet(f"{folder}/state-{number}")
        old = session.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/state-{number - 2}")
        old.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    drain(stream, folder, each=each)
    done = committed(spark, f"{folder}/checkpoint/commits")
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{folder}/state-{done[-1]}")


def updated(stream: DataFrame, key: Column, folder: str) -> DataFrame:
    """The last state of each ``key`` of an aggregate over a stream, of all that it has told of in update mode so far.

    Each batch appends what has changed, so the work of a batch follows its changes and not all windows there are. The
    changes stay on disk, a folder a batch; for a stream without end take ``keep_last``, which holds two states.
    """
    spark = stream.sparkSession
    told = stream.schema.add("_batch", "long")

    def each(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{folder}/changes/batch-{number}")

    drain(stream, folder, "update", each)
    done = committed(spark, f"{folder}/checkpoint/commits")
    if not done:
        return spark.createDataFrame([], stream.schema)
    changes = spark.read.schema(told).parquet(*(f"{folder}/changes/batch-{n}" for n in done))
    return changes.groupBy(key.alias("_key")).agg(F.max_by(F.struct(*stream.columns), "_batch").alias("_last")).select("_last.*")


def committed(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the batches that a checkpoint has as committed."""
    try:
        files = spark.read.format("binaryFile").load(f"{folder}/[0-9]*").select(F.element_at(F.split("path", "/"), -1).alias("name"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(int(r["name"]) for r in files.collect())
