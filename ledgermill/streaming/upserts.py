"""Streaming forms of the keyed loads: state by key in a state store, late rows in a table of their own."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgermill.session import read_text

# State on the executors' disks with only its changes written a batch, instead of all keys on the heap.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
LOOSE, NEWEST, COPIES = "_loose", "_newest", "_copies"
OUTCOME, LATE_BY = "outcome", "late_by_seconds"
COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in ("input", "kept", "repeated", "late")])


def read_file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, each file read once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def keep_state_on_disk(spark: SparkSession) -> None:
    """Apply the state settings that the session's owner has left open; a query keeps those it began with."""
    chosen = spark.conf.getAll
    for key, value in STATE_CONF.items():
        if key not in chosen:
            spark.conf.set(key, value)


def stream_upsert(
    stream: DataFrame, keys: list[str], order: list[str], checkpoint: str, changes: str | None = None
) -> StreamingQuery:
    """Keep the newest row of every key in the state store and stop when the input is drained.

    The state is a value a key, the greatest (``order``, other columns) seen so far, so
    an event that arrives late never replaces a newer one, whatever batch it is in. Each
    task first reduces its own rows to one a key, so a hot key costs one row a task, and
    a batch reads and writes the state of its own keys only, however large the table is.
    State and progress are committed together: a batch repeated after a failure counts
    once. Rows with a NULL in the key are all kept, equal ones as one state with a count.

    ``latest_rows`` reads the table from ``checkpoint``. With ``changes`` every batch also
    writes there, in a folder of its own, the rows that are new or newer; a batch that is
    repeated replaces its folder.
    """
    keep_state_on_disk(stream.sparkSession)
    rest = [c for c in stream.columns if c not in keys]
    ranked = order + [c for c in rest if c not in order]
    partial = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    loose = F.when(partial, F.sha2(F.to_json(F.struct(*stream.columns)), 256))
    newest = stream.withColumn(LOOSE, loose).groupBy(*keys, LOOSE).agg(
        F.max(F.struct(*ranked)).alias(NEWEST), F.count(F.lit(1)).alias(COPIES)
    )
    writer = newest.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if changes is None:
        return writer.format("noop").start()

    def write(batch: DataFrame, batch_id: int) -> None:
        _rows(batch, keys, ranked).write.mode("overwrite").parquet(f"{changes.rstrip('/')}/batch={batch_id}")

    return writer.foreachBatch(write).start()


def _rows(state: DataFrame, keys: list[str], ranked: list[str]) -> DataFrame:
    """The rows behind states: one a whole key, as many as there were for others."""
    copies = F.when(F.col(LOOSE).isNull(), 1).otherwise(F.col(COPIES))
    return state.withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long")))).select(
        *keys, *[F.col(f"{NEWEST}.`{c}`").alias(c) for c in ranked]
    )


def latest_rows(spark: SparkSession, checkpoint: str, columns: list[str], batch: int | None = None) -> DataFrame:
    """The table that ``stream_upsert`` keeps, as of the last batch or an earlier one.

    Read from the state store itself, a task a state partition. How far back ``batch``
    may go is set by ``spark.sql.streaming.minBatchesToRetain``.
    """
    keep_state_on_disk(spark)
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    keys = [f.name for f in state.schema["key"].dataType.fields if f.name != LOOSE]
    newest, copies = state.schema["value"].dataType.fieldNames()
    ranked = state.schema["value"].dataType[newest].dataType.fieldNames()
    flat = state.select("key.*", F.col(f"value.{newest}").alias(NEWEST), F.col(f"value.{copies}").alias(COPIES))
    return _rows(flat, keys, ranked).select(*columns)


def late_bound(spark: SparkSession, checkpoint: str, batch_id: int) -> Column:
    """The event time up to which the query itself passes over rows in a batch.

    The engine logs with each batch the watermark it began with and drops rows not
    beyond that of the batch before, so this is the same bound, also after a restart.
    """
    if not batch_id:
        return F.lit(None).cast("timestamp")
    log = read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id - 1}")
    return F.timestamp_millis(F.lit(json.loads(log.splitlines()[1])["batchWatermarkMs"]).cast("long"))


def stream_dedupe(
    stream: DataFrame, keys: list[str], event_time: str, delay: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Keep the first row of every key, remembering keys for ``delay`` of event time; late rows go to a side table.

    A row is late if its event time is not beyond the query's watermark, which trails the
    newest event time by ``delay``: the engine drops it, and here it is written with how
    late it is. The kept rows and the late ones are two branches over the same batch,
    written by one job into folders by batch and outcome, so a batch that is repeated
    after a failure replaces its own rows. Beside them stand each batch's counts: rows
    that came are kept, repeats of a kept row, or late. Rows without an event time are
    never late; NULL keys are equal to each other.

    Read with ``kept_rows``, ``late_rows`` and ``dedupe_counts``.
    """
    spark = stream.sparkSession
    keep_state_on_disk(spark)
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    first = timed.dropDuplicatesWithinWatermark(keys).withColumn(OUTCOME, F.lit("kept"))
    both = first.unionByName(timed.withColumn(OUTCOME, F.lit("late")))

    def write(batch: DataFrame, batch_id: int) -> None:
        session, at = batch.sparkSession, path.rstrip('/')
        bound, kept = late_bound(session, checkpoint, batch_id), F.col(OUTCOME) == "kept"
        late = ~kept & F.coalesce(F.col(event_time) <= bound, F.lit(False))
        seen = Observation()
        counted = batch.observe(seen, F.count_if(~kept).alias("input"), F.count_if(kept).alias("kept"), F.count_if(late).alias("late"))
        late_by = F.when(late, (F.unix_micros(bound) - F.unix_micros(event_time)) / 1_000_000)
        rows = counted.filter(kept | late).withColumn(LATE_BY, late_by)
        rows.write.mode("overwrite").partitionBy(OUTCOME).parquet(f"{at}/rows/batch={batch_id}")
        n = seen.get
        repeated = n["input"] - n["kept"] - n["late"]
        totals = session.createDataFrame([(n["input"], n["kept"], repeated, n["late"])], COUNTS)
        totals.coalesce(1).write.mode("overwrite").parquet(f"{at}/counts/batch={batch_id}")

    return (
        both.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _outcome(spark: SparkSession, path: str, schema: T.StructType, outcome: str) -> DataFrame:
    held = T.StructType([*schema.fields, T.StructField(LATE_BY, T.DoubleType()), T.StructField("batch", T.LongType()), T.StructField(OUTCOME, T.StringType())])
    return spark.read.schema(held).parquet(f"{path.rstrip('/')}/rows").filter(F.col(OUTCOME) == outcome)


def kept_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The first row of every key; ``schema`` is the stream's, its event time as a timestamp."""
    return _outcome(spark, path, schema, "kept").select(*schema.names)


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows behind the watermark, with the batch that they came in and the seconds that they were late."""
    return _outcome(spark, path, schema, "late").select(*schema.names, "batch", LATE_BY)


def dedupe_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch, input, kept, repeated, late) of every batch."""
    held = T.StructType([*COUNTS.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(held).parquet(f"{path.rstrip('/')}/counts").select("batch", *COUNTS.names)
