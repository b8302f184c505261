"""Structured Streaming operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lectern.session import shared_dir


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder or pattern as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a streaming query over all input that is there, and read what it wrote.

    The sink is a folder of parquet files for ``append``; for ``complete`` and
    ``update`` each batch is written under its number, and the last or latest count.
    """
    spark = stream.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/lectern/stream-{uuid.uuid4().hex}"
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start()
    else:
        q = (
            stream.writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{at}/out/batch={n}"))
            .option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True).start()
        )
    q.awaitTermination()
    out = spark.read.schema(stream.schema if mode == "append" else StructType([*stream.schema.fields, StructField("batch", IntegerType())])).parquet(f"{at}/out")
    if mode == "complete":
        last = out.agg(F.max("batch")).first()[0]
        return out.where(F.col("batch") == F.lit(last)).drop("batch")
    return out


def tumbling(events: DataFrame, at: str, size: str, late: str, *by: str, value: str = "value") -> DataFrame:
    """Counts and sums of windows that follow each other; rows later than ``late`` are dropped."""
    return _windowed(events, F.window(at, size), at, late, by, value)


def sliding(events: DataFrame, at: str, size: str, step: str, late: str, *by: str, value: str = "value") -> DataFrame:
    """Counts and sums of windows that overlap."""
    return _windowed(events, F.window(at, size, step), at, late, by, value)


def sessions(events: DataFrame, at: str, gap: str, late: str, *by: str, value: str = "value") -> DataFrame:
    """Counts and sums of runs of rows with no pause of ``gap``."""
    return _windowed(events, F.session_window(at, gap), at, late, by, value)


def _windowed(events: DataFrame, window: Column, at: str, late: str, by, value: str) -> DataFrame:
    rows = events.withWatermark(at, late) if events.isStreaming else events
    counted = rows.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")


def first_seen(events: DataFrame, at: str, late: str, *keys: str) -> DataFrame:
    """The first row of each key; keys are forgotten after ``late``, so state stays bounded."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


def latest_state(events: DataFrame, key: str, at: str, value: str, ttl_hours: float) -> DataFrame:
    """(key, at, value, version) of the latest row of each key, updated batch by batch.

    State of a key that had no newer row for ``ttl_hours`` of event time is dropped.
    """
    kind = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    schema = f"{key} {kind[key]}, {at} timestamp, {value} {kind[value]}, version int"

    def update(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old = state.get if state.exists else None
        stamp, held, version = old if old is not None else (None, None, 0)
        for batch in batches:  # a hot key's rows come in several batches, of which only the newest row is held
            newest = batch.loc[batch[at].idxmax()]
            when = int(newest[at].timestamp() * 1e6)
            if stamp is None or when >= stamp:
                stamp, held = when, newest[value]
            version += len(batch)
        state.update((stamp, held, version))
        state.setTimeoutTimestamp(max(int(stamp / 1000 + ttl_hours * 3_600_000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [k[0]], at: [pd.Timestamp(stamp, unit="us")], value: [held], "version": [version]})

    rows = events.withWatermark(at, f"{int(ttl_hours)} hours").select(key, at, value)
    return rows.groupBy(key).applyInPandasWithState(update, schema, f"stamp long, held {kind[value]}, version int", "update", "EventTimeTimeout")


def into_store(stream: DataFrame, upsert: Callable[[DataFrame], None], checkpoint: str) -> None:
    """Drain a stream into a keyed store, one upsert a micro-batch; a batch that is replayed changes nothing.

    How many files make a batch is a matter of the stream (:func:`file_stream`).
    """
    q = stream.writeStream.foreachBatch(lambda df, _: upsert(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def advanced(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of a second stage whose key the first stage has finished."""
    return rows.join(done.select(key).distinct(), key, "left_semi")


def retried(results: DataFrame, again: Callable[[DataFrame], DataFrame], key: str, ok: str = "success") -> DataFrame:
    """Results with the failed ones run again: what succeeded stays, each failed key has its new result, or its old one if it has none."""
    failed = results.where(~F.coalesce(F.col(ok), F.lit(False)))
    new = again(failed.select(key).distinct()).select(*results.columns)
    still = failed.join(new.select(key).distinct(), key, "left_anti").select(*results.columns)
    return results.where(F.coalesce(F.col(ok), F.lit(False))).unionByName(new).unionByName(still)


def in_two_waves(items: DataFrame, first: Callable[[DataFrame], DataFrame], second: Callable[[DataFrame, DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results of the first wave, stored, and of the second, which works on what the first found."""
    one = keep(first(items))
    return one.unionByName(second(items, one))


def cached(rows: DataFrame, key: str, at: str, now: Column, hours: float, most: int) -> DataFrame:
    """The newest row of each key that is no older than ``hours``, newest first, at most ``most``."""
    fresh = expired(rows, F.col(at), now, hours)
    rest = [c for c in rows.columns if c not in (key, at)]
    one = fresh.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("_r")).select(key, f"_r.{at}", *[f"_r.{c}" for c in rest])
    return one.orderBy(F.col(at).desc(), key).limit(most)


def expired(rows: DataFrame, at: Column, now: Column, hours: float) -> DataFrame:
    """Rows no older than ``hours`` at a stated time."""
    return rows.where((now.cast("timestamp").cast("double") - at.cast("timestamp").cast("double")) <= hours * 3600)


def changed(rows: DataFrame, seen: DataFrame, key: str, signature: str) -> DataFrame:
    """Rows whose key and signature haven't been processed: what a resumed run has left to do."""
    return rows.join(seen.select(key, signature).distinct(), [key, signature], "left_anti")


def job_states(log: DataFrame, job: str, at: str, event: str) -> DataFrame:
    """(job, state, steps): where each job's log of events leaves it.

    Terminal events win over what is logged after them; else the latest event tells.
    """
    terminal = ("done", "failed", "rejected", "terminated")
    end = F.min(F.when(F.col(event).isin(*terminal), F.struct(at, event)))
    last = F.max(F.struct(at, event))
    return log.groupBy(job).agg(end.alias("_e"), last.alias("_l"), F.count("*").alias("steps")).select(job, F.coalesce(F.col(f"_e.{event}"), F.col(f"_l.{event}")).alias("state"), "steps")
