"""Streaming session text (N1), micro-batch scoring (N2), dedupe.

The reference polls a moving range on a cron; the Spark form is a stream:
the watermark delay plays the role of the job's lag (``now_delta``), a
tumbling window the bucket, and the checkpoint folder gives exactly-once
output across restarts and lost executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wtprof.functions.text import clean_text
from wtprof.functions.timeutil import parse_interval
from wtprof.sessions_common import DEFAULT_TEXT


def event_time(df: DataFrame, col: str = "logtime") -> DataFrame:
    """Watermarks need ``timestamp`` (not ``timestamp_ntz``): cast first."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def stream_session_text(log: DataFrame, interval: str = "1 hour", delay: str = "1 hour",
                        keys: Sequence[str] = ("src_ip", "dst_ip"), label_col: str | None = "hash",
                        text_cols: Sequence[tuple[str, str]] = DEFAULT_TEXT, time_col: str = "logtime") -> DataFrame:
    """D1/D2 on a stream. Append mode emits a session once the
    watermark passes its window end; state holds cleaned distinct texts."""
    d = event_time(log, time_col).withWatermark(time_col, delay)
    n, unit = parse_interval(interval)
    if unit in ("month", "quarter", "year"):
        raise ValueError(f"a stream window has a fixed length; {unit} has none")
    # weeks start on Monday, as in batch (the epoch is a Thursday)
    window = F.window(time_col, f"{n} {unit}", startTime="4 days" if unit == "week" else None)
    grp = [window.alias("w"), *keys] + ([F.col(label_col).alias("label")] if label_col else [])
    cleaned = d.select(*grp, *[clean_text(src).alias(out) for out, src in text_cols])
    agg = cleaned.groupBy("w", *keys, *(["label"] if label_col else [])).agg(
        *[F.collect_set(out).alias(out) for out, _ in text_cols])
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("lgtime"), *keys,
                      *(["label"] if label_col else []),
                      *[F.array_join(F.sort_array(out), " ").alias(out) for out, _ in text_cols])


def stream_dedupe(df: DataFrame, keys: Sequence[str], delay: str = "1 hour", time_col: str = "logtime") -> DataFrame:
    """Drop repeats of ``keys`` arriving within the watermark delay."""
    return event_time(df, time_col).withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def run_to_completion(stream: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                      fmt: str = "parquet", foreach_batch: Callable | None = None) -> None:
    """Drive a stream over everything available now, then stop. The
    checkpoint must be on shared storage (it is the recovery log)."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", sink_path).start()
    q.awaitTermination()


def stream_predict(sessions: DataFrame, score: Callable[[DataFrame, int], DataFrame], sink_path: str,
                   checkpoint: str) -> None:
    """Score every micro-batch of closed sessions (``foreachBatch``:
    plain batch operators); ``score`` gets the batch and its number.

    Each micro-batch overwrites its own ``batch_id=<id>`` folder, so a batch
    replayed after a failure replaces its earlier output instead of adding
    duplicates (exactly-once output with the stream checkpoint)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(score(batch, batch_id), sink_path, batch_id)

    run_to_completion(sessions, sink_path, checkpoint, foreach_batch=handle)


def write_batch(df: DataFrame, sink_path: str, batch_id: int) -> None:
    """Idempotent micro-batch sink: overwrite the batch's own folder."""
    import os

    df.write.mode("overwrite").parquet(os.path.join(sink_path, f"batch_id={batch_id}"))


def events_stream(spark: SparkSession, source_dir: str, schema) -> DataFrame:
    """File stream over a folder of ``events``-shaped parquet files."""
    return spark.readStream.schema(schema).parquet(source_dir)
