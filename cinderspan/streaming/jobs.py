"""Structured Streaming jobs: detection windows, rolling state, ledger state and activity sessions.

Each takes a streaming (or batch) DataFrame and returns one; the caller picks sink and trigger.
A row later than the watermark is left out, as with any watermark; the batch operators have no
such bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detection_windows(detections: DataFrame, hours: int = 12, late: str = "24 hours") -> DataFrame:
    """Per cell and window: distinct detections, brightest, latest. Repeated ids count once within the watermark."""
    once = detections.withWatermark("acquired_at", late)
    once = once.dropDuplicatesWithinWatermark(["detection_id"]) if detections.isStreaming else once.dropDuplicates(["detection_id"])
    return _by_window(once, F.window("acquired_at", f"{hours} hours"))


def rolling_state(detections: DataFrame, hours: int = 24, every: int = 3, late: str = "24 hours") -> DataFrame:
    """The state of the last ``hours``, every few hours."""
    return _by_window(detections.withWatermark("acquired_at", late), F.window("acquired_at", f"{hours} hours", f"{every} hours"))


def _by_window(detections: DataFrame, window) -> DataFrame:
    found = detections.groupBy(window.alias("w"), "x", "y").agg(F.count("*").alias("n"), F.max("bright_ti4").alias("max_bright"), F.max("acquired_at").alias("last_at"))
    return found.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "x", "y", "n", "max_bright", "last_at")


def ledger_current(entries: DataFrame, key: str = "expected_coverage_id") -> DataFrame:
    """The newest status of every key, kept up to date (update or complete mode)."""
    newest = entries.groupBy(key).agg(F.max_by(F.struct("status", "recorded_at"), F.struct("recorded_at", "append_order")).alias("r"))
    return newest.select(key, "r.status", "r.recorded_at")


def activity_sessions(events: DataFrame, key: str = "fire_id", time: str = "acquired_at", gap: str = "18 hours", late: str = "24 hours") -> DataFrame:
    """Runs of activity per key that no gap of ``gap`` or more breaks."""
    found = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("s"), key).agg(F.count("*").alias("n"))
    return found.select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def publish(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Run what is available, once. Append mode adds Parquet files; the others replace the table with each batch's result."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).outputMode(mode)
    if mode == "append":
        return writer.format("parquet").option("path", path).start()

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return writer.foreachBatch(replace).start()
