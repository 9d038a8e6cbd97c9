"""Running streams: sinks, and the point-in-time feature job.

The feature job keeps its history as a table, not in operator state: a micro-batch reads the history days
its windows reach, runs the same strict rolling sweep as the batch engine over history and batch together
and keeps the batch rows. Hot users and merchants are therefore split like everywhere else, late rows see
all history that had arrived, and a retried batch overwrites its own partition.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from riskloom.config import DAY, DEFAULT, Config
from riskloom.functions.scalars import confidence, decision
from riskloom.operators.cleaning import dedupe_first
from riskloom.operators.drift import drift_tests
from riskloom.plans.features import engineer_features
from riskloom.sources.readers import path_exists
from riskloom.sources.deltas import append_delta, take_new

BatchFn = Callable[[DataFrame, int], None]


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into a parquet sink (exactly once) and stop."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(
        "append"
    ).trigger(availableNow=True).start().awaitTermination()


def run_each_batch(stream: DataFrame, fn: BatchFn, checkpoint: str, mode: str = "append") -> None:
    """Process everything available through ``fn(batch, batch_id)`` and stop."""
    stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(mode).trigger(
        availableNow=True
    ).start().awaitTermination()


def batch_sink(path: str) -> BatchFn:
    """Write each micro-batch to its own partition; a retry replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(path)

    return write


def upsert_sink(path: str, key: str, *order: str) -> BatchFn:
    """Upsert each micro-batch by key as a delta of its own (``deltas.read_latest`` reads, ``deltas.compact`` merges)."""
    return lambda batch, batch_id: append_delta(batch, path, batch_id, key, *order)


class LateRows(StreamingQueryListener):
    """Counts the rows that running queries drop behind their watermarks."""

    def __init__(self):
        self.dropped, self._ended = 0, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped += sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def after(self, spark: SparkSession, run: Callable[[], None]) -> int:
        """Rows dropped while ``run`` starts one query and waits for its end."""
        spark.streams.addListener(self)
        try:
            run()
            self._ended.wait(60)  # events come in order: behind the last progress
        finally:
            spark.streams.removeListener(self)
        return self.dropped


# --- point-in-time features ------------------------------------------------------------------------------------


def feature_batch(cfg: Config, history: str, sink: BatchFn) -> BatchFn:
    """A foreachBatch function that engineers features of each micro-batch against the stored history."""
    reach = max(cfg.user_window, cfg.merchant_window, cfg.velocity_window)
    time = cfg.time_column

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.floor(F.col(time) / DAY).cast("int")
        # The id is a primary key: within the batch here, against the stored history below.
        fresh = dedupe_first(batch, cfg.join_key, time).withColumns({"day": day, "batch_id": F.lit(batch_id).cast("bigint")})
        # A repeat may come long after, or claim an earlier time.
        fresh = take_new(fresh, f"{history}-ids", cfg.join_key, batch_id)
        past = None
        if path_exists(spark, history):
            span = batch.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).first()
            if span["lo"] is None:
                return
            first = (span["lo"] - reach) // DAY
            known = spark.read.parquet(history).where(F.col("batch_id") < batch_id)
            past = known.where(F.col("day").between(first, span["hi"] // DAY))
        fresh.select(*batch.columns, "batch_id", "day").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id", "day").parquet(history)

        stored = spark.read.parquet(history)
        rows = stored.where(F.col("batch_id") == batch_id)
        if past is not None:
            rows = rows.unionByName(past)
        # The sweep needs rows of the batch apart from history: the marker column rides along.
        marked = rows.withColumn("is_inference_batch", F.col("batch_id") == batch_id).drop("batch_id", "day")
        features = engineer_features(marked, cfg, ties="strict")
        sink(features.where("is_inference_batch").drop("is_inference_batch"), batch_id)

    return run


def stream_features(stream: DataFrame, history: str, out: str, checkpoint: str, cfg: Config = DEFAULT) -> None:
    """Transactions in, point-in-time features out (strictly earlier rows plus the row itself)."""
    run_each_batch(stream, feature_batch(cfg, history, batch_sink(out)), checkpoint)


def stream_scores(
    stream: DataFrame, history: str, out: str, checkpoint: str, score: Callable[[DataFrame], DataFrame],
    cfg: Config = DEFAULT,
) -> None:
    """Features, probability, band and confidence per event. ``score`` adds the column ``score``."""
    write = batch_sink(out)

    def sink(features: DataFrame, batch_id: int) -> None:
        p = F.col("score")
        banded = score(features).withColumns(
            {
                "prediction": decision(p, cfg.fraud_threshold, cfg.suspicious_threshold),
                "confidence": confidence(p, cfg.fraud_threshold, cfg.suspicious_threshold),
            }
        )
        write(banded, batch_id)

    run_each_batch(stream, feature_batch(cfg, history, sink), checkpoint)


def stream_drift(stream: DataFrame, reference: DataFrame, out: str, checkpoint: str, cfg: Config = DEFAULT, **tests) -> None:
    """Drift tests of every micro-batch against the reference: rows of the drift log."""
    write = batch_sink(out)
    run_each_batch(
        stream, lambda batch, batch_id: write(drift_tests(reference, batch, threshold=cfg.drift_threshold, **tests), batch_id), checkpoint
    )

