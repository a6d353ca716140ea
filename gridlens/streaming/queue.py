"""A staged work queue as streams.

Messages arrive as files or from any source (image_id, model or stage, ...). State is kept by
key in the state store, exactly once with the checkpoint; acknowledgement is the commit of a
micro-batch, and what a batch writes carries its id, so that a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

#: Milliseconds for which a key that is through is remembered: a day.
KEEP_MS = 86_400_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def messages(spark: SparkSession, path: str, schema, per_batch: int = 1) -> DataFrame:
    """Messages appended to a folder, in order of arrival; the checkpoint is the reader's place."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def submit(rows: DataFrame, path: str) -> None:
    """Appends messages; files show up whole or not at all."""
    rows.write.mode("append").parquet(path)


class Barrier(StatefulProcessor):
    """Lets a key through once ``need`` different models have reported, or, with a time limit, whoever has by then."""

    def __init__(self, need: int, limit_ms: int | None = None, keep_ms: int = KEEP_MS):
        self.need, self.limit_ms, self.keep_ms = need, limit_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # one value, read and written once a batch: each call to the store is a round trip
        self.seen = handle.getValueState("seen", "models array<long>, boxes array<long>, through boolean")

    def _row(self, key, seen: dict[int, int], late: bool) -> Row:
        self.seen.update(([], [], True))
        for at in list(self.handle.listTimers()) if self.limit_ms is not None else ():
            self.handle.deleteTimer(at)
        return Row(image_id=key[0], models=len(seen), boxes=sum(seen.values()), late=late)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.seen.get()
        if held is not None and held[2]:
            return
        seen = {} if held is None else dict(zip(held[0], held[1], strict=True))
        for row in rows:
            seen[row.model] = row.boxes  # a repeated report counts once
        if len(seen) >= self.need:
            yield self._row(key, seen, False)
            return
        self.seen.update((list(seen), list(seen.values()), False))
        if held is None and self.limit_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.limit_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.seen.get()
        if held is not None and not held[2]:
            yield self._row(key, dict(zip(held[0], held[1], strict=True)), True)

    def close(self) -> None:
        pass


class Retries(StatefulProcessor):
    """Counts the attempts of failed work: again, or dead at ``most``. Work that is dead, or came through, is forgotten."""

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.attempts = handle.getValueState("attempts", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.attempts.get()[0] if self.attempts.exists() else 0
        n, through = before, False
        for batch in rows:
            n += int(batch["failed"].sum())
            through |= not batch["failed"].all()
        if n >= self.most or (through and n == before):
            self.attempts.clear()
        elif n > before:
            self.attempts.update((n,))
        if n > before:
            yield pd.DataFrame({"image_id": [key[0]], "attempts": [min(n, self.most)], "outcome": ["dead" if n >= self.most else "again"]})

    def close(self) -> None:
        pass


class Stale(StatefulProcessor):
    """Gives back a claim of which nothing was heard for ``limit_ms``, by the clock or by the rows' own time ``ms``."""

    def __init__(self, limit_ms: int, by_clock: bool = True):
        self.limit_ms, self.by_clock = limit_ms, by_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.claim = handle.getValueState("claim", "worker string, until long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = before = self.claim.get()
        now = timerValues.getCurrentProcessingTimeInMs() if self.by_clock else None
        for row in rows:
            until = (now if self.by_clock else row.ms) + self.limit_ms
            if row.kind == "release":
                held = None
            elif held is None or held[1] <= until:  # a claim or a heartbeat
                held = (row.worker, until)
        if held is None:
            if before is not None:
                self.claim.clear()
        elif before is None or tuple(held) != tuple(before):
            self.claim.update(tuple(held))
        old, new = (None if x is None else x[1] for x in (before, held))
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if new is not None and old != new:
            self.handle.registerTimer(new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.claim.get()
        if held is not None and held[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.claim.clear()
            yield Row(image_id=key[0], worker=held[0])

    def close(self) -> None:
        pass


def barrier(reports: DataFrame, need: int, limit_ms: int | None = None) -> DataFrame:
    """(image_id, models, boxes, late) from reports (image_id, model, boxes)."""
    return reports.groupBy("image_id").transformWithState(Barrier(need, limit_ms), "image_id long, models long, boxes long, late boolean", "Append", "ProcessingTime" if limit_ms is not None else "None")


def retries(results: DataFrame, most: int) -> DataFrame:
    """(image_id, attempts, outcome) from results (image_id, failed)."""
    return results.groupBy("image_id").transformWithStateInPandas(Retries(most), "image_id long, attempts long, outcome string", "Update", "None")


def stale(claims: DataFrame, limit_ms: int) -> DataFrame:
    """(image_id, worker) of claims that went silent by the clock, from (image_id, kind, worker)."""
    return claims.groupBy("image_id").transformWithState(Stale(limit_ms), "image_id long, worker string", "Append", "ProcessingTime")


def stale_by_time(claims: DataFrame, limit_ms: int, late: str = "0 seconds") -> DataFrame:
    """(image_id, worker) of claims of which nothing is heard for so long by the time ts of (image_id, kind, worker, ts)."""
    timed = claims.withColumn("ms", F.unix_millis("ts")).withWatermark("ts", late)
    return timed.groupBy("image_id").transformWithState(Stale(limit_ms, False), "image_id long, worker string", "Append", "EventTime")


def enveloped(rows: DataFrame, stage: str, job: str) -> DataFrame:
    """Messages as they travel: message_id (of the stage, the job and the content, so that a repeated one has the same), stage, job_id, data."""
    data = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    return rows.select(data.alias("data")).select(F.sha2(F.concat_ws("\n", F.lit(stage), F.lit(job), "data"), 256).substr(1, 32).alias("message_id"), F.lit(stage).alias("stage"), F.lit(job).alias("job_id"), "data")


def opened(messages: DataFrame, schema: str) -> DataFrame:
    """message_id, stage, job_id and the content's columns."""
    return messages.select("message_id", "stage", "job_id", F.from_json("data", schema).alias("_d")).select("message_id", "stage", "job_id", "_d.*")


def dead_letters(messages: DataFrame, error: Column) -> DataFrame:
    """Failed messages in an envelope of stage dead_letter that holds where they come from, their id, content and error."""
    inner = F.to_json(F.struct(F.col("stage").alias("origin"), "message_id", "data", error.alias("error")))
    return messages.where(error.isNotNull()).select("message_id", F.lit("dead_letter").alias("stage"), "job_id", inner.alias("data"))


def of_job(rows: DataFrame, job: str) -> DataFrame:
    return rows.where(F.col("job_id") == job)


def forward(rows: DataFrame, checkpoint: str, results: str, dead: str, good=None, mode: str = "append") -> StreamingQuery:
    """Writes good rows to results and the others with their batch to dead; a repeated batch replaces itself."""
    ok = F.lit(True) if good is None else good

    def both(batch: DataFrame, batch_id: int) -> None:
        kept = batch.withColumn("_ok", F.coalesce(ok, F.lit(False))).persist()
        try:
            kept.where("_ok").drop("_ok").write.mode("overwrite").parquet(f"{results}/batch={batch_id}")
            kept.where("not _ok").drop("_ok").write.mode("overwrite").parquet(f"{dead}/batch={batch_id}")
        finally:
            kept.unpersist()

    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(both).start()


def run_now(rows: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there and gives what it wrote."""
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(out)


def event_windows(events: DataFrame, size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Events by type in tumbling or sliding windows, closed by the watermark."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def session_counts(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """Events of each user in sessions that a gap ends."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), "user_id", "n")


def with_backoff(effect: Callable, tries: int = 3, base_s: float = 0.5, again: Callable[[Exception], bool] = lambda e: True) -> Callable:
    """``effect`` tried again with doubling waits; the last error becomes the row's error, not the task's."""
    import time

    def run(x):
        for k in range(tries + 1):
            try:
                return effect(x), None
            except Exception as e:  # noqa: BLE001
                if k == tries or not again(e):
                    return None, f"{type(e).__name__}: {e}"
                time.sleep(base_s * 2**k)

    return run
