"""A fixed-window rate limiter, as a stream and over a table; resumable processing of new rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Events allowed in a window, and its milliseconds.
LIMIT, WINDOW_MS = 8, 60_000

OUTPUT = "key string, ts timestamp_ntz, event_id long, count int, denied boolean"
State = tuple[int, int]


def counted(times: np.ndarray, state: State | None, window: int = WINDOW_MS) -> tuple[np.ndarray, State | None]:
    """The count of each event in its window, and (reset, count) after the last: a window opens at its first event and lasts to reset inclusive. times ascend, in milliseconds."""
    counts, at = np.empty(len(times), np.int32), 0
    while at < len(times):
        if state is None or times[at] > state[0]:
            state = int(times[at]) + window, 0
        stop = int(np.searchsorted(times, state[0], side="right"))
        counts[at:stop] = state[1] + np.arange(1, stop - at + 1)
        state = state[0], state[1] + stop - at
        at = stop
    return counts, state


def _events(events: DataFrame) -> DataFrame:
    return events.select(F.col("key").cast("string").alias("key"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("event_id").cast("long").alias("event_id"))


def limited(events: DataFrame, limit: int = LIMIT, window: int = WINDOW_MS) -> DataFrame:
    """events (key, ts, event_id) with their count in the window and whether they are denied; denied events count too.

    The windows of a key follow from each other, so its events are read in order, as a stream of Arrow batches
    from a sort within partitions: a key of any size passes in bounded memory, window by window. A null key is a key
    like any other; an event without time belongs to no window, so its count and denied are null. No events give no rows.
    """
    ordered = _events(events).repartition("key").sortWithinPartitions("key", "ts", "event_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: str | None = None
        state: State | None = None
        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))
            ends = np.asarray(runs.run_ends)
            timed = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            times = pc.fill_null(batch.column(1).cast(pa.int64()), 0).to_numpy(zero_copy_only=False) // 1000
            counts = np.zeros(len(times), np.int32)
            for key, start, end in zip(runs.values.to_pylist(), np.r_[0, ends], ends):
                start += int((~timed[start:end]).sum())
                counts[start:end], state = counted(times[start:end], state if key == last else None, window)
                last = key
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, mask=~timed), pa.array(counts > limit, mask=~timed)], names=["key", "ts", "event_id", "count", "denied"])

    return ordered.mapInArrow(run, OUTPUT)


def limited_stream(events: DataFrame, limit: int = LIMIT, window: int = WINDOW_MS, late: str = "10 minutes") -> DataFrame:
    """The same for a stream, with one state (reset, count) for each key.

    A key's state is dropped when the watermark, late behind the newest event, has passed its reset: any event that may
    still come opens a new window anyway. Events that are later than that are dropped by the watermark, as are events
    without time.
    """
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frame = pd.concat(list(frames)).sort_values(["ts", "event_id"], kind="stable")
        times = frame.ts.to_numpy("datetime64[us]").astype(np.int64) // 1000
        counts, now = counted(times, tuple(state.get) if state.exists else None, window)
        state.update(now)
        state.setTimeoutTimestamp(max(now[0], state.getCurrentWatermarkMs()) + 1)
        name = None if pd.isna(key[0]) else key[0]
        yield pd.DataFrame({"key": pd.Series([name] * len(counts), dtype=object), "ts": frame.ts.to_numpy(), "event_id": frame.event_id.to_numpy(), "count": counts, "denied": counts > limit})

    timed = _events(events).where("ts IS NOT NULL").withColumn("at", F.to_timestamp("ts")).withWatermark("at", late)
    return timed.groupBy("key").applyInPandasWithState(run, OUTPUT, "reset long, count int", "append", GroupStateTimeout.EventTimeTimeout)


def resume(stream: DataFrame, keys: list[str], path: str, process: Callable[[DataFrame], DataFrame], checkpoint: str):
    """Starts a query that appends process(new rows) to path; rows whose keys path has are skipped, so a batch may be repeated."""
    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        try:
            done = spark.read.parquet(path).select(*keys)
        except Exception as error:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            done = None
        new = rows.dropDuplicates(keys)
        new = new.join(done, keys, "left_anti") if done is not None else new
        process(new).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
