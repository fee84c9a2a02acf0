"""Keep the newest rows of every open window of a stream, in bounded state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatpulse.config import WindowPlan
from chatpulse.operators.windows import assign_windows
from chatpulse.session import pin_zone

EVENT_TIME = "EventTime"
PROCESSING_TIME = "ProcessingTime"

_BOUNDS = ("_start_us", "_end_us")


class NewestRows(StatefulProcessor):
    """State of one shard of one window: at most ``limit`` rows, handed over at its end."""

    def __init__(self, plan: WindowPlan, state: T.StructType, early_ms: int) -> None:
        self._early_ms = early_ms
        self._limit = plan.limit
        self._order = list(plan.order)
        self._group = [*plan.keys, *_BOUNDS]
        self._state_schema = state
        self._names = state.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("newest", self._state_schema)

    def _trim(self, frames: list[pd.DataFrame]) -> pd.DataFrame:
        rows = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        return rows.sort_values(self._order, ascending=False, kind="stable").head(self._limit)

    def _stored(self) -> pd.DataFrame:
        return pd.DataFrame(list(self._rows.get()), columns=self._names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = None if not self._rows.exists() else self._stored()
        for batch in rows:
            batch = batch[self._names]
            newest = self._trim([batch] if newest is None else [newest, batch])
        if newest is not None:
            self._rows.put([tuple(row) for row in newest.astype(object).itertuples(index=False)])
            end_us = int(key[self._group.index("_end_us")])
            self._handle.registerTimer(end_us // 1000 - self._early_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = self._stored()
        self._rows.clear()
        for name, value in zip(self._group, key):
            rows[name] = value
        yield rows[self._group + self._names]

    def close(self) -> None:
        pass


#: Rows and bytes a task holds back while it trims; it passes them on beyond that.
HELD_ROWS, HELD_BYTES = 200_000, 16 << 20


def trim_tasks(rows: DataFrame, group: list[str], order: list[str], limit: int) -> DataFrame:
    """At most the newest ``limit`` rows of each group from each task, before anything is shuffled.

    A task whose groups hold more than it may keep passes them on now and then; then it sends
    more than that, never less. Rows are trimmed when half of that has come in, not at every batch.
    """

    def newest(held: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(held)
        keys = table.select([*group, *order]).to_pandas(types_mapper=pd.ArrowDtype)
        best = keys.sort_values(order, ascending=False, kind="stable").groupby(group, dropna=False, sort=False).head(limit)
        return table.take(pa.array(best.index.to_numpy()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full(tables: list[pa.Table], share: int = 1) -> bool:
            return share * sum(t.num_rows for t in tables) >= HELD_ROWS or share * sum(t.nbytes for t in tables) >= HELD_BYTES

        held, since = [], []
        for batch in batches:
            since.append(pa.Table.from_batches([batch]))
            if full(since, 2):
                held, since = [newest([*held, *since])], []
                if full(held):
                    yield from held[0].to_batches()
                    held = []
        if held or since:
            yield from newest([*held, *since]).to_batches()

    return rows.mapInArrow(work, rows.schema)


def closed_windows(
    messages: DataFrame, plan: WindowPlan = WindowPlan(), mode: str = EVENT_TIME, delay: str = "0 seconds"
) -> DataFrame:
    """Newest rows of each window, sent once, when the window ends.

    Up to ``limit * state_shards`` rows of a window come out, all in the same micro-batch;
    ``keep_newest`` over them gives the window's final rows. Columns: the group columns,
    the order columns and ``message``. Each task trims its part of a window to ``limit`` rows before
    the shuffle.

    ``EventTime`` ends a window when a later one has been seen (plus ``delay``): the
    watermark runs on window starts, so rows out of order inside an open window stay.
    ``ProcessingTime`` goes by the clock and also ends windows of a stream gone idle; the
    arrival column must then be the micro-batch time (``sources.readers.stamped``).
    """
    pin_zone(messages.sparkSession)
    windowed = assign_windows(messages, plan)
    types = {f.name: f.dataType for f in messages.schema.fields}
    instants = [name for name in plan.order if isinstance(types[name], T.TimestampType)]

    def as_long(name: str):
        return (F.unix_micros(name) if name in instants else F.col(name).cast("bigint")).alias(name)

    shard = F.pmod(F.xxhash64(*plan.order), F.lit(plan.state_shards)).alias("_shard")
    state = T.StructType(
        [T.StructField(name, T.LongType()) for name in plan.order] + [T.StructField("message", T.StringType())]
    )
    output = T.StructType(
        [T.StructField(name, types[name]) for name in plan.keys]
        + [T.StructField(name, T.LongType()) for name in _BOUNDS]
        + state.fields
    )
    # The watermark column has to stay among the inputs although only its micros are used.
    rows = windowed.select(
        *plan.keys,
        "win_start",
        F.unix_micros("win_start").alias("_start_us"),
        F.unix_micros("win_end").alias("_end_us"),
        shard,
        *[as_long(name) for name in plan.order],
        "message",
    )
    rows = trim_tasks(rows, [*plan.keys, "_start_us"], list(plan.order), plan.limit)
    early_ms = 0
    if mode == EVENT_TIME:
        # Rows AT the watermark count as late. Held back by a millisecond it stays below the
        # start of the newest window; timers are early by as much, so windows end on time.
        early_ms = 1
        rows = rows.withWatermark("win_start", f"{delay} {early_ms} millisecond")
    closed = rows.groupBy(*plan.keys, *_BOUNDS, "_shard").transformWithStateInPandas(
        statefulProcessor=NewestRows(plan, state, early_ms),
        outputStructType=output,
        outputMode="append",
        timeMode=mode,
    )
    return closed.select(
        *plan.keys,
        F.timestamp_micros("_start_us").alias("win_start"),
        F.timestamp_micros("_end_us").alias("win_end"),
        *[F.timestamp_micros(n).alias(n) if n in instants else F.col(n) for n in plan.order],
        "message",
    )
