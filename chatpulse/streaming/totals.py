"""Summaries over all messages of every open window of a stream: one small state row a window."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatpulse.config import WindowPlan
from chatpulse.functions.sentiment import NEGATIVE_CEILING, POSITIVE_FLOOR, Scorer
from chatpulse.operators.scoring import score_stats
from chatpulse.operators.summary import NUMBERS, SUMMARY_COLUMNS, with_label
from chatpulse.operators.windows import assign_windows
from chatpulse.session import pin_zone
from chatpulse.streaming.newest import EVENT_TIME

_BOUNDS = ("_start_us", "_end_us")
PICKS = ("most_positive", "most_negative")
#: Windows, and characters of their texts, that a task holds while it combines its rows; it passes them on beyond that.
HELD_WINDOWS, HELD_CHARS = 100_000, 32 << 20


def combined(frames: list[pd.DataFrame], group: list[str], order: list[str]) -> pd.DataFrame:
    """Partial summaries added up by group: sums, extremes, and the earliest pick of each kind."""
    rows = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    # By number: empty keys are keys like any other.
    number = rows.groupby(group, dropna=False, sort=False).ngroup().rename("_group")
    out = rows.groupby(number).agg(
        message_count=("message_count", "sum"),
        sentence_count=("sentence_count", "sum"),
        score_sum=("score_sum", "sum"),
        max_score=("max_score", "max"),
        min_score=("min_score", "min"),
    )
    out = out.join(rows[group].assign(_group=number).drop_duplicates("_group").set_index("_group"))
    for pick in PICKS:
        columns = [f"{pick}_{name}" for name in order]
        there = rows[rows[f"{pick}_there"]].sort_values(columns, kind="stable")
        first = there[[f"{pick}_there", *columns, pick]].assign(_group=number).drop_duplicates("_group")
        out = out.join(first.set_index("_group"))
        out[f"{pick}_there"] = out[f"{pick}_there"].notna()
    return out.reset_index(drop=True)


class WindowTotals(StatefulProcessor):
    """State of one window: its numbers and the two picked messages."""

    def __init__(self, group: list[str], order: list[str], state: T.StructType, early_ms: int) -> None:
        self._group, self._order, self._state, self._early_ms = group, order, state, early_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._totals = handle.getValueState("totals", self._state)

    def _keyed(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        """The state's columns with the key's beside them; rows come without the key's names."""
        return typed(rows[self._state.names].assign(**dict(zip(self._group, key))), self._state)

    def _stored(self, key) -> pd.DataFrame:
        return self._keyed(key, pd.DataFrame([tuple(self._totals.get())], columns=self._state.names))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [self._stored(key)] if self._totals.exists() else []
        frames += [self._keyed(key, batch) for batch in rows]
        total = combined(frames, self._group, self._order)[self._state.names].astype(object)
        row = total.where(total.notna(), None).iloc[0]
        self._totals.update(tuple(row))
        end_us = int(key[self._group.index("_end_us")])
        self._handle.registerTimer(end_us // 1000 - self._early_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = self._stored(key)[[*self._group, *NUMBERS, *PICKS]]
        self._totals.clear()
        yield out

    def close(self) -> None:
        pass


def typed(rows: pd.DataFrame, schema: T.StructType) -> pd.DataFrame:
    """Whole-number columns as ones that can be null, so that pandas makes no floats of them."""
    whole = {f.name: "Int64" for f in schema.fields if isinstance(f.dataType, T.LongType)}
    return rows.astype(whole | {f.name: bool for f in schema.fields if isinstance(f.dataType, T.BooleanType)})


def partial_schema(order: list[str]) -> T.StructType:
    fields = [T.StructField(name, T.LongType()) for name in NUMBERS]
    for pick in PICKS:
        fields.append(T.StructField(f"{pick}_there", T.BooleanType()))
        fields += [T.StructField(f"{pick}_{name}", T.LongType()) for name in order]
        fields.append(T.StructField(pick, T.StringType()))
    return T.StructType(fields)


def task_totals(
    own: list[str], order: list[str], state: T.StructType, names: list[str]
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Adds up a task's rows by window, in bounded memory: windows come out again when their texts are too long to hold."""

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def full(frames: list[pd.DataFrame], share: int = 1) -> bool:
            chars = sum(int(frame[pick].map(len, na_action="ignore").sum()) for frame in frames for pick in PICKS)
            return share * sum(map(len, frames)) >= HELD_WINDOWS or share * chars >= HELD_CHARS

        held, since = [], []
        for batch in batches:
            if len(batch):
                since.append(combined([typed(batch, state)], own, order))
            if full(since, 2):
                held, since = [combined([*held, *since], own, order)], []
                if full(held):
                    yield held[0][names]
                    held = []
        if held or since:
            yield combined([*held, *since], own, order)[names]

    return combine


def all_message_windows(
    messages: DataFrame,
    scorer: Scorer,
    plan: WindowPlan = WindowPlan(),
    mode: str = EVENT_TIME,
    delay: str = "0 seconds",
) -> DataFrame:
    """The summary of ALL messages of each window of a stream, sent once, when the window ends.

    Messages are scored where they are read, and only those that could be picked keep their text. Each
    task combines its rows to one row a window before the shuffle; the state of a window is one
    row with its numbers and two texts. Windows end as in ``closed_windows``: when a later
    one has been seen (plus ``delay``), or by the clock.
    """
    pin_zone(messages.sparkSession)
    types = {f.name: f.dataType for f in messages.schema.fields}
    order = list(plan.order)
    group = [*plan.keys, *_BOUNDS]
    state = partial_schema(order)

    def place(name: str) -> Column:
        return F.unix_micros(name) if isinstance(types[name], T.TimestampType) else F.col(name).cast("bigint")

    scored = score_stats(assign_windows(messages, plan), scorer)
    there = {"most_positive": F.col("max_score") >= POSITIVE_FLOOR, "most_negative": F.col("min_score") < NEGATIVE_CEILING}
    numbers = {"message_count": F.lit(1)} | {name: F.col(name) for name in NUMBERS[1:]}
    picks = []
    for pick, test in there.items():
        test = F.coalesce(test, F.lit(False))
        picks.append(test.alias(f"{pick}_there"))
        picks += [F.when(test, place(name)).alias(f"{pick}_{name}") for name in order]
        picks.append(F.when(test, F.col("message")).alias(pick))
    rows = scored.select(
        *plan.keys,
        "win_start",
        F.unix_micros("win_start").alias("_start_us"),
        F.unix_micros("win_end").alias("_end_us"),
        *[column.cast("bigint").alias(name) for name, column in numbers.items()],
        *picks,
    )
    combine = task_totals(["win_start", *group], order, state, rows.columns)
    watched, early_ms = rows.mapInPandas(combine, rows.schema), 0
    if mode == EVENT_TIME:
        # Rows at the watermark count as late; see ``closed_windows``.
        early_ms = 1
        watched = watched.withWatermark("win_start", f"{delay} {early_ms} millisecond")
    output = T.StructType(
        [T.StructField(name, types[name]) for name in plan.keys]
        + [T.StructField(name, T.LongType()) for name in _BOUNDS]
        + [T.StructField(name, T.LongType()) for name in NUMBERS]
        + [T.StructField(name, T.StringType()) for name in PICKS]
    )
    ended = watched.groupBy(*group).transformWithStateInPandas(
        statefulProcessor=WindowTotals(group, order, state, early_ms),
        outputStructType=output,
        outputMode="append",
        timeMode=mode,
    )
    small = [F.col(name).cast("int").alias(name) if name.endswith("_score") else F.col(name) for name in NUMBERS]
    bounds = [F.timestamp_micros(name).alias(to) for name, to in zip(_BOUNDS, ("win_start", "win_end"))]
    return with_label(ended.select(*plan.keys, *bounds, *small, *PICKS)).select(*plan.group, *SUMMARY_COLUMNS)
