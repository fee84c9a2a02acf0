"""Both results of every window put together as they come in: latest of each side, changes sent once, waiting sides told."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatpulse.config import WindowPlan
from chatpulse.operators.comparison import (
    CLASSIFIER,
    NARRATIVE,
    PLACED,
    RESULT_COLUMNS,
    Order,
    comparison_columns,
)
from chatpulse.session import pin_zone

KINDS = (CLASSIFIER, NARRATIVE)
NUMBERS = {"message_count": T.LongType(), "average_score": T.DoubleType()}
_BOUNDS = ("_start_us", "_end_us")
#: Place of a result without an order: before all others.
OLDEST = -(2**63)

_FIELDS = [T.StructField(name, NUMBERS.get(name, T.StringType())) for name in RESULT_COLUMNS]


def _plain(value):
    """A value as state rows take it: None for what is missing, Python numbers."""
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


class TwoSides(StatefulProcessor):
    """State of one window: the latest result of each kind, and how many changes have been sent."""

    def __init__(self, group: list[str], order: list[str]) -> None:
        self._group, self._order = group, order
        self._kind = T.StructType([T.StructField("kind", T.StringType())])
        self._side = T.StructType([T.StructField(name, T.LongType()) for name in order] + _FIELDS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._sides = handle.getMapState("sides", self._kind, self._side)
        self._sent = handle.getValueState("sent", T.StructType([T.StructField("n", T.LongType())]))

    def _latest(self, rows: Iterator[pd.DataFrame]) -> dict[str, tuple]:
        """The newest result of each kind among the input rows; of equal places the one that came last."""
        found: dict[str, tuple] = {}
        for batch in rows:
            newest = batch.sort_values(self._order, kind="stable").groupby("kind", sort=False).tail(1)
            for row in newest[["kind", *self._order, *RESULT_COLUMNS]].itertuples(index=False):
                kind, *values = map(_plain, row)
                if kind not in found or found[kind][: len(self._order)] <= tuple(values[: len(self._order)]):
                    found[kind] = tuple(values)
        return found

    def _out(self, key, missing: str | None) -> pd.DataFrame:
        sent = self._sent.get()[0] + 1 if self._sent.exists() else 0
        self._sent.update((sent,))
        values = {name: [value] for name, value in zip(self._group, key)} | {"change": [sent], "missing": [missing]}
        for kind in KINDS:
            side = self._sides.getValue((kind,))[len(self._order) :] if self._sides.containsKey((kind,)) else [None] * len(RESULT_COLUMNS)
            values |= {f"{kind}_{name}": [value] for name, value in zip(RESULT_COLUMNS, side)}
        return pd.DataFrame(values).astype({f"{kind}_message_count": "Int64" for kind in KINDS})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        places = len(self._order)
        changed = False
        for kind, new in self._latest(rows).items():
            old = tuple(self._sides.getValue((kind,))) if self._sides.containsKey((kind,)) else None
            if old is None or new[:places] > old[:places]:
                self._sides.updateValue((kind,), new)
                changed |= old is None or new[places:] != old[places:]
        self._handle.registerTimer(int(key[self._group.index("_start_us")]) // 1000)
        if changed and all(self._sides.containsKey((kind,)) for kind in KINDS):
            yield self._out(key, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        missing = [kind for kind in KINDS if not self._sides.containsKey((kind,))]
        if len(missing) == 1:
            yield self._out(key, missing[0])
        self._sides.clear()
        self._sent.clear()

    def close(self) -> None:
        pass


def merged_sides(
    results: DataFrame, plan: WindowPlan = WindowPlan(), delay: str = "10 minutes", seq: Order = "seq"
) -> DataFrame:
    """Changes of the comparison of a result stream (``read_results`` or ``place_results``), as they happen.

    One row when a window first has both sides and whenever a newer result changes one of them: the columns of
    ``compare_windows`` with ``missing`` null. A window that still waits for a side when results ``delay``
    further on have come gets one row with the ``missing`` kind, and is closed. ``change``
    numbers the rows of a window from 0; the last one holds (``last_changes``). A result that comes
    again, or one older than what is there, sends nothing.

    State is two results a window for as long as it is open. Results may come in any order within
    ``delay``; later ones are dropped, as their window is closed. Results without bounds
    are left out, as in ``compare_windows``; one without an order counts as the oldest.
    """
    pin_zone(results.sparkSession)
    order = [seq] if isinstance(seq, str) else list(seq)
    types = {f.name: f.dataType for f in results.schema.fields}

    def place(name: str) -> Column:
        value = F.unix_micros(name) if isinstance(types[name], T.TimestampType) else F.col(name).cast("bigint")
        return F.coalesce(value, F.lit(OLDEST)).alias(f"place_{name}")

    group = [*plan.keys, *_BOUNDS]
    rows = (
        results.where(PLACED)
        .where(F.col("kind").isin(*KINDS))
        .select(
            *plan.keys,
            "win_start",
            F.unix_micros("win_start").alias("_start_us"),
            F.unix_micros("win_end").alias("_end_us"),
            "kind",
            *[place(name) for name in order],
            *RESULT_COLUMNS,
        )
        .withWatermark("win_start", delay)
    )
    output = T.StructType(
        [T.StructField(name, types[name]) for name in plan.keys]
        + [T.StructField(name, T.LongType()) for name in _BOUNDS]
        + [T.StructField("change", T.LongType()), T.StructField("missing", T.StringType())]
        + [T.StructField(f"{kind}_{f.name}", f.dataType) for kind in KINDS for f in _FIELDS]
    )
    changes = rows.groupBy(*group).transformWithStateInPandas(
        statefulProcessor=TwoSides(group, [f"place_{name}" for name in order]),
        outputStructType=output,
        outputMode="append",
        timeMode="EventTime",
    )
    sides = [F.struct(*[F.col(f"{kind}_{name}").alias(name) for name in RESULT_COLUMNS]).alias(kind) for kind in KINDS]
    bounds = [F.timestamp_micros("_start_us").alias("win_start"), F.timestamp_micros("_end_us").alias("win_end")]
    both = changes.select(*plan.keys, *bounds, "change", "missing", *sides)
    shown = [F.when(F.col("missing").isNull(), column).alias(name) for name, column in zip(COMPARED, comparison_columns())]
    return both.select(*plan.group, "change", "missing", *shown)


#: Names of ``comparison_columns``, in order.
COMPARED = (
    "window_key",
    "classifier_sentiment",
    "classifier_positive",
    "classifier_negative",
    "classifier_count",
    "average_score",
    "narrative_sentiment",
    "narrative_positive",
    "narrative_negative",
    "narrative_count",
    "descriptive_paragraph",
)


def last_changes(changes: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """What holds of each window, from stored changes: compared sides, or the ``missing`` one."""
    columns = [c for c in changes.columns if c not in (*plan.group, "change", "batch_id")]
    last = F.max_by(F.struct(*columns), "change").alias("_last")
    return changes.groupBy(*plan.group).agg(last).select(*plan.group, "_last.*")
