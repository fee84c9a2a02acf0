"""The model step as a stream of its own: requests wait in state, retries wait on timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.operators.enrichment import ClientFactory
from chatpulse.session import pin_zone

_BOUNDS = ("_start_us", "_end_us")
REPLY = [
    T.StructField("response", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
]


class RetryQueue(StatefulProcessor):
    """State of one window: its request, the calls made so far, and whether it is settled.

    A call is made when the request comes and whenever a timer says so; between two calls
    nothing waits but the timer. A settled window stays known for ``remember_ms``, so that
    a request handed over twice is answered once.
    """

    def __init__(self, group: list[str], client_factory: ClientFactory, settings: EnrichSettings, remember_ms: int) -> None:
        self._group, self._factory = group, client_factory
        self._attempts, self._wait_ms, self._remember_ms = settings.attempts, settings.wait_ms, remember_ms
        self._client = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._entry = handle.getValueState(
            "entry",
            T.StructType([
                T.StructField("request", T.StringType()),
                T.StructField("attempts", T.IntegerType()),
                T.StructField("settled", T.BooleanType()),
            ]),
        )

    def _settle(self, key, now_ms: int, attempts: int, response: str | None, error: str | None) -> pd.DataFrame:
        self._entry.update((None, attempts, True))
        self._handle.registerTimer(now_ms + self._remember_ms)
        values = {name: [value] for name, value in zip(self._group, key)}
        return pd.DataFrame(values | {"response": [response], "attempts": [attempts], "error": [error]})

    def _call(self, key, now_ms: int, request: str, attempts: int) -> Iterator[pd.DataFrame]:
        if self._client is None:
            self._client = self._factory()
        try:
            response = self._client(request)
        except OSError as e:
            if attempts + 1 >= self._attempts:
                yield self._settle(key, now_ms, attempts + 1, None, str(e) or type(e).__name__)
                return
            self._entry.update((request, attempts + 1, False))
            # Doubling waits, at least a millisecond: a timer of this instant would not fire.
            self._handle.registerTimer(now_ms + max(1, self._wait_ms << attempts))
            return
        yield self._settle(key, now_ms, attempts + 1, response, None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        requests = [request for batch in rows for request in batch["request"]]
        if not self._entry.exists():
            yield from self._call(key, timerValues.getCurrentProcessingTimeInMs(), requests[0], 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._entry.exists():
            return
        request, attempts, settled = self._entry.get()
        if settled:
            self._entry.clear()
        else:
            yield from self._call(key, timerValues.getCurrentProcessingTimeInMs(), request, attempts)

    def close(self) -> None:
        pass


def with_heartbeat(requests: DataFrame) -> DataFrame:
    """The stream with a source beside it that never has a row but always news.

    A restarted stream runs its first micro-batch when a source has news, and timers only fire in
    micro-batches; without the beat, waits from before the restart would last until the next request.
    """
    beat = requests.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().where("value < 0")
    return requests.unionByName(beat.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in requests.schema.fields]))


def model_replies(
    requests: DataFrame,
    client_factory: ClientFactory,
    settings: EnrichSettings,
    plan: WindowPlan = WindowPlan(),
    remember: str = "1 day",
) -> DataFrame:
    """Replies to a stream of requests (``narrative_requests``), one row a window: ``response, attempts, error``.

    Every window comes out once, answered or with the reason of its last failed call. Waits
    between the calls of a window are timers on the state, so a window that is waiting holds up neither
    the others nor a task; calls and waits survive a restart with the state. As many calls are
    under way as the stream has state partitions. A call whose micro-batch fails is made again. The stream
    must keep running for timers to fire (a trigger by time).
    """
    spark = pin_zone(requests.sparkSession)
    group = [*plan.keys, *_BOUNDS]
    types = {f.name: f.dataType for f in requests.schema.fields}
    milliseconds = f"SELECT cast(unix_millis(timestamp_seconds(0) + INTERVAL '{remember}') AS bigint)"
    remember_ms = spark.sql(milliseconds).first()[0]
    rows = with_heartbeat(requests).select(
        *plan.keys, F.unix_micros("win_start").alias("_start_us"), F.unix_micros("win_end").alias("_end_us"), "request"
    )
    output = T.StructType(
        [T.StructField(name, types[name]) for name in plan.keys]
        + [T.StructField(name, T.LongType()) for name in _BOUNDS]
        + REPLY
    )
    replies = rows.groupBy(*group).transformWithStateInPandas(
        statefulProcessor=RetryQueue(group, client_factory, settings, remember_ms),
        outputStructType=output,
        outputMode="append",
        timeMode="ProcessingTime",
    )
    bounds = [F.timestamp_micros("_start_us").alias("win_start"), F.timestamp_micros("_end_us").alias("win_end")]
    return replies.select(*plan.keys, *bounds, *[f.name for f in REPLY])
