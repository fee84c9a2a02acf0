"""Incoming lines: parsed once, good and damaged ones stored apart, counted, and stopped if too many are damaged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from chatpulse.operators.lines import REASONS, damaged_lines, good_lines, line_counts, tagged_lines
from chatpulse.sources.writers import BatchSink
from chatpulse.streaming.jobs import start_batches


class TooManyDamagedLines(RuntimeError):
    """The share of damaged lines in a micro-batch is beyond what the rule allows."""


@dataclass(frozen=True)
class StopRule:
    """Stop when more than ``share`` of a micro-batch's lines are damaged, if it has at least ``lines``."""

    share: float
    lines: int = 100

    def check(self, counts: dict[str, int]) -> None:
        damaged = sum(counts[name] for name in REASONS)
        if counts["lines"] >= self.lines and damaged > self.share * counts["lines"]:
            told = ", ".join(f"{name} {counts[name]}" for name in REASONS if counts[name])
            raise TooManyDamagedLines(f"{damaged} of {counts['lines']} lines are damaged: {told}")


def store_tagged(lines: DataFrame, path: str, value: str = "value") -> dict[str, int]:
    """Parse each line once into a table at ``path`` and return the counts, taken on the way."""
    seen = Observation()
    tagged_lines(lines, value).observe(seen, *line_counts()).write.mode("overwrite").parquet(path)
    return {name: int(count) for name, count in seen.get.items()}


def line_handler(
    work_dir: str,
    good: BatchSink,
    damaged: BatchSink,
    stop: StopRule | None = None,
    counts: Callable[[dict[str, int], int], None] | None = None,
    value: str = "value",
) -> Callable[[DataFrame, int], None]:
    def handle(lines: DataFrame, batch_id: int) -> None:
        path = f"{work_dir}/lines/batch_id={batch_id}"
        found = store_tagged(lines, path, value)
        if counts:
            counts(found, batch_id)
        stored = lines.sparkSession.read.parquet(path)
        damaged(damaged_lines(stored), batch_id)
        if stop:
            stop.check(found)
        good(good_lines(stored, value), batch_id)

    return handle


def start_lines(
    lines: DataFrame,
    work_dir: str,
    good: BatchSink,
    damaged: BatchSink,
    stop: StopRule | None = None,
    counts: Callable[[dict[str, int], int], None] | None = None,
    trigger: str | None = "10 seconds",
    name: str = "chat-lines",
) -> StreamingQuery:
    """Split a stream of lines into messages and damaged lines.

    A micro-batch is read and parsed once and stored with its tags; both sinks read that table. Damaged
    lines are kept before the rule is asked, so what stopped a stream can be looked at;
    nothing of that micro-batch has been passed on as good, and it runs again after a restart.
    """
    return start_batches(lines, line_handler(work_dir, good, damaged, stop, counts), name, work_dir, trigger)


def split_lines(lines: DataFrame, path: str, stop: StopRule | None = None, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(messages, damaged lines) of a table of lines, through one stored pass."""
    found = store_tagged(lines, path, value)
    if stop:
        stop.check(found)
    stored = lines.sparkSession.read.parquet(path)
    return good_lines(stored, value), damaged_lines(stored)
