"""Settings of the batch and streaming jobs."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# Names and defaults a deployed installation already relies on.
DEFAULT_BOOTSTRAP_SERVERS = "kafka:9092"
DEFAULT_GROUP_ID = "flink-group"
DEFAULT_MESSAGES_TOPIC = "slack_messages"
DEFAULT_CLASSIFIER_TOPIC = "stanford_results"
DEFAULT_NARRATIVE_TOPIC = "gpt4_results"
DEFAULT_ATTEMPTS = 3
DEFAULT_WAIT_MS = 1000


class SettingsError(ValueError):
    """A setting is missing or has an unusable value."""


@dataclass(frozen=True)
class WindowPlan:
    """How messages are cut into windows and thinned out.

    ``keys`` adds grouping columns to the time window (none: one stream for all).
    ``order`` is the total arrival order inside a window; the last column must break ties.
    ``limit`` keeps only the newest rows of a window. ``shards`` spreads one very full
    window over that many tasks before its newest rows are picked; the square root of
    the number of input splits is a good value for a large table. ``state_shards`` does the
    same for the state of a stream; every shard is a state entry of its own, so raise it
    for few, very full windows only.
    """

    duration: str = "1 minute"
    offset: str = "0 seconds"
    limit: int = 50
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ("arrival", "seq")
    shards: int = 32
    state_shards: int = 4

    def __post_init__(self) -> None:
        if self.limit < 1:
            raise SettingsError("limit must be at least 1")
        if self.shards < 1 or self.state_shards < 1:
            raise SettingsError("shards must be at least 1")
        if not self.order:
            raise SettingsError("order needs at least one column")

    @property
    def group(self) -> list[str]:
        return [*self.keys, "win_start", "win_end"]

    def with_(self, **changes: object) -> WindowPlan:
        return replace(self, **changes)


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS
    group_id: str = DEFAULT_GROUP_ID
    messages_topic: str = DEFAULT_MESSAGES_TOPIC
    classifier_topic: str = DEFAULT_CLASSIFIER_TOPIC
    narrative_topic: str = DEFAULT_NARRATIVE_TOPIC


@dataclass(frozen=True)
class EnrichSettings:
    model: str
    api_key: str = field(default="", repr=False)
    attempts: int = DEFAULT_ATTEMPTS
    wait_ms: int = DEFAULT_WAIT_MS
    #: Calls that one task has under way at a time.
    calls: int = 4

    def __post_init__(self) -> None:
        if not self.model:
            raise SettingsError("a model name must be set")
        if self.attempts < 1 or self.calls < 1:
            raise SettingsError("attempts and calls must be at least 1")
        if self.wait_ms < 0:
            raise SettingsError("wait_ms must not be negative")


def _number(env: Mapping[str, str], name: str, default: int) -> int:
    text = env.get(name)
    if text is None:
        return default
    try:
        return int(text)
    except ValueError as e:
        raise SettingsError(f"{name} must be a whole number, not {text!r}") from e


def kafka_settings(env: Mapping[str, str] | None = None) -> KafkaSettings:
    env = os.environ if env is None else env
    return KafkaSettings(
        bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BOOTSTRAP_SERVERS),
        group_id=env.get("KAFKA_FLINK_GROUP_ID", DEFAULT_GROUP_ID),
        messages_topic=env.get("SLACK_MESSAGES_TOPIC", DEFAULT_MESSAGES_TOPIC),
        classifier_topic=env.get("STANFORD_RESULTS_TOPIC", DEFAULT_CLASSIFIER_TOPIC),
        narrative_topic=env.get("GPT4_RESULTS_TOPIC", DEFAULT_NARRATIVE_TOPIC),
    )


def enrich_settings(env: Mapping[str, str] | None = None) -> EnrichSettings:
    """Settings of the enrichment step; key and model are required."""
    env = os.environ if env is None else env
    for name in ("OPENAI_API_KEY", "OPENAI_MODEL"):
        if not env.get(name):
            raise SettingsError(f"{name} must be set")
    return EnrichSettings(
        model=env["OPENAI_MODEL"],
        api_key=env["OPENAI_API_KEY"],
        attempts=_number(env, "OPENAI_MAX_RETRIES", DEFAULT_ATTEMPTS),
        wait_ms=_number(env, "OPENAI_WAIT_TIME", DEFAULT_WAIT_MS),
    )
