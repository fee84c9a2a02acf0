import pytest

from chatpulse.config import EnrichSettings, SettingsError, enrich_settings, kafka_settings


def test_kafka_defaults_and_overrides():
    settings = kafka_settings({})
    assert (settings.bootstrap_servers, settings.messages_topic) == ("kafka:9092", "slack_messages")
    assert kafka_settings({"SLACK_MESSAGES_TOPIC": "t"}).messages_topic == "t"


def test_key_and_model_are_required():
    for env in ({}, {"OPENAI_API_KEY": "k"}, {"OPENAI_MODEL": "m"}, {"OPENAI_API_KEY": "", "OPENAI_MODEL": "m"}):
        with pytest.raises(SettingsError):
            enrich_settings(env)


def test_retry_settings():
    env = {"OPENAI_API_KEY": "k", "OPENAI_MODEL": "m"}
    assert (enrich_settings(env).attempts, enrich_settings(env).wait_ms) == (3, 1000)
    settings = enrich_settings({**env, "OPENAI_MAX_RETRIES": "5", "OPENAI_WAIT_TIME": "10"})
    assert (settings.attempts, settings.wait_ms) == (5, 10)
    with pytest.raises(SettingsError):
        enrich_settings({**env, "OPENAI_MAX_RETRIES": "many"})
    with pytest.raises(SettingsError):
        enrich_settings({**env, "OPENAI_MAX_RETRIES": "0"})


def test_the_key_is_not_printed():
    assert "secret" not in repr(EnrichSettings(model="m", api_key="secret"))
