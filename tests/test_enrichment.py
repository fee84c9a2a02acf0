import json

import pytest

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.operators import enrichment
from chatpulse.operators.enrichment import (
    answered,
    call_with_retries,
    enrich,
    extract_content,
    failed,
    unusable_replies,
    window_prompts,
    window_requests,
)
from chatpulse.plans.branches import kept_messages, narrative_branch
from tests.helpers import at, messages

SETTINGS = EnrichSettings(model="m", wait_ms=0)


def test_prompt_lists_messages_in_arrival_order(spark):
    frame = messages(spark, [(30, "last"), (10, "first, with 100% of: signs"), (20, None)])
    row = window_prompts(kept_messages(frame)).first()
    assert row.message_count == 3
    assert row.bullets == "- first, with 100% of: signs\n- null\n- last"
    assert row.prompt.startswith("Please analyse the following set of Slack messages and provide")
    assert (
        "tone.\n\nWindow Start: 01/01/2024 00:00:00\nWindow End: 01/01/2024 00:01:00\n"
        "Messages Processed: 3\nMessages:\n- first, with 100% of: signs\n- null\n- last\n\nProvide your answer"
    ) in row.prompt
    assert row.prompt.endswith("around your response.\n\n")


def test_prompt_holds_at_most_the_limit(spark):
    frame = messages(spark, [(i * 0.5, str(i)) for i in range(60)])
    row = window_prompts(kept_messages(frame)).first()
    assert (row.message_count, row.bullets.split("\n")[0]) == (50, "- 10")


def test_request_body(spark):
    prompts = window_prompts(kept_messages(messages(spark, [(0, 'say "hi"\n')])))
    body = json.loads(window_requests(prompts, "some-model").first().request)
    assert list(body) == ["model", "messages"]
    assert body["model"] == "some-model"
    assert body["messages"][0] == {"role": "system", "content": "You are an expert in sentiment analysis."}
    assert body["messages"][1] == {"role": "user", "content": prompts.first().prompt}


def flaky(failures):
    left = [failures]

    def call(request):
        if left[0]:
            left[0] -= 1
            raise OSError(f"down {left[0]}")
        return "reply to " + request

    return call


def test_waits_double_between_attempts(monkeypatch):
    waits = []
    monkeypatch.setattr(enrichment.time, "sleep", waits.append)
    assert call_with_retries(flaky(2), "r", 3, 1000) == ("reply to r", 3, None)
    assert waits == [1, 2]
    waits.clear()
    assert call_with_retries(flaky(3), "r", 3, 1000) == (None, 3, "down 0")
    assert waits == [1, 2]
    assert call_with_retries(flaky(0), "r", 3, 1000) == ("reply to r", 1, None)


def test_other_errors_are_not_hidden():
    def broken(request):
        raise KeyError("bug")

    with pytest.raises(KeyError):
        call_with_retries(broken, "r", 3, 0)


def test_failed_windows_are_split_off(spark):
    def factory():
        calls = {}

        def call(request):
            calls[request] = calls.get(request, 0) + 1
            if "never" in request or ("later" in request and calls[request] < 3):
                raise OSError("busy")
            return json.dumps({"choices": [{"message": {"content": "fine"}}]})

        return call

    frame = messages(spark, [(0, "at once"), (60, "later"), (120, "never")])
    replies = narrative_branch(kept_messages(frame), factory, SETTINGS, parallelism=2)
    rows = replies.orderBy("win_start").collect()
    assert [(r.win_start, r.attempts, r.error) for r in rows] == [
        (at(0), 1, None), (at(60), 3, None), (at(120), 3, "busy"),
    ]
    assert [r.win_start for r in failed(replies).collect()] == [at(120)]
    assert {r.value for r in extract_content(answered(replies)).collect()} == {"fine"}


def test_keys_and_bounds_pass_through_the_calls(spark):
    plan = WindowPlan(keys=("channel",))
    frame = messages(spark, [(0, "x")]).selectExpr("*", "'C1' AS channel")
    requests = window_requests(window_prompts(kept_messages(frame, plan), plan), "m", plan)
    row = enrich(requests, lambda: (lambda request: "ok"), SETTINGS, plan).first()
    assert (row.channel, row.win_start, row.win_end, row.response) == ("C1", at(0), at(60), "ok")


CONTENT = '{"start":"31/07/2024 15:18:30","overallSentiment":"positive","messageCount":5}'


@pytest.mark.parametrize(
    "response, value",
    [
        (json.dumps({"id": "u", "usage": {"total": 2}, "choices": [{"index": 0, "message": {"role": "assistant", "content": CONTENT}}]}), CONTENT),
        ('{"choices":[{"message":{}}]}', ""),
        ('{"choices":[{}]}', ""),
        ('{"choices":[{"message":{"content":null}}]}', "null"),
        ('{"choices":[{"message":{"content":{"a":1}}}]}', ""),
        ('{"choices":[{"message":{"content":[1]}}]}', ""),
        ('{"choices":[{"message":{"content":7}}]}', "7"),
        ('{"choices":[{"message":{"content":true}}]}', "true"),
        ('{"choices":[{"message":{"content":"a"}},{"message":{"content":"b"}}]}', "a"),
        ('{"choices":[null]}', ""),
    ],
)
def test_content_of_the_first_choice(spark, response, value):
    replies = spark.createDataFrame([(response,)], "response string")
    assert [r.value for r in extract_content(replies).collect()] == [value]
    assert unusable_replies(replies).count() == 0


@pytest.mark.parametrize("response", ['{"choices":[]}', "{}", '{"choices":{"0":1}}', "not json", "", '{"choices":'])
def test_replies_without_a_choice_are_set_aside(spark, response):
    replies = spark.createDataFrame([(response,)], "response string")
    assert extract_content(replies).count() == 0
    assert unusable_replies(replies).count() == 1
