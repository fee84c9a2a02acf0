"""Narrative branch: prompt, request, batch calls with retries, content of the reply."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.functions.clock import london_text
from chatpulse.functions.once import with_once
from chatpulse.operators.windows import order_key

#: Sends one request body and returns the reply body; raises ``OSError`` on any failure.
Client = Callable[[str], str]
#: Called once for each thread of a task that sends requests, so that connections live where they are used.
ClientFactory = Callable[[], Client]

# The instructions the model gets.
SYSTEM_PROMPT = "You are an expert in sentiment analysis."
PROMPT_FORMAT = """\
Please analyse the following set of Slack messages and provide a summary of the overall sentiment. \
Indicate whether the sentiment is very positive, positive, neutral, negative, or very negative. \
Provide a summary paragraph that describes the overall sentiment, including the general tone.

Window Start: %s
Window End: %s
Messages Processed: %d
Messages:
%s

Provide your answer in JSON format, as per the following structure:

{
  "start": "[Start Time]",
  "end": "[End Time]",
  "overallSentiment": "[Overall Sentiment]",
  "mostPositiveMessage": "[Most Positive Message]",
  "mostNegativeMessage": "[Most Negative Message]",
  "messageCount": [Message Count],
  "descriptiveParagraph": "[Descriptive Paragraph]"
}

Ensure that your answer is in JSON format, the JSON object is properly formatted and includes \
all the required fields. Do not include ```json or ``` around your response.

"""
BULLET = "- "
NULL_TEXT = "null"


def window_prompts(kept: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """``message_count, bullets, prompt`` per window.

    ``kept`` must come from ``keep_newest``: a window then lists at most ``plan.limit``
    messages, and the rows are already grouped where they are needed.
    """
    listed = F.struct(order_key(plan).alias("at"), F.coalesce("message", F.lit(NULL_TEXT)).alias("text"))
    bullets = F.array_join(
        F.transform(F.sort_array("_listed"), lambda m: F.concat(F.lit(BULLET), m["text"])), "\n"
    )
    return (
        kept.groupBy(*plan.group)
        .agg(F.collect_list(listed).alias("_listed"))
        .withColumn("message_count", F.size("_listed"))
        .withColumn("bullets", bullets)
        .withColumn(
            "prompt",
            F.format_string(
                PROMPT_FORMAT,
                london_text("win_start"),
                london_text("win_end"),
                F.col("message_count"),
                F.col("bullets"),
            ),
        )
        .drop("_listed")
    )


def window_requests(prompts: DataFrame, model: str, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """``request``: the JSON body to send for each window."""

    def entry(role: str, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    body = F.struct(
        F.lit(model).alias("model"),
        F.array(entry("system", F.lit(SYSTEM_PROMPT)), entry("user", F.col("prompt"))).alias("messages"),
    )
    return prompts.select(*plan.group, F.to_json(body).alias("request"))


def call_with_retries(client: Client, request: str, attempts: int, wait_ms: int) -> tuple[str | None, int, str | None]:
    """``(reply, attempts made, error)``; the wait doubles after every failure."""
    wait = wait_ms / 1000
    error = None
    for attempt in range(1, attempts + 1):
        try:
            return client(request), attempt, None
        except OSError as e:
            error = str(e) or type(e).__name__
            if attempt < attempts:
                time.sleep(wait)
                wait *= 2
    return None, attempts, error


def enrich(
    requests: DataFrame,
    client_factory: ClientFactory,
    settings: EnrichSettings,
    plan: WindowPlan = WindowPlan(),
    parallelism: int | None = None,
) -> DataFrame:
    """Call the model once per window: ``response, attempts, error``.

    ``parallelism`` fixes how many tasks call at the same time; without it the requests are
    spread over as many tasks as the cluster runs at once, whatever their partitioning
    was. A task has up to ``settings.calls`` calls under way, and takes a request out of Spark's batch when
    its turn comes. Every evaluation calls again, so write the result to a table before reading it more
    than once (the streaming job does; ``session.small_batches`` keeps what a task gets at a time small).
    """
    attempts, wait_ms, calls = settings.attempts, settings.wait_ms, settings.calls
    group = plan.group
    schema = T.StructType(
        [requests.schema[name] for name in group]
        + [
            T.StructField("response", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def call_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = threading.local()

        def ask(request: str) -> tuple[str | None, int, str | None]:
            if not hasattr(own, "client"):
                own.client = client_factory()
            return call_with_retries(own.client, request, attempts, wait_ms)

        def ask_in_turn(pool: ThreadPoolExecutor, requests: pa.Array) -> Iterator[tuple[str | None, int, str | None]]:
            under_way = deque()
            for request in requests:
                under_way.append(pool.submit(ask, request.as_py()))
                if len(under_way) >= 2 * calls:
                    yield under_way.popleft().result()
            while under_way:
                yield under_way.popleft().result()

        with ThreadPoolExecutor(calls) as pool:
            for batch in batches:
                replies = list(ask_in_turn(pool, batch.column("request")))
                responses, made, errors = zip(*replies) if replies else ((), (), ())
                told = [pa.array(responses, pa.string()), pa.array(made, pa.int32()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(name) for name in group] + told, names=schema.names)

    tasks = parallelism or requests.sparkSession.sparkContext.defaultParallelism
    # By a hash of its own: one by the group columns would be merged with the grouping's shuffle, which
    # adaptive execution may shrink to one task.
    return requests.repartition(tasks, F.xxhash64(*group)).mapInArrow(call_all, schema)


def answered(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("error").isNull()).drop("error")


def failed(enriched: DataFrame) -> DataFrame:
    """Windows whose calls all failed; they get no narrative result."""
    return enriched.where(F.col("error").isNotNull()).drop("response")


def _first_choice(response: str):
    return F.try_variant_get(F.try_parse_json(response), "$.choices[0]", "variant")


def extract_content(responses: DataFrame, response: str = "response") -> DataFrame:
    """``value``: text of the first choice, for every reply that has one.

    A choice without content gives ``""``, a JSON null gives ``"null"``, an object or
    list gives ``""``. Replies without a first choice, or that are no JSON, are left out
    (``unusable_replies`` returns them).
    """
    content = F.try_variant_get(F.col("_choice"), "$.message.content", "variant")
    kind = F.schema_of_variant(content)
    text = (
        F.when(content.isNull(), "")
        .when(F.is_variant_null(content), NULL_TEXT)
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), "")
        .otherwise(F.try_variant_get(F.col("_choice"), "$.message.content", "string"))
    )
    return (
        with_once(responses, _choice=_first_choice(response))
        .where(F.col("_choice").isNotNull())
        .withColumn("value", text)
        .drop("_choice", response)
    )


def unusable_replies(responses: DataFrame, response: str = "response") -> DataFrame:
    return responses.where(_first_choice(response).isNull())
