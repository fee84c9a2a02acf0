"""A deterministic stand-in for the model, for runs without a network."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable


def offline_client_factory(every: int = 5, down_at: int = 2, unusable_at: int = 4) -> Callable[[], Callable[[str], str]]:
    """Clients that repeat a prompt's bounds and message count in a whole, neutral reply.

    Of every ``every`` one-minute windows, the model is down for the one at ``down_at`` (it raises, on each
    attempt) and answers the one at ``unusable_at`` without JSON, whatever their size.
    """

    def open_client() -> Callable[[str], str]:
        def call(request: str) -> str:
            prompt = json.loads(request)["messages"][1]["content"]
            start = re.search(r"^Window Start: (.*)$", prompt, re.M).group(1)
            count = re.search(r"^Messages Processed: (\d+)$", prompt, re.M).group(1)
            turn = int(dt.datetime.strptime(start, "%d/%m/%Y %H:%M:%S").replace(tzinfo=dt.UTC).timestamp()) // 60 % every
            if turn == down_at:
                raise OSError("model unavailable")
            fields = {
                "start": start,
                "end": re.search(r"^Window End: (.*)$", prompt, re.M).group(1),
                "overallSentiment": "neutral",
                "mostPositiveMessage": "N/A",
                "mostNegativeMessage": "",
                "messageCount": int(count),
                "descriptiveParagraph": f"{count} messages were read.",
            }
            content = json.dumps(fields)
            if turn == unusable_at:
                content = "I can't say."
            return json.dumps({"choices": [{"message": {"role": "assistant", "content": content}}]})

        return call

    return open_client
