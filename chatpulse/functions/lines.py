"""Column expressions of the line format ``Timestamp: <s.micros>, User: <id>, Message: <text>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line layout shared with producers.
LINE_FORMAT = "Timestamp: %s, User: %s, Message: %s"
FIELD_BREAK = ", "
LABEL_BREAK = ": "

_LONG_MAX = (1 << 63) - 1


def line_of(timestamp: Column, user: Column, text: Column) -> Column:
    return F.format_string(LINE_FORMAT, timestamp, user, text)


def decoded(value: Column) -> Column:
    """UTF-8 text of bytes or a string; undecodable bytes become U+FFFD."""
    return F.make_valid_utf8(value.cast("string"))


def line_fields(text: Column) -> Column:
    """The (at most three) labelled fields of a line; the text keeps its own separators."""
    return F.split(text, FIELD_BREAK, 3)


def message_text(field: Column) -> Column:
    """Everything after the label, separators included; may be empty, null without a label."""
    at = F.locate(LABEL_BREAK, field)
    return F.when(at > 0, F.substring(field, at + F.lit(len(LABEL_BREAK)), F.length(field)))


def labelled_value(field: Column) -> Column:
    """Second ``": "`` piece of a field; null when only the label (and separators) is there."""
    rest = message_text(field)
    only_breaks = F.replace(rest, F.lit(LABEL_BREAK), F.lit("")) == ""
    return F.when(~only_breaks, F.substring_index(rest, LABEL_BREAK, 1))


def whole_seconds(text: Column) -> Column:
    """Number text truncated toward zero; null when it is no number.

    Not-a-number counts as 0 and values beyond a long stop at its ends.
    """
    number = text.try_cast("double")
    odd_spelling = F.lower(F.trim(text)).rlike("^[+-]?(inf|infinity|nan)$") & ~F.trim(text).rlike(
        "^[+-]?(Infinity|NaN)$"
    )
    return (
        F.when(F.abs(number) < float(_LONG_MAX), number.try_cast("bigint"))
        .when(odd_spelling, F.lit(None).cast("bigint"))
        .when(F.isnan(number), F.lit(0).cast("bigint"))
        .when(number > 0, F.lit(_LONG_MAX))
        .when(number < 0, F.lit(-_LONG_MAX - 1))
    )


def epoch_text(instant: Column) -> Column:
    """``seconds.micros`` of an instant, built from integers so that no digit is lost."""
    micros = F.unix_micros(instant)
    fraction = F.pmod(micros, F.lit(1_000_000))
    return F.format_string("%d.%06d", F.unix_seconds(instant), fraction)
