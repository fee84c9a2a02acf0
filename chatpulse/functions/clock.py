"""Wall-clock text of window bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How results print the bounds of a window.
DISPLAY_ZONE = "Europe/London"
DISPLAY_FORMAT = "dd/MM/yyyy HH:mm:ss"


def london_text(instant: Column | str) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` London time of an instant (session zone must be UTC)."""
    col = F.col(instant) if isinstance(instant, str) else instant
    return F.date_format(F.from_utc_timestamp(col, DISPLAY_ZONE), DISPLAY_FORMAT)


def london_instant(text: Column) -> Column:
    """The instant that a printed London time names; null if it can't be read.

    An hour is printed twice each autumn and counts as summer time here, so windows of its second
    run take the bounds of the first. Stored results, which carry their own bounds, have no such gap.
    """
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(DISPLAY_FORMAT)), DISPLAY_ZONE)


def window_key(start_text: Column, end_text: Column) -> Column:
    """The display key of a window, ``start - end``."""
    return F.concat(start_text, F.lit(" - "), end_text)
