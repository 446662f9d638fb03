"""Tolerant parsing and other scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three timestamp layouts of the input texts.
PLAIN_ISO = "yyyy-MM-dd'T'HH:mm:ss"
ZONED_ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
LOG_MILLIS = "yyyy/MM/dd HH:mm:ss.SSS"


def parse_ts(text: Column | str, layout: str, keep_fraction: bool = False) -> Column:
    """Text to timestamp; null for text that does not fit the layout.

    Whole seconds unless ``keep_fraction``, as a conversion through epoch
    seconds would give.
    """
    column = F.col(text) if isinstance(text, str) else text
    parsed = F.try_to_timestamp(column, F.lit(layout))
    return parsed if keep_fraction else F.date_trunc("second", parsed)


def from_epoch_millis(millis: Column | str) -> Column:
    """Epoch milliseconds to timestamp, fraction kept."""
    return F.timestamp_millis(millis)


# Fixed value: the characters that an identifier keeps, a-z, A-Z and 0-9.
def identifier(text: Column | str) -> Column:
    """Text with everything but ASCII letters and digits turned into underscores."""
    return F.regexp_replace(text, "[^a-zA-Z0-9]", "_")
