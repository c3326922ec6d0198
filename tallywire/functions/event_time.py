"""Reading the published time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only date layout accepted.
PUBLISHED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_published_at(text: Column | str) -> Column:
    """Timestamp of a published-at text; null where the layout does not match.

    Fractional seconds, offsets other than ``Z``, impossible dates and free text
    all give null rather than failing the query.
    """
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text,
                              F.lit(PUBLISHED_AT_FORMAT))


def without_zone(instant: Column | str) -> Column:
    """The same wall-clock time as a zoneless timestamp."""
    return (F.col(instant) if isinstance(instant, str) else instant).cast("timestamp_ntz")
