"""Messages to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.schemas import ARTICLE, POLL_RESPONSE


def message_text(value: Column | str = "value") -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def decode_messages(
    messages: DataFrame, schema: T.StructType = ARTICLE, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per message with the schema's fields as columns.

    Text that is not one JSON object gives a row of nulls; nothing fails and no
    row is lost. The struct is expanded by ``inline`` over a one-element array
    rather than by ``select("data.*")``: a later filter on a decoded field cannot
    be pushed below a generator, whereas below a projection it would be, and the
    JSON text would be parsed once for the filter and once more for the columns.
    """
    decoded = F.from_json(message_text(), schema)
    return messages.select(*keep, F.inline(F.array(decoded)))


def decode_poll_responses(responses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per article of every poll response; ``rejected_responses`` has those without."""
    decoded = F.from_json(message_text(), POLL_RESPONSE)
    return responses.select(*keep, F.inline(decoded["articles"]))


def rejected_responses(responses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Responses without a list of articles, as text: errors of the service, broken JSON."""
    decoded = F.from_json(message_text(), POLL_RESPONSE)
    return responses.where(decoded["articles"].isNull()).select(
        *keep, message_text().alias("value"))


def as_json(*columns: Column | str) -> Column:
    """JSON text of a row, null fields written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def encode_articles(articles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Articles as UTF-8 message bytes, fields in the published order."""
    return articles.select(*keep, F.encode(as_json(*ARTICLE.names), "UTF-8").alias("value"))
