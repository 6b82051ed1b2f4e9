"""Exchange-rate payloads as events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog import rules, schemas


def currency_list(text: str) -> tuple[str, ...]:
    """Codes of a comma-separated list, trimmed and in upper case; empty text gives none."""
    return tuple(part.strip().upper() for part in text.split(",") if part.strip())


def rates_to_events(
    payloads: DataFrame,
    currencies: Sequence[str] = rules.QUOTED_CURRENCIES,
    fetched_at: str | None = None,
) -> DataFrame:
    """One event per quoted currency from a table with a JSON column ``payload``.

    No currencies given keeps all. ``sorted_events`` puts them in order for display.
    """
    fetched = F.lit(fetched_at) if fetched_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
    )
    quotes = payloads.select(F.from_json("payload", schemas.RATES_PAYLOAD).alias("p")).select(
        F.col("p.base").alias("base"),
        F.col("p.date").alias("rate_date"),
        F.explode("p.rates").alias("currency", "rate"),
    )
    if currencies:
        quotes = quotes.filter(F.col("currency").isin(*currencies))
    return quotes.select(
        F.lit("exchange_rate").alias("event_type"),
        "base",
        "currency",
        F.round("rate", 6).alias("rate"),
        "rate_date",
        fetched.alias("fetched_at"),
    )


def sorted_events(events: DataFrame) -> DataFrame:
    return events.orderBy("currency", "rate_date", "base")
